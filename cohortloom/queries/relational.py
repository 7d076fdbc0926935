"""Scans, filters, lookups, ordering and counts (A*, B*, C*, D*, E*, F*, U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as c, vocab
from ..operators import dedupe, lookup
from ..plans import report
from ..sources.delimited import col_or_null, drop_leading_rows, empty_table, rename_headers
from .registry import query, sql_content_id, sql_list, sql_pick

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


# ---- scans and filters ----

@query("q_a2", """
    SELECT o_orderkey, o_orderstatus FROM
      (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn FROM orders) WHERE rn > 2""")
def leading_rows(t):
    """Each status stands for a file whose first two rows are no data."""
    lines = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_orderstatus").alias("_file"),
                            F.lit(0).cast("bigint").alias("_block"), F.col("o_orderkey").alias("_line"))
    return drop_leading_rows(lines, 2).select("o_orderkey", "o_orderstatus")


@query("q_a7", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def missing_source(t):
    present = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return present.unionByName(empty_table(t.spark, present.schema))


@query("q_a8", "SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS notes FROM events")
def missing_column(t):
    events = t.events
    return events.select("event_id", col_or_null(events, "event_type").alias("event_type"),
                         col_or_null(events, "notes").alias("notes"))


@query("q_b1", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def equality(t):
    return t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")


@query("q_b2", "SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'small')")
def prefix(t):
    return t.part.where(F.col("p_name").startswith("small")).select("p_partkey", "p_name")


_SYMBOL = sql_pick(["", "nan", "?", None, "A", "B", "C"], "p_partkey")


@query("q_b3", f"""
    SELECT p_partkey, symbol FROM (SELECT p_partkey, {_SYMBOL} AS symbol FROM part)
    WHERE symbol IS NOT NULL AND symbol NOT IN ('', 'nan', '?')""")
def valid_symbols(t):
    return t.part.select("p_partkey", F.expr(_SYMBOL).alias("symbol")).where(c.valid_symbol("symbol"))


@query("q_b6", """
    SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'purchase') THEN event_type END AS event_type
    FROM events""")
def domain(t):
    return t.events.select("event_id", c.in_domain("event_type", ["click", "view", "purchase"]).alias("event_type"))


@query("q_b7", """
    SELECT p_partkey, coalesce(CASE WHEN p_size > 25 THEN p_brand END, p_type) AS barcode, p_name AS gene,
           'WES' AS sequencing_scope, 'GRCh38' AS reference_genome FROM part""")
def renamed(t):
    source = t.part.select(
        "p_partkey", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("Tumor_Sample_Barcode"),
        F.col("p_type").alias("SAMPLE_ID"), F.col("p_name").alias("Hugo_Symbol"))
    return rename_headers(source, vocab.VARIANT_HEADERS).withColumns({
        "sequencing_scope": F.lit("WES"), "reference_genome": F.lit(vocab.BUILD_TARGET)})


@query("q_b8", """
    SELECT event_type, count(v) AS n_kept, count(*) FILTER (WHERE isnan(v)) AS n_nan,
           count(*) FILTER (WHERE v >= 10 AND NOT isnan(v)) AS n_large
    FROM (SELECT event_type, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'nan'::DOUBLE
                                  ELSE value END AS v FROM events) WHERE v IS NOT NULL GROUP BY event_type""")
def null_free(t):
    v = F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 11 == 0, float("nan")).otherwise(F.col("value"))
    kept = lookup.null_free(t.events.select("event_type", v.alias("v")), "v")
    return kept.groupBy("event_type").agg(
        F.count("v").alias("n_kept"), F.count_if(F.isnan("v")).alias("n_nan"),
        F.count_if((F.col("v") >= 10) & ~F.isnan("v")).alias("n_large"))


_KEYED = sql_pick(["", "NA", "  ", None, " x ", "y", "[Unknown]"], "o_orderkey")


@query("q_b9", f"""
    SELECT o_orderkey, trim(k) AS k FROM (SELECT o_orderkey, {_KEYED} AS k FROM orders)
    WHERE k IS NOT NULL AND trim(k) NOT IN ({sql_list(vocab.NULL_SENTINELS)})""")
def blank_keys(t):
    return t.orders.select("o_orderkey", c.clean_text(F.expr(_KEYED)).alias("k")).where(F.col("k").isNotNull())


_RAW_A = sql_pick(["", None, "NA", "a"], "o_orderkey")
_RAW_B = sql_pick(["", None, "NA", "b", "o_orderpriority"], "o_custkey").replace("'o_orderpriority'", "o_orderpriority")


@query("q_b10", f"""
    SELECT o_orderkey, CASE WHEN a <> '' THEN a WHEN b <> '' THEN b ELSE '' END AS raw,
           CASE WHEN a <> '' THEN a ELSE o_custkey || '-T' END AS sample_id
    FROM (SELECT *, {_RAW_A} AS a, {_RAW_B} AS b FROM orders)""")
def raw_fallback(t):
    return t.orders.select(
        "o_orderkey", c.first_nonblank(F.expr(_RAW_A), F.expr(_RAW_B)).alias("raw"),
        c.first_nonblank(F.expr(_RAW_A), F.expr("o_custkey || '-T'")).alias("sample_id"))


@query("q_b11", f"""
    SELECT o_orderkey, CASE WHEN a NOT IN ('', 'NA') THEN a WHEN b NOT IN ('', 'NA') THEN b END AS cleaned
    FROM (SELECT *, {_RAW_A} AS a, {_RAW_B} AS b FROM orders)""")
def clean_fallback(t):
    return t.orders.select("o_orderkey", c.first_clean(F.expr(_RAW_A), F.expr(_RAW_B)).alias("cleaned"))


_HER2 = sql_pick(["Positive", "Negative", "Equivocal", "Unknown"], "o_orderkey")
_FISH = sql_pick(["Positive", "Negative", "Equivocal", "Unknown", None], "o_custkey")


@query("q_b13", f"""
    SELECT o_orderkey, CASE WHEN h = 'Equivocal' AND f IN ('Positive', 'Negative') THEN f ELSE h END AS status
    FROM (SELECT o_orderkey, {_HER2} AS h, {_FISH} AS f FROM orders)""")
def equivocal(t):
    return t.orders.select("o_orderkey", c.resolve_equivocal(F.expr(_HER2), F.expr(_FISH)).alias("status"))


# ---- lookups ----

@query("q_c1", """
    SELECT c_custkey AS patient_id, c_acctbal AS amount, o_totalprice AS amount_s, o_orderkey AS sample_id
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def suffix_join(t):
    patients = t.customer.select(F.col("c_custkey").alias("patient_id"), F.col("c_acctbal").alias("amount"))
    samples = t.orders.select(F.col("o_custkey").alias("patient_id"), F.col("o_totalprice").alias("amount"),
                              F.col("o_orderkey").alias("sample_id"))
    return lookup.join_with_suffix(patients, samples, "patient_id", "_s")


_STATUS = "CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE 'Unknown' END"


@query("q_c2", f"""
    SELECT c_custkey, CASE WHEN s <> 'Unknown' THEN s ELSE coalesce(event_type, 'Unknown') END AS status
    FROM (SELECT c_custkey, {_STATUS} AS s FROM customer) LEFT JOIN
         (SELECT user_id, event_type,
                 row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) e
      ON c_custkey = user_id AND rn = 1""")
def last_value(t):
    latest = lookup.last_value_lookup(
        t.events.select(F.col("user_id").alias("c_custkey"), "event_type", "ts", "event_id"),
        "c_custkey", ["ts", "event_id"])
    return t.customer.select("c_custkey", F.expr(_STATUS).alias("s")).join(latest, "c_custkey", "left").select(
        "c_custkey", c.known_or(F.col("s"), F.col("event_type")).alias("status"))


def _known_customers(t):
    return t.customer.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))


@query("q_c4", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def semi_join(t):
    return lookup.members(t.orders.select("o_orderkey", "o_custkey"), _known_customers(t), "o_custkey")


@query("q_c4b", """
    SELECT count(*) FILTER (WHERE c_custkey IS NOT NULL) AS n_matched,
           count(*) FILTER (WHERE c_custkey IS NULL) AS n_skipped
    FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey""")
def matched_and_skipped(t):
    return lookup.member_counts(t.orders, _known_customers(t), "o_custkey")


@query("q_c5", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def anti_join(t):
    return lookup.non_members(t.orders.select("o_orderkey", "o_custkey"), _known_customers(t), "o_custkey")


_GENE = "CASE WHEN l_suppkey % 10 = 0 THEN '?' WHEN l_suppkey % 10 = 1 THEN 'nan' ELSE 'S' || l_suppkey END"


_PART_GENE = _GENE.replace("'S' || l_suppkey", "'S' || l_suppkey || '-' || l_partkey")


@query("q_c6", f"""
    SELECT * FROM (SELECT {_PART_GENE} AS gene FROM lineitem WHERE l_returnflag = 'R'
                   INTERSECT SELECT {_PART_GENE} FROM lineitem WHERE l_returnflag <> 'R')
    WHERE gene NOT IN ('', 'nan', '?')""")
def shared_genes(t):
    returned = F.col("l_returnflag") == "R"
    cohorts = [t.lineitem.where(f).select(F.expr(_PART_GENE).alias("gene")) for f in (returned, ~returned)]
    return lookup.shared_keys(*cohorts, "gene").where(c.valid_symbol("gene"))


@query("q_c8", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity = 50)
                THEN 1 ELSE 0 END AS in_panel FROM lineitem""")
def panel_flag(t):
    panel = t.lineitem.where("l_returnflag = 'R' AND l_quantity = 50").select("l_partkey")
    return lookup.flag_members(t.lineitem.select(*LINE_KEY), panel, "l_partkey", "in_panel").select(*LINE_KEY, "in_panel")


# ---- ordering ----

@query("q_e1", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM
      (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                    ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""")
def first_row(t):
    lines = t.lineitem.select(*LINE_KEY, "l_quantity", "l_shipdate")
    return dedupe.keep_first(lines, LINE_KEY[:2], ["l_shipdate", "l_partkey", "l_suppkey"]).drop("l_shipdate")


@query("q_e2", """
    SELECT event_id, user_id,
           format('TX-{:06d}', row_number() OVER (ORDER BY ts, event_id)) AS treatment_id FROM events""")
def numbered(t):
    events = t.events.select("event_id", "user_id", "ts")
    return dedupe.sequential_ids(events, "treatment_id", "TX-", ["ts", "event_id"]).drop("ts")


_THIRD = "CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' ELSE l_returnflag END"


@query("q_e5", f"""
    WITH k AS (SELECT l_orderkey, l_linenumber, {_THIRD} AS flag FROM lineitem),
    c AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, flag) AS n FROM k)
    SELECT l_orderkey, l_linenumber, flag, {sql_content_id("MUT-", ["l_orderkey", "l_linenumber", "flag"], "n")} AS mutation_id FROM c""")
def hashed(t):
    """Null and empty values in the key, and copies."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.expr(_THIRD).alias("flag"))
    return dedupe.content_ids(lines, "mutation_id", "MUT-", ["l_orderkey", "l_linenumber", "flag"])


# ---- counts ----

TABLE_NAMES = ["customer", "supplier", "part", "orders", "lineitem", "events"]


@query("q_d1", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in TABLE_NAMES))
def row_counts(t):
    return report.table_counts({n: getattr(t, n) for n in TABLE_NAMES})


_NULLED = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END"


@query("q_d2", f"SELECT coalesce({_NULLED}, 'NULL') AS value, count(*) AS n_rows FROM orders GROUP BY 1")
def grouped_counts(t):
    return report.group_counts(t.orders.select(F.expr(_NULLED).alias("status")), "status")


@query("q_d13", """
    SELECT count(*) AS n_total, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
           round(count(*) FILTER (WHERE l_returnflag = 'R') * 100.0::DOUBLE / count(*), 1) AS pct_returned,
           count(*) FILTER (WHERE l_quantity > 25) AS n_large,
           round(count(*) FILTER (WHERE l_quantity > 25) * 100.0::DOUBLE / count(*), 1) AS pct_large FROM lineitem""")
def conditional_counts(t):
    return report.condition_counts(t.lineitem, {
        "returned": F.col("l_returnflag") == "R", "large": F.col("l_quantity") > 25})


@query("q_f2", "SELECT o_orderpriority AS value, count(*) AS n_rows FROM orders GROUP BY 1 ORDER BY 2 DESC, 1")
def ranked_counts(t):
    return report.largest_first(report.group_counts(t.orders, "o_orderpriority"), "n_rows", "value")


@query("q_f3", "SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest(t):
    return report.latest_row(t.events, ["ts", "event_id"]).select("event_id", "user_id", "event_type")


# ---- unions ----

@query("q_u1", """
    SELECT 'A' AS study, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'B', s_name, s_acctbal FROM supplier""")
def cohort_union(t):
    a = t.customer.select(F.lit("A").alias("study"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.lit("B").alias("study"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return a.unionByName(b)


_RAW_TYPE = sql_pick(["Chemotherapy", "Targeted Molecular therapy", "Ancillary", "Vaccine", None], "event_id")


@query("q_u2", f"""
    SELECT event_id, user_id AS patient_id, kind AS treatment_type,
           format('TX-{{:06d}}', row_number() OVER (ORDER BY src, ts, event_id)) AS treatment_id FROM (
      SELECT 1 AS src, event_id, user_id, ts, CASE {_RAW_TYPE} WHEN 'Chemotherapy' THEN 'Chemotherapy'
             WHEN 'Targeted Molecular therapy' THEN 'Targeted Therapy' ELSE 'Other' END AS kind
      FROM events WHERE event_type IN ('click', 'signup')
      UNION ALL SELECT 2, event_id, user_id, ts, 'Radiation' FROM events WHERE event_type IN ('view', 'error')
      UNION ALL SELECT 3, event_id, user_id, ts, 'Surgery' FROM events WHERE event_type = 'purchase')""")
def treatment_union(t):
    def source(rank, event_types, kind):
        return t.events.where(F.col("event_type").isin(event_types)).select(
            F.lit(rank).alias("src"), "event_id", F.col("user_id").alias("patient_id"), "ts", kind.alias("treatment_type"))

    merged = (
        source(1, ["click", "signup"], c.therapy_type(F.expr(_RAW_TYPE)))
        .unionByName(source(2, ["view", "error"], F.lit("Radiation")))
        .unionByName(source(3, ["purchase"], F.lit("Surgery")))
    )
    return dedupe.sequential_ids(merged, "treatment_id", "TX-", ["src", "ts", "event_id"]).drop("src", "ts")
