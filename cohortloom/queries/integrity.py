"""Constraint checks, loads and the audit log (S*, K*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from ..operators import cascade as walk, key_index, quality as q
from ..operators.dedupe import sequential_numbers
from ..plans.schema import SEED_LOG
from ..plans.store import LOG_FIELDS, audit_rows, number_audit_rows
from .registry import query, sql_list

LINES = q.TableSpec(
    "lines",
    T.StructType([
        T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_partkey", T.LongType()), T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_quantity", T.DoubleType()), T.StructField("l_returnflag", T.StringType()),
    ]),
    key=["l_orderkey", "l_linenumber"],
    not_null=["l_quantity"],
    checks={**q.enum_check("l_returnflag", ["R", "A"]), "l_quantity": "l_quantity <= 45"},
    foreign_keys=[q.ForeignKey("l_suppkey", "supplier", "s_suppkey")],
)
ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]
_QUANTITY = "CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE l_quantity END"


def _load(t) -> q.Insert:
    """Lines with some quantities lost; those without tax are stored already."""
    batch = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.expr(_QUANTITY).alias("l_quantity"),
        "l_returnflag", "l_shipdate")
    existing = t.lineitem.where(F.col("l_tax") == 0).select(*LINES.key)
    return q.insert_ignore(LINES, batch, ORDER, existing)


_LOAD_SQL = f"""
    batch AS (SELECT *, {_QUANTITY} AS qty FROM lineitem),
    checked AS (SELECT *, qty IS NULL AS no_qty, l_returnflag NOT IN ('R', 'A') AS bad_flag,
                       coalesce(qty > 45, FALSE) AS bad_qty FROM batch),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                            ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn
               FROM checked WHERE NOT (no_qty OR bad_flag OR bad_qty)),
    old AS (SELECT DISTINCT l_orderkey, l_linenumber, 1 AS known FROM lineitem WHERE l_tax = 0),
    placed AS (SELECT r.*, known FROM ranked r LEFT JOIN old USING (l_orderkey, l_linenumber))"""


@query("q_s1", f"""
    WITH {_LOAD_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, qty AS l_quantity, l_returnflag
    FROM placed WHERE rn = 1 AND known IS NULL""")
def stored(t):
    return _load(t).stored


@query("q_s1_counts", f"""
    WITH {_LOAD_SQL} SELECT (SELECT count(*) FROM lineitem) AS n_attempted, count(*) AS n_stored,
           (SELECT count(*) FROM lineitem) - count(*) AS n_rejected FROM placed WHERE rn = 1 AND known IS NULL""")
def load_counts(t):
    load = _load(t)
    parts = load.stored.select(F.lit(1).alias("stored")).unionByName(load.rejected.select(F.lit(0).alias("stored")))
    return parts.agg(
        F.count("*").alias("n_attempted"), F.count_if(F.col("stored") == 1).alias("n_stored"),
        F.count_if(F.col("stored") == 0).alias("n_rejected"))


@query("q_d_reject", f"""
    WITH {_LOAD_SQL} SELECT reason, count(*) AS n_rows FROM (
        SELECT 'not_null:l_quantity' AS reason FROM checked WHERE no_qty
        UNION ALL SELECT 'check:l_returnflag' FROM checked WHERE bad_flag
        UNION ALL SELECT 'check:l_quantity' FROM checked WHERE bad_qty
        UNION ALL SELECT 'duplicate_in_batch' FROM ranked WHERE rn > 1
        UNION ALL SELECT 'already_stored' FROM placed WHERE rn = 1 AND known = 1) GROUP BY reason""")
def reject_reasons(t):
    reasons = _load(t).rejected.select(F.explode("reasons").alias("reason"))
    return reasons.groupBy("reason").agg(F.count("*").alias("n_rows"))


_GROUPS = "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL"


@query("q_s2", f"""
    SELECT * FROM (VALUES {", ".join(f"({i}::BIGINT, {sql_list(list(r))})" for i, r in enumerate(SEED_LOG, 1))})
        v(log_id, {", ".join(LOG_FIELDS)})
    UNION ALL
    SELECT {len(SEED_LOG)} + row_number() OVER (ORDER BY o_orderstatus, o_orderpriority), 'orders', 'BOTH',
           o_orderstatus, 'n=' || n, 'o_orderpriority', o_orderpriority FROM ({_GROUPS})""")
def audit_log(t):
    seeds = audit_rows(t.spark, SEED_LOG).select("log_id", *LOG_FIELDS)
    groups = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    new = groups.select(
        F.lit("orders").alias("table_name"), F.lit("BOTH").alias("study_source"),
        F.col("o_orderstatus").alias("field_name"), F.concat(F.lit("n="), "n").alias("transformation"),
        F.lit("o_orderpriority").alias("source_field"), F.col("o_orderpriority").alias("notes"))
    return seeds.unionByName(number_audit_rows(seeds, new, ["field_name", "notes"]))


ORDERS = q.TableSpec(
    "orders",
    T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_orderpriority", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()), T.StructField("reference_genome", T.StringType()),
    ]),
    key=["o_orderkey"],
    not_null=["o_totalprice", "o_orderstatus"],
    checks={
        **q.enum_check("o_orderstatus", ["O", "F"]),
        **q.enum_check("o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"]),
        "o_totalprice": "o_totalprice >= 1000.0 AND o_totalprice <= 400000.0",
    },
    foreign_keys=[q.ForeignKey("o_custkey", "customer", "c_custkey")],
    defaults={"reference_genome": "GRCh38"},
)
_PRICE = "CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE o_totalprice END"
_STATUS = "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderstatus END"


@query("q_k1", f"""
    SELECT o_orderkey, concat_ws(',',
        CASE WHEN price IS NULL THEN 'not_null:o_totalprice' END,
        CASE WHEN status IS NULL THEN 'not_null:o_orderstatus' END,
        CASE WHEN status NOT IN ('O', 'F') THEN 'check:o_orderstatus' END,
        CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW') THEN 'check:o_orderpriority' END,
        CASE WHEN price < 1000.0 OR price > 400000.0 THEN 'check:o_totalprice' END) AS broken
    FROM (SELECT *, {_PRICE} AS price, {_STATUS} AS status FROM orders)""")
def rules(t):
    batch = t.orders.withColumns({"o_totalprice": F.expr(_PRICE), "o_orderstatus": F.expr(_STATUS)})
    return batch.select("o_orderkey", F.concat_ws(",", q.violations(ORDERS)).alias("broken"))


def _known_suppliers(t):
    return t.supplier.where(F.col("s_acctbal") > 2000).select("s_suppkey")


@query("q_k4", """
    SELECT DISTINCT l_suppkey AS s_suppkey FROM lineitem
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 2000)""")
def orphan_keys(t):
    return q.orphan_keys(t.lineitem, LINES.foreign_keys[0], _known_suppliers(t))


@query("q_k4_rows", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 2000) THEN 0 ELSE 1 END AS orphan
    FROM lineitem""")
def orphan_rows(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    good, bad = q.quarantine_orphans(lines, LINES.foreign_keys[0], _known_suppliers(t))
    return good.withColumn("orphan", F.lit(0)).unionByName(bad.withColumn("orphan", F.lit(1)))


@query("q_k5", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def cascade(t):
    deleted = t.customer.where(F.col("c_mktsegment") == "MACHINERY")
    return q.cascade_delete(t.orders.select("o_orderkey", "o_custkey"), ORDERS.foreign_keys[0], deleted)


CUSTOMERS = q.TableSpec("customer", T.StructType([T.StructField("c_custkey", T.LongType())]), key=["c_custkey"])
LINES_OF_ORDERS = q.TableSpec(
    "lineitem", LINES.schema, key=LINES.key, foreign_keys=[
        q.ForeignKey("l_orderkey", "orders", "o_orderkey"), q.ForeignKey("l_suppkey", "supplier", "s_suppkey")])
SUPPLIERS = q.TableSpec(
    "supplier", T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_nationkey", T.IntegerType())]),
    key=["s_suppkey"], foreign_keys=[q.ForeignKey("s_nationkey", "nation", "n_nationkey")])
NATIONS = q.TableSpec("nation", T.StructType([T.StructField("n_nationkey", T.IntegerType())]), key=["n_nationkey"])
BUYERS = q.TableSpec("customer", CUSTOMERS.schema, key=["c_custkey"], foreign_keys=[
    q.ForeignKey("c_nationkey", "nation", "n_nationkey")])
# Children are listed before their parents: the walk finds the order.
CHAIN = [LINES_OF_ORDERS, ORDERS, CUSTOMERS]
DIAMOND = [LINES_OF_ORDERS, ORDERS, BUYERS, SUPPLIERS, NATIONS]


def _listed(tables: dict, keys: dict[str, list[str]]):
    """(table_name, k1, k2): the keys of the rows of several tables."""
    parts = [tables[name].select(F.lit(name).alias("table_name"), F.col(cols[0]).cast("bigint").alias("k1"),
                                 (F.col(cols[1]) if len(cols) > 1 else F.lit(None)).cast("bigint").alias("k2"))
             for name, cols in keys.items()]
    return reduce(DataFrame.unionByName, parts)


@query("q_k5_chain", """
    WITH c AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY'),
    o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c))
    SELECT 'customer' AS table_name, CAST(c_custkey AS BIGINT) AS k1, CAST(NULL AS BIGINT) AS k2 FROM customer
    WHERE c_custkey NOT IN (SELECT c_custkey FROM c)
    UNION ALL SELECT 'orders', o_orderkey, NULL FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)
    UNION ALL SELECT 'lineitem', l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o)""")
def cascade_chain(t):
    """Customers of a segment go, with their orders and the lines of these."""
    tables = {"customer": t.customer, "orders": t.orders, "lineitem": t.lineitem}
    kept = walk.surviving_rows(tables, CHAIN, "customer", t.customer.where(F.col("c_mktsegment") == "MACHINERY"))
    return _listed(kept, {"customer": ["c_custkey"], "orders": ["o_orderkey"], "lineitem": LINES.key})


@query("q_k5_diamond", """
    WITH n AS (SELECT n_nationkey FROM nation WHERE n_regionkey = 2),
    c AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n)),
    s AS (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n)),
    o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c))
    SELECT 'nation' AS table_name, CAST(n_nationkey AS BIGINT) AS k1, CAST(NULL AS BIGINT) AS k2 FROM n
    UNION ALL SELECT 'customer', c_custkey, NULL FROM c
    UNION ALL SELECT 'supplier', s_suppkey, NULL FROM s
    UNION ALL SELECT 'orders', o_orderkey, NULL FROM o
    UNION ALL SELECT 'lineitem', l_orderkey, l_linenumber FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM o) OR l_suppkey IN (SELECT s_suppkey FROM s)""")
def cascade_diamond(t):
    """The nations of a region go; a line goes with its order or with its supplier, once."""
    tables = {n: getattr(t, n) for n in ("nation", "customer", "supplier", "orders", "lineitem")}
    gone = walk.doomed_rows(tables, DIAMOND, "nation", t.nation.where(F.col("n_regionkey") == 2))
    return _listed(gone, {"nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
                          "orders": ["o_orderkey"], "lineitem": LINES.key})


_LINE_KEYS = ["l_orderkey", "l_linenumber"]


@query("q_s1_ranges", """
    WITH f AS (SELECT l_orderkey // 1000 AS file, min((l_orderkey, l_linenumber)) AS low, max((l_orderkey, l_linenumber)) AS high,
                      count(*) AS n_keys FROM lineitem GROUP BY 1),
    b AS (SELECT min((l_orderkey, l_linenumber)) AS low, max((l_orderkey, l_linenumber)) AS high FROM lineitem
          WHERE l_tax = 0 AND l_quantity >= 49 AND l_discount >= 0.1)
    SELECT CAST(f.file AS VARCHAR) AS file, f.n_keys, CAST(f.low[1] AS BIGINT) AS low_order, CAST(f.high[1] AS BIGINT) AS high_order
    FROM f, b WHERE f.high >= b.low AND f.low <= b.high""")
def key_ranges(t):
    """Thousands of order numbers stand in for files: those that overlap the keys of a batch of large lines."""
    rows = t.lineitem.select(F.floor(F.col("l_orderkey") / 1000).cast("string").alias("file"), *_LINE_KEYS)
    batch = t.lineitem.where("l_tax = 0 AND l_quantity >= 49 AND l_discount >= 0.1").select(*_LINE_KEYS)
    found = key_index.in_range(key_index.file_ranges(rows, _LINE_KEYS), batch, _LINE_KEYS)
    return found.select("file", "n_keys", F.col("low.l_orderkey").alias("low_order"), F.col("high.l_orderkey").alias("high_order"))


@query("q_k6", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, 'GRCh38' AS reference_genome FROM orders""")
def defaults(t):
    return q.conform(t.orders, ORDERS)


@query("q_s2_ids", """
    SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS log_id FROM orders""")
def running_numbers(t):
    numbered = sequential_numbers(t.orders.select("o_orderkey", "o_orderdate"), "log_id", ["o_orderdate", "o_orderkey"])
    return numbered.select("o_orderkey", "log_id")
