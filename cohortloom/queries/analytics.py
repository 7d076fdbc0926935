"""Views, reshaping, liftover and batch correction (V*, G*, I*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import clean as c, vocab
from ..operators import combat, liftover, reshape
from ..operators.lookup import flag_members
from ..plans import genomics, report, views
from ..plans.store import Store
from ..session import shared_folder
from ..sources.matrix import Matrix, read_matrix
from .registry import query, sql_pick

# ---- views ----

_STUDY = "CASE WHEN c_custkey % 2 = 0 THEN 'TCGA-BRCA' ELSE 'METABRIC' END"
_SUBTYPE = "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END"
_PANEL = "SELECT p_brand FROM part WHERE p_type = 'PROMO' AND p_size = 1"
_STAR = f"""
    patients AS (SELECT c_custkey AS patient_id, {_STUDY} AS study_source, c_acctbal AS os_months FROM customer),
    tumors AS (SELECT o_orderkey AS tumor_id, o_custkey AS patient_id, {_SUBTYPE} AS pam50_subtype,
                      o_totalprice AS tumor_size_cm FROM orders),
    mutations AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS mutation_id,
                         l_orderkey AS tumor_id, p_brand AS gene_symbol, l_discount AS vaf,
                         CASE WHEN l_returnflag = 'R' THEN 'WES' ELSE 'PANEL' END AS sequencing_scope,
                         CASE WHEN l_linestatus = 'F' THEN 'GRCh38' END AS reference_genome,
                         CASE WHEN p_brand IN ({_PANEL}) THEN 1 ELSE 0 END AS in_metabric_panel
                  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def patients(t):
    return t.customer.select(F.col("c_custkey").alias("patient_id"), F.expr(_STUDY).alias("study_source"),
                             F.col("c_acctbal").alias("os_months"))


def tumors(t):
    return t.orders.select(F.col("o_orderkey").alias("tumor_id"), F.col("o_custkey").alias("patient_id"),
                           F.expr(_SUBTYPE).alias("pam50_subtype"), F.col("o_totalprice").alias("tumor_size_cm"))


def mutations(t):
    """Line items with their part's brand as gene; the panel is flagged on the parts."""
    genes = t.part.select("p_partkey", F.col("p_brand").alias("gene_symbol"))
    panel = t.part.where("p_type = 'PROMO' AND p_size = 1").select(F.col("p_brand").alias("gene_symbol"))
    flagged = flag_members(genes, panel, "gene_symbol", "in_metabric_panel", large=False)
    return t.lineitem.join(flagged, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("mutation_id"),
        F.col("l_orderkey").alias("tumor_id"), "gene_symbol", F.col("l_discount").alias("vaf"),
        F.when(F.col("l_returnflag") == "R", "WES").otherwise("PANEL").alias("sequencing_scope"),
        F.when(F.col("l_linestatus") == "F", vocab.BUILD_TARGET).alias("reference_genome"), "in_metabric_panel")


@query("q_v1", f"""
    WITH {_STAR} SELECT patient_id, study_source, os_months, tumor_id, pam50_subtype, tumor_size_cm
    FROM patients JOIN tumors USING (patient_id)""")
def patient_tumor(t):
    return views.patient_tumor(patients(t), tumors(t), ["patient_id", "study_source", "os_months"],
                               ["tumor_id", "pam50_subtype", "tumor_size_cm"])


@query("q_v2", f"""
    WITH {_STAR} SELECT mutation_id, study_source, tumor_id, gene_symbol, vaf, sequencing_scope
    FROM mutations JOIN tumors USING (tumor_id) JOIN patients USING (patient_id) WHERE in_metabric_panel = 1""")
def cross_study(t):
    return views.mutations_cross_study(
        mutations(t), patients(t), tumors(t),
        ["mutation_id", "study_source", "tumor_id", "gene_symbol", "vaf", "sequencing_scope"])


@query("q_v3", f"""
    WITH {_STAR} SELECT study_source, gene_symbol, count(DISTINCT m.tumor_id) AS n_mutated_samples,
           count(DISTINCT t.tumor_id) AS n_total_samples_in_study,
           round(count(DISTINCT m.tumor_id)::DOUBLE / count(DISTINCT t.tumor_id)::DOUBLE * 100, 2) AS mutation_pct
    FROM mutations m JOIN tumors t ON m.tumor_id = t.tumor_id JOIN patients p ON t.patient_id = p.patient_id
    WHERE in_metabric_panel = 1 GROUP BY study_source, gene_symbol""")
def frequency(t):
    return views.mutation_frequency(mutations(t), patients(t), tumors(t), parity=True)


@query("q_v3b", f"""
    WITH {_STAR}, totals AS (SELECT study_source, count(*) AS n FROM tumors JOIN patients USING (patient_id) GROUP BY 1)
    SELECT study_source, gene_symbol, count(DISTINCT m.tumor_id) AS n_mutated_samples,
           any_value(n) AS n_total_samples_in_study,
           round(count(DISTINCT m.tumor_id)::DOUBLE / any_value(n)::DOUBLE * 100, 2) AS mutation_pct
    FROM mutations m JOIN tumors t ON m.tumor_id = t.tumor_id JOIN patients p ON t.patient_id = p.patient_id
         JOIN totals USING (study_source)
    WHERE in_metabric_panel = 1 GROUP BY study_source, gene_symbol""")
def frequency_of_study(t):
    return views.mutation_frequency(mutations(t), patients(t), tumors(t), parity=False)


_EVENT_FLAGS = {f"had_{e}": e for e in ["signup", "error", "click", "view", "purchase"]}


@query("q_v4", "SELECT user_id AS patient_id, " + ", ".join(
    f"max(CASE WHEN event_type = '{e}' AND value >= 10 THEN 1 ELSE 0 END) AS {n}" for n, e in _EVENT_FLAGS.items()
) + " FROM events GROUP BY user_id")
def treatment_summary(t):
    treatments = t.events.select(
        F.col("user_id").alias("patient_id"), F.col("event_type").alias("treatment_type"),
        F.when(F.col("value") >= 10, 1).otherwise(0).alias("received"))
    return views.treatment_summary(treatments, _EVENT_FLAGS)


@query("q_v5", f"""
    WITH {_STAR}
    SELECT 'Rows' AS section, 'patients' AS value, count(*) AS n_rows FROM patients
    UNION ALL SELECT 'Rows', 'tumors', count(*) FROM tumors UNION ALL SELECT 'Rows', 'mutations', count(*) FROM mutations
    UNION ALL SELECT 'Patients by study', study_source, count(*) FROM patients GROUP BY 2
    UNION ALL SELECT 'Tumors by PAM50', coalesce(pam50_subtype, 'NULL'), count(*) FROM tumors GROUP BY 2
    UNION ALL SELECT 'Mutations by scope', sequencing_scope, count(*) FROM mutations GROUP BY 2
    UNION ALL SELECT 'Mutations by genome build', coalesce(reference_genome, 'NULL'), count(*) FROM mutations GROUP BY 2""")
def summary(t):
    return report.database_summary({"patients": patients(t), "tumors": tumors(t), "mutations": mutations(t)})


# ---- reshaping ----

_EVENT_TYPES = ["signup", "error", "click", "view", "purchase"]


@query("q_g1", f"""
    SELECT u.user_id, e.event_type, max(value) AS value
    FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (VALUES {", ".join(f"('{e}')" for e in _EVENT_TYPES)}) e(event_type)
         LEFT JOIN events v ON v.user_id = u.user_id AND v.event_type = e.event_type GROUP BY 1, 2""")
def unpivot(t):
    wide = t.events.groupBy("user_id").pivot("event_type", _EVENT_TYPES).agg(F.max("value"))
    return reshape.unpivot(wide, ["user_id"], _EVENT_TYPES, "event_type", "value")


# Cells brand x supplier: some samples lose about half of their values, one brand is rare.
_HOLES = """CASE WHEN (l_suppkey * 7 + b) % 13 = 0 OR (l_suppkey % 10 = 0 AND b % 2 = 1)
                   OR (l_suppkey % 10 = 1 AND b % 2 = 0) OR (b = 13 AND l_suppkey > 3) THEN NULL ELSE total END"""
_CELLS = f"""
    cells AS (SELECT p_brand AS feature, l_suppkey AS sample, CASE WHEN l_suppkey % 2 = 0 THEN 'A' ELSE 'B' END AS batch,
                     {_HOLES} AS value
              FROM (SELECT p_brand, l_suppkey, CAST(substr(p_brand, 7) AS INTEGER) AS b, sum(l_quantity) AS total
                    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, l_suppkey))"""


def cells(t):
    brands = t.part.select("p_partkey", "p_brand")
    totals = (
        t.lineitem.select("l_partkey", "l_suppkey", "l_quantity")
        .join(brands, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand", "l_suppkey").agg(F.sum("l_quantity").alias("total"))
        .withColumn("b", F.substring("p_brand", 7, 3).cast("int"))
    )
    return totals.select(
        F.col("p_brand").alias("feature"), F.col("l_suppkey").alias("sample"),
        F.when(F.col("l_suppkey") % 2 == 0, "A").otherwise("B").alias("batch"), F.expr(_HOLES).alias("value"))


@query("q_g2", f"""
    WITH {_CELLS}, n AS (SELECT count(*) AS n FROM supplier),
    stats AS (SELECT feature, avg(value) AS mu, sqrt(var_pop(value) * n / (n - 1)) AS sigma FROM cells, n GROUP BY feature, n)
    SELECT feature, sample, value, CASE WHEN sigma > 0 THEN round((value - mu) / sigma, 4) + 0.0 ELSE 0.0 END AS z_score
    FROM cells JOIN stats USING (feature) WHERE value IS NOT NULL""")
def z_scores(t):
    scored = reshape.feature_scores(cells(t), "feature", "value", t.supplier.count())
    return scored.select("feature", "sample", "value", (F.col("z_score") + 0.0).alias("z_score"))


def _sql(t, text, **tables):
    """Shared SQL on these tables, without naming views in the session."""
    for name in tables:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}")
    return t.spark.sql(text, **tables)


# One text line per user and a column per event type; click and view share a sample,
# signup and error are no known samples. Empty and NA cells are missing.
_LINES = "SELECT user_id, " + ", ".join(
    f"max(CASE WHEN event_type = '{e}' AND (user_id + {i}) % 7 <> 0 THEN event_id END) AS {e}"
    for i, e in enumerate(_EVENT_TYPES)
) + " FROM events GROUP BY user_id"
_SAMPLES = {"click": "web", "view": "web", "purchase": "shop"}


def _lines(t):
    texts = [F.coalesce(F.col(e).cast("string"), F.lit("" if e == "click" else "NA")) for e in _EVENT_TYPES]
    lines = _sql(t, _LINES, events=t.events).select(
        F.concat(F.lit("G"), "user_id").alias("label"), F.concat(F.col("user_id"), F.lit(".0")).alias("entrez_text"),
        F.concat_ws("\t", F.lit("G"), *texts).alias("value"),
        F.lit("f").alias("_file"), F.lit(0).cast("bigint").alias("_block"), F.col("user_id").alias("_line"))
    header = t.spark.createDataFrame(list(enumerate(_EVENT_TYPES, 1)), "pos int, sample string")
    return Matrix(lines, header)


def _sample_id(name):
    return F.coalesce(c.lookup(name, _SAMPLES), F.col(name))


def _known_samples(t):
    return t.spark.createDataFrame([(s,) for s in sorted(set(_SAMPLES.values()))], "tumor_id string")


_LINES_SQL = f"""
    WITH w AS ({_LINES}), v AS (SELECT user_id, unnest([view, click, purchase])::DOUBLE AS x FROM w),
    stats AS (SELECT user_id, avg(x) AS mu, sqrt(var_pop(x) * 3 / 2) AS sigma FROM v GROUP BY user_id),
    stored AS (SELECT user_id, 'web' AS tumor_id, coalesce(click, view)::DOUBLE AS x FROM w
               UNION ALL SELECT user_id, 'shop', purchase::DOUBLE FROM w)
    SELECT tumor_id, 'G' || user_id AS gene_symbol, user_id AS entrez_id, x AS expression_value,
           CASE WHEN sigma > 0 THEN round((x - mu) / sigma, 4) + 0.0 ELSE 0.0 END AS expression_z_score, 'RNA-seq' AS platform
    FROM stored JOIN stats USING (user_id) WHERE x IS NOT NULL"""


@query("q_g2_lines", _LINES_SQL)
def expression_lines(t):
    rows = genomics.expression_rows(_lines(t), _sample_id, _known_samples(t), None, "RNA-seq")
    return rows.withColumn("expression_z_score", F.col("expression_z_score") + 0.0)


@query("q_g2_text", _LINES_SQL)
def expression_text(t):
    """From text to stored rows: plain part files of users with an even number, compressed ones in another order
    of columns of the others, each with a header; read as one matrix, scored, inserted and read back."""
    folder = f"{shared_folder(t.spark)}/{t.spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    cells = _sql(t, _LINES, events=t.events).select(
        F.col("user_id"), F.concat(F.lit("G"), "user_id").alias("Hugo_Symbol"),
        F.concat(F.col("user_id"), F.lit(".0")).alias("Entrez_Gene_Id"),
        *(F.coalesce(F.col(e).cast("string"), F.lit("" if e == "click" else "NA")).alias(e) for e in _EVENT_TYPES))
    names = ["Hugo_Symbol", "Entrez_Gene_Id", *_EVENT_TYPES]
    for odd, columns, packed in [(0, names, "none"), (1, [*names[:1:-1], *names[:2]], "gzip")]:
        part = cells.where(F.col("user_id") % 2 == odd).select(*columns)
        part.write.options(header=True, sep="\t", emptyValue="", compression=packed).csv(f"{folder}/text/part={odd}")
    matrix = read_matrix(t.spark, f"{folder}/text/*")
    store = Store(t.spark, f"{folder}/store")
    rows = genomics.expression_rows(matrix, _sample_id, _known_samples(t), None, "RNA-seq")
    store.insert("gene_expression", rows, [], "trust", unique=True)
    stored = store.read("gene_expression")
    return stored.withColumn("expression_z_score", F.col("expression_z_score") + 0.0)


@query("q_g3_lines", f"""
    WITH w AS ({_LINES.replace("event_id END", "event_id % 8 - 4 END")}), f AS (SELECT user_id, {", ".join(
        f"CASE WHEN {e} BETWEEN -2 AND 2 THEN {e} END AS {e}" for e in _SAMPLES)} FROM w)
    SELECT tumor_id, 'G' || user_id AS gene_symbol, CAST(x AS INTEGER) AS gistic_value, NULL::DOUBLE AS log2_ratio FROM
      (SELECT user_id, 'web' AS tumor_id, coalesce(click, view) AS x FROM f UNION ALL SELECT user_id, 'shop', purchase FROM f)
    WHERE x IS NOT NULL""")
def copy_number_lines(t):
    events = t.events.withColumn("event_id", F.col("event_id") % 8 - 4)
    return genomics.copy_number_rows(_lines(Events(t.spark, events)), _sample_id, _known_samples(t), None)


class Events:
    """The one table the matrix lines are made from."""

    def __init__(self, spark, events):
        self.spark, self.events = spark, events


@query("q_g3", """
    SELECT gene_symbol, sample, CAST(v AS INTEGER) AS gistic_value, CAST(NULL AS DOUBLE) AS log2_ratio
    FROM (SELECT p_brand AS gene_symbol, l_suppkey AS sample, count(*) % 7 - 3 AS v
          FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) WHERE v BETWEEN -2 AND 2""")
def copy_number(t):
    counts = (
        t.lineitem.select("l_partkey", F.col("l_suppkey").alias("sample"))
        .join(t.part.select("p_partkey", F.col("p_brand").alias("gene_symbol")), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("gene_symbol", "sample").agg(F.count("*").alias("n"))
    )
    value = c.in_domain((F.col("n") % 7 - 3).cast("int"), vocab.GISTIC_VALUES)
    return counts.select("gene_symbol", "sample", value.alias("gistic_value"),
                         F.lit(None).cast("double").alias("log2_ratio")).where(F.col("gistic_value").isNotNull())


_ANSWERS = {k: sql_pick(["YES", "no", "1", "0", "NA", None, "y"], key)
            for k, key in {"Chemotherapy": "c_custkey", "Hormone Therapy": "c_custkey + c_nationkey", "Radiation": "c_nationkey"}.items()}


@query("q_g4", " UNION ALL ".join(
    f"SELECT c_custkey, {i} AS position, '{k}' AS treatment_type, "
    f"CASE WHEN upper(a) IN ('YES', '1', 'Y') THEN 1 ELSE 0 END AS received "
    f"FROM (SELECT c_custkey, {a} AS a FROM customer) WHERE a <> 'NA'" for i, (k, a) in enumerate(_ANSWERS.items())))
def fan_out(t):
    fields = [(k, c.received_flag(F.expr(a))) for k, a in _ANSWERS.items()]
    return reshape.fan_out(t.customer, ["c_custkey"], fields, "treatment_type", "received", "position")


# ---- liftover ----

_BLOCKS = """
    SELECT CAST(1 AS BIGINT) AS chain_id, CAST(1000 AS BIGINT) AS score, concat('chr', p_partkey % 7 + 1) AS t_chrom,
           p_partkey * 74 AS t_start, p_partkey * 74 + 30 + p_size AS t_end,
           concat('chr', CASE WHEN p_size = 1 THEN 9 ELSE p_partkey % 7 + 1 END) AS q_chrom,
           p_partkey * 74 + 1000 AS q_start, CAST(1000000000000 AS BIGINT) AS q_size,
           CASE WHEN p_type = 'PROMO' THEN '-' ELSE '+' END AS strand FROM part
    UNION ALL
    SELECT s_suppkey + 2, s_suppkey * 13 % 1000 + 500, concat('chr', s_suppkey % 7 + 1), s_suppkey * 740,
           s_suppkey * 740 + 400, concat('chr', s_suppkey % 7 + 1), s_suppkey * 740 + 5000,
           CAST(1000000000000 AS BIGINT), '+' FROM supplier"""
_POINTS = """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_linenumber AS STRING) AS chromosome,
           l_partkey * 37 AS start_position,
           CASE WHEN l_returnflag = 'N' AND l_quantity > 40 THEN NULL
                ELSE l_partkey * 37 + CAST(l_quantity AS BIGINT) END AS end_position,
           CASE WHEN l_linestatus = 'O' AND l_tax = 0 THEN 'GRCh38' ELSE 'GRCh37' END AS reference_genome FROM lineitem"""
_LIFT_SQL = f"""
    WITH blocks AS ({_BLOCKS}), points AS ({_POINTS}),
    spots AS (SELECT chromosome, start_position AS pos FROM points UNION SELECT chromosome, end_position FROM points),
    hits AS (SELECT chromosome, pos, replace(q_chrom, 'chr', '') AS q_chrom,
                    CASE WHEN strand = '+' THEN q_start + pos - 1 - t_start
                         ELSE q_size - 1 - (q_start + pos - 1 - t_start) END + 1 AS q_pos,
                    row_number() OVER (PARTITION BY chromosome, pos ORDER BY score DESC, chain_id) AS rn
             FROM spots JOIN blocks ON t_chrom = 'chr' || chromosome AND pos - 1 >= t_start AND pos - 1 < t_end),
    mapped AS (SELECT p.*, s.q_chrom AS s_chrom, s.q_pos AS s_pos, e.q_chrom AS e_chrom, e.q_pos AS e_pos,
                      CASE WHEN reference_genome <> 'GRCh37' THEN NULL
                           WHEN e.q_chrom IS NOT NULL AND (s.q_chrom IS NULL OR s.q_chrom <> e.q_chrom) THEN 'cross_chromosome'
                           WHEN s.q_chrom IS NOT NULL THEN 'lifted' ELSE 'unmapped' END AS lift_outcome
               FROM points p
               LEFT JOIN hits s ON s.chromosome = p.chromosome AND s.pos = start_position AND s.rn = 1
               LEFT JOIN hits e ON e.chromosome = p.chromosome AND e.pos = end_position AND e.rn = 1)"""


def _lifted(t):
    return liftover.lift_variants(_sql(t, _POINTS, lineitem=t.lineitem), _sql(t, _BLOCKS, part=t.part, supplier=t.supplier))


@query("q_i4", f"""{_LIFT_SQL}
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CASE WHEN lift_outcome = 'lifted' THEN s_chrom ELSE chromosome END AS chromosome,
           CASE WHEN lift_outcome = 'lifted' THEN s_pos ELSE start_position END AS start_position,
           CASE WHEN lift_outcome = 'lifted' THEN e_pos ELSE end_position END AS end_position,
           CASE WHEN lift_outcome = 'lifted' THEN 'GRCh38' WHEN lift_outcome IS NOT NULL THEN 'GRCh37_UNMAPPED'
                ELSE reference_genome END AS reference_genome, lift_outcome FROM mapped""")
def lift(t):
    return _lifted(t)


@query("q_i4_summary", f"""{_LIFT_SQL}
    SELECT count(lift_outcome) AS total, count(*) FILTER (WHERE lift_outcome = 'lifted') AS lifted,
           count(*) FILTER (WHERE lift_outcome <> 'lifted') AS failed,
           count(*) FILTER (WHERE lift_outcome = 'cross_chromosome') AS cross_chromosome,
           round(count(*) FILTER (WHERE lift_outcome = 'lifted') * 100.0::DOUBLE / count(lift_outcome), 1) AS pct_lifted
    FROM mapped""")
def lift_counts(t):
    return liftover.lift_summary(_lifted(t))


_ALLELES = [("A", "C"), ("G", "GTC"), ("-", "AAC"), ("TGA", "T"), ("CC", "-"), ("AG", "TN"), ("a", "r"), ("T", None)]
_ALLELE = {name: sql_pick([pair[k] for pair in _ALLELES], "l_suppkey") for k, name in enumerate(("ref", "alt"))}
_STRAND_POINTS = f"SELECT *, {_ALLELE['ref']} AS reference_allele, {_ALLELE['alt']} AS variant_allele FROM ({_POINTS})"
_TURNED = "reverse(translate({}, 'ACGTMRWSYKVHDBNacgtmrwsykvhdbn', 'TGCAKYWSRMBDHVNtgcakywsrmbdhvn'))"


@query("q_i4_strand", f"""
    {_LIFT_SQL.replace(_POINTS, _STRAND_POINTS).replace("AS q_pos,", "AS q_pos, strand,").replace(
        "e.q_pos AS e_pos,", "e.q_pos AS e_pos, s.strand AS s_strand, e.strand AS e_strand,").replace(
        "WHEN s.q_chrom IS NOT NULL THEN 'lifted'", "WHEN s.strand <> e.strand THEN 'strand_change' WHEN s.q_chrom IS NOT NULL THEN 'lifted'")},
    kinds AS (SELECT *, lift_outcome = 'lifted' AND s_strand = '-' AS back,
                     reference_allele = 'G' AND variant_allele = 'GTC' AS added, reference_allele = 'TGA' AS removed FROM mapped)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CASE WHEN lift_outcome = 'lifted' THEN s_chrom ELSE chromosome END AS chromosome,
           CASE WHEN back AND added THEN s_pos - 1 WHEN back THEN coalesce(e_pos, s_pos)
                WHEN lift_outcome = 'lifted' THEN s_pos ELSE start_position END AS start_position,
           CASE WHEN back AND added THEN s_pos WHEN back AND e_pos IS NULL THEN NULL WHEN back AND removed THEN s_pos - 1
                WHEN back THEN s_pos WHEN lift_outcome = 'lifted' THEN e_pos ELSE end_position END AS end_position,
           CASE WHEN back AND added THEN '-' WHEN back AND removed THEN 'TC'
                WHEN back THEN {_TURNED.format("reference_allele")} ELSE reference_allele END AS reference_allele,
           CASE WHEN back AND added THEN 'GA' WHEN back AND removed THEN '-'
                WHEN back THEN {_TURNED.format("variant_allele")} ELSE variant_allele END AS variant_allele,
           CASE WHEN lift_outcome = 'lifted' THEN 'GRCh38' WHEN lift_outcome IS NOT NULL THEN 'GRCh37_UNMAPPED'
                ELSE reference_genome END AS reference_genome, lift_outcome FROM kinds""")
def lift_by_strand(t):
    points = _sql(t, _STRAND_POINTS, lineitem=t.lineitem)
    return liftover.lift_variants(points, _sql(t, _BLOCKS, part=t.part, supplier=t.supplier), strand_aware=True)


# ---- batch correction ----

MIN_SAMPLES = 5
#: SQL steps on to the limit that the engine solves for; so many are not needed.
SQL_STEPS = 20_000
_PREPARED = f"""{_CELLS},
    cover AS (SELECT feature FROM cells GROUP BY feature HAVING count(value) >= {MIN_SAMPLES}),
    kept AS (SELECT sample, batch FROM cells JOIN cover USING (feature) GROUP BY sample, batch
             HAVING 1.0::DOUBLE - count(value)::DOUBLE / (SELECT count(*) FROM cover) < 0.5),
    used AS (SELECT feature, sample, batch, value FROM cells JOIN cover USING (feature) JOIN kept USING (sample, batch)),
    filled AS (SELECT feature, sample, batch, value IS NULL AS imputed,
                      coalesce(value, avg(value) OVER (PARTITION BY feature)) AS value FROM used)"""
_COMBAT = f"""
    WITH RECURSIVE {_PREPARED},
    stats AS (SELECT feature, batch, count(*)::DOUBLE AS n, avg(value) AS mean, var_pop(value) * count(*) AS m2
              FROM filled GROUP BY 1, 2),
    scale AS (SELECT feature, sum(n * mean) / sum(n) AS alpha, sqrt(sum(m2) / sum(n)) AS sigma FROM stats GROUP BY 1),
    est AS (SELECT *, (mean - alpha) / sigma AS gamma, m2 / (sigma * sigma * (n - 1)) AS delta
            FROM stats JOIN scale USING (feature)),
    prior AS (SELECT batch, gamma_bar, tau2, (2 * s2 + m * m) / s2 AS a, (m * s2 + m * m * m) / s2 AS b
              FROM (SELECT batch, avg(gamma) AS gamma_bar, var_samp(gamma) AS tau2, avg(delta) AS m, var_samp(delta) AS s2
                    FROM est GROUP BY batch)),
    steps AS (
        SELECT feature, batch, 0 AS i, gamma AS g, delta AS d, NULL::DOUBLE AS before FROM est
        UNION ALL
        SELECT feature, batch, i + 1, g_new,
               (0.5 * (m2 / (sigma * sigma) + n * (gamma - g_new) * (gamma - g_new)) + b) / (n / 2 + a - 1), d
        FROM (SELECT s.feature, s.batch, s.i, s.d, e.n, e.m2, e.sigma, e.gamma, p.a, p.b,
                     (e.n * p.tau2 * e.gamma + s.d * p.gamma_bar) / (e.n * p.tau2 + s.d) AS g_new
              FROM steps s JOIN est e ON s.feature = e.feature AND s.batch = e.batch JOIN prior p ON p.batch = s.batch
              WHERE s.i < {combat.ITERATIONS} OR (abs(s.d - s.before) > {combat.SETTLED} * s.d AND s.i < {SQL_STEPS}))),
    ends AS (SELECT feature, batch, arg_max(g, i) AS g, arg_max(d, i) AS d FROM steps GROUP BY ALL),
    corrected AS (SELECT f.feature, f.sample, f.batch, f.value,
                         sigma / sqrt(d) * ((f.value - alpha) / sigma - g) + alpha AS corrected
                  FROM filled f JOIN est e ON f.feature = e.feature AND f.batch = e.batch
                       JOIN ends s ON s.feature = f.feature AND s.batch = f.batch)"""


def _prepared(t):
    return combat.prepare(cells(t), MIN_SAMPLES)


@query("q_i5a", f"""
    WITH {_CELLS} SELECT feature, count(value) AS n_values FROM cells GROUP BY feature
    HAVING count(value) >= {MIN_SAMPLES}""")
def coverage(t):
    return combat.feature_coverage(cells(t), MIN_SAMPLES)


@query("q_i5b", f"WITH {_PREPARED} SELECT sample, batch FROM kept")
def samples_kept(t):
    return _prepared(t).cells.select("sample", "batch").distinct()


@query("q_i5c", f"""
    WITH {_PREPARED} SELECT feature, sample, batch, round(value, 6) AS value, CAST(imputed AS INTEGER) AS imputed FROM filled""")
def imputed(t):
    filled = combat.impute_feature_mean(_prepared(t).cells)
    return filled.select("feature", "sample", "batch", F.round("value", 6).alias("value"), F.col("imputed").cast("int"))


@query("q_i5d", f"WITH {_PREPARED} SELECT batch, count(*) AS n_samples FROM kept GROUP BY batch")
def batch_sizes(t):
    return combat.batch_sizes(_prepared(t).cells)


@query("q_i5", f"{_COMBAT} SELECT feature, sample, batch, round(corrected, 4) AS corrected FROM corrected")
def corrected(t):
    result = combat.correct_batches(_prepared(t))
    return result.select("feature", "sample", "batch", F.round("corrected", 4).alias("corrected"))


@query("q_i5e", f"""{_COMBAT}
    SELECT round(max(before) - min(before), 4) AS shift_before, round(max(after) - min(after), 4) AS shift_after
    FROM (SELECT batch, avg(value) AS before, avg(corrected) AS after FROM corrected GROUP BY batch) HAVING count(*) = 2""")
def shift(t):
    moved = combat.batch_shift(combat.correct_batches(_prepared(t)))
    return moved.select(F.round("shift_before", 4).alias("shift_before"), F.round("shift_after", 4).alias("shift_after"))
