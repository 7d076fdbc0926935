"""Scalar functions (H*) over whole tables with messy texts spread over the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean as c, vocab
from .registry import query, sql_list, sql_map, sql_pick

_BLANKS = vocab.NULL_SENTINELS
_TEXTS = [*_BLANKS, None, "  Hello  ", "\tTab ", "UNKNOWN", "Value"]
_CLEAN = f"CASE WHEN trim(s, ' \t') IN ({sql_list(_BLANKS)}) THEN NULL ELSE trim(s, ' \t') END"


def _picked(values: list, key: str):
    return F.expr(sql_pick(values, key))


@query("q_h1", f"""
    SELECT o_orderkey, {_CLEAN} AS cleaned FROM
      (SELECT o_orderkey, {sql_pick(_TEXTS, "o_orderkey")} AS s FROM orders)""")
def clean_text(t):
    return t.orders.select("o_orderkey", c.clean_text(_picked(_TEXTS, "o_orderkey")).alias("cleaned"))


# Text and the number it stands for.
_NUMBERS = {
    "3.14": 3.14, "42": 42, " 7 ": 7, ".5": 0.5, "5.": 5, "-1e3": -1000, "1_000": 1000, "1d": None, "1f": None,
    "0x10": None, "1,5": None, "NA": None, "abc": None, "+2.5E-1": 0.25, "": None,
}


@query("q_h2", f"""
    SELECT o_orderkey, CAST({sql_map(f"({sql_pick(list(_NUMBERS), 'o_orderkey')})", _NUMBERS)} AS DOUBLE) AS number
    FROM orders""")
def clean_double(t):
    return t.orders.select("o_orderkey", c.clean_double(_picked(list(_NUMBERS), "o_orderkey")).alias("number"))


@query("q_h3", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(trunc((l_partkey + 0.7) * CASE WHEN l_linenumber = 1 THEN -1 ELSE 1 END) AS BIGINT) AS whole
    FROM lineitem""")
def clean_long(t):
    text = F.expr("concat(CASE WHEN l_linenumber = 1 THEN '-' ELSE '' END, l_partkey, '.7')")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", c.clean_long(text).alias("whole"))


@query("q_h4", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_linenumber = 7 THEN NULL ELSE round(l_partkey / 30.44::DOUBLE, 2) END AS months
    FROM lineitem""")
def days_to_months(t):
    text = F.expr("CASE WHEN l_linenumber = 7 THEN '[Not Available]' ELSE cast(l_partkey AS string) END")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             c.days_to_months(text).alias("months"))


_SUBTYPES = [*vocab.PAM50, None, "NA", "other"]
_RECEPTORS = [*vocab.RECEPTOR_STATUS, "POSITIVE", "nEGATIVE", "EQUIVOCAL", None, "weak"]
_RECEPTOR_SQL = (
    f"coalesce({sql_map('r', vocab.RECEPTOR_STATUS)}, "
    f"{sql_map('upper(substr(r, 1, 1)) || lower(substr(r, 2))', vocab.RECEPTOR_STATUS)}, 'Unknown')"
)


@query("q_h_vocab", f"""
    SELECT o_orderkey, {sql_map("p", vocab.PAM50, "'Unknown'")} AS subtype, {_RECEPTOR_SQL} AS receptor
    FROM (SELECT o_orderkey, {sql_pick(_SUBTYPES, "o_orderkey")} AS p,
                 {sql_pick(_RECEPTORS, "o_custkey")} AS r FROM orders)""")
def vocabularies(t):
    return t.orders.select(
        "o_orderkey",
        c.normalize_subtype(_picked(_SUBTYPES, "o_orderkey")).alias("subtype"),
        c.normalize_receptor(_picked(_RECEPTORS, "o_custkey")).alias("receptor"),
    )


_STATUSES = ["Positive", "Negative", "Equivocal", "Unknown"]


@query("q_h7", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN 'Unknown' IN (a, b, h) THEN NULL
                WHEN a = 'Negative' AND b = 'Negative' AND h = 'Negative' THEN 1 ELSE 0 END AS triple_negative
    FROM (SELECT *, {sql_pick(_STATUSES, "l_orderkey")} AS a, {sql_pick(_STATUSES, "l_partkey")} AS b,
                 {sql_pick(_STATUSES, "l_suppkey")} AS h FROM lineitem)""")
def triple_negative(t):
    statuses = [_picked(_STATUSES, k) for k in ("l_orderkey", "l_partkey", "l_suppkey")]
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             c.triple_negative(*statuses).alias("triple_negative"))


_STAGES = [*vocab.STAGE, "iiia", "NA", None, "stage ii"]


@query("q_h8", f"""
    SELECT o_orderkey, coalesce({sql_map("s", vocab.STAGE)}, {sql_map("upper(s)", vocab.STAGE)}) AS stage
    FROM (SELECT o_orderkey, {sql_pick(_STAGES, "o_orderkey")} AS s FROM orders)""")
def stage(t):
    return t.orders.select("o_orderkey", c.normalize_stage(_picked(_STAGES, "o_orderkey")).alias("stage"))


_HISTOLOGIES = [*vocab.HISTOLOGY, "Rare Type", "[Unknown]", None]
_CLASSES = [*vocab.VARIANT_CLASS, "Custom_Type", "NA", None]


@query("q_h9", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           {sql_map("h", vocab.HISTOLOGY, "CASE WHEN h = '[Unknown]' THEN NULL ELSE h END")} AS histology,
           {sql_map("v", vocab.VARIANT_CLASS, "CASE WHEN v = 'NA' THEN NULL ELSE v END")} AS variant_class
    FROM (SELECT *, {sql_pick(_HISTOLOGIES, "l_partkey")} AS h, {sql_pick(_CLASSES, "l_orderkey")} AS v
          FROM lineitem)""")
def pass_through(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        c.normalize_histology(_picked(_HISTOLOGIES, "l_partkey")).alias("histology"),
        c.normalize_variant_class(_picked(_CLASSES, "l_orderkey")).alias("variant_class"),
    )


@query("q_h10", """
    SELECT p_partkey, CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 50 THEN 'Pre' ELSE 'Post' END AS status
    FROM (SELECT p_partkey, CASE WHEN p_size = 13 THEN NULL ELSE p_size + 20 END AS age FROM part)""")
def menopause_by_age(t):
    age = F.when(F.col("p_size") != 13, F.col("p_size") + 20).cast("double")
    return t.part.select("p_partkey", c.menopause_by_age(age).alias("status"))


_MENOPAUSE = ["Pre (<6 months)", "POST (prior)", "peri (6-12)", "Indeterminate (x)", "other", "[Not Available]", None]
_STATES = ["Pre", "post", "Peri", "NA", None]


@query("q_h11", f"""
    SELECT p_partkey,
           CASE WHEN m IS NULL OR m = '[Not Available]' THEN NULL WHEN lower(m) LIKE 'pre%' THEN 'Pre'
                WHEN lower(m) LIKE 'post%' THEN 'Post' WHEN lower(m) LIKE 'peri%' THEN 'Peri'
                ELSE 'Unknown' END AS recorded,
           CASE WHEN s IS NULL OR s = 'NA' THEN CASE WHEN p_size + 20 < 50 THEN 'Pre' ELSE 'Post' END
                WHEN s IN ('Pre', 'pre') THEN 'Pre' WHEN s IN ('Post', 'post') THEN 'Post'
                ELSE 'Unknown' END AS state_or_age
    FROM (SELECT *, {sql_pick(_MENOPAUSE, "p_partkey")} AS m, {sql_pick(_STATES, "p_partkey")} AS s FROM part)""")
def menopause_text(t):
    age = (F.col("p_size") + 20).cast("double")
    return t.part.select(
        "p_partkey", c.normalize_menopause(_picked(_MENOPAUSE, "p_partkey")).alias("recorded"),
        c.menopause_state_or_age(_picked(_STATES, "p_partkey"), age).alias("state_or_age"),
    )


_VITALS = [*vocab.VITAL_STATUS, "NA", "x", None]


@query("q_h12", f"""
    SELECT o_orderkey, {sql_map("v", vocab.VITAL_STATUS)} AS vital,
           CASE e WHEN 1 THEN 'Deceased' WHEN 0 THEN 'Alive' END AS vital_of_event
    FROM (SELECT o_orderkey, {sql_pick(_VITALS, "o_orderkey")} AS v, o_custkey % 3 AS e FROM orders)""")
def vital(t):
    return t.orders.select(
        "o_orderkey", c.normalize_vital(_picked(_VITALS, "o_orderkey")).alias("vital"),
        c.vital_of_event(F.col("o_custkey") % 3).alias("vital_of_event"),
    )


_NPI = """CASE WHEN size IS NULL THEN NULL ELSE round(0.2::DOUBLE * size + grade +
          CASE WHEN nodes = 0 THEN 1 WHEN nodes <= 3 THEN 2 ELSE 3 END, 2) END"""


@query("q_h14", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_NPI} AS npi,
           CASE WHEN l_linenumber > 1 AND l_discount <> 0 THEN l_discount ELSE {_NPI} END AS given_or_computed
    FROM (SELECT *, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity / 10 END AS size,
                 1 + l_suppkey % 3 AS grade, l_partkey % 6 AS nodes FROM lineitem)""")
def prognostic_index(t):
    size = F.when(F.col("l_linenumber") != 7, F.col("l_quantity") / 10)
    grade, nodes = 1 + F.col("l_suppkey") % 3, F.col("l_partkey") % 6
    given = F.when(F.col("l_linenumber") > 1, F.col("l_discount"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        c.prognostic_index(size, grade, nodes).alias("npi"),
        c.given_or_computed_index(given, size, grade, nodes).alias("given_or_computed"),
    )


_BARCODE = """CASE o_orderkey % 4
    WHEN 0 THEN concat('CO-', o_custkey, '-', o_orderkey)
    WHEN 1 THEN concat('CO-', o_custkey, '-', o_orderkey, '-01A-11R')
    WHEN 2 THEN concat('CO-', o_custkey, '-', o_orderkey, '-11B')
    ELSE concat('CO-', o_custkey, '-', o_orderkey, '-77') END"""


@query("q_h15", f"""
    SELECT o_orderkey, p[1] || '-' || p[2] || '-' || p[3] AS patient_id,
           CASE WHEN len(p) >= 4 THEN substr(p[4], 1, 2) END AS sample_type_code,
           CASE WHEN len(p) >= 4 THEN {sql_map("substr(p[4], 1, 2)", vocab.SAMPLE_TYPE,
                                               "'Unknown (' || substr(p[4], 1, 2) || ')'")} END AS sample_type,
           array_to_string(p[1:4], '-') AS tumor_id
    FROM (SELECT o_orderkey, string_split({_BARCODE}, '-') AS p FROM orders)""")
def barcode(t):
    parsed = c.parse_barcode(F.expr(_BARCODE))
    return t.orders.select("o_orderkey", parsed.alias("b")).select(
        "o_orderkey", "b.patient_id", "b.sample_type_code", "b.sample_type", "b.tumor_id")


@query("q_h16", f"""
    SELECT o_orderkey, array_to_string(string_split({_BARCODE}, '-')[1:3], '-') || '-01' AS tumor_id FROM orders""")
def tumor_id(t):
    return t.orders.select("o_orderkey", c.primary_tumor_id(F.expr(_BARCODE)).alias("tumor_id"))


_OS = ["1:DECEASED", "Deceased", "0:LIVING", "living", "", None, "2:other"]


@query("q_h18", f"""
    SELECT o_orderkey, e AS event, CASE e WHEN 1 THEN 'Deceased' WHEN 0 THEN 'Alive' END AS vital
    FROM (SELECT o_orderkey, CASE WHEN upper(s) LIKE '%DECEASED%' OR s LIKE '1%' THEN 1
                                  WHEN upper(s) LIKE '%LIVING%' OR s LIKE '0%' THEN 0 END AS e
          FROM (SELECT o_orderkey, {sql_pick(_OS, "o_orderkey")} AS s FROM orders))""")
def survival(t):
    return t.orders.select("o_orderkey", c.survival_status(_picked(_OS, "o_orderkey")).alias("s")).select(
        "o_orderkey", "s.event", "s.vital")


_RFS = ["0:Not Recurred", "1:Recurred", "Not Recurred", "Recurred", "", None, "recurred"]


@query("q_h19", f"""
    SELECT o_orderkey, CASE WHEN s LIKE '%Not Recurred%' OR s LIKE '0%' THEN 0
                            WHEN s LIKE '%Recurred%' OR s LIKE '1%' THEN 1 END AS event
    FROM (SELECT o_orderkey, {sql_pick(_RFS, "o_orderkey")} AS s FROM orders)""")
def recurrence(t):
    return t.orders.select("o_orderkey", c.recurrence_event(_picked(_RFS, "o_orderkey")).alias("event"))


@query("q_h20", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           round(CASE WHEN l_linestatus = 'F' AND death <> 0 THEN death ELSE l_suppkey END / 30.44::DOUBLE, 2) AS months
    FROM (SELECT *, CASE l_linenumber WHEN 1 THEN 0 WHEN 2 THEN NULL ELSE l_partkey END AS death FROM lineitem)""")
def follow_up(t):
    event = F.when(F.col("l_linestatus") == "F", 1).otherwise(0)
    death = F.expr("CASE l_linenumber WHEN 1 THEN 0 WHEN 2 THEN NULL ELSE l_partkey END").cast("double")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             c.follow_up_months(event, death, F.col("l_suppkey").cast("double")).alias("months"))


@query("q_h21", """
    SELECT p_partkey, CASE WHEN p_size = 13 THEN NULL ELSE p_size / 10.0::DOUBLE END AS size_cm FROM part""")
def mm_to_cm(t):
    mm = c.clean_double(F.expr("CASE WHEN p_size = 13 THEN 'NA' ELSE cast(p_size AS string) END"))
    return t.part.select("p_partkey", c.mm_to_cm(mm).alias("size_cm"))


@query("q_h26", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN depth = 0 AND alt = 0 THEN NULL WHEN depth = 0 THEN 'infinity'::DOUBLE
                ELSE round(alt / depth, 4) END AS vaf
    FROM (SELECT *, (l_partkey % 5)::DOUBLE AS alt, (l_suppkey % 7)::DOUBLE AS depth FROM lineitem)""")
def allele_frequency(t):
    counts = t.lineitem.withColumns({
        "t_alt": (F.col("l_partkey") % 5).cast("string"), "t_depth": (F.col("l_suppkey") % 7).cast("string")})
    return counts.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         F.round(c.allele_frequency(counts.columns), 4).alias("vaf"))
