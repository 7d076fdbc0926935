"""Scalar functions against value tables."""

import math

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import clean as c


def apply(spark, fn, values, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[1] for r in sorted(df.select("i", fn(F.col("v"))).collect())]


CASES = {
    "clean_text": (c.clean_text, {
        None: None, "NA": None, "[Not Available]": None, "": None, "nan": None, "Hello": "Hello",
        "  Hello  ": "Hello", "\t x　\n": "x", " Unknown ": None, "UNKNOWN": "UNKNOWN", "--": None,
    }),
    "clean_double": (c.clean_double, {
        "3.14": 3.14, "42": 42.0, "NA": None, None: None, "1d": None, "1f": None, "1_000": 1000.0,
        ".5": 0.5, "5.": 5.0, "-1e3": -1000.0, "inf": math.inf, "-Infinity": -math.inf, "abc": None, "1,5": None,
        "0x10": None, " 7 ": 7.0,
    }),
    "clean_int": (c.clean_int, {"3": 3, "3.7": 3, "-3.7": -3, "NA": None, "inf": None, "x": None}),
    "days_to_months": (c.days_to_months, {"365": 11.99, "0": 0.0, None: None, "NA": None}),
    "subtype": (c.normalize_subtype, {
        "Luminal A": "LumA", "Basal-like": "Basal", "HER2-enriched": "Her2", "lumA": "LumA",
        "": "Unknown", None: "Unknown", "claudin-low": "Basal", "NC": "Unknown", "zzz": "Unknown",
    }),
    "receptor": (c.normalize_receptor, {
        "Positive": "Positive", "Negative": "Negative", "[Not Evaluated]": "Unknown", "": "Unknown",
        None: "Unknown", "POSITIVE": "Positive", "nEGATIVE": "Negative", "Indeterminate": "Unknown",
        "equivocal": "Equivocal",
    }),
    "stage": (c.normalize_stage, {
        "Stage IIA": "IIA", "Stage X": None, "IIIC": "IIIC", None: None, "iiic": "IIIC", "0": None, "2": "II",
    }),
    "vital": (c.normalize_vital, {
        "LIVING": "Alive", "1": "Deceased", "Deceased": "Deceased", None: None, "0": "Alive",
        "Died of Disease": "Deceased", "x": None,
    }),
    "variant_class": (c.normalize_variant_class, {
        "missense_variant": "Missense_Mutation", "stop_gained": "Nonsense_Mutation",
        "Custom_Type": "Custom_Type", None: None, "5'UTR": "5'UTR",
    }),
    "histology": (c.normalize_histology, {
        "Infiltrating Ductal Carcinoma": "IDC", "Infiltrating Lobular Carcinoma": "ILC",
        "Metaplastic Carcinoma": "Metaplastic", "IDC": "IDC", "Rare Type": "Rare Type", None: None,
    }),
    "menopause": (c.normalize_menopause, {
        "Post (prior bilateral ovariectomy)": "Post", "Pre (<6 months since LMP)": "Pre",
        "Peri (6-12 months)": "Peri", "Indeterminate (neither)": "Unknown", "other": "Unknown",
        "[Not Available]": None, None: None, "": None,
    }),
    "recurrence": (c.recurrence_event, {
        "0:Not Recurred": 0, "1:Recurred": 1, "Not Recurred": 0, "Recurred": 1, "": None, None: None,
        "recurred": None,
    }),
    "received": (c.received_flag, {"yes": 1, "Y": 1, "1": 1, "NO": 0, "0": 0, "NA": None, None: None}),
    "therapy": (c.therapy_type, {
        "Chemotherapy": "Chemotherapy", "Targeted Molecular therapy": "Targeted Therapy",
        "Immunotherapy": "Other", "Vaccine": "Other", None: "Other", "NA": "Other",
    }),
    "tumor_id": (c.primary_tumor_id, {
        "TCGA-A2-A0YF-11A-11R": "TCGA-A2-A0YF-01", "TCGA-A2-A0YF": "TCGA-A2-A0YF-01", "X": "X-01",
    }),
    "entrez": (c.entrez_id, {"7157": 7157, "7157.0": 7157, "NA": None, "7157.9": 7157, "nan": None}),
    "parse_long": (c.parse_long, {"1": 1, "-2": -2, "1.0": None, "NA": None, "+1": 1}),
}


@pytest.mark.parametrize("name", CASES)
def test_value_table(spark, name):
    fn, table = CASES[name]
    assert apply(spark, fn, list(table)) == list(table.values())


def test_nan_spelling_is_a_number(spark):
    assert math.isnan(apply(spark, c.clean_double, ["NAN"])[0])
    assert apply(spark, c.clean_double, ["nan"]) == [None]


def test_menopause_by_age(spark):
    ages = [45.0, 55.0, 50.0, None, math.nan]
    assert apply(spark, c.menopause_by_age, ages, "double") == ["Pre", "Post", "Post", "Unknown", "Unknown"]


def test_recorded_menopause_beats_age(spark):
    df = spark.createDataFrame([("post", 30.0), ("odd", 30.0), ("NA", 30.0), (None, None)], "s string, a double")
    got = [r[0] for r in df.select(c.menopause_state_or_age("s", F.col("a"))).collect()]
    assert got == ["Post", "Unknown", "Pre", "Unknown"]


def test_triple_negative(spark):
    n, p, u, e = "Negative", "Positive", "Unknown", "Equivocal"
    df = spark.createDataFrame([(n, n, n), (p, n, n), (n, n, u), (n, n, e)], "a string, b string, c string")
    assert [r[0] for r in df.select(c.triple_negative("a", "b", "c")).collect()] == [1, 0, None, 0]


def test_prognostic_index(spark):
    data = [(2.0, 2, 0), (3.0, 3, 5), (1.0, 1, 2), (None, 2, 0), (2.0, None, 0), (2.0, 2, None), (math.nan, 1, 1)]
    df = spark.createDataFrame(data, "s double, g int, n int")
    got = [r[0] for r in df.select(c.prognostic_index(F.col("s"), F.col("g"), F.col("n"))).collect()]
    assert got == [3.4, 6.6, 3.2, None, None, None, None]


def test_given_index_zero_falls_through(spark):
    df = spark.createDataFrame([(4.5,), (0.0,), (None,)], "npi double")
    expr = c.given_or_computed_index(F.col("npi"), F.lit(2.0), F.lit(2), F.lit(0))
    assert [r[0] for r in df.select(expr).collect()] == [4.5, 3.4, 3.4]


def test_barcode(spark):
    got = [tuple(v) for v in apply(spark, c.parse_barcode, [
        "TCGA-A2-A0YF-01A-11R-A034-13", "TCGA-A2-A0YF-11A-1", "TCGA-A2-A0YF", "TCGA-A2-A0YF-99Z", "AB-C"])]
    assert [g[1:] for g in got] == [
        ("TCGA-A2-A0YF", "01", "Primary Solid Tumor", "TCGA-A2-A0YF-01A"),
        ("TCGA-A2-A0YF", "11", "Solid Tissue Normal", "TCGA-A2-A0YF-11A"),
        ("TCGA-A2-A0YF", None, None, "TCGA-A2-A0YF"),
        ("TCGA-A2-A0YF", "99", "Unknown (99)", "TCGA-A2-A0YF-99Z"),
        ("AB-C", None, None, "AB-C"),
    ]


def test_survival_status(spark):
    got = [tuple(v) for v in apply(spark, c.survival_status, ["1:DECEASED", "Deceased", "0:LIVING", "living", "", None])]
    assert got == [(1, "Deceased")] * 2 + [(0, "Alive")] * 2 + [(None, None)] * 2


def test_equivocal_resolution(spark):
    data = [("Equivocal", "Positive"), ("Equivocal", "Negative"), ("Equivocal", "Unknown"),
            ("Positive", "Negative"), ("Equivocal", None)]
    df = spark.createDataFrame(data, "h string, f string")
    got = [r[0] for r in df.select(c.resolve_equivocal(F.col("h"), F.col("f"))).collect()]
    assert got == ["Positive", "Negative", "Equivocal", "Positive", "Equivocal"]


def test_follow_up_months(spark):
    data = [(1, 304.4, 100.0), (1, 0.0, 608.8), (0, 304.4, 608.8), (1, None, 608.8), (None, 1.0, None)]
    df = spark.createDataFrame(data, "e int, d double, l double")
    got = [r[0] for r in df.select(c.follow_up_months(F.col("e"), F.col("d"), F.col("l"))).collect()]
    assert got == [10.0, 20.0, 20.0, 20.0, None]


def test_mm_to_cm(spark):
    assert apply(spark, lambda v: c.mm_to_cm(c.clean_double(v)), ["15", "20", "25", "30", None]) == [1.5, 2.0, 2.5, 3.0, None]


def test_fallbacks(spark):
    df = spark.createDataFrame([("", "x"), (None, "x"), ("NA", "x"), (None, None)], "a string, b string")
    got = [tuple(r) for r in df.select(c.first_nonblank("a", "b"), c.first_clean("a", "b")).collect()]
    assert got == [("x", "x"), ("x", "x"), ("NA", "x"), ("", None)]


def test_allele_frequency_is_chosen_by_columns(spark):
    df = spark.createDataFrame([("5", "5", "20"), ("1", "0", "0"), ("0", "0", "0"), ("x", "1", "2")],
                               "t_alt string, t_ref string, t_depth string")
    depth = [r[0] for r in df.select(c.allele_frequency(df.columns)).collect()]
    ref = [r[0] for r in df.select(c.allele_frequency(["t_alt", "t_ref"])).collect()]
    assert depth == [0.25, math.inf, None, None]
    assert ref == [0.5, 1.0, None, None]
    assert [r[0] for r in df.select(c.allele_frequency(["t_alt"])).collect()] == [None] * 4
