"""Constraint checks and ignore-on-conflict loads."""

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import quality as q
from cohortloom.plans.schema import MUTATIONS, PATIENTS, TABLES, TUMORS
from cohortloom.plans.store import LOG_FIELDS, Store
from conftest import rows


def patients(spark, data):
    return spark.createDataFrame(data, "o int, patient_id string, study_source string, sex string, os_event int")


def test_rules_of_the_tables():
    assert sum(len(s.checks) for s in TABLES.values()) == 21
    assert sum(len(s.foreign_keys) for s in TABLES.values()) == 8


def test_violations(spark):
    df = q.conform(patients(spark, [
        (1, "A", "METABRIC", "F", 1), (2, "B", "INVALID", "F", None), (3, "C", None, "FEMALE", 2),
        (4, "D", "METABRIC", None, None)]), PATIENTS).select("patient_id", q.violations(PATIENTS).alias("r"))
    assert dict(rows(df)) == {
        "A": [], "B": ["check:study_source"], "D": [],
        "C": ["not_null:study_source", "check:sex", "check:os_event"]}


def test_defaults_fill_absent_columns_not_nulls(spark):
    df = spark.createDataFrame([("m", "t", "g", "WES")],
                               "mutation_id string, tumor_id string, gene_symbol string, sequencing_scope string")
    row = q.conform(df, MUTATIONS).head()
    assert (row.reference_genome, row.in_metabric_panel) == ("GRCh38", 0)
    null_build = df.withColumn("reference_genome", F.lit(None).cast("string"))
    got = q.insert_ignore(MUTATIONS, null_build, [])
    assert got.stored.count() == 0
    assert rows(got.rejected, "reasons") == [(["not_null:reference_genome"],)]


def test_insert_ignore(spark):
    batch = patients(spark, [
        (1, "A", "BAD", "F", 1), (2, "A", "METABRIC", "F", 1), (3, "A", "METABRIC", "M", 0),
        (4, "B", "METABRIC", "F", 1), (5, None, "METABRIC", "F", 1), (6, None, "METABRIC", "F", 1)])
    existing = q.conform(patients(spark, [(1, "B", "METABRIC", "M", 0)]), PATIENTS)
    got = q.insert_ignore(PATIENTS, batch, ["o"], existing)
    # The broken row does not use up its key; rows without a key are all kept.
    assert rows(got.stored, "patient_id", "sex") == [("A", "F"), (None, "F"), (None, "F")]
    assert rows(got.rejected, "patient_id", "sex", "reasons") == [
        ("A", "F", ["check:study_source"]), ("A", "M", ["duplicate_in_batch"]), ("B", "F", ["already_stored"])]
    assert got.attempted.count() == 6 == got.stored.count() + got.rejected.count()


def test_insert_ignore_does_not_depend_on_partitions(spark):
    data = [(i, "HOT" if i % 3 == 0 else f"P{i % 40}", "METABRIC", "F" if i % 2 else "M", i % 2) for i in range(500)]
    results = []
    for n in (1, 8):
        got = q.insert_ignore(PATIENTS, patients(spark, data).repartition(n, "sex"), ["o"])
        results.append((rows(got.stored, "patient_id", "sex"), rows(got.rejected, "patient_id", "sex")))
    assert results[0] == results[1]
    assert len(results[0][0]) == 41 and len(results[0][1]) == 459


def test_foreign_keys(spark):
    parents = patients(spark, [(1, "A", "METABRIC", "F", 1)])
    children = spark.createDataFrame([("t1", "A"), ("t2", "FAKE"), ("t3", None)], "tumor_id string, patient_id string")
    fk = TUMORS.foreign_keys[0]
    with pytest.raises(ValueError, match="FAKE"):
        q.check_foreign_keys(TUMORS, children, {"patients": parents})
    q.check_foreign_keys(TUMORS, children.where("tumor_id <> 't2'"), {"patients": parents})
    good, bad = q.quarantine_orphans(children, fk, parents)
    assert rows(good, "tumor_id") == [("t1",), ("t3",)] and rows(bad, "tumor_id") == [("t2",)]
    assert rows(q.cascade_delete(children, fk, parents), "tumor_id") == [("t2",), ("t3",)]


def test_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"))
    assert store.count("patients") == 0
    many = patients(spark, [(i, f"P{i}", "METABRIC", "F", 0) for i in range(5001)])
    store.insert("patients", many, ["o"])
    store.insert("patients", many, ["o"])
    assert store.count("patients") == 5001
    orphan = spark.createDataFrame([(1, "FAKE", "NONEXISTENT")], "o int, tumor_id string, patient_id string")
    with pytest.raises(ValueError, match="NONEXISTENT"):
        store.insert("tumors", orphan, ["o"])
    assert store.count("tumors") == 0
    got = store.insert("tumors", orphan, ["o"], on_orphan="reject")
    assert rows(got.rejected, "tumor_id", "reasons") == [("FAKE", ["foreign_key:patient_id"])]
    store.truncate("patients")
    assert store.count("patients") == 0


def test_audit_log(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db")).create()
    assert store.count("harmonization_log") == 16
    store.create()
    assert store.count("harmonization_log") == 16
    store.log([("t", "BOTH", "f", "x", None, None)])
    last = store.read("harmonization_log").orderBy(F.desc("log_id")).select("log_id", *LOG_FIELDS).head()
    assert tuple(last) == (17, "t", "BOTH", "f", "x", None, None)
