"""Snapshots, the key index and cascades of a store."""

import itertools

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import key_index
from cohortloom.operators.cascade import affected_tables
from cohortloom.operators.quality import insert_ignore, key_certificate
from cohortloom.plans import snapshot
from cohortloom.plans.schema import TABLES
from cohortloom.plans.store import Store
from cohortloom.sources import files
from conftest import rows


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "db"))


def variants(spark, ids, build, tumor="T1"):
    return spark.createDataFrame(
        [(i, tumor, "G", build, "WES", 1) for i in ids],
        "mutation_id string, tumor_id string, gene_symbol string, reference_genome string, sequencing_scope string, "
        "in_metabric_panel int")


def cells(spark, study, tumors, genes):
    return spark.createDataFrame(
        [(f"{study}-{t:03d}", f"G{g}", 1) for t in tumors for g in genes], "tumor_id string, gene_symbol string, gistic_value int")


def test_each_variant_once_between_the_steps_of_a_swap(spark, store, monkeypatch):
    """A reader at every step of a swap sees the old rows or the new ones, whole; a failure at any
    step leaves the old ones, and the swap can be repeated."""
    store.append("mutations", variants(spark, ["a", "b", "c"], "GRCh37"))
    store.append("mutations", variants(spark, ["d"], "GRCh38"))
    old = rows(store.read("mutations"), "mutation_id", "reference_genome")
    lifted = store.read("mutations").where("reference_genome = 'GRCh37'").withColumn("reference_genome", F.lit("GRCh38"))
    early = store.read("mutations").select("mutation_id", "reference_genome")
    seen = []
    steps = [(snapshot.TableFolder, "add"), (snapshot.TableFolder, "_index"), (files, "publish_json")]
    for owner, name in steps:
        real = getattr(owner, name)

        def broken(*args, **kwargs):
            seen.append(rows(Store(spark, store.root).read("mutations"), "mutation_id", "reference_genome"))
            if owner is not files:
                real(*args, **kwargs)
            raise OSError(name)

        with monkeypatch.context() as m:
            m.setattr(owner, name, broken)
            with pytest.raises(OSError, match=name):
                store.move_partition("mutations", "GRCh37", lifted)
        assert rows(store.read("mutations"), "mutation_id", "reference_genome") == old
    assert seen == [old] * 3
    store.move_partition("mutations", "GRCh37", lifted)
    new = [(i, "GRCh38") for i in "abcd"]
    assert rows(store.read("mutations"), "mutation_id", "reference_genome") == new and store.count("mutations") == 4
    # Who began to read before the swap still finds the old files, until they are cleared away.
    assert rows(early) == old
    before = set(files.names(spark, f"{store.root}/mutations/data"))
    store.vacuum()
    assert len(files.names(spark, f"{store.root}/mutations/data")) == 2 < len(before)
    assert files.names(spark, f"{store.root}/_snapshots") == ["000000000003.json"]
    assert rows(store.read("mutations"), "mutation_id", "reference_genome") == new


def test_transactions_are_all_or_nothing(spark, store):
    store.append("mutations", variants(spark, ["a"], "GRCh37"))
    other = Store(spark, store.root)
    with pytest.raises(ZeroDivisionError), store.transaction():
        store.append("mutations", variants(spark, ["b"], "GRCh37"))
        store.log([("t", "BOTH", "f", "x", None, None)])
        assert store.count("mutations") == 2 and other.count("mutations") == 1
        1 / 0
    assert store.count("mutations") == 1 and store.count("harmonization_log") == 0
    with store.transaction():
        store.overwrite("mutations", store.read("mutations").withColumn("gene_symbol", F.lit("H")))
        store.log([("t", "BOTH", "f", "x", None, None)])
    assert rows(other.read("mutations"), "mutation_id", "gene_symbol") == [("a", "H")]
    assert other.count("harmonization_log") == 1 and other.snapshot().number == 2


def test_a_second_writer_fails(spark, store):
    now = snapshot.latest(spark, store.root)
    snapshot.publish(spark, store.root, now)
    with pytest.raises(FileExistsError):
        snapshot.publish(spark, store.root, now)


def used_files(df):
    return {f.rpartition("/")[2] for f in df.inputFiles()}


def test_an_insert_reads_only_files_that_may_hold_a_key(spark, store, monkeypatch):
    """Another study's files are out of range. Within the range, filters rule files out."""
    store.insert("copy_number", cells(spark, "TCGA", range(40), range(50)).repartition(4), [], "trust")
    store.insert("copy_number", cells(spark, "MB", range(40), range(50)).repartition(4), [], "trust")
    parts, folder = store.snapshot().parts("copy_number"), store._folder("copy_number")
    mb = used_files(folder.rows(parts[1:]))
    batch = cells(spark, "MB", [1, 900], [49, 99])
    held = folder.may_hold(parts, batch)
    assert used_files(held) == mb and len(mb) == 4
    # The plan names no file of the other study.
    assert parts[0].path not in held._jdf.queryExecution().executedPlan().toString()
    assert folder.may_hold(parts, cells(spark, "ZZ", [1], [1])) is None
    assert folder.may_hold(parts, batch.limit(0)) is None
    monkeypatch.setattr(snapshot, "FEW_KEYS", 0)
    one = folder.may_hold(parts, cells(spark, "MB", [7], [9]))
    assert len(used_files(one)) < 4 and one.where("tumor_id = 'MB-007' and gene_symbol = 'G9'").count() == 1
    # The range of the tumors spans a key that no file holds.
    assert len(used_files(folder.may_hold(parts, cells(spark, "MB", [7], [77])) or spark.range(0))) < 4


def test_rows_are_those_of_the_full_comparison(spark, store, monkeypatch):
    spec = TABLES["copy_number"]
    loads = [cells(spark, "MB", range(0, 20), range(10)), cells(spark, "MB", range(10, 30), range(5, 15)),
             cells(spark, "TCGA", range(5), range(3)), cells(spark, "MB", range(0, 30), range(0, 15))]
    for few in (1_000_000, 0):
        monkeypatch.setattr(snapshot, "FEW_KEYS", few)
        store.truncate("copy_number")
        want = spark.createDataFrame([], spec.schema)
        for load in loads:
            want = want.union(insert_ignore(spec, load, [], want).stored)
            store.insert("copy_number", load, [], "trust")
            assert rows(store.read("copy_number")) == rows(want)
    assert store.loads[-1].reasons == {"already_stored": 350} and store.loads[-1].stored == 100


def test_filters_hold_every_key_and_few_others(spark):
    keys = spark.range(6000).select((F.col("id") % 3).cast("string").alias("file"), F.concat(F.lit("k"), "id").alias("a"), "id")
    ranges, bitmaps = key_index.file_ranges(keys, ["a", "id"]), key_index.file_bitmaps(keys, ["a", "id"], 1)
    for n in (0, 4001, 5999):
        hit = key_index.may_hold(ranges, bitmaps, keys.where(F.col("id") == n), ["a", "id"], [1])
        assert str(n % 3) in {r["file"] for r in hit.collect()}
    others = [len(key_index.may_hold(ranges, bitmaps, keys.limit(1).select(F.lit(f"z{n}").alias("a"), "id"), ["a", "id"], [1]).collect())
              for n in range(12)]
    assert sum(others) <= 6


def test_counts_read_no_column(spark, store):
    store.append("mutations", variants(spark, ["a", "b"], "GRCh37"))
    store.append("mutations", variants(spark, ["c"], "GRCh38").limit(0))
    store.append("mutations", variants(spark, ["c"], None))
    assert store.count("mutations") == store.read("mutations").count() == 3
    counted = store._folder("mutations")._scan([p.path for p in store.snapshot().parts("mutations")]).groupBy().count()
    assert "ReadSchema: struct<>" in counted._jdf.queryExecution().executedPlan().toString()


def clinic(spark, store, n_patients):
    people = [f"P{i}" for i in range(n_patients)]
    with store.transaction():
        store.append("patients", spark.createDataFrame([(p, "METABRIC") for p in people], "patient_id string, study_source string"))
        tumors = spark.createDataFrame([(f"{p}-{k}", p) for p in people for k in range(2)], "tumor_id string, patient_id string")
        store.append("tumors", tumors)
        store.append("treatments", spark.createDataFrame(
            [(f"R{i}", p, "Surgery", 1) for i, p in enumerate(people)],
            "treatment_id string, patient_id string, treatment_type string, received int"))
        for p in people:
            store.append("mutations", variants(spark, [f"{p}-m1", f"{p}-m2"], "GRCh37", f"{p}-1"))
        store.append("copy_number", tumors.select("tumor_id", F.lit("G").alias("gene_symbol"), F.lit(1).alias("gistic_value")))


def test_deleting_patients_deletes_all_below_them(spark, store):
    """Tumors, treatments, mutations and cells of two patients go; folders without them stay as they are."""
    clinic(spark, store, 4)
    before = {t: store.snapshot().parts(t) for t in TABLES}
    gone = spark.createDataFrame([("P1",), ("P3",), ("P3",), ("nobody",), (None,)], "patient_id string")
    assert store.delete("patients", gone) == {"patients": 2, "tumors": 4, "treatments": 2, "mutations": 4, "copy_number": 4}
    assert rows(store.read("patients"), "patient_id") == [("P0",), ("P2",)]
    assert rows(store.read("tumors"), "tumor_id") == [("P0-0",), ("P0-1",), ("P2-0",), ("P2-1",)]
    assert rows(store.read("treatments"), "patient_id") == [("P0",), ("P2",)]
    assert rows(store.read("mutations"), "mutation_id") == [("P0-m1",), ("P0-m2",), ("P2-m1",), ("P2-m2",)]
    assert rows(store.read("copy_number"), "tumor_id") == rows(store.read("tumors"), "tumor_id")
    assert store.snapshot().number == 2
    assert set(store.snapshot().parts("mutations")) < set(before["mutations"])
    assert store.delete("patients", gone) == {} and store.count("patients") == 2
    assert store.delete("tumors", spark.createDataFrame([("P0-1",)], "tumor_id string")) == {
        "tumors": 1, "mutations": 2, "copy_number": 1}


def test_parents_come_first():
    names = [s.name for s in affected_tables(list(TABLES.values()), "patients")]
    at = {n: i for i, n in enumerate(names)}
    assert names[0] == "patients" and set(names) == set(TABLES) - {"harmonization_log"}
    assert all(at[fk.parent] < at[n] for n in names for fk in TABLES[n].foreign_keys)
    assert [s.name for s in affected_tables(list(TABLES.values()), "treatments")] == ["treatments"]
    assert list(itertools.chain(*(s.key for s in affected_tables(list(TABLES.values()), "copy_number")))) == ["tumor_id", "gene_symbol"]


def test_a_repeated_key_fails_a_batch_without_order(spark, store):
    """Nothing is stored then; digests of keys are all that is shuffled."""
    good = cells(spark, "MB", range(5), range(4))
    store.insert("copy_number", good, [], "trust")
    assert store.loads[-1].distinct_keys == 20
    with pytest.raises(ValueError, match="3 rows of one key .tumor_id, gene_symbol."):
        store.insert("copy_number", cells(spark, "ZZ", [1, 2, 1, 1], [1]), [], "trust")
    assert store.count("copy_number") == 20 and len(store.loads) == 1
    store.insert("copy_number", cells(spark, "YY", range(2), range(2)), [], "trust", unique=True)
    assert store.loads[-1].distinct_keys is None
    digests = good.select(F.xxhash64(F.lit(1), "tumor_id", "gene_symbol").alias("h1"), F.xxhash64(F.lit(2), "tumor_id", "gene_symbol").alias("h2"))
    assert key_certificate(good, ["tumor_id", "gene_symbol"]) == (digests.distinct().count(), 1)
    assert key_certificate(good.limit(0), ["tumor_id"]) == (0, 0)
    assert key_certificate(good.withColumn("tumor_id", F.lit(None).cast("string")), ["tumor_id"]) == (0, 0)
