"""A third of all rows on one key: joins split it, groups collapse before shuffles."""

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import liftover
from cohortloom.operators.lookup import checked_broadcast, flag_members, member_counts
from cohortloom.plans import views
from conftest import rows
from test_liftover import SCHEMA

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_limits(spark):
    """Scale the engine's size limits down to the size of the test data."""
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


N = 60_000


def hot(column="id"):
    return F.when(F.col(column) % 3 == 0, 0).otherwise(F.col(column) % 997)


@pytest.fixture
def star(spark):
    patients = spark.range(50).select(F.col("id").alias("patient_id"), F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("study_source"))
    tumors = spark.range(997).select(F.col("id").alias("tumor_id"), (F.col("id") % 50).alias("patient_id"))
    mutations = spark.range(N, numPartitions=12).select(
        F.col("id").alias("mutation_id"), hot().alias("tumor_id"), F.concat(F.lit("G"), F.col("id") % 7).alias("gene_symbol"),
        F.sha2(F.col("id").cast("string"), 256).alias("hgvsp"), F.lit(1).alias("in_metabric_panel"))
    return mutations, patients, tumors


def final_plan(df):
    """The plan after adaptive execution of the same frame."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


def test_row_level_join_splits_the_hot_key(spark, star, small_limits):
    columns = ["mutation_id", "study_source", "tumor_id", "gene_symbol", "hgvsp"]
    joined = views.mutations_cross_study(*star, columns)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == N and joined.select("mutation_id").distinct().count() == N


def test_frequency_collapses_before_the_join(spark, star, small_limits):
    mutations, patients, tumors = star
    got = views.mutation_frequency(mutations, patients, tumors, parity=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    want = (mutations.join(tumors, "tumor_id").join(patients, "patient_id").groupBy("study_source", "gene_symbol")
            .agg(F.countDistinct("tumor_id").alias("n_mutated_samples")))
    assert rows(got, "study_source", "gene_symbol", "n_mutated_samples") == rows(want)


def test_member_counts(spark, star, small_limits):
    mutations, _, tumors = star
    got = member_counts(mutations, tumors.where("tumor_id < 10"), "tumor_id").head()
    matched = mutations.where("tumor_id < 10").count()
    assert tuple(got) == (matched, N - matched)


def test_liftover_of_a_hot_position(spark, small_limits):
    blocks = spark.createDataFrame(
        [(i, 100 + i % 5, "chr1", i * 50, i * 50 + 40, "chr2", i * 60, 10**6, "+") for i in range(2000)], SCHEMA)
    variants = spark.range(N, numPartitions=12).select(
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit("1").alias("chromosome"),
        F.when(F.col("id") % 3 == 0, 101).otherwise(F.col("id") % 99_000 + 1).alias("start_position"),
        F.lit(None).cast("bigint").alias("end_position"), F.lit("GRCh37").alias("reference_genome"))
    lifted = liftover.lift_variants(variants, blocks, broadcast_pieces=0)
    assert "skew=true" in final_plan(lifted)
    counts = liftover.lift_summary(lifted).head()
    # Of every 50 positions 40 are covered.
    assert counts.total == N and counts.lifted == variants.where("(start_position - 1) % 50 < 40").count()
    broadcast = liftover.lift_variants(variants, blocks)
    assert "Exchange hashpartitioning" not in broadcast._jdf.queryExecution().executedPlan().toString()
    assert broadcast.exceptAll(lifted).isEmpty()
    assert rows(lifted.where("start_position = 121").groupBy("chromosome").count())[0][1] >= N // 3


def test_checked_broadcast_has_another_way(spark):
    keys = spark.range(100).withColumnRenamed("id", "k")
    facts = spark.range(1000).select((F.col("id") % 150).alias("k"))
    small, large = checked_broadcast(keys, 100), checked_broadcast(keys, 99)
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    assert facts.join(small, "k").count() == facts.join(large, "k").count()
    flagged = flag_members(facts, keys, "k", "f")
    assert flagged.where("f = 1").count() == facts.where("k < 100").count()
