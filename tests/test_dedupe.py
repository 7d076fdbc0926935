"""Order-dependent operators give the same rows for any partitioning."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import dedupe
from conftest import rows


@pytest.fixture(params=[1, 8])
def data(spark, request):
    # A third of all rows share key 0.
    out = [(0 if i % 3 == 0 else i % 11, i, f"v{i}") for i in range(600)]
    return spark.createDataFrame(out, "k int, o int, v string").repartition(request.param, "v")


def test_keep_first_and_last(data):
    first, last = {}, {}
    for k, o, v in sorted(rows(data), key=lambda r: r[1]):
        first.setdefault(k, v)
        last[k] = v
    assert dict(rows(dedupe.keep_first(data, ["k"], ["o"]), "k", "v")) == first
    assert dict(rows(dedupe.keep_last(data, ["k"], ["o"]), "k", "v")) == last


def test_keep_first_limits_groups_before_the_shuffle(spark):
    data = spark.range(100, numPartitions=4).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = dedupe.keep_first(data, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(k") < plan.index("Partial")


def test_sequential_ids(data):
    got = dedupe.sequential_ids(data, "id", "T-", ["o"])
    assert rows(got, "o", "id") == sorted(
        ((i, f"T-{i + 1:06d}") for i in range(600)), key=lambda t: (False, str(t[0])))


def test_sequential_ids_grow_past_the_width(data):
    assert {r[0] for r in rows(dedupe.sequential_ids(data, "id", "", ["o"], width=2), "id")} == {
        f"{i:02d}" for i in range(1, 601)}


@pytest.mark.parametrize("chunk", [7, 10_000])
def test_content_ids_number_copies(spark, chunk):
    # 40 identical rows among a few others.
    df = spark.createDataFrame([("a", 1)] * 40 + [("b", 2), (None, 3)], "x string, y int").repartition(5)
    got = dedupe.content_ids(df, "id", "P-", ["x"], chunk)

    def expected(x, n):
        x = "null" if x is None else f"{len(x)}:{x}"
        return "P-" + hashlib.sha256(f"{x}\x1f{len(str(n))}:{n}".encode()).hexdigest()[:32]
    assert sorted(r[0] for r in got.select("id").collect()) == sorted(
        [expected("a", n) for n in range(1, 41)] + [expected("b", 1), expected(None, 1)])
    assert rows(got.groupBy("x", "y").count()) == [("a", 1, 40), ("b", 2, 1), (None, 3, 1)]
    again = dedupe.content_ids(df.repartition(7, "x"), "id", "P-", ["x"])
    assert rows(again) == rows(got)


def test_content_ids_tell_null_from_empty_and_borders_apart(spark):
    rows = [("a", None), ("a", ""), (None, "a"), ("", "a"), ("a\x1f1:b", "c"), ("a", "b\x1f1:c"), ("null", None), (None, None)]
    got = dedupe.content_ids(spark.createDataFrame(rows, "x string, y string"), "id", "P-", ["x", "y"])
    assert len({r.id for r in got.collect()}) == len(rows)
