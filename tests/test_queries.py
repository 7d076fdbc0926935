"""Every registered query against its SQL in DuckDB, and what plans must not hold."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from cohortloom.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield con
    con.close()


def comparable(records):
    def cell(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)
    return sorted(tuple(cell(v) for v in r) for r in records)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan and "Python" not in plan
    want = duck.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    types = dict(zip(want.columns, map(str, want.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    places = [want.columns.index(c) for c in columns]
    assert comparable(df.select(*columns).collect()) == comparable([[r[i] for i in places] for r in want.fetchall()])


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "study_source", "gene_symbol", "n_mutated_samples", "n_total_samples_in_study", "mutation_pct"]


def plan_of(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "q_b1")
    assert "EqualTo(o_orderstatus,F)" in plan
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"}


def test_latest_row_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "q_f3")


@pytest.mark.parametrize("name, table, scans", [("q_d_reject", "lineitem", 3), ("q_s1_counts", "lineitem", 6)])
def test_a_load_reads_its_batch_twice(spark, name, table, scans):
    """Once for the first row of every key, once for the rows; the third scan is of the
    rows stored before. Counting both sides without writing the judged rows doubles it."""
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= scans


def test_queries_leave_no_views_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    for name in ("q_i4", "q_g2_lines", "q_g3_lines"):
        entry.queries()[name](spark, FOLDER)
    assert {t.name for t in spark.catalog.listTables()} == before
