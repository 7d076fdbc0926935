"""Registered queries: a Spark function and the SQL that gives the same rows.

The star-schema tables stand in for the cohorts: customers are patients, orders
are tumors, line items are variants, brands are genes, events are treatments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Parquet tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its equivalent SQL."""
    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(tune(spark), folder))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def sql_list(values: list) -> str:
    return ", ".join("NULL" if v is None else "'" + str(v).replace("'", "''") + "'" for v in values)


def sql_pick(values: list, key: str) -> str:
    """SQL text: the value at position ``key`` modulo the number of values. Works in
    both engines and spreads test texts over every row."""
    cases = " ".join(
        f"WHEN {i} THEN {sql_list([v])}" for i, v in enumerate(values)
    )
    return f"CASE ({key}) % {len(values)} {cases} END"


def sql_map(column: str, mapping: dict, default: str = "NULL") -> str:
    """SQL text: a vocabulary lookup."""
    cases = " ".join(f"WHEN {sql_list([k])} THEN {sql_list([v])}" for k, v in mapping.items())
    return f"CASE {column} {cases} ELSE {default} END"


def sql_content_id(prefix: str, columns: list[str], copy: str) -> str:
    """SQL text: the id of a row by its content and the number of its copy (E5)."""
    def part(x: str) -> str:
        return f"coalesce(length(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), 'null')"

    joined = " || chr(31) || ".join(map(part, [*columns, copy]))
    return f"'{prefix}' || substr(sha256({joined}), 1, 32)"
