"""Lookups between tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed
from .dedupe import keep_last

BROADCAST_ROWS = 200_000


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, beyond: str | None = None) -> DataFrame:
    """Broadcast ``df`` if it has at most ``max_rows`` rows, else leave the join to
    a shuffle with skew splitting. ``df`` is computed once, for check and use.

    ``beyond`` is a hint for the larger table. With "merge" the engine cannot broadcast it by its estimate,
    which a checkpoint inherits and which does not count rows that were exploded."""
    table = checkpointed(df)
    if table.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(table)
    return table.hint(beyond) if beyond else table


def join_with_suffix(left: DataFrame, right: DataFrame, key: str, suffix: str) -> DataFrame:
    """Left join; clashing right columns get ``suffix``."""
    clashes = {c: c + suffix for c in right.columns if c != key and c in left.columns}
    return left.join(right.withColumnsRenamed(clashes), key, "left")


def last_value_lookup(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the last one in order."""
    return keep_last(df, [key], order).drop(*order)


def members(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is in ``keys``."""
    return df.join(keys, on, "left_semi")


def non_members(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """C5"""
    return df.join(keys, on, "left_anti")


def member_counts(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """(n_matched, n_skipped). Rows are counted per key before the join."""
    flagged = keys.select(on).distinct().withColumn("_hit", F.lit(1))
    return (
        df.groupBy(on).agg(F.count("*").alias("_n")).join(flagged, on, "left")
        .agg(
            F.coalesce(F.sum(F.when(F.col("_hit") == 1, F.col("_n"))), F.lit(0)).alias("n_matched"),
            F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0)).alias("n_skipped"),
        )
    )


def shared_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys present on both sides."""
    return a.select(key).intersect(b.select(key))


def flag_members(df: DataFrame, keys: DataFrame, key: str, flag: str, large: bool = True) -> DataFrame:
    """0/1 column. With a ``large`` ``df`` it pays to size the keys beforehand,
    as a small set then spares shuffling ``df``; otherwise the optimizer decides."""
    marked = keys.select(key).distinct().withColumn("_hit", F.lit(1))
    marked = checked_broadcast(marked) if large else marked
    return df.join(marked, key, "left").withColumn(
        flag, F.col("_hit").isNotNull().cast("int")
    ).drop("_hit")


def null_free(df: DataFrame, column: str) -> DataFrame:
    """Drop nulls, keep NaN."""
    return df.where(F.col(column).isNotNull())


def null_label(c: Column) -> Column:
    return F.coalesce(c, F.lit("NULL"))
