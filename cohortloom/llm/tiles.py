"""Comparing the rows of a group with each other in tiles of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def in_tiles(rows: DataFrame, group: list[str], unit: str, limit: int, is_left: Column | None = None) -> DataFrame:
    """Deal the rows of each group out to tiles ``i``, ``j``, with flags ``left`` and
    ``right``: every left row meets every row of its group, on the right, in one tile.

    A group of n rows becomes a square of ceil(n / limit) tiles a side, where the hash of
    ``unit`` is a row's number. Groups within the limit are one tile and are not copied.
    """
    left = F.lit(True) if is_left is None else is_left
    crowded = rows.groupBy(*group).agg(F.ceil(F.count("*") / limit).cast("int").alias("_tiles")).where("_tiles > 1")
    known = rows.join(crowded, group, "left").withColumn("_tiles", F.coalesce("_tiles", F.lit(1))).withColumn(
        "_own", F.pmod(F.xxhash64(unit), F.col("_tiles")).cast("int"))
    own, numbers = F.col("_own"), F.sequence(F.lit(0), F.col("_tiles") - 1)
    as_left = F.transform(F.filter(numbers, lambda j: left), lambda j: F.struct(
        own.alias("i"), j.alias("j"), F.lit(True).alias("left"), (j == own).alias("right")))
    as_right = F.transform(F.filter(numbers, lambda i: ~left | (i != own)), lambda i: F.struct(
        i.alias("i"), own.alias("j"), F.lit(False).alias("left"), F.lit(True).alias("right")))
    return known.withColumn("_tile", F.explode(F.concat(as_left, as_right))).select(*rows.columns, "_tile.*")
