"""What keys a stored file may hold: their range and a Bloom filter, built from the files.

The filter of a file is a set of bitmaps of 32,768 bits, about 16 bits per key, in which
two hashes of every key are set. So of the keys that a file does not hold, about 1.4 % pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 32_768
KEYS_PER_BITMAP = BITS // 16
SEEDS = (1, 2)


def _whole(key: list[str]) -> Column:
    """A key with a null in it equals no other."""
    return F.forall(F.array(*(F.col(c).isNotNull() for c in key)), lambda known: known)


def _range(key: list[str]) -> list[Column]:
    return [F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high")]


def file_ranges(rows: DataFrame, key: list[str]) -> DataFrame:
    """(file, low, high, n_keys) of (file, *key)."""
    return rows.where(_whole(key)).groupBy("file").agg(*_range(key), F.count("*").alias("n_keys"))


def file_bitmaps(rows: DataFrame, key: list[str], n_bitmaps: int) -> DataFrame:
    """(file, n_bitmaps, number, bits) of (file, *key); a task sends bitmaps only."""
    place = F.explode(F.array(*(F.pmod(F.xxhash64(F.lit(s), *key), F.lit(n_bitmaps * BITS)) for s in SEEDS)))
    placed = rows.where(_whole(key)).select("file", place.alias("place"))
    return placed.groupBy("file", F.floor(F.col("place") / BITS).alias("number")).agg(
        F.bitmap_construct_agg(F.pmod("place", F.lit(BITS))).alias("bits")).select(
        "file", F.lit(n_bitmaps).alias("n_bitmaps"), "number", "bits")


def in_range(ranges: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``ranges`` that overlap the range of the batch's keys. That is one row, and
    the types of the keys are those of the stored ones."""
    own = batch.where(_whole(key)).agg(*_range(key))
    low, high = own.select(F.struct("low").alias("v")).scalar(), own.select(F.struct("high").alias("v")).scalar()
    return ranges.where((F.col("high") >= low["low"]) & (F.col("low") <= high["high"]))


def may_hold(files: DataFrame, bitmaps: DataFrame, batch: DataFrame, key: list[str], sizes: list[int]) -> DataFrame:
    """(file): those of ``files`` whose filter passes one of the batch's keys. ``sizes``
    are the numbers of bitmaps in use, a few."""
    keys = batch.where(_whole(key)).select(*key).distinct().select(*(F.xxhash64(F.lit(s), *key).alias(f"h{s}") for s in SEEDS))
    of_size = keys.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("n_bitmaps"))
    places = [F.pmod(f"h{s}", F.col("n_bitmaps") * BITS) for s in SEEDS]
    first, second = (F.struct(F.floor(p / BITS).alias("number"), F.pmod(p, F.lit(BITS)).alias("bit")) for p in places)
    wanted = of_size.select("h1", "h2", "n_bitmaps", F.explode(F.array(first, second)).alias("p")).select(
        "h1", "h2", "n_bitmaps", "p.*").distinct()
    here = bitmaps.join(files.select("file"), "file", "left_semi")
    # Bit b of a bitmap is bit b % 8 of byte b // 8.
    byte = F.conv(F.hex(F.substring("bits", (F.col("bit") / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    # A byte is at most 255, so a set bit shows in the odd quotient by its power of two.
    is_set = F.floor(byte / F.pow(F.lit(2.0), F.pmod("bit", F.lit(8)))) % 2 == 1
    hits = wanted.join(here, ["n_bitmaps", "number"]).where(is_set)
    n_places = wanted.groupBy("h1", "h2", "n_bitmaps").agg(F.count("*").alias("n_places"))
    return hits.groupBy("file", "h1", "h2", "n_bitmaps").agg(F.count("*").alias("n_hits")).join(
        n_places, ["h1", "h2", "n_bitmaps"]).where("n_hits = n_places").select("file").distinct()
