"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; the fractional rank
(rank - 1/2) / (rows of the source) spreads every source evenly over 0 to 1. Sorted by it
and cut into equal runs, every shard holds the mixture of the whole.

Both rankings are exact without a large group in one task: ranks within small cells of
the order, plus the number of rows in the cells before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Cells per source, and of the interleaved order. A hot source is spread over as many tasks.
CELLS = 1024


def _numbered(rows: DataFrame, group: list[str], cell: Column, order: list[str], name: str, total: str) -> DataFrame:
    """Add the position from 0 within ``group`` in the order of (cell, order), and the
    group's number of rows. ``order`` tells all rows of a cell apart, or they are alike."""
    rows = rows.withColumn("_cell", cell)
    sizes = rows.groupBy(*group, "_cell").agg(F.count("*").alias("_n"))
    # CELLS rows a group at most.
    before = Window.partitionBy(*group).orderBy("_cell")
    offsets = sizes.select(
        *[F.col(c).alias(f"_of_{c}") for c in [*group, "_cell"]],
        (F.sum("_n").over(before) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*group)).alias(total),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*group, "_cell"]]
    within = F.row_number().over(Window.partitionBy(*group, "_cell").orderBy(*order)) - 1
    return (
        rows.withColumn("_within", within).join(offsets, same, "left")
        .withColumn(name, F.col("_before") + F.col("_within"))
        .drop("_cell", "_within", "_before", *[f"_of_{c}" for c in [*group, "_cell"]])
    )


def interleave(docs: DataFrame, shards: int, seed: int = 0, cells: int = CELLS) -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot): counts of shards differ by one at
    most, and so do a source's, but for the rounding of the cuts.

    size: UTF-8 bytes of the text plus 16. A null source is a source of its own; a null
    text has no bytes; repeated rows are dealt each; null ids are ranked like others; an
    empty table gives no rows; other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")).alias("_hash"),
    )
    ties = ["doc_id", "text_crc32", "size"]
    ranked = _numbered(
        rows, ["source"], F.pmod(F.shiftrightunsigned("_hash", 32), F.lit(cells)), ["_hash", *ties], "_rank", "_rows")
    share = ranked.withColumn("_share", (F.col("_rank") + 0.5) / F.col("_rows")).withColumn("_all", F.lit(0))
    placed = _numbered(
        share, ["_all"], F.floor(F.col("_share") * cells), ["_share", "_hash", "source", *ties], "_place", "_total")
    # Shard k starts at the first place p with p * shards >= k * total.
    shard = F.expr(f"(_place * {shards}) div _total").cast("int")
    start = F.expr(f"(_shard * _total + {shards - 1}) div {shards}")
    return placed.withColumn("_shard", shard).select(
        "doc_id", "source", "size", "text_crc32", F.col("_shard").alias("shard"),
        (F.col("_place") - start).cast("bigint").alias("slot"))
