"""Alignment chain files as a table of ungapped blocks (I4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .delimited import LINE_ORDER, with_line_order

BLOCK_COLUMNS = ["chain_id", "score", "t_chrom", "t_start", "t_end",
                 "q_chrom", "q_start", "q_size", "strand"]


def read_chain(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of a chain file (plain or gzip).

    A chain is a header line and lines "size dt dq"; offsets are running sums
    within the chain. Chains are reference data: their size does not follow the
    size of the tables lifted with them.
    """
    lines = with_line_order(spark.read.text(path)).where(
        ~F.col("value").startswith("#") & (F.length(F.btrim("value")) > 0)
    )
    is_header = F.col("value").startswith("chain")
    numbered = _number_chains(lines, is_header)
    part = F.split(F.btrim("value"), r"\s+")
    headers = numbered.where(is_header).select(
        "_file", "_chain",
        part[1].cast("bigint").alias("score"),
        part[2].alias("t_chrom"), part[5].cast("bigint").alias("_t0"),
        part[7].alias("q_chrom"), part[8].cast("bigint").alias("q_size"),
        part[9].alias("strand"), part[10].cast("bigint").alias("_q0"),
        F.coalesce(F.get(part, F.lit(12)).try_cast("bigint"), F.col("_chain")).alias("chain_id"),
    )
    steps = numbered.where(~is_header).select(
        "_file", "_chain", *LINE_ORDER[1:],
        part[0].cast("bigint").alias("_size"),
        F.coalesce(F.get(part, F.lit(1)).cast("bigint"), F.lit(0)).alias("_dt"),
        F.coalesce(F.get(part, F.lit(2)).cast("bigint"), F.lit(0)).alias("_dq"),
    )
    earlier = (
        Window.partitionBy("_file", "_chain").orderBy(*LINE_ORDER[1:])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0).cast("bigint")
    offsets = steps.withColumns({
        "_t_off": F.coalesce(F.sum(F.col("_size") + F.col("_dt")).over(earlier), zero),
        "_q_off": F.coalesce(F.sum(F.col("_size") + F.col("_dq")).over(earlier), zero),
    })
    return offsets.join(headers, ["_file", "_chain"]).select(
        "chain_id", "score", "t_chrom",
        (F.col("_t0") + F.col("_t_off")).alias("t_start"),
        (F.col("_t0") + F.col("_t_off") + F.col("_size")).alias("t_end"),
        "q_chrom", (F.col("_q0") + F.col("_q_off")).alias("q_start"), "q_size", "strand",
    )


def _number_chains(lines: DataFrame, is_header: Column) -> DataFrame:
    """Running count of headers per file: within each scan split, then split offsets."""
    in_split = Window.partitionBy("_file", "_block").orderBy("_line")
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = lines.groupBy("_file", "_block").agg(F.count_if(is_header).alias("_n"))
    offsets = sizes.select("_file", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    local = F.sum(is_header.cast("int")).over(in_split)
    return (
        lines.withColumn("_local", local).join(offsets, ["_file", "_block"])
        .withColumn("_chain", F.col("_before") + F.col("_local")).drop("_before", "_local")
    )
