"""Order-dependent operators (E1-E3, E5) on explicit order columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpointed


def keep_first(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """First row per key.

    ``row_number() = 1`` plans a group limit below the shuffle, so a hot key sends
    one row per map task.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_last(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Last row per key (later rows overwrite earlier ones)."""
    return keep_first(df, key, [F.col(c).desc() for c in order])


def sequential_numbers(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Number all rows 1..n in ``order``, which must be a total order.

    A distributed sort, then per-partition offsets: no global window. The sorted
    rows are checkpointed so that counting and numbering see the same partitions.
    """
    ranked = checkpointed(
        df.orderBy(*order).select(
            "*",
            F.spark_partition_id().alias("_part"),
            # The low 33 bits count rows within a partition.
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
        )
    )
    # One row per sort partition, at most spark.sql.shuffle.partitions of them.
    sizes = ranked.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        ranked.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row") + 1)
        .drop("_part", "_row", "_offset")
    )


def sequential_ids(df: DataFrame, name: str, prefix: str, order: list[str], width: int = 6) -> DataFrame:
    """``prefix`` + running number in ``order``, zero-padded."""
    numbered = sequential_numbers(df, "_number", order)
    return numbered.withColumn(
        name, F.format_string(f"{prefix}%0{width}d", "_number")).drop("_number")


def content_ids(df: DataFrame, name: str, prefix: str, key: list[str], chunk: int = 10_000) -> DataFrame:
    """E5: ``prefix`` + 32 hex digits of the hashed row content and copy number. Each value
    is hashed with its length, so no two rows give the same text; null is not empty.

    Equal rows are counted, which collapses copies before the shuffle, and written
    out again with numbers 1..n, the rare large counts in chunks over many tasks.
    All other columns must follow from ``key``. Reloading the same rows gives the
    same ids, so loads can be repeated.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    n, part = F.col("_n"), F.col("_part")
    few = counted.where(n <= chunk).select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), n)).alias("_copy"))
    many = (
        counted.where(n > chunk)
        .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / chunk))).alias("_part"))
        .repartition("_part", *key)
        .select("*", F.explode(F.sequence(part * chunk + 1, F.least(n, (part + 1) * chunk))).alias("_copy"))
        .drop("_part")
    )
    texts = [F.col(c).cast("string") for c in [*key, "_copy"]]
    parts = [F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("null")) for x in texts]
    digits = F.substring(F.sha2(F.concat_ws(chr(31), *parts), 256), 1, 32)
    return few.unionByName(many).withColumn(name, F.concat(F.lit(prefix), digits)).drop("_n", "_copy")
