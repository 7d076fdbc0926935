"""Helpers that several operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import tune

#: Bounds what a Python worker holds at a time when texts are very long.
BATCH_BYTES = str(16 << 20)


def prepared(df: DataFrame, batch_bytes: str = BATCH_BYTES) -> DataFrame:
    """The same rows, in a session set up for the operators."""
    tune(df.sparkSession).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch_bytes)
    return df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table."""
    return prepared(spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet"))


def identified_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone, so that other columns can neither clash nor be read. A
    null text is empty."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus
