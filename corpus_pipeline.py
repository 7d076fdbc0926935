"""A training corpus in four stages: drop what has no language, keep one of each group of
near-duplicates, mask secrets, pack token ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.llm import language, near_texts, packing, secrets
from cohortloom.llm.base import prepared, table
from cohortloom.llm.queries import BYTE_BPE
from cohortloom.session import staged


#: Stages carry whole rows, so workers get less of them at a time than for a single operator.
BATCH_BYTES = str(4 << 20)
#: Workers outlive their stage and keep their words (250 bytes each) beside what the next one needs.
CACHE_PIECES = 200_000


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language, which needs a letter; filters are learned
    from the stage's own labels."""
    docs = prepared(docs, BATCH_BYTES)
    return language.keep_identified(docs, language.learn(docs, F.col("lang")))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near-duplicates, by the
    stage's shingles of five words and a similarity of 0.8 or more."""
    return near_texts.keep_one_of_each(prepared(docs, BATCH_BYTES), near_texts.Similarity(width=5, percent=80))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of each secret in its place."""
    return secrets.mask_secrets(prepared(docs, BATCH_BYTES))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths with their token ids."""
    return packing.pack(prepared(docs, BATCH_BYTES), BYTE_BPE, cache_pieces=CACHE_PIECES)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identified),
    ("near_duplicates", deduplicated),
    ("secrets", masked),
    ("packing", packed),
]

#: No SQL: tokenizer ids and checksums are beyond it. Tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents; each stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
