"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: as many of the
limit as fit, then the binary digits of the rest from the largest down. Each piece is a
sequence of its own in the bucket of its length, so no sequence crosses documents and
none is padded.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .base import identified_texts
from .tokens import piece_encoder

LIMIT = 2048
SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"


def binary_lengths(n: int, limit: int) -> Iterator[int]:
    """Powers of two that add up to n, none above the limit, largest first."""
    for _ in range(n // limit):
        yield limit
    rest, power = n % limit, limit
    while power > 1:
        power //= 2
        if rest & power:
            yield power


def pack(docs: DataFrame, tokenizer: str, limit: int = LIMIT, end_id: int = 1, cache_pieces: int | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (little-endian unsigned
    32-bit), sequence_id, offset, bucket (binary logarithm of the length).

    ``limit`` is a power of two. There is no shuffle: pieces stay where their document was
    read, sequences are numbered by input partition. A null or empty text is the end id
    alone; a null doc_id stays null; repeated rows are packed each; an empty table gives
    no rows; other columns are not read. ``cache_pieces`` bounds the words whose ids a worker keeps, for
    as long as it lives.
    """
    if limit < 1 or limit & (limit - 1):
        raise ValueError("the limit must be a power of two")
    end = end_id.to_bytes(4, "little")

    def cut(batches):
        encoder = piece_encoder(tokenizer, cache_pieces)
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.encode(text) + end
                n, at = len(ids) // 4, 0
                for length in binary_lengths(n, limit):
                    rows.append((doc_id, at, length, n, ids[4 * at:4 * (at + length)]))
                    at += length
                size += len(ids)
                if size > 8 << 20:
                    yield arrow(rows)
                    rows, size = [], 0
            yield arrow(rows)

    sequences = identified_texts(docs).mapInArrow(cut, SCHEMA)
    return sequences.select(
        "*",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
        F.log2("length").cast("int").alias("bucket"),
    )


def arrow(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "length", "doc_tokens", "ids"])


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder per bucket of equal lengths; a trainer draws a batch from one of them."""
    packed.write.partitionBy("bucket").parquet(path)
