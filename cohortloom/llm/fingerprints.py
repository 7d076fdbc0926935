"""Document fingerprints from Lempel-Ziv phrases.

A text's bytes are parsed into phrases: each is the shortest run that is not yet in the
dictionary, which it then enters. The dictionary is kept as the hashes of its phrases; the
fingerprint is the smallest of them. Two fingerprints estimate how much two dictionaries
share, which follows how well one text compresses given the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .base import identified_texts

#: Hashes kept per fingerprint.
SIZE = 128
SEED, MULTIPLIER, BITS48 = 7, 1_000_003, (1 << 48) - 1
SPREAD = np.uint64(0x9E3779B97F4A7C15)
LOWEST = -(1 << 63)


def parse(data: bytes, phrases: set[int], state: int = SEED) -> int:
    """Add the phrases of ``data`` to the dictionary; ``state`` is the hash of the run
    that has begun before, and the result that of the run left open at the end."""
    add = phrases.add
    for byte in data:
        state = (state * MULTIPLIER ^ byte) & BITS48
        if state not in phrases:
            add(state)
            state = SEED
    return state


def smallest(phrases: set[int]) -> np.ndarray:
    """The smallest hashes, sorted."""
    mixed = np.unique((np.fromiter(phrases, np.uint64, len(phrases)) * SPREAD) >> np.uint64(32))
    return mixed[:SIZE].astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common phrases, from the smallest hashes of both together."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:SIZE]
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True)).mean())


def written(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


class _Document:
    """A text parsed up to where its edited text differs, and as a whole."""

    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.n_chars = doc_id, len(text)
        self.head = text[:self.n_chars - self.n_chars // 4]
        tail = text[len(self.head):]
        self.phrases: set[int] = set()
        self.state = parse(self.head.encode(), self.phrases)
        whole = self.phrases.copy() if tail else self.phrases
        parse(tail.encode(), whole, self.state)
        self.hashes = smallest(whole)

    def beside(self, follower: _Document, start: str) -> tuple:
        """The row of this document, given the next one and the first of its text."""
        edit = start[:self.n_chars // 4]
        phrases = self.phrases
        parse(edit.encode(), phrases, self.state)
        edited = smallest(phrases)
        digest = hashlib.sha256((self.head + edit).encode()).hexdigest()
        return (self.doc_id, self.n_chars, digest, written(self.hashes), written(edited),
                likeness(self.hashes, edited), likeness(self.hashes, follower.hashes))


FIELDS = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents come in order, the one after each run's last behind it as its guest."""
    before, run = None, None
    for batch in batches:
        out = []
        for of_run, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            if of_run != run:
                before, run = None, of_run
            if guest and before is None:
                continue
            document = _Document(doc_id, text)
            if before is not None:
                out.append(before.beside(document, text))
            before = None if guest else document
            if len(out) == 1000:
                yield _arrow(out)
                out = []
        if out:
            yield _arrow(out)


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), FIELDS)], schema=FIELDS)


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint), one row per document, without a shuffle.

    A null or empty text has an empty fingerprint; null ids and repeated rows are kept;
    an empty table gives no rows; other columns are not read.
    """
    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                phrases: set[int] = set()
                parse(text.encode(), phrases)
                out.append(written(smallest(phrases)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "fingerprint"])

    return identified_texts(docs).mapInArrow(run, "doc_id bigint, fingerprint string")


def fingerprint_beside_edits(docs: DataFrame, runs: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last quarter is replaced
    by the first as many characters of the next document in the order of doc_id (after
    the last: the first).

    The order is cut into ``runs`` of about as many documents (by default four per
    shuffle partition). A run is one shuffle key, and the first document of a run also
    goes to the run before. Texts are shuffled once and parsed in order. Null texts are
    empty; null ids come first; of documents with the same id the one with the smaller
    hash of the text; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = runs or 4 * parts
    rows = identified_texts(docs).withColumn("key", F.coalesce("doc_id", F.lit(LOWEST)))
    cuts = rows.select("key").agg(F.percentile_approx(
        "key", [i / runs for i in range(1, runs)] or [0.5], F.lit(20 * runs))).first()[0] or []
    cuts = sorted(set(cuts if runs > 1 else []))
    edges = F.array(*map(F.lit, cuts)) if cuts else None
    run = F.size(F.filter(edges, lambda x: x <= F.col("key"))) if cuts else F.lit(0)
    # One row per run.
    firsts = rows.select(run.alias("run"), "key").groupBy("run").agg(F.min("key").alias("key")).sort("run").collect()
    guests = spark.createDataFrame(
        [(f.key, firsts[k - 1].run) for k, f in enumerate(firsts)], "key bigint, guest_of int")
    homes = F.array(
        F.struct(run.alias("run"), F.lit(False).alias("guest")),
        F.struct(F.col("guest_of").alias("run"), F.lit(True).alias("guest")))
    dealt = (
        rows.join(F.broadcast(guests), "key", "left")
        .withColumn("home", F.explode(F.filter(homes, lambda h: h["run"].isNotNull())))
        .select("home.run", "home.guest", "doc_id", "text")
    )
    ordered = dealt.repartition(parts, "run").sortWithinPartitions(
        "run", "guest", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return ordered.mapInArrow(
        _rows, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")
