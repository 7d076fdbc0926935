"""Language identification with bit-sliced Bloom filters.

One table of slots serves up to 64 languages: a slot holds a bit per language, and the bitwise
and of an n-gram's slots gives all languages that contain it at once. Further languages have
further tables. A text's hits are
counted per language, freed of the hits that are expected by mistake, and set against the
share of hits that texts of the language have; the largest wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .base import id_remainder

#: The bound of the training sample: expected documents per language, chosen by a hash
#: of their id. All statistics of a language are taken from it.
SAMPLE_DOCS = 5_000
#: An n-gram belongs to a language if it makes up so much of its n-grams, so a language
#: has 1 / LEAST_SHARE n-grams at most ...
LEAST_SHARE = 1e-5
#: ... and is at least so frequent against the language that has most of it.
LEAST_RATIO = 0.25
GRAM = 4
MASK_BITS = 64
SLOT_BITS = 20
#: Odd multipliers of the three hash functions; products with an n-gram fit 64 bits.
MULTIPLIERS = (0x5E3779B1, 0x45EBCA77, 0x42B2AE3D)

#: Languages whose tables a worker can be asked to hold (half a gigabyte); more are refused.
MOST_LANGUAGES = 4_096
#: A text's language is doubted where less of its n-grams than this, against texts of the language,
#: are in its filter ...
LEAST_EVIDENCE = 0.02
#: ... unless the text has too few n-grams to tell.
LEAST_GRAMS = 40

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
#: Bytes of ASCII that are no letters become spaces.
LETTERS_ONLY = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


class Filters(NamedTuple):
    languages: list[str]  # bit by bit
    slots: np.ndarray  # by table and slot, a mask of languages
    mistaken: np.ndarray  # share of foreign n-grams that a language's filter lets pass
    own: np.ndarray  # share of a language's n-grams that are in its filter
    common: int  # the language with most documents


#: Characters of texts that are taken apart at a time; a longer text is taken alone.
SLICE = 1 << 20


def in_slices(texts: list) -> Iterator[slice]:
    """Runs of texts of about SLICE characters. Their n-grams take some forty times the memory."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text or "") > SLICE:
            yield slice(start, i)
            start, size = i, 0
        size += len(text or "")
    if start < len(texts):
        yield slice(start, len(texts))


def letters_of(text: str) -> bytes:
    """Lower-case letters, with one space for all else."""
    return b" " + b" ".join(text.lower().encode().translate(LETTERS_ONLY).split()) + b" "


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts as integers, and where each text's n-grams end."""
    padded = [t.ljust(GRAM) for t in texts]
    flat = np.frombuffer(b"".join(padded), np.uint8).astype(np.uint32)
    lengths = np.array([len(t) for t in padded], np.int64)
    ends = np.cumsum(lengths)
    if not len(flat):
        return np.zeros(0, np.uint32), ends
    grams = flat[:-3] | flat[1:-2] << 8 | flat[2:-1] << 16 | flat[3:] << 24
    keep = np.ones(len(flat), bool)
    for back in range(1, GRAM):
        keep[ends - back] = False
    return grams[keep[:len(grams)]], np.cumsum(lengths - GRAM + 1)


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    return [(grams * np.uint32(m)) >> np.uint32(32 - SLOT_BITS) for m in MULTIPLIERS]


def _bit(masks: np.ndarray, language: int) -> np.ndarray:
    kind = masks.dtype.type
    return masks >> kind(language % MASK_BITS) & kind(1)


def learn(docs: DataFrame, label: Column, sample_docs: int = SAMPLE_DOCS) -> Filters:
    """Filters of all non-null values of ``label``, from a sample that is bounded per
    language. Null texts are skipped; without any label the filters know no language."""
    spark = docs.sparkSession
    labelled = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", label.cast("string").alias("lang")
    ).where("lang is not null and text is not null")
    # One row per language.
    counted = labelled.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counted) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    sizes = sorted((-r["count"], r["lang"]) for r in counted)
    languages = sorted(lang for _, lang in sizes)
    kind = next(k for k, bits in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 64))
                if len(languages) <= bits or bits == MASK_BITS)
    table = np.zeros((-(-len(languages) // MASK_BITS), 1 << SLOT_BITS), kind)
    if not languages:
        return Filters([], table, np.zeros(0), np.ones(0), 0)

    shares = spark.createDataFrame(
        [(lang, i, int(min(1.0, sample_docs / -n) * (1 << 30))) for n, lang in sizes for i in [languages.index(lang)]],
        "lang string, bit int, below long")
    chosen = labelled.join(F.broadcast(shares), "lang").where(
        F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 30)) < F.col("below"))

    def count(batches):
        for batch in batches:
            bits, texts = np.array(batch.column(0), np.int64), batch.column(1).to_pylist()
            for part in in_slices(texts):
                grams, ends = grams_of([letters_of(t) for t in texts[part]])
                of = np.repeat(bits[part], np.diff(ends, prepend=0))
                keys, n = np.unique(of << 32 | grams, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys >> 32, pa.int32()), pa.array(keys & 0xFFFFFFFF), pa.array(n)], ["bit", "gram", "n"])

    counts = chosen.select("bit", "text").mapInArrow(count, "bit int, gram bigint, n bigint").groupBy("bit", "gram").agg(
        F.sum("n").alias("n"))
    # At most SLOT_BITS slots and one row per language come back.
    totals = counts.groupBy("bit").agg(F.sum("n").alias("total"))
    shared = counts.join(F.broadcast(totals), "bit").withColumn("share", F.col("n") / F.col("total")).where(
        F.col("share") >= LEAST_SHARE)
    best = shared.groupBy("gram").agg(
        F.max("share").alias("most"), F.collect_list(F.struct("bit", "share")).alias("bits"))
    kept = best.select("gram", "most", F.explode("bits").alias("b")).where(
        F.col("b.share") >= LEAST_RATIO * F.col("most")).select("gram", "b.bit", "b.share")
    own = np.ones(len(languages))
    for r in kept.groupBy("bit").agg(F.sum("share").alias("own")).collect():
        own[r.bit] = r.own
    places = F.array(*[
        F.shiftright((F.col("gram") * m).bitwiseAND(0xFFFFFFFF), 32 - SLOT_BITS) for m in MULTIPLIERS])
    slots = kept.select(
        F.expr(f"bit div {MASK_BITS}").alias("of"), F.explode(places).alias("slot"),
        F.expr(f"shiftleft(1L, bit % {MASK_BITS})").alias("mask")
    ).groupBy("of", "slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    table[slots["of"].to_numpy(), slots["slot"].to_numpy()] = slots["mask"].to_numpy().view(np.uint64).astype(kind)
    filled = np.array([np.count_nonzero(_bit(table[i // MASK_BITS], i)) / table.shape[1] for i in range(len(languages))])
    return Filters(languages, table, filled ** len(MULTIPLIERS), own, languages.index(sizes[0][1]))


def decide(texts: list[str | None], filters: Filters) -> tuple[list[str], list[float], list[bool]]:
    """Language and score of each text, the winner's part of what all languages have, and
    whether its n-grams bear the language out."""
    parts = [_decide(texts[part], filters) for part in in_slices(texts)]
    return tuple([x for p in parts for x in p[k]] for k in range(3))


def _decide(texts: list[str | None], filters: Filters) -> tuple[list[str], list[float], list[bool]]:
    found = [t is not None and bool(filters.languages) and LETTER.search(t) is not None for t in texts]
    known = [letters_of(t) for t, ok in zip(texts, found) if ok]
    if not known:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
    grams, ends = grams_of(known)
    starts = np.concatenate([[0], ends[:-1]])
    sizes = np.diff(ends, prepend=0).astype(float)
    places, hits = _slots(grams), []
    for k, table in enumerate(filters.slots):
        mask = table[places[0]]
        for slot in places[1:]:
            mask = mask & table[slot]
        hits += [np.add.reduceat(_bit(mask, i).astype(np.int64), starts)
                 for i in range(k * MASK_BITS, min((k + 1) * MASK_BITS, len(filters.languages)))]
    true = np.maximum(0, (np.stack(hits, 1) - sizes[:, None] * filters.mistaken) / np.maximum(1e-9, 1 - filters.mistaken))
    weight = true / np.maximum(filters.own, 1e-9)
    total = weight.sum(1)
    best = np.where(total > 0, weight.argmax(1), filters.common)
    score = np.where(total > 0, weight.max(1) / np.maximum(total, 1e-300), 0.0)
    borne = (weight.max(1) >= LEAST_EVIDENCE * sizes) | (sizes < LEAST_GRAMS)
    out = iter(zip(best.tolist(), score.tolist(), borne.tolist()))
    rows = [next(out) if ok else (-1, 0.0, False) for ok in found]
    return ([filters.languages[i] if i >= 0 else UNKNOWN for i, _, _ in rows],
            [s for _, s, _ in rows], [ok for _, _, ok in rows])


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, lang_pred, score), one row per document, without a shuffle.

    A text that is null or has no letters is ``und`` with score 0; one without any known
    n-gram is of the most frequent language with score 0. Null ids and repeated rows are
    kept; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        for batch in batches:
            languages, scores, _ = decide(batch.column(1).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def keep_identified(docs: DataFrame, filters: Filters) -> DataFrame:
    """The rows whose text has a language, all columns as they are, repeated rows and null ids
    among them. Null texts and those without a letter go, and so do texts of LEAST_GRAMS n-grams
    or more whose corrected counts fall short of LEAST_EVIDENCE in every learned language. Where
    the filters know no language, all texts with a letter stay. An empty table gives no rows; a
    very long text is judged as a whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            if shared.value.languages:
                keep = decide(texts, shared.value)[2]
            else:
                keep = [t is not None and LETTER.search(t) is not None for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def training_label(doc_id: Column, lang: Column) -> Column:
    """The label of documents that are not held out."""
    return F.when(id_remainder(doc_id, 4) != 2, lang)
