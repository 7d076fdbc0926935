"""MinHash near-duplicates with sequential Bayesian verification.

Texts with the same set of word shingles form a class, and one of them stands for it.
Signatures are cut into bands; classes that agree in a band are candidates. A candidate
pair's signatures are compared batch by batch, and the pair is given up as soon as its
similarity is unlikely to reach the threshold given the agreements so far. What is left
is verified on the full sets.

A bucket's members are first compared with one leader, so a group of near copies costs as
many pairs as it has members. Where a bucket then still holds several components, its
members are compared in tiles, the likeliest pairs first, as long as they are apart; a
tile returns the links that join components, never the pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged
from .base import identified_texts
from .components import connected_components
from .tiles import in_tiles

BANDS, ROWS = 30, 5
BATCH = 30
#: Probability with which a pair at the threshold may be given up, at each batch.
MISS = 1e-7
#: Members of a bucket that are compared in one task on either side, and pairs at a time.
TILE, PAIRS = 512, 50_000
TILE_KEY = ["band", "key", "i", "j"]
#: Sets that a task keeps while it verifies pairs of a tile; beyond, they are made again.
SET_BYTES = 256 << 20
#: Bits of the filter by which documents that are no candidates are left out early. It is
#: of fixed size; beyond some ten million candidates it lets more pass, all to be joined.
FILTER_BITS = 25
#: Texts are hashed together up to so many bytes.
CHUNK_BYTES = 1 << 20

_RANDOM = np.random.Generator(np.random.PCG64(20_240_601))
BYTE_HASHES = _RANDOM.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
STEP = 0x9E3779B97F4A7C15
STEP_BACK = pow(STEP, -1, 1 << 64)
MULTIPLIERS = _RANDOM.integers(1, 1 << 63, BANDS * ROWS, np.uint64) | np.uint64(1)
SHINGLE_STEP = np.uint64(0xD6E8FEB86659FD93)

#: [\\x20\\x09-\\x0D] separates words; A-Z are lowered.
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[9, 10, 11, 12, 13, 32]] = True


class Similarity(NamedTuple):
    width: int = 5
    percent: int = 80


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers under which every bit counts."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=1)
def _steps(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(STEP, n), _powers(STEP_BACK, n)


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word. A word's hash is a difference of running sums of
    byte hashes times powers, shifted back to the power zero."""
    raw = np.frombuffer(data, np.uint8)
    blank = IS_BLANK[raw]
    edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    forth, back = _steps(max(2 * CHUNK_BYTES, len(raw)))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_HASHES[raw] * forth[:len(raw)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text; one of all words if there are fewer."""
    sets: list[np.ndarray] = []
    waiting: list[bytes] = []
    size = 0
    for text in texts:
        waiting.append(text.encode().lower())
        size += len(waiting[-1])
        if size >= CHUNK_BYTES:
            sets += _sets_of(waiting, width)
            waiting, size = [], 0
    return sets + _sets_of(waiting, width)


def _sets_of(texts: list[bytes], width: int) -> list[np.ndarray]:
    if not texts:
        return []
    words, starts = _word_hashes(b" ".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    last = np.searchsorted(starts, ends).tolist()
    n = max(0, len(words) - width + 1)
    shingles = np.zeros(n, np.uint64)
    for k in range(width):
        shingles = shingles * SHINGLE_STEP + words[k:k + n]
    shingles = _mixed(shingles)
    out, first = [], 0
    for end in last:
        if end - first >= width:
            out.append(np.unique(shingles[first:end - width + 1]))
        elif end > first:
            value = end - first
            for w in words[first:end].tolist():
                value = (value * int(SHINGLE_STEP) + w) & ((1 << 64) - 1)
            out.append(_mixed(np.array([value], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        first = end
    return out


def signatures(sets: list[np.ndarray]) -> list[bytes | None]:
    """Upper halves of the minima under each multiplier; none for an empty set."""
    full = [s for s in sets if len(s)]
    if not full:
        return [None] * len(sets)
    table = np.empty((len(MULTIPLIERS), len(full)), np.uint32)
    at = 0
    while at < len(full):
        # As many sets at a time as stay in the processor's cache.
        end, size = at, 0
        while end < len(full) and (end == at or size + len(full[end]) <= 1 << 15):
            size += len(full[end])
            end += 1
        flat = np.concatenate(full[at:end])
        starts = np.cumsum([0, *map(len, full[at:end - 1])])
        for k, m in enumerate(MULTIPLIERS):
            table[k, at:end] = np.minimum.reduceat(flat * m, starts) >> np.uint64(32)
        at = end
    rows = iter(np.ascontiguousarray(table.T))
    return [next(rows).tobytes() if len(s) else None for s in sets]


def least_agreements(percent: int, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared, agreements needed): with fewer, the similarity reaches the
    threshold with a posterior probability below ``miss``, from an even prior."""
    t, out = percent / 100, []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        # P(s >= t | m of n agree) is the chance of at most m hits in n + 1 throws at t.
        tail, m = 0.0, 0
        while m <= n:
            tail += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def _agreeing(left: np.ndarray, right: np.ndarray, x: np.ndarray, y: np.ndarray, plan) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs (left[x], right[y]) are left by sequential verification, and
    the agreements of those."""
    alive, agree, before = np.arange(len(x)), np.zeros(len(x), np.int64), 0
    for n, least in plan:
        agree[alive] += (left[x[alive], before:n] == right[y[alive], before:n]).sum(1)
        alive, before = alive[agree[alive] >= least], n
    return alive, agree[alive]


def _signatures_of(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), BANDS * ROWS)


def _promising(pairs: DataFrame, classes: DataFrame, like: Similarity) -> DataFrame:
    """Pairs (a, b) of classes that sequential verification leaves."""
    plan = least_agreements(like.percent)

    def prune(batches):
        for batch in batches:
            every = np.arange(batch.num_rows)
            alive, _ = _agreeing(_signatures_of(batch.column(2)), _signatures_of(batch.column(3)), every, every, plan)
            chosen = pa.array(alive)
            yield pa.RecordBatch.from_arrays([batch.column(k).take(chosen) for k in (0, 1)], ["a", "b"])

    of = classes.select("node", "n_shingles", "signature")
    left = of.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("s_a"))
    right = of.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("s_b"))
    # A set cannot be that similar to one of another size.
    sized = pairs.join(left, "a").join(right, "b").where(
        100 * F.least("n_a", "n_b") >= like.percent * F.greatest("n_a", "n_b"))
    return sized.select("a", "b", "s_a", "s_b").mapInArrow(prune, "a bigint, b bigint")


def _starts(table: pa.Table) -> np.ndarray:
    """Where the tiles of a sorted table start."""
    change = np.zeros(table.num_rows, bool)
    change[:1] = True
    for c in TILE_KEY:
        column = table.column(c).to_numpy()
        change[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(change)


def _whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches as tables that no tile crosses: the last tile of a batch waits for the next one."""
    waiting = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if waiting is not None:
            table = pa.concat_tables([waiting, table])
        cut = int(_starts(table)[-1]) if table.num_rows else 0
        if cut:
            yield table.slice(0, cut)
        waiting = table.slice(cut)
    if waiting is not None and waiting.num_rows:
        yield waiting


def _pairs_apart(tiles: pa.Table, plan, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows x, y of one tile and component each that sequential verification leaves, and
    their agreements; all tiles of the table at once, by the distance of the rows."""
    starts = _starts(tiles)
    end = np.repeat(np.append(starts[1:], tiles.num_rows), np.diff(starts, append=tiles.num_rows))
    component, size, band, left, right = (
        tiles.column(c).to_numpy() for c in ("component", "n_shingles", "band", "left", "right"))
    signs = _signatures_of(tiles.column("signature"))
    x, distance, waiting, count = np.flatnonzero(left), 0, [], 0
    while len(x):
        distance += 1
        x = x[x + distance < end[x]]
        y = x + distance
        fit = right[y] & (component[x] != component[y]) & (
            100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y]))
        waiting.append(np.stack([x[fit], y[fit]]))
        count += waiting[-1].shape[1]
        if count < PAIRS and len(x):
            continue
        a, b = np.concatenate(waiting, 1)
        waiting, count = [], 0
        for at in range(0, len(a), PAIRS):
            alive, agree = _agreeing(signs, signs, a[at:at + PAIRS], b[at:at + PAIRS], plan)
            u, v = a[at:at + PAIRS][alive], b[at:at + PAIRS][alive]
            first = (signs[u] == signs[v]).reshape(len(u), BANDS, ROWS).all(2).argmax(1) == band[u]
            yield u[first], v[first], agree[first]


def _joining(members: DataFrame, components: DataFrame, classes: DataFrame, texts: DataFrame, like: Similarity) -> DataFrame:
    """Links (a, b) that join the components within each bucket, verified on full sets.
    A pair is looked at in the first band that it shares, and only while it is apart.

    Signatures alone are dealt out to tiles first. Texts are fetched for the rows that are
    left with a promising pair, to the same tiles.
    """
    plan = least_agreements(like.percent)
    bucket = ["band", "key"]
    placed = members.select(*bucket, "node").join(components.withColumnRenamed("id", "node"), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    mixed = placed.groupBy(*bucket).agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    rows = placed.join(mixed.select(*bucket), bucket, "left_semi").join(
        classes.select("node", "n_shingles", "signature"), "node")

    def promising(batches):
        for tiles in _whole_tiles(batches):
            used = np.zeros(tiles.num_rows, bool)
            for x, y, _ in _pairs_apart(tiles, plan, like.percent):
                used[x] = used[y] = True
            yield from tiles.filter(pa.array(used)).to_batches()

    def join(batches):
        for tiles in _whole_tiles(batches):
            found = [np.zeros((3, 0), np.int64), *map(np.stack, _pairs_apart(tiles, plan, like.percent))]
            a, b, agree = np.concatenate(found, 1)
            node, component, texts_of = tiles.column("node").to_numpy(), tiles.column("component").to_pylist(), tiles.column("text")
            tree = {c: c for c in component}
            sets: dict[int, np.ndarray] = {}
            held = 0

            def root(c: int) -> int:
                while tree[c] != c:
                    tree[c] = c = tree[tree[c]]
                return c

            def set_of(k: int) -> np.ndarray:
                nonlocal held
                if node[k] not in sets:
                    if held > SET_BYTES:
                        sets.clear()
                        held = 0
                    sets[node[k]] = shingle_sets([texts_of[k].as_py()], like.width)[0]
                    held += sets[node[k]].nbytes
                return sets[node[k]]

            links = []
            for k in np.argsort(-agree, kind="stable").tolist():
                i, j = int(a[k]), int(b[k])
                x, y = root(component[i]), root(component[j])
                if x != y and _alike(set_of(i), set_of(j), like):
                    tree[max(x, y)] = min(x, y)
                    links.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(node[a[links]]), pa.array(node[b[links]])], ["a", "b"])

    def by_tile(df: DataFrame) -> DataFrame:
        return df.repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY, "node")

    dealt = in_tiles(rows, bucket, "node", TILE)
    left = staged(by_tile(dealt).mapInArrow(promising, dealt.schema))
    return staged(by_tile(left.join(texts, "node")).mapInArrow(join, "a bigint, b bigint"))


def _alike(a: np.ndarray, b: np.ndarray, like: Similarity) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= like.percent * (len(a) + len(b) - common)


def _candidate_texts(docs: DataFrame, members: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, text) of the classes that share a bucket with another. A filter of fixed
    size spares most other texts the shuffle; the join is exact."""
    reps = classes.select("node", F.col("rep").alias("doc_id"), "text_key").join(
        members.select("node").distinct(), "node", "left_semi")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    words = reps.select(place.alias("p")).select(
        F.shiftright("p", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("bit")
    ).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def pass_on(batches):
        for batch in batches:
            p = np.array(batch.column(2), np.int64)
            hit = (shared.value[p >> 6] >> (p & 63)) & 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(hit.astype(bool))) for k in (0, 1)], ["doc_id", "text"])

    passed = docs.where("doc_id is not null").select("doc_id", "text", place).mapInArrow(
        pass_on, "doc_id bigint, text string")
    own = ["doc_id", "text_key"]
    return staged(passed.withColumn("text_key", text_key()).join(reps, own).groupBy(*own).agg(
        F.min("node").alias("node"), F.min("text").alias("text")).select("node", "text"))


def _linked(pairs: DataFrame, texts: DataFrame, like: Similarity) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough; written, as it is read again."""
    both = (
        pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("t_b")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("t_a")), "a")
        .select("a", "b", "t_a", "t_b")
    )

    def verify(batches):
        known = (None, None)
        for batch in batches:
            ids, keep = batch.column(0).to_pylist(), []
            right = shingle_sets(batch.column(3).to_pylist(), like.width)
            for a, text, other in zip(ids, batch.column(2), right):
                if known[0] != a:
                    known = a, shingle_sets([text.as_py()], like.width)[0]
                keep.append(_alike(known[1], other, like))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(mask) for k in (0, 1)], ["a", "b"])

    return staged(both.mapInArrow(verify, "a bigint, b bigint"))


class Graph(NamedTuple):
    signed: DataFrame  # doc_id, text_key, n_shingles, digest of every row
    classes: DataFrame  # digest, node, and the least row (rep, text_key) of each class
    links: DataFrame  # (a, b): nodes


def text_key() -> Column:
    """Tells texts with the same doc_id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _graph(docs: DataFrame, like: Similarity) -> Graph:
    """Classes of texts with the same set, and links that join all classes that are alike."""
    texts = identified_texts(docs)

    def sign(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), like.width)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array(signatures(sets), pa.binary())], ["doc_id", "text_key", "n_shingles", "digest", "signature"])

    signed = staged(texts.withColumn("text_key", text_key()).mapInArrow(
        sign, "doc_id bigint, text_key bigint, n_shingles bigint, digest binary, signature binary"))
    # One doc_id can stand for several classes, so they are numbered; the numbers are written.
    classes = staged(
        signed.where("digest is not null and doc_id is not null").groupBy("digest")
        .agg(F.min(F.struct("doc_id", "text_key", "n_shingles", "signature")).alias("least"))
        .select("digest", F.monotonically_increasing_id().alias("node"), F.col("least.doc_id").alias("rep"),
                "least.text_key", "least.n_shingles", "least.signature"))
    width = 4 * ROWS
    keys = F.array(*[F.struct(F.lit(k).alias("band"), F.xxhash64(F.substring("signature", width * k + 1, width)).alias("key"))
                     for k in range(BANDS)])
    members = classes.select("node", F.explode(keys).alias("_b")).select("_b.*", "node")
    heads = members.groupBy("band", "key").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1")
    members = staged(members.join(heads, ["band", "key"]).select("band", "key", "node", "leader"))
    candidates = _candidate_texts(texts, members, classes)

    stars = members.where("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = _linked(staged(_promising(stars, classes, like)), candidates, like)
    components = staged(connected_components(links))
    more = _joining(members, components, classes, candidates, like)
    return Graph(signed.drop("signature"), classes.select("digest", "node", "rep", "text_key"), links.union(more))


def _least_rows(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(digest, least) of every class: the least row (rep, text_key) that links reach."""
    components = staged(connected_components(links).withColumnRenamed("id", "node"))
    row = F.struct("rep", "text_key")
    least = components.join(classes, "node").groupBy("component").agg(F.min(row).alias("least"))
    reached = components.join(least, "component").select("node", "least")
    return classes.join(reached, "node", "left").select("digest", F.coalesce("least", row).alias("least"))


def near_duplicates(docs: DataFrame, like: Similarity = Similarity()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document. Documents are linked if
    the sets of their word shingles have a Jaccard similarity of ``like.percent`` or more;
    component_id is the smallest doc_id that links reach, and kept marks it.

    Null texts and texts without words have no set and link with nothing. Rows with the
    same doc_id count as one node, whatever their texts. A row with a null id belongs to
    the documents of the same set, if any, and has a null component otherwise. An empty
    table gives no rows; other columns are not read.
    """
    signed, classes, links = _graph(docs, like)
    rows = signed.select("doc_id", "n_shingles", "digest")
    # The texts of an id that has several are linked, and it stands for those without a set.
    several = staged(
        rows.where("doc_id is not null").groupBy("doc_id")
        .agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"), F.count("digest").alias("n"), F.count("*").alias("of"))
        .where("lo < hi or n < of and n > 0").select("doc_id", "lo"))
    node = classes.select("digest", "node")
    same_id = (
        rows.join(several, "doc_id").where("digest > lo").select("lo", "digest").distinct()
        .join(node.select(F.col("digest").alias("lo"), F.col("node").alias("a")), "lo")
        .join(node.withColumnRenamed("node", "b"), "digest").select("a", "b")
    )
    found = rows.join(several, "doc_id", "left").withColumn("digest", F.coalesce("digest", "lo")).join(
        _least_rows(classes, links.union(same_id)), "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("least.rep"))
    return found.withColumn("component_id", component).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one_of_each(docs: DataFrame, like: Similarity = Similarity()) -> DataFrame:
    """The row with the smallest doc_id of each group of near-duplicates, all columns as
    they are. Texts are grouped by their links alone: a text stays if none of its group
    does, also where its doc_id has another text that goes. Of rows with the same doc_id
    and text one stays; rows with a null id all stay."""
    signed, classes, links = _graph(docs, like)
    own = F.struct(F.col("doc_id").alias("rep"), "text_key")
    named = signed.where("doc_id is not null")
    gone = named.join(_least_rows(classes, links), "digest").where(own != F.col("least")).select("doc_id", "text_key").distinct()
    repeated = named.groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key")
    marks = staged(gone.withColumn("goes", F.lit(True)).unionByName(repeated.withColumn("goes", F.lit(False))).groupBy(
        "doc_id", "text_key").agg(F.max("goes").alias("goes")))
    # The rows as structs, so that no column of theirs can clash.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("text_key"))
    # Only rows that a filter of fixed size does not rule out are shuffled to their marks.
    place = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(1 << FILTER_BITS))
    filter_words = marks.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits"))
    tested = rows.withColumn("p", place).withColumn("word", F.shiftright("p", 6)).join(F.broadcast(filter_words), "word", "left")
    hit = F.col("doc_id").isNotNull() & F.coalesce(F.expr("(shiftright(bits, cast(p % 64 as int)) & 1) = 1"), F.lit(False))
    marked = tested.where(hit).select("row", "doc_id", "text_key").join(marks, ["doc_id", "text_key"], "left")
    first = marked.where("goes = false").dropDuplicates(["doc_id", "text_key"])
    return tested.where(~hit).select("row").union(marked.where("goes is null").select("row")).union(
        first.select("row")).select("row.*")
