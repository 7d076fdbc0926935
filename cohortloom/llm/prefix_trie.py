"""The prefix trie of conversations by union-find over sorted neighbours.

A conversation is a key of 24-byte items, one per turn: 128 bits of a digest and the length of
the text. Distinct keys are sorted, so that those below a node are neighbours. A task takes
them in chunks: the edges between neighbours, as deep as the turns they share, are processed from the deepest up;
each merges two components in a node at its depth, and the nodes without a branch above either
component are written out.

Nodes on the path of a chunk's first or last key may go on in other chunks. Everything that
hangs below these paths is contracted into sums per depth, and the two keys with their sums
are all that is left of the chunk. They are sorted and taken in chunks in turn, until one chunk is left.

Long conversations are cut into segments, each a key below the digest of the turns before it,
so no row grows with a conversation. Their tries are built from the last segments up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import staged
from .base import id_remainder

ITEM = 24
HEADS = 6


class Sizes(NamedTuple):
    """What a row or a task holds at most."""

    #: Turns of a segment.
    segment: int = 1024
    #: Keys and items of a chunk; of the latter one key more.
    keys: int = 2048
    items: int = 1 << 18
    #: Characters of ids that are hashed at a time.
    piece: int = 1 << 16


_NOBODY = np.iinfo(np.int64).max
#: Sums of what hangs at a node: member conversations, the smallest of them, closed children, leaves and
#: saved code points below those, conversations that end here.
_N, _CONV, _KIDS, _LEAVES, _SAVED, _ENDS = range(6)
SUMS = ["n", "conv_id", "kids", "leaves", "saved", "ends"]

_NODE = [("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
         ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.int64()),
         ("digest", pa.string()), ("parent_digest", pa.string())]
_PART = pa.schema([*_NODE, ("key", pa.binary()), ("hanging", pa.binary())])
_PART_TYPE = ("depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
              "saved bigint, ends bigint, digest string, parent_digest string, key binary, hanging binary")


def _nothing(depth: int) -> np.ndarray:
    sums = np.zeros((depth + 1, 6), np.int64)
    sums[:, _CONV] = _NOBODY
    return sums


def _add(to: np.ndarray, more: np.ndarray) -> None:
    """Add one node's sums, or those of several depths."""
    conv = np.minimum(to[..., _CONV], more[..., _CONV])
    to += more
    to[..., _CONV] = conv


def shared_depths(keys: list[bytes]) -> np.ndarray:
    """How many items each key shares with the one before it; nothing for the first."""
    lengths = np.array([len(k) // ITEM for k in keys])
    words = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, ITEM // 8)
    begins = np.cumsum(lengths) - lengths
    place = np.arange(len(words)) - np.repeat(begins, lengths)
    before = np.concatenate([[0], lengths[:-1]])
    inside = place < np.repeat(before, lengths)
    other = np.where(inside, np.repeat(np.concatenate([[0], begins[:-1]]), lengths) + place, 0)
    differs = ~(inside & (words == words[other]).all(1))
    first = np.minimum.reduceat(np.where(differs, place, len(words)), begins)
    return np.minimum(first, lengths)


class _Chunk:
    """The forest of a chunk of sorted distinct keys (``hanging``: sums by depth, or those of
    the key's own node alone). ``whole``: there are no other chunks."""

    def __init__(self, keys: list[bytes], hanging: list[np.ndarray], whole: bool, named: bool):
        self.keys, self.whole, self.named = keys, whole, named
        self.nodes: list[list] = []
        self.tree = list(range(len(keys)))
        self.top = [len(k) // ITEM for k in keys]
        # Of a component: the sums of its top node, those of higher ones (rare), and
        # the nodes whose parent is its top node.
        self.sums = [h[-1] for h in hanging]
        self.above = [h if len(h) > 1 else None for h in hanging]
        self.below: list[list[int]] = [[] for _ in keys]
        self.ends = [] if whole else sorted({0, len(keys) - 1})
        self.open = {k: (hanging[k] if len(hanging[k]) > 1 else self._alone(k)).copy() for k in self.ends}
        self.on_path = {k: k for k in self.ends}

    def _alone(self, k: int) -> np.ndarray:
        sums = _nothing(self.top[k])
        sums[-1] = self.sums[k]
        return sums

    def _root(self, k: int) -> int:
        while self.tree[k] != k:
            self.tree[k] = self.tree[self.tree[k]]
            k = self.tree[k]
        return k

    def _digest(self, k: int, depth: int) -> str:
        return hashlib.md5(self.keys[k][:depth * ITEM]).hexdigest()

    def _climb(self, k: int, depth: int) -> None:
        """Write out the nodes of a closed component that are deeper than ``depth``."""
        sums, above, key = self.sums[k], self.above[k], self.keys[k]
        n, conv, kids, leaves, saved, ends = sums.tolist()
        for at in range(self.top[k], depth, -1):
            leaves += kids == 0
            saved += (n - 1) * int.from_bytes(key[at * ITEM - 8:at * ITEM], "big")
            for child in self.below[k]:
                self.nodes[child][2] = conv
            name = self._digest(k, at) if self.named or ends or at == 1 else None
            self.below[k] = [len(self.nodes)]
            self.nodes.append([at, conv, None, n, kids, leaves, saved, ends, name, None])
            kids, ends = 1, 0
            if above is not None:
                more = above[at - 1].tolist()
                n, conv, kids = n + more[_N], min(conv, more[_CONV]), kids + more[_KIDS]
                leaves, saved, ends = leaves + more[_LEAVES], saved + more[_SAVED], more[_ENDS]
        self.top[k] = depth
        self.sums[k] = np.array([n, conv, kids, leaves, saved, ends])

    def _hang(self, closed: int, end: int, depth: int) -> None:
        """Leave a closed component to an open path."""
        self._climb(closed, depth)
        sums = self.open[end]
        _add(sums[depth], self.sums[closed])
        if self.above[closed] is not None:
            _add(sums[:depth], self.above[closed][:depth])
        if self.below[closed]:
            name = self._digest(end, depth)
            for child in self.below[closed]:
                self.nodes[child][9] = name

    def _merge(self, left: int, right: int, depth: int) -> None:
        a, b = self._root(left), self._root(right)
        if a in self.on_path and b in self.on_path:
            first, last = self.on_path[a], self.on_path.pop(b)
            _add(self.open[first][:depth + 1], self.open[last][:depth + 1])
            self.open[last][:depth + 1] = _nothing(depth)
            self.tree[b] = a
        elif a in self.on_path or b in self.on_path:
            a, b = (a, b) if a in self.on_path else (b, a)
            self._hang(b, self.on_path[a], depth)
            self.tree[b] = a
        else:
            self._climb(a, depth)
            self._climb(b, depth)
            a, b = (a, b) if len(self.below[a]) >= len(self.below[b]) else (b, a)
            _add(self.sums[a], self.sums[b])
            self.below[a] += self.below[b]
            self.below[b] = []
            if self.above[a] is None:
                self.above[a] = self.above[b]
            elif self.above[b] is not None:
                self.above[a] = self.above[a][:depth].copy()
                _add(self.above[a], self.above[b][:depth])
            self.tree[b] = a

    def build(self) -> None:
        depths = shared_depths(self.keys)
        for k in np.argsort(-depths, kind="stable").tolist():
            if depths[k]:
                self._merge(k - 1, k, int(depths[k]))
        for k in range(len(self.keys)):
            if self._root(k) == k and k not in self.on_path:
                self._climb(k, 0)

    def rows(self) -> Iterator[list]:
        """The nodes, then what is left of the chunk."""
        yield from (node + [None, None] for node in self.nodes)
        for k in self.ends:
            yield [None] * len(_NODE) + [self.keys[k], self.open[k].tobytes()]


def _chunks(batches: Iterable[pa.RecordBatch], whole: bool, named: bool, sizes: Sizes) -> Iterator[pa.RecordBatch]:
    keys, hanging, items = [], [], 0

    def built():
        chunk = _Chunk(keys, hanging, whole, named)
        chunk.build()
        rows = list(chunk.rows())
        for at in range(0, len(rows), 10_000):
            columns = zip(*rows[at:at + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PART)], schema=_PART)

    for batch in batches:
        sums = np.stack([np.array(batch.column(2 + i), np.int64) for i in range(6)], 1)
        for key, packed, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sums):
            keys.append(key)
            hanging.append(own[None] if packed is None else np.frombuffer(packed, np.int64).reshape(-1, 6))
            items += len(key) // ITEM
            if not whole and (len(keys) >= sizes.keys or items >= sizes.items):
                yield from built()
                keys, hanging, items = [], [], 0
    if keys:
        yield from built()


def forest(keys: DataFrame, sizes: Sizes) -> DataFrame:
    """The nodes of the tries of distinct keys (key, n, conv_id, kids, leaves, saved, ends), as
    _NODE says, with ``depth`` counted in items."""
    rows = keys.select("key", F.lit(None).cast("binary").alias("hanging"), *SUMS)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done: list[DataFrame] = []
    while True:
        n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("key")), F.lit(0))).first()
        whole = n <= sizes.keys and size <= sizes.items * ITEM
        # Enough keys in a task that every round leaves a small part of them.
        n_tasks = 1 if whole else min(tasks, -(-n // max(4, sizes.keys // 8)))
        ordered = rows.repartitionByRange(n_tasks, "key").sortWithinPartitions("key")
        named = bool(done)
        parts = staged(ordered.mapInArrow(lambda batches: _chunks(batches, whole, named, sizes), _PART_TYPE))
        done.append(parts.where("key is null").drop("key", "hanging"))
        if whole:
            break
        zero = [F.lit(0).cast("bigint").alias(c) for c in SUMS]
        rows = parts.where("key is not null").select("key", "hanging", *zero)
    if len(done) == 1:
        return done[0]
    # Nodes that were on the path of a chunk were written by later rounds, with their digest.
    later = reduce(DataFrame.union, done[1:])
    names = later.select(F.col("digest").alias("parent_digest"), F.col("conv_id").alias("_parent"))
    both = reduce(DataFrame.union, done)
    known = both.where("parent_digest is null")
    found = both.where("parent_digest is not null").join(names, "parent_digest").withColumn("parent_conv_id", F.col("_parent"))
    return known.unionByName(found.drop("_parent"))


def _numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, item): turns by a number that grows with (conv_id, turn) without gaps.

    Texts are digests by now. A distributed sort, then an offset per partition."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    item = F.concat(digest, F.lpad(F.hex(F.length(text).cast("bigint")), 16, "0"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", item.alias("item"))
    ranked = staged(rows.orderBy("conv_id", F.asc_nulls_first("turn"), "item").select(
        "conv_id", "item", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row")))
    # One row per sort partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranked.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return ranked.join(F.broadcast(offsets), "part").select(
        "conv_id", (F.col("offset") + F.col("row")).alias("place"), "item")


def _rebuilt(turns: DataFrame, segment: int) -> DataFrame:
    """(conv_id, level, key, last): the segments of the rebuilt conversations.

    A conversation of t turns has t // segment + 1 segments, the last of which may be
    empty; ``last`` marks the one whose key ends at its last turn."""
    own = turns.groupBy("conv_id").agg(F.min("place").alias("first"), F.count("*").alias("n")).withColumns({
        "heads": id_remainder(F.col("conv_id"), HEADS), "base": F.col("conv_id") - F.col("conv_id") % 100})
    bases = own.where(F.col("conv_id") % 100 == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("heads", F.coalesce("n_base", F.lit(0)))
    convs = staged(own.join(bases, "base", "left").withColumn("taken", taken).withColumn(
        "total", F.col("taken") + F.greatest(F.col("n") - F.col("heads"), F.lit(0))))
    placed = turns.join(convs, "conv_id").withColumn("place", F.col("place") - F.col("first") + 1)
    late = placed.where(F.col("place") > F.col("heads")).select(
        "conv_id", (F.col("taken") + F.col("place") - F.col("heads")).alias("depth"), "item", "total")
    early = placed.where((F.col("conv_id") % 100 == 0) & (F.col("place") < HEADS)).select(
        F.col("conv_id").alias("base"), F.col("place").alias("depth"), "item")
    heads = early.join(convs.select("conv_id", "base", "taken", "total"), "base").where(
        F.col("depth") <= F.col("taken")).select("conv_id", "depth", "item", "total")
    level = F.floor((F.col("depth") - 1) / segment)
    filled = late.unionByName(heads).groupBy("conv_id", level.alias("level"), "total").agg(
        F.sort_array(F.collect_list(F.struct("depth", "item"))).alias("items")).select(
        "conv_id", "level", F.unhex(F.array_join("items.item", "")).alias("key"),
        (F.col("level") == F.floor((F.col("total") - 1) / segment)).alias("last"))
    empty = convs.where(F.col("total") % segment == 0).select(
        "conv_id", F.floor(F.col("total") / segment).alias("level"), F.lit(b"").alias("key"), (F.col("total") == 0).alias("last"))
    return filled.unionByName(empty)


def _root_item(*halves: Column) -> Column:
    """The first item of a key: the digest of the turns before the segment."""
    return F.unhex(F.concat(*(F.lpad(F.hex(h), 16, "0") for h in halves), F.lit("0" * 16)))


def _with_roots(segments: DataFrame, step_size: int = 1024) -> DataFrame:
    """Put the root item before each key, and ``next`` is that of the following segment. The
    digest of the turns before a segment is a sum of hashes without carry, in two steps, so
    that a very long conversation is not one group."""
    step = F.floor(F.col("level") / step_size)
    hashes = [F.xxhash64(F.lit(i), "level", "key").alias(f"x{i}") for i in (1, 2)]
    hashed = segments.select("*", *hashes, step.alias("step"))
    running = Window.partitionBy("conv_id").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = hashed.groupBy("conv_id", "step").agg(*(F.bit_xor(f"x{i}").alias(f"x{i}") for i in (1, 2))).select(
        "conv_id", "step", *(F.coalesce(F.bit_xor(f"x{i}").over(running), F.lit(0)).alias(f"s{i}") for i in (1, 2)))
    within = Window.partitionBy("conv_id", "step").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.bit_xor(f"x{i}").over(within), F.lit(0)) for i in (1, 2)]
    roots = hashed.withColumns({f"b{i}": b for i, b in zip((1, 2), before)}).join(steps, ["conv_id", "step"]).withColumns(
        {f"p{i}": F.col(f"b{i}").bitwiseXOR(F.col(f"s{i}")) for i in (1, 2)})
    after = _root_item(*(F.col(f"p{i}").bitwiseXOR(F.col(f"x{i}")) for i in (1, 2)))
    return roots.select("conv_id", "level", F.concat(_root_item(F.col("p1"), F.col("p2")), "key").alias("key"), "last",
                        F.md5(after).alias("next"))


def _hashed_ids(ends: DataFrame, piece: int) -> DataFrame:
    """(digest, ends_sha256) of (digest, conv_id): SHA-256 of the ascending ids of each digest, with commas.

    Sorted tasks hash the groups that lie within them, and pass the two at their borders on as pieces of text,
    to be hashed one after the other: a hot group is read as a stream, never held."""

    def within(batches):
        first, digest, start, ids, size = True, None, None, [], 0
        out: list[tuple] = []

        def closed(done: bool):
            nonlocal ids, size, start
            text = ",".join(ids)
            out.append((digest, start, hashlib.sha256(text.encode()).hexdigest() if done else None, None if done else text))
            ids, size, start = [], 0, None

        pieces = False
        for batch in batches:
            for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != digest:
                    if digest is not None:
                        closed(not first and not pieces)
                        first = False
                    digest, pieces = name, False
                elif size >= piece:
                    closed(False)
                    pieces = True
                start = conv if start is None else start
                text = str(conv)
                ids.append(text)
                size += len(text) + 1
            if out:
                yield _batch(out)
                out = []
        if digest is not None:
            closed(False)
            yield _batch(out)

    def _batch(rows):
        types = [pa.string(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], ["digest", "start", "sha", "piece"])

    def across(batches):
        digest, state, out = None, None, []
        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != digest:
                    if digest is not None:
                        out.append((digest, state.hexdigest()))
                    digest, state = name, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["digest", "ends_sha256"])
                out = []
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([digest]), pa.array([state.hexdigest()])], ["digest", "ends_sha256"])

    parts = staged(ends.orderBy("digest", "conv_id").mapInArrow(within, "digest string, start bigint, sha string, piece string"))
    pieces = parts.where("sha is null").select("digest", "start", "piece").repartition("digest").sortWithinPartitions(
        "digest", "start").select("digest", "piece")
    return parts.where("sha is not null").select("digest", F.col("sha").alias("ends_sha256")).union(
        pieces.mapInArrow(across, "digest string, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row per node
    of the trie of the rebuilt conversations of (conv_id, turn, role, text).

    Turns are ordered by ``turn``, null first; turns of the same number by a digest of role and
    text. A null role or text is empty. Conversation c is rebuilt from the first h turns of c - c % 100 and its
    own after the first h, h being crc32(c) % 6. A node is a distinct sequence of first turns; conv_id is its
    smallest member, n_leaves and saved_tokens cover its subtree.

    Rows with a null conv_id take no part; repeated rows are turns of their own. Texts enter as digests,
    whole, and a conversation of any number of turns is cut into segments of 1,024; every 1,024 turns of
    the longest are one more round. An empty table gives no rows; other columns are not read.
    """
    # No node without a conversation, so the root of an empty table is left out too.
    segments = staged(_rebuilt(_numbered(conversations), sizes.segment))
    deepest = segments.agg(F.max("level")).first()[0] or 0
    if deepest:
        segments = staged(_with_roots(segments))
    else:
        root = _root_item(F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))
        segments = segments.select("conv_id", "level", F.concat(root, "key").alias("key"), "last", F.lit("").alias("next"))
    keys = segments.groupBy("level", "key", "next").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.count_if("last").alias("ends"))
    keys = staged(keys) if deepest else keys
    nodes, totals = [], None
    zero = F.lit(0).cast("bigint")
    for level in range(deepest, -1, -1):
        rows = keys.where(F.col("level") == level)
        if totals is None:
            rows = rows.withColumns({"kids": zero, "leaves": zero, "saved": zero})
        else:
            full = F.octet_length("key") == (sizes.segment + 1) * ITEM
            rows = rows.withColumn("next", F.when(full, F.col("next"))).join(totals, "next", "left").withColumns(
                {c: F.coalesce(c, zero) for c in ("kids", "leaves", "saved")})
        built = forest(rows, sizes)
        totals = built.where("depth = 1").select(
            F.col("digest").alias("next"), F.col("n_children").alias("kids"),
            F.when(F.col("n_children") > 0, F.col("n_leaves")).otherwise(0).alias("leaves"), "saved")
        # Below the first level, a root is the last node of the segment before.
        nodes.append(built.where("depth > 1" if level else "true").withColumn("depth", F.col("depth") - 1 + level * sizes.segment))
    every = reduce(DataFrame.union, nodes)
    ids = _hashed_ids(segments.where("last").select(F.md5("key").alias("digest"), "conv_id"), sizes.piece)
    none = every.where("ends = 0").withColumn("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    some = every.where("ends > 0").join(ids, "digest")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
               F.col("saved").alias("saved_tokens"), "ends_sha256"]
    return none.select(*columns).union(some.select(*columns))
