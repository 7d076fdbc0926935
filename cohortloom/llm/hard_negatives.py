"""Hard negatives by Four-Russians scoring.

Vectors become integers. For every eight dimensions of an anchor, a table holds the sums of
all 256 subsets of its components. A candidate is stored as bit planes, one byte per plane
and eight dimensions. So a byte looks up the anchor's share of a plane in one step, and
the planes, shifted and added, give the exact inner product; the sign plane counts negative.

Anchors meet candidates in tiles of bounded size, once among equal labels for the
positives, once among different ones for the negatives; a tile returns its first rows only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window, functions as F

from ..session import staged

#: Rows of a tile at most, but for chance.
ANCHORS, CANDIDATES = 8192, 4096
#: Lookups of a step: anchors times candidates that are scored at a time.
ANCHOR_STEP, CANDIDATE_STEP = 128, 1024
N_POSITIVES, N_NEGATIVES = 5, 3


def bit_planes(numbers: np.ndarray) -> np.ndarray:
    """(row, plane, group) bytes of whole numbers in two's complement, the sign plane last;
    bit i of a byte is dimension 8 * group + i."""
    rows, dim = numbers.shape
    low, high = (int(numbers.min()), int(numbers.max())) if numbers.size else (0, 0)
    n_planes = max((-1 - low).bit_length() if low < 0 else 0, high.bit_length()) + 1
    padded = np.zeros((rows, -(-dim // 8) * 8), np.int64)
    padded[:, :dim] = numbers
    bits = (padded[:, None, :] >> np.arange(n_planes)[None, :, None] & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little")


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(group, 256, anchor) sums of the anchors' components over all subsets of eight dimensions."""
    rows, dim = anchors.shape
    padded = np.zeros((-(-dim // 8) * 8, rows), anchors.dtype)
    padded[:dim] = anchors.T
    sums = np.zeros((len(padded) // 8, 256, rows), anchors.dtype)
    for i in range(8):
        # The subsets with i as their largest member: those of smaller ones, and i.
        np.add(sums[:, :1 << i], padded[i::8][:, None, :], out=sums[:, 1 << i:2 << i])
    return sums


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidate, anchor) inner products."""
    n, n_planes, groups = planes.shape
    total = np.zeros((n, tables.shape[2]), tables.dtype)
    looked, plane = np.empty_like(total), np.empty_like(total)
    for k in range(n_planes - 1, -1, -1):
        plane[:] = 0
        for g in range(groups):
            np.take(tables[g], planes[:, k, g], axis=0, out=looked, mode="clip")
            plane += looked
        if k == n_planes - 1:
            np.negative(plane, out=total)
        else:
            total <<= 1
            total += plane
    return total


def _matrix(column, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(len(column), -1).astype(np.int64) if size else np.zeros(
        (len(column), 0), np.int64)


class _Rows:
    """The rows of one side of a tile, ordered by id."""

    def __init__(self, tile: pa.Table):
        ids = np.array(tile.column("vec_id"), np.int64)
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.labels = np.array(tile.column("label"), np.int64)[order]
        self.numbers = _matrix(tile.column("numbers"), tile.column("dim")[0].as_py())[order] if tile.num_rows else None
        self.order = order

    def __len__(self) -> int:
        return len(self.ids)


def _kind(anchors: np.ndarray, candidates: np.ndarray):
    """32 bits where no sum can leave them."""
    bound = anchors.shape[1] * float(np.abs(anchors).max(initial=0)) * 2.0 * (float(np.abs(candidates).max(initial=0)) + 1)
    return np.int32 if bound < 2**31 else np.int64


def _steps(anchors: np.ndarray, candidates: np.ndarray):
    """(first anchor, scores (candidate, anchor) of some anchors with all candidates)."""
    kind, planes = _kind(anchors, candidates), bit_planes(candidates)
    for at in range(0, len(anchors), ANCHOR_STEP):
        tables = subset_sums(anchors[at:at + ANCHOR_STEP].astype(kind))
        yield at, np.concatenate(
            [scores(tables, planes[i:i + CANDIDATE_STEP]) for i in range(0, len(planes), CANDIDATE_STEP)])


def best_positives(anchors: _Rows, candidates: _Rows) -> list[tuple[int, int, int]]:
    """(place of the anchor, place of the candidate, score): the first rows per anchor."""
    found = []
    for label in np.intersect1d(anchors.labels, candidates.labels):
        a, c = np.flatnonzero(anchors.labels == label), np.flatnonzero(candidates.labels == label)
        for at, table in _steps(anchors.numbers[a], candidates.numbers[c]):
            for k in range(table.shape[1]):
                own, column = a[at + k], table[:, k]
                # One more than wanted, as the row itself may be among them; all of the last score.
                if len(column) > N_POSITIVES + 1:
                    least = np.partition(column, len(column) - N_POSITIVES - 1)[len(column) - N_POSITIVES - 1]
                    others = np.flatnonzero(column >= least)
                else:
                    others = np.arange(len(column))
                others = others[candidates.ids[c[others]] != anchors.ids[own]]
                if len(others) < min(N_POSITIVES, len(column)):
                    others = np.flatnonzero(candidates.ids[c] != anchors.ids[own])
                for j in others[np.argsort(-column[others].astype(np.int64), kind="stable")][:N_POSITIVES]:
                    found.append((int(own), int(c[j]), int(column[j])))
    return found


def best_negatives(anchors: _Rows, wanted: list[list[int]], candidates: _Rows) -> list[tuple[int, int, int, int]]:
    """(place of the anchor, positive score, place of the candidate, score): the first rows
    per anchor and wanted positive score."""
    found = []
    for at, table in _steps(anchors.numbers, candidates.numbers):
        for k in range(table.shape[1]):
            own = at + k
            bounds = {p: (-(-50 * p // 100), 95 * p // 100) for p in wanted[own]}
            bounds = {p: b for p, b in bounds.items() if b[0] <= b[1]}
            if not bounds:
                continue
            column = table[:, k].astype(np.int64)
            low, high = min(b[0] for b in bounds.values()), max(b[1] for b in bounds.values())
            within = np.flatnonzero((column >= low) & (column <= high) & (candidates.labels != anchors.labels[own]))
            falling = within[np.argsort(-column[within], kind="stable")]
            keys = -column[falling]
            for p, (least, most) in bounds.items():
                start = np.searchsorted(keys, -most)
                for j in falling[start:start + N_NEGATIVES]:
                    if column[j] < least:
                        break
                    found.append((own, p, int(j), int(column[j])))
    return found


def _table(columns, schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(columns or [()] * len(schema), schema)], schema=schema)


def quantized(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, numbers, mark) of the rows that take part, equal ones once:
    ``numbers`` are 32-bit integers floor(256 * x), ``mark`` a digest of the row."""
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * 256))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    exact = F.forall("embedding", lambda v: F.abs(v) < 2.0**22) & (F.aggregate(
        "embedding", F.lit(0.0), lambda s, v: s + v.cast("double") * v) < 2.0**44)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding")
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & exact, F.lit(False)))
    names = ["vec_id", "label", "numbers"]

    def pack(batches):
        for batch in batches:
            lists = batch.column(2)
            flat = np.array(lists.flatten(), np.int32)
            ends = np.cumsum(np.array(pa.compute.list_value_length(lists), np.int64))
            data = [part.tobytes() for part in np.split(flat, ends[:-1])] if len(ends) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], names)

    packed = rows.select("vec_id", label.alias("label"), x.cast("array<int>").alias("numbers")).mapInArrow(
        pack, "vec_id bigint, label bigint, numbers binary")
    mark = F.md5(F.concat(F.encode(F.concat_ws(":", "vec_id", "label"), "utf-8"), F.lit(b":"), "numbers"))
    return packed.distinct().select("*", (F.octet_length("numbers") / 4).cast("int").alias("dim"), mark.alias("mark"))


def hard_negatives(vectors: DataFrame, every: int = 50) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of
    (vec_id, embedding, label).

    Components become floor(256 * x) and a score is an integer inner product; higher ones come
    first, ties by vec_id. Anchors are the rows whose vec_id is a multiple of ``every``. Their
    positives are the first five rows of the same label with another vec_id; each positive
    brings the first three rows of other labels with 50 % to 95 % of its score. A vec_id that is
    a multiple of 7 has its label moved on by one, modulo 10.

    Rows with a null id, label or vector, or with a null or non-finite component, take no
    part, nor do those whose norm is 2**22 or more, as their scores do not fit 64 bits.
    Equal rows count once; rows of one vec_id with different vectors are different rows. Vectors
    of different lengths do not meet. An empty table gives no rows; other columns are not read.
    """
    rows = staged(quantized(vectors))
    anchor = F.col("vec_id") % every == 0
    n_anchors, n_rows = rows.agg(F.count_if(anchor), F.count("*")).first()
    down, across = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n_rows // CANDIDATES))
    own = F.xxhash64("mark")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    tile = ["dim", "i", "j"]
    candidates = rows.select("dim", numbers(down).alias("i"), F.pmod(own, F.lit(across)).cast("int").alias("j"),
                             "vec_id", "label", "mark", "numbers")

    def dealt(some: DataFrame) -> DataFrame:
        # New names for the columns, which stem from the same table as the candidates'.
        fresh = [F.col(c).alias(c) for c in some.columns]
        return some.select(*fresh, F.pmod(own, F.lit(down)).cast("int").alias("i"), numbers(across).alias("j"))

    def positives(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table(None, first)
        a, c = _Rows(left), _Rows(right)
        marks = left.column("mark").to_pylist()
        return _table(list(zip(*(
            (marks[a.order[i]], int(c.ids[j]), s) for i, j, s in best_positives(a, c)))), first)

    first = pa.schema([("mark", pa.string()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
    anchors = rows.where(anchor).select("dim", "vec_id", "label", "mark", "numbers")
    met = dealt(anchors).groupBy(*tile).cogroup(candidates.groupBy(*tile)).applyInArrow(
        positives, "mark string, positive_id bigint, positive_score bigint")
    by_score = Window.partitionBy("mark").orderBy(F.desc("positive_score"), "positive_id")
    best = staged(met.withColumn("_n", F.row_number().over(by_score)).where(F.col("_n") <= N_POSITIVES).drop("_n"))
    # At most five scores an anchor.
    wanted = best.groupBy("mark").agg(F.collect_set("positive_score").alias("wanted"))

    second = pa.schema([("mark", pa.string()), ("positive_score", pa.int64()), ("negative_id", pa.int64()),
                        ("negative_score", pa.int64())])

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table(None, second)
        a, c = _Rows(left), _Rows(right)
        marks, scores_of = left.column("mark").to_pylist(), left.column("wanted").to_pylist()
        got = best_negatives(a, [scores_of[k] for k in a.order], c)
        return _table(list(zip(*((marks[a.order[i]], p, int(c.ids[j]), s) for i, p, j, s in got))), second)

    met = dealt(anchors.join(wanted, "mark")).groupBy(*tile).cogroup(candidates.groupBy(*tile)).applyInArrow(
        negatives, "mark string, positive_score bigint, negative_id bigint, negative_score bigint")
    order = Window.partitionBy("mark", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= N_NEGATIVES)
    out = best.join(ranked, ["mark", "positive_score"]).join(
        anchors.select("mark", F.col("vec_id").alias("anchor_id")), "mark")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
