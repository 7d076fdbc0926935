"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with a cosine of c or more are at most sqrt(2 - 2c) apart. A rotation keeps
distances and spreads them over all dimensions; cut into blocks, a pair's squared distance
must stay within its proportional budget in one block at least. So every block is a range
join on a few dimensions: a vector has a home cell there and visits the cells that its
range touches, and meets its partners at home. A pair is verified exactly and counted in
the first block that finds it.

Equal vectors are taken together beforehand. Crowded cells are cut into tiles of bounded
size, and a tile returns sums and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import staged
from .components import connected_components
from .tiles import in_tiles

BLOCKS = 8
#: A cell's side in ranges. Wider cells are visited less often and hold more.
SIDE = 4.0
#: Rows of a tile on either side at most, but for chance.
TILE = 2048
SLACK = 1 + 1e-9


@lru_cache(maxsize=8)
def _rotation(dim: int) -> np.ndarray:
    square = np.random.Generator(np.random.PCG64(dim)).standard_normal((dim, dim))
    return np.linalg.qr(square)[0]


def _blocks(dim: int) -> list[np.ndarray]:
    return np.array_split(np.arange(dim), min(BLOCKS, dim))


def _units(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _scaled(rows: np.ndarray) -> np.ndarray:
    """The rows times powers of two, so that no square overflows or vanishes."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1, keepdims=True))[1])


def _visits(vectors: np.ndarray, cosine: float) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(block, rows, their cells, whether at home) of every visit."""
    dim = vectors.shape[1]
    rotated = _units(vectors) @ _rotation(dim)
    for block, dims in enumerate(_blocks(dim)):
        reach = np.sqrt((2 - 2 * cosine) * len(dims) / dim) * (1 + 1e-6) + 1e-9
        plane = rotated[:, dims[:2]]
        if plane.shape[1] < 2:
            plane = np.hstack([plane, np.zeros_like(plane)])
        # A cell is wider than two ranges, so a range touches two cells at most.
        home, low, high = (np.floor((plane + s * reach) / (SIDE * reach)).astype(np.int64) for s in (0, -1, 1))
        for x, x_new in ((low[:, 0], True), (high[:, 0], high[:, 0] != low[:, 0])):
            for y, y_new in ((low[:, 1], True), (high[:, 1], high[:, 1] != low[:, 1])):
                rows = np.flatnonzero(np.broadcast_to(x_new & y_new, len(x)))
                cells = np.stack([x[rows], y[rows]], 1)
                yield block, rows, cells, (cells == home[rows]).all(1)


def tile_links(ids, weights, vectors, left, right, block: int, cosine: float) -> list[tuple[int, int, int]]:
    """(id, n, other) of the vectors with links between ``left`` and ``right`` that this
    block is the first to find: n counts partners by weight, other is the smallest id of
    the vector's tree in this tile."""
    order = np.argsort(ids, kind="stable")
    ids, weights, vectors, left, right = ids[order], weights[order], _scaled(vectors[order]), left[order], right[order]
    dim, norms = vectors.shape[1], np.linalg.norm(vectors, axis=1)
    rotated = _units(vectors) @ _rotation(dim)
    blocks = _blocks(dim)
    budgets = np.array([(2 - 2 * cosine) * len(d) / dim for d in blocks]) * SLACK + 1e-12
    begins = [d[0] for d in blocks]
    of_left, of_right = np.flatnonzero(left), np.flatnonzero(right)
    a, b = rotated[of_left][:, blocks[block]], rotated[of_right][:, blocks[block]]
    b_squares = (b * b).sum(1)
    found = [np.zeros((2, 0), np.int64)]
    for start in range(0, len(of_left), 256):
        part = a[start:start + 256]
        near = (part * part).sum(1)[:, None] + b_squares - 2 * part @ b.T <= budgets[block] + 1e-12
        near &= of_left[start:start + 256, None] < of_right
        x, y = np.nonzero(near)
        for at in range(0, len(x), 20_000):
            h, p = of_left[start + x[at:at + 20_000]], of_right[y[at:at + 20_000]]
            within = np.add.reduceat((rotated[h] - rotated[p]) ** 2, begins, axis=1) <= budgets
            within[:, block] = True
            first = within.argmax(1) == block
            h, p = h[first], p[first]
            alike = np.einsum("ij,ij->i", vectors[h], vectors[p]) / (norms[h] * norms[p]) >= cosine
            found.append(np.stack([h[alike], p[alike]]))
    h, p = np.concatenate(found, 1)
    n = np.zeros(len(ids), np.int64)
    np.add.at(n, h, weights[p])
    np.add.at(n, p, weights[h])
    tree = np.arange(len(ids))
    while len(h):
        least = np.minimum(tree[h], tree[p])
        new = tree.copy()
        np.minimum.at(new, h, least)
        np.minimum.at(new, p, least)
        new = new[new]
        if (new == tree).all():
            break
        tree = new
    return [(int(ids[i]), int(n[i]), int(ids[tree[i]])) for i in np.flatnonzero(n)]


def near_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label).

    Vectors of the same label and length with at least that cosine are linked. n_links
    counts a vector's partners, component_id is the smallest vec_id that links reach, and
    kept marks it. A row with a null id or label, or whose vector is null, empty, zero or
    holds a null or non-finite number, links with nothing and is its own component. Rows
    with the same vec_id count as one node. An empty table gives no rows; other columns
    are not read.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding")
    single = isinstance(rows.schema["embedding"].dataType.elementType, T.FloatType)
    kind, size = (np.float32, 4) if single else (np.float64, 8)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0),
        F.lit(False))
    # 128 bits tell equal vectors; the label is part of the key.
    marks = ["label", "_m1", "_m2"]
    marked = rows.withColumns({
        "_valid": valid, "_m1": F.xxhash64(F.lit(1), "embedding"), "_m2": F.xxhash64(F.lit(2), "embedding")})
    distinct = staged(
        marked.where("_valid").groupBy(*marks).agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.any_value("embedding").alias("embedding")))

    cell = ["mark", "dim", "block", "x", "y"]
    schema = pa.schema([
        ("mark", pa.int64()), ("dim", pa.int32()), ("block", pa.int32()), ("x", pa.int64()), ("y", pa.int64()),
        ("home", pa.bool_()), ("rep", pa.int64()), ("weight", pa.int64()), ("vector", pa.binary())])

    def visit(batches):
        for batch in batches:
            mark, rep, weight = (np.array(batch.column(k), np.int64) for k in (0, 1, 2))
            lists = batch.column(3)
            lengths = np.array(pa.compute.list_value_length(lists), np.int64)
            flat, ends = np.array(lists.flatten(), kind), np.cumsum(lengths)
            for dim in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == dim)
                raw = flat[(ends[own] - dim)[:, None] + np.arange(dim)]
                data = [r.tobytes() for r in raw]
                for block, k, cells, home in _visits(_scaled(raw.astype(np.float64)), cosine):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(mark[own[k]]), pa.array(np.full(len(k), dim, np.int32)),
                        pa.array(np.full(len(k), block, np.int32)), pa.array(cells[:, 0]), pa.array(cells[:, 1]),
                        pa.array(home), pa.array(rep[own[k]]), pa.array(weight[own[k]]),
                        pa.array([data[i] for i in k.tolist()], pa.binary())], schema=schema)

    visits = distinct.select(F.xxhash64("label").alias("mark"), "rep", "weight", "embedding").mapInArrow(
        visit, "mark bigint, dim int, block int, x bigint, y bigint, home boolean, rep bigint, weight bigint, vector binary")
    dealt = in_tiles(visits, cell, "rep", TILE, F.col("home"))
    links = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("other", pa.int64())])

    def meet(tile: pa.Table) -> pa.Table:
        get = {c: tile.column(c) for c in tile.column_names}
        data = np.frombuffer(b"".join(get["vector"].to_pylist()), kind).reshape(tile.num_rows, -1).astype(np.float64)
        ids, weights = (np.array(get[c], np.int64) for c in ("rep", "weight"))
        left, right = (np.array(get[c], bool) for c in ("left", "right"))
        found = tile_links(ids, weights, data, left, right, get["block"][0].as_py(), cosine)
        columns = list(zip(*found)) or [()] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=links)

    met = staged(dealt.groupBy(*cell, "i", "j").applyInArrow(meet, "rep bigint, n bigint, other bigint"))
    counts = met.groupBy("rep").agg(F.sum("n").alias("n"))
    components = connected_components(met.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    of = distinct.select(*marks, "rep", "weight").join(counts, "rep", "left").join(
        components.withColumnRenamed("id", "rep"), "rep", "left").select(
        *marks, (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"), F.lit(True).alias("_valid"))
    out = marked.select("vec_id", "_valid", *marks).join(of, ["_valid", *marks], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))
