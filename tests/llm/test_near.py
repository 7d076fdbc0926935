"""Near-duplicates of texts and vectors, and components, against brute force."""

import random
import re

import numpy as np
import pytest
from .helpers import FOLDER, texts
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cohortloom.llm import near_texts, near_vectors, queries
from cohortloom.llm.components import connected_components
from cohortloom.llm.near_texts import Similarity


def smallest_reachable(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(5, 3), (3, 5), (3, 9), (7, 8)], [(i, i + 1) for i in range(40)],
    [(0, i) for i in range(1, 50)], [(99, i) for i in range(1, 50)] + [(200, 99), (200, 201)]])
def test_components(spark, links):
    got = connected_components(spark.createDataFrame(links, "a bigint, b bigint"))
    ids = {i for a, b in links if a != b for i in (a, b)}
    assert {r.id: r.component for r in got.collect()} == smallest_reachable(ids, [x for x in links if x[0] != x[1]])
    assert got.count() == len(ids)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def set_of(text, width):
    words = words_of(text or "")
    if not words:
        return set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} or {tuple(words)}


def brute(rows, like):
    sets = {i: set_of(t, like.width) for i, t in rows}
    ids, links = sorted(sets), []
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= like.percent * len(sets[a] | sets[b]):
                links.append((a, b))
    reached = smallest_reachable(ids, [x for x in links if x[0] != x[1]])
    return {i: (len(sets[i]), reached[i], reached[i] == i) for i in ids}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abAÉé \t\n\x0b\x1c x", max_size=30), max_size=6), st.integers(1, 5))
def test_shingle_sets(data, width):
    sets = near_texts.shingle_sets(data, width)
    assert [len(s) for s in sets] == [len(set_of(t, width)) for t in data]
    for a, x in zip(data, sets):
        for b, y in zip(data, sets):
            assert len(np.intersect1d(x, y)) == len(set_of(a, width) & set_of(b, width))


def test_chunks_do_not_matter(monkeypatch):
    data = ["a b c d e f " * 50, "", "x y", "a b c d e f g h i j"]
    want = near_texts.shingle_sets(data, 4)
    near_texts._steps.cache_clear()
    monkeypatch.setattr(near_texts, "CHUNK_BYTES", 64)
    for got, s in zip(near_texts.shingle_sets(data, 4), want):
        assert (got == s).all()
    near_texts._steps.cache_clear()


def test_bounds_prune_what_is_unlikely_only():
    rng = np.random.default_rng(5)
    plan = near_texts.least_agreements(80)
    assert [n for n, _ in plan] == [30, 60, 90, 120, 150] and all(0 < m < n for n, m in plan)
    hits = (rng.random((20_000, 150)) < 0.8).cumsum(1)
    assert all((hits[:, n - 1] >= m).all() for n, m in plan)
    misses = (rng.random((2_000, 150)) < 0.3).cumsum(1)
    assert np.mean([misses[:, n - 1] >= m for n, m in plan[1:2]]) < 0.01


def test_pruning_misses_no_more_than_the_bands():
    """Exact chance of giving up a pair at the threshold at any of the batches."""
    alive, before, lost = np.ones(1), 0, 0.0
    for n, least in near_texts.least_agreements(80):
        for _ in range(n - before):
            alive = np.concatenate([alive, [0]]) * 0.2 + np.concatenate([[0], alive]) * 0.8
        lost, before = lost + alive[:least].sum(), n
        alive[:least] = 0
    assert 1e-9 < lost < (1 - 0.8 ** near_texts.ROWS) ** near_texts.BANDS < 1e-5


def variants(seed, n, changes):
    """A group of texts, each with a few words of a common text replaced."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(changes + 1)):
            own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("width", [4, 5])
def test_groups_of_near_copies(spark, width):
    data = [*variants(1, 60, 4), *variants(2, 12, 9), *variants(3, 5, 1), "alone here", "Alone  HERE", "", None, "a b c d e f g"]
    rows = list(enumerate(data, 100))
    random.Random(9).shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, signature string")
    like = Similarity(width, 80)
    want = brute(rows, like)
    assert len({v[1] for v in want.values()}) > 8
    assert result(near_texts.near_duplicates(docs, like)) == want
    kept = near_texts.keep_one_of_each(docs, like)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, v in want.items() if v[2])


def test_chains_are_followed_to_their_end(spark):
    """Each text is near the next one only, so leaders alone would not link them all."""
    base = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(8):
        rows.append((50 - k, " ".join(base[k * 30:k * 30 + 300])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows, Similarity(4, 80))
    assert {v[1] for v in want.values()} == {43}
    assert result(near_texts.near_duplicates(docs, Similarity(4, 80))) == want


def test_odd_texts(odd_docs, no_docs):
    rows = [(i, t) for i, t in texts(odd_docs) if i is not None]
    got = result(near_texts.near_duplicates(odd_docs, Similarity(4, 80)))
    assert got.pop(None) == (2, None, True)
    assert got == brute(rows, Similarity(4, 80))
    assert near_texts.near_duplicates(no_docs).collect() == []
    twice = near_texts.keep_one_of_each(odd_docs.union(odd_docs))
    ids = sorted(str(r.doc_id) for r in twice.collect())
    assert ids == sorted([*(str(i) for i in got if i != 13), "None", "None"])


def test_rows_that_share_an_id_but_not_the_text(spark):
    """5:B is alone, 7:D is near 4:D', 8 has two texts alike; 6 and 9 have one of their own each."""
    a, b, d, e, g, h = (" ".join(f"{x}{i}" for i in range(80)) for x in "abdegh")
    rows = [(3, a), (5, a), (5, b), (7, g), (7, d), (4, d + " end"), (8, e), (8, e + " end"), (6, h), (6, None), (9, a), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    like = Similarity(5, 80)
    got = near_texts.near_duplicates(docs, like).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {
        (3, 3), (5, 3), (7, 4), (4, 4), (8, 8), (6, 6), (9, 3)}
    kept = sorted((r.doc_id, r.text or "") for r in near_texts.keep_one_of_each(docs, like).collect())
    assert {t for i, t in kept if i == 8} < {e, e + " end"} and len([1 for i, _ in kept if i == 8]) == 1
    assert [r for r in kept if r[0] != 8] == sorted([(3, a), (5, b), (4, d + " end"), (7, g), (6, h), (6, ""), (9, "")])


def test_text_query(spark, docs):
    got = result(queries.QUERIES["op9_near_texts"](spark, FOLDER))
    assert got == brute(texts(docs), Similarity(4, 80))


def brute_vectors(rows, cosine):
    good = {}
    for i, v, label in rows:
        if i is not None and v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = (np.array(v, float), label)
    ids, links = sorted(good), []
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            (x, s), (y, t) = good[a], good[b]
            if s == t and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                links.append((a, b))
    every = {r[0] for r in rows}
    reached = smallest_reachable({i for i in every if i is not None}, links)
    n = {i: 0 for i in every}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return {i: (n[i], reached.get(i), True if i is None else reached[i] == i) for i in every}


def vector_result(df):
    rows = df.collect()
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows}
    assert len(out) == len(rows)
    return out


def made_vectors(dim, n, seed):
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for size in [1] * n + [2] * 10 + [30, 12]:
        centre = rng.standard_normal(dim)
        for _ in range(size):
            noise = rng.standard_normal(dim) * rng.choice([0, 0.02, 0.1, 0.14])
            rows.append((at, (rng.uniform(0.1, 9) * (centre + noise)).tolist(), int(rng.integers(2)) if size < 3 else 1))
            at += 1
    return rows


@pytest.mark.parametrize("dim,kind", [(64, "float"), (64, "double"), (16, "float"), (7, "double"), (2, "double"), (1, "double")])
def test_vectors(spark, dim, kind):
    rows = made_vectors(dim, 40, dim)
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int").repartition(3)
    seen = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert vector_result(near_vectors.near_vectors(df, 0.98)) == brute_vectors(seen, 0.98)


def test_crowded_cells_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "TILE", 8)
    rows = made_vectors(16, 30, 4)
    rows += [(10_000 + k, rows[-1][1], rows[-1][2]) for k in range(20)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert vector_result(near_vectors.near_vectors(df, 0.98)) == brute_vectors(rows, 0.98)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1e200, 1e198], 1), (4, [1e-200, 0.0], 1), (5, [1.0, 0.0], 2),
            (6, [1.0, 0.0], None), (7, None, 1), (8, [], 1), (9, [0.0, 0.0], 1), (10, [1.0, nan], 1), (11, [inf, 0.0], 1),
            (12, [1.0, None], 1), (13, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (14, [-1.0, -0.0], 1), (15, [1.0, 0.1], 1)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id bigint, embedding array<double>, label int, rep int")
    got = vector_result(near_vectors.near_vectors(df, 0.98))
    assert {i: v for i, v in got.items() if i in (1, 2, 3, 4, 15)} == {i: (4, 1, i == 1) for i in (1, 2, 3, 4, 15)}
    assert {i: v for i, v in got.items() if i not in (1, 2, 3, 4, 15)} == {
        i: (0, i, True) for i in (5, 6, 7, 8, 9, 10, 11, 12, 13, 14, None)}
    assert near_vectors.near_vectors(df.limit(0), 0.98).collect() == []


def test_vector_query(spark):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.select("vec_id", "embedding", "label").collect()]
    assert vector_result(queries.QUERIES["op3_near_vectors"](spark, FOLDER)) == brute_vectors(rows, 0.98)


def test_columns_of_any_name_stay(spark):
    """Names that the stage might use itself, dots among them; hash places past the sign bit."""
    copy = "one two three four five six seven eight nine ten"
    rows = [(i, f"{copy} {'eleven' if i % 2 else 'number ' + str(i)}", i) for i in range(200)] + [(7, f"{copy} eleven", 7), (None, copy, -1)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n int")
    names = ["_id", "_key", "row", "p", "word", "bits", "goes", "text_key", "rep", "a.b"]
    wide = docs.select("*", *(docs["n"].alias(c) for c in names))
    kept = near_texts.keep_one_of_each(wide, near_texts.Similarity(width=5, percent=80))
    assert kept.columns == wide.columns
    want = {r["doc_id"] for r in near_texts.near_duplicates(docs, near_texts.Similarity(5, 80)).where("kept").collect()}
    got = [tuple(r) for r in kept.collect()]
    assert {r[0] for r in got} == want and None in want and len(got) == len(want) == 102
    assert all(set(r[3:]) == {r[2]} for r in got)


def test_tiles_of_a_crowded_bucket(spark, monkeypatch):
    """Texts that share half of their words and are near copies in small groups: leaders
    link few of them, so buckets are dealt out to many tiles, over several Arrow batches."""
    monkeypatch.setattr(near_texts, "TILE", 4)
    monkeypatch.setattr(near_texts, "PAIRS", 16)
    monkeypatch.setattr(near_texts, "SET_BYTES", 2_000)
    rng = random.Random(3)
    common = [f"c{i}" for i in range(300)]
    rows = []
    for group in range(12):
        base = [*common, *(f"g{group}.{i}" for i in range(60))]
        for k in range(5):
            own = list(base)
            for _ in range(k):
                own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    like = Similarity(5, 80)
    want = brute(rows, like)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert len({v[1] for v in want.values()}) > 1
        assert result(near_texts.near_duplicates(docs, like)) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
