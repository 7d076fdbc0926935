import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cohortloom.llm import hard_negatives as h


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 20), st.integers(1, 6), st.integers(1, 6), st.sampled_from([1, 2, 200, 2**30 - 1]), st.integers(0, 2**32))
def test_scores_are_inner_products(dim, n, m, most, seed):
    rng = np.random.default_rng(seed)
    a, c = (rng.integers(-most - 1, most + 1, (k, dim)) for k in (n, m))
    kind = h._kind(a, c)
    assert (h.scores(h.subset_sums(a.astype(kind)), h.bit_planes(c)) == c @ a.T).all()


def brute_force(rows, every=50):
    kept = set()
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            kept.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for i, label, v in kept:
        if i % every:
            continue
        score = lambda w: sum(x * y for x, y in zip(v, w))
        same = sorted((-score(w), j) for j, k, w in kept if k == label and j != i and len(w) == len(v))[:5]
        other = sorted((-score(w), j) for j, k, w in kept if k != label and len(w) == len(v))
        for p, j in same:
            fit = [(s, k) for s, k in other if 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(fit, 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)


def f32(v):
    return v if v is None else [x if x is None else float(np.float32(x)) for x in v]


@pytest.mark.parametrize("sizes", [(8192, 4096), (2, 30)])
def test_against_brute_force(spark, monkeypatch, sizes):
    """One tile and many; a third of the rows share a label, many scores are equal."""
    monkeypatch.setattr(h, "ANCHORS", sizes[0])
    monkeypatch.setattr(h, "CANDIDATES", sizes[1])
    rng = random.Random(4)
    rows = [(i, f32([rng.choice([-.1, 0.05, .3, .31, .6]) for _ in range(9)]), 0 if i % 3 else i % 10) for i in range(300)]
    assert got(h.hard_negatives(frame(spark, rows))) == brute_force(rows)


def test_odd_rows(spark):
    """Nulls, numbers that are not finite, zero vectors, repeated rows and ids, mixed lengths, clashing columns."""
    one = [0.5, 0.25, -0.125]
    rows = [(50, one, 1), (51, one, 1), (51, one, 1), (52, [0.3, 0.2, 0.0], 2), (53, None, 1), (None, one, 1), (54, one, None),
            (55, [None, 1.0, 1.0], 1), (57, [float("nan")] * 3, 1), (58, [float("inf")] * 3, 1), (0, [0.0] * 3, 1),
            (59, [0.0] * 3, 2), (60, [1.0], 1), (61, [1.0], 1), (62, [0.6], 2), (100, [1.0], 1), (63, [0.7], 4), (64, [0.8], 5),
            (65, [0.9], 5), (66, [0.9], 6), (150, [1e-3, 5.0], 1), (151, [1000.0, 5.0], 1), (152, [600.0, 1.0], 3), (-50, [-1.0], 1),
            (200, [0.9], 1), (200, [1.0], 1), (250, [], 1), (251, [], 1), (252, [], 3), (253, [], 3)]
    rows = [(i, f32(v), k) for i, v, k in rows]
    df = frame(spark, rows).selectExpr("*", "'m' mark", "1 dim", "2 i", "3 j", "'n' numbers", "4 wanted")
    assert got(h.hard_negatives(df)) == brute_force(rows)


def test_vectors_whose_scores_do_not_fit(spark):
    """Norms of 2**22 or more take no part; just below, scores are exact."""
    rows = [(50, [2.0**22 - 1, 0.5], 1), (51, [2.0**22 - 1, 0.25], 1), (52, [2.0**21 + 99, 0.0], 2), (53, [2.0**22, 0.0], 1)]
    assert got(h.hard_negatives(frame(spark, rows))) == brute_force(rows[:3])


def test_no_rows_and_no_anchor(spark):
    assert got(h.hard_negatives(frame(spark, []))) == []
    assert got(h.hard_negatives(frame(spark, [(1, [1.0], 1), (2, [1.0], 1)]))) == []
