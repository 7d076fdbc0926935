"""Batch correction against an independent dense implementation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import combat
from conftest import rows


def dense_combat(x, batch, iterations=50):
    """Johnson et al. 2007 on a full features x samples matrix."""
    x = np.asarray(x, float)
    names = sorted(set(batch))
    idx = [np.flatnonzero(np.asarray(batch) == b) for b in names]
    n = np.array([len(i) for i in idx])
    means = np.stack([x[:, i].mean(axis=1) for i in idx], axis=1)
    alpha = means @ (n / n.sum())
    resid = np.concatenate([x[:, i] - means[:, [k]] for k, i in enumerate(idx)], axis=1)
    sigma = np.sqrt((resid ** 2).mean(axis=1))
    ok = sigma > 0
    out = x.copy()
    z = (x[ok] - alpha[ok, None]) / sigma[ok, None]
    for i in idx:
        m = len(i)
        g_hat, d_hat = z[:, i].mean(axis=1), z[:, i].var(axis=1, ddof=1)
        g_bar, t2 = g_hat.mean(), g_hat.var(ddof=1)
        mm, s2 = d_hat.mean(), d_hat.var(ddof=1)
        a, b = (2 * s2 + mm ** 2) / s2, (mm * s2 + mm ** 3) / s2
        g, d = g_hat.copy(), d_hat.copy()
        for _ in range(iterations):
            g = (m * t2 * g_hat + d * g_bar) / (m * t2 + d)
            ss = ((z[:, i] - g[:, None]) ** 2).sum(axis=1)
            d = (0.5 * ss + b) / (m / 2 + a - 1)
        zc = (z[:, i] - g[:, None]) / np.sqrt(d)[:, None]
        out[np.ix_(ok, i)] = zc * sigma[ok, None] + alpha[ok, None]
    return out


def matrix(features=30, sizes=(12, 9), seed=3):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(5 + 2 * k, 1 + k, (features, n)) + rng.normal(0, 1, (features, 1))
             for k, n in enumerate(sizes)]
    batch = [f"b{k}" for k, n in enumerate(sizes) for _ in range(n)]
    return np.concatenate(parts, axis=1), batch


def long(spark, x, batch, partitions=None):
    data = [(f"g{i:03d}", f"s{j:03d}", batch[j], None if v is None else float(v))
            for i, row in enumerate(x) for j, v in enumerate(row)]
    df = spark.createDataFrame(data, "feature string, sample string, batch string, value double")
    return df.repartition(partitions, "sample") if partitions else df


def wide(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[int(r["feature"][1:]), int(r["sample"][1:])] = r["corrected"]
    return out


@pytest.mark.parametrize("sizes", [(12, 9), (8, 8, 5)])
def test_matches_dense(spark, sizes):
    x, batch = matrix(sizes=sizes)
    got = combat.correct_batches(combat.prepare(long(spark, x, batch), min_samples=5))
    assert np.abs(wide(got, x.shape) - dense_combat(x, batch)).max() < 1e-9


def test_features_that_settle_late_reach_their_limit(spark):
    """Far shifts, from either side: a few need many more steps than 50."""
    n, t2, g_bar, a, b = 20, 0.3, 0.1, 3.0, 1.0
    grid = [(g, d) for g in np.linspace(-9, 9, 400) for d in (0.2, 0.3, 5.0, 9.0)]
    g_hat, d_hat = np.array(grid).T
    m2 = d_hat * (n - 1)
    # Every other row starts far above its limit.
    start = np.where(np.arange(len(grid)) % 2, 40.0, d_hat)

    def dense(steps):
        d = start.copy()
        for _ in range(steps):
            g = (n * t2 * g_hat + d * g_bar) / (n * t2 + d)
            d = (0.5 * (m2 + n * (g_hat - g) ** 2) + b) / (n / 2 + a - 1)
        return g, d

    want_g, want_d = dense(20_000)
    assert np.abs(dense(50)[1] / want_d - 1).max() > 0.1
    estimates = spark.createDataFrame(
        [(f"g{i:04d}", "A", 0.0, 0.0, 1.0, float(n), float(m), float(g), float(d))
         for i, (g, m, d) in enumerate(zip(g_hat, m2, start))],
        "feature string, batch string, feature_mean double, alpha double, sigma double, n double, m2 double, "
        "gamma double, delta double")
    prior = spark.createDataFrame([("A", g_bar, t2, a, b)], "batch string, gamma_bar double, tau2 double, a double, b double")
    got = rows(combat.posterior(estimates, prior), "feature", "gamma_star", "delta_star")
    assert np.abs(np.array([r[2] for r in got]) / want_d - 1).max() < 1e-9
    assert np.abs(np.array([r[1] for r in got]) - want_g).max() < 1e-9


def test_missing_values_and_constant_feature(spark):
    x, batch = matrix()
    x[3] = 4.0
    holes = [(0, 1), (0, 14), (5, 2), (7, 20), (9, 0), (9, 1), (9, 2)]
    gaps = x.astype(object)
    for n, (i, j) in enumerate(holes):
        gaps[i, j] = None if n % 2 else float("nan")
        x[i, j] = np.nan
    for i in range(len(x)):
        x[i, np.isnan(x[i])] = np.nanmean(x[i])
    want = dense_combat(x, batch)
    results = []
    for partitions in (1, 8):
        got = combat.correct_batches(combat.prepare(long(spark, gaps, batch, partitions), min_samples=5))
        results.append(wide(got, x.shape))
        assert np.abs(results[-1] - want).max() < 1e-9
        assert {r["corrected"] for r in got.where("feature = 'g003'").collect()} == {4.0}
    assert np.abs(results[0] - results[1]).max() < 1e-9


def test_batches_move_together(spark):
    x, batch = matrix()
    shift = combat.batch_shift(combat.correct_batches(combat.prepare(long(spark, x, batch), min_samples=5))).head()
    assert shift.shift_before > 1 and shift.shift_after < 0.1 * shift.shift_before


def test_shift_needs_two_batches(spark):
    x, batch = matrix(sizes=(5, 5, 5))
    cells = long(spark, x, batch).withColumn("corrected", F.col("value"))
    assert combat.batch_shift(cells).isEmpty()


def test_preparation(spark):
    # g0 and g1 are covered; s3 misses exactly half of them and is dropped.
    cells = spark.createDataFrame([
        (g, s, b, v) for g, vs in {
            "g0": [1.0, 2.0, 3.0, 4.0], "g1": [1.0, 2.0, float("nan"), None], "g2": [None, None, 1.0, None],
        }.items() for (s, b), v in zip([("s0", "A"), ("s1", "A"), ("s2", "B"), ("s3", "B")], vs)
    ], "feature string, sample string, batch string, value double")
    assert rows(combat.feature_coverage(cells, 3), "feature", "n_values") == [("g0", 4), ("g1", 3)]
    covered = cells.where("feature <> 'g2'")
    assert rows(combat.sample_missingness(covered, 2), "sample", "missing") == [
        ("s0", 0.0), ("s1", 0.0), ("s2", 0.5), ("s3", 0.5)]
    got = combat.prepare(cells, min_samples=3)
    assert got.n_features == 2 and rows(got.sizes) == [("A", 2)]
    assert combat.prepare(cells, min_samples=5) is None


def test_imputation(spark):
    cells = spark.createDataFrame([("g", "a", "A", 1.0), ("g", "b", "B", 3.0), ("g", "c", "B", float("nan"))],
                                  "feature string, sample string, batch string, value double")
    assert rows(combat.impute_feature_mean(cells), "sample", "value", "imputed") == [
        ("a", 1.0, False), ("b", 3.0, False), ("c", 2.0, True)]


def test_single_sample_batch_is_an_error(spark):
    x, batch = matrix(sizes=(5, 1))
    with pytest.raises(ValueError, match="b1"):
        combat.correct_batches(combat.prepare(long(spark, x, batch), min_samples=3))
