"""Empirical-Bayes batch correction (I5) and its preparation.

After Johnson, Li and Rabinovic (2007), parametric priors, no covariates. Cells are
long: (feature, sample, batch, value), one row per feature and sample, null value
for "not measured". The iteration runs on one row per feature and batch, up to its limit;
cells are only scanned for grouped statistics and for the final correction.

Where the paper leaves room: prior variances use n - 1; features without any
variance stay out of the priors and pass unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed, staged
from .lookup import checked_broadcast

#: Fixed-point steps of every feature, and the relative change of the last one above which
#: a feature has not settled; its limit is then found by halving.
ITERATIONS = 50
SETTLED = 1e-12
HALVINGS = 100


def measured(value: str = "value") -> Column:
    """The value unless it is null or NaN."""
    return F.nanvl(F.col(value), F.lit(None).cast("double"))


def feature_coverage(cells: DataFrame, min_samples: int) -> DataFrame:
    """Features with enough values (NaN counts as present)."""
    return cells.groupBy("feature").agg(F.count("value").alias("n_values")).where(
        F.col("n_values") >= min_samples)


def sample_missingness(cells: DataFrame, n_features: int) -> DataFrame:
    """Share of the features a sample lacks."""
    return cells.groupBy("sample", "batch").agg(
        (F.lit(1.0) - F.count(measured()) / F.lit(n_features)).alias("missing"))


def kept_samples(cells: DataFrame, n_features: int, max_missing: float = 0.5) -> DataFrame:
    """(sample, batch) below the limit; exactly at the limit is dropped."""
    return (
        sample_missingness(cells, n_features).where(F.col("missing") < max_missing)
        .select("sample", "batch")
    )


def impute_feature_mean(cells: DataFrame) -> DataFrame:
    """Missing cells take the feature's mean over all batches."""
    means = checked_broadcast(cells.groupBy("feature").agg(F.avg(measured()).alias("_mean")))
    return (
        cells.join(means, "feature")
        .withColumn("imputed", measured().isNull())
        .withColumn("value", F.coalesce(measured(), F.col("_mean"))).drop("_mean")
    )


def batch_sizes(cells: DataFrame) -> DataFrame:
    """Samples per batch. Samples collapse first, so no batch is hot."""
    return (
        cells.select("batch", "sample").distinct()
        .groupBy("batch").agg(F.count("*").alias("n_samples"))
    )


@dataclass
class Prepared:
    """Cells of kept features and samples, with missing values still null."""

    cells: DataFrame
    sizes: DataFrame
    n_features: int


def prepare(cells: DataFrame, min_samples: int = 10, max_missing: float = 0.5, written: bool = False) -> Prepared | None:
    """D8, D9, D11. None when no feature or no sample is left.

    Four passes follow, so the cells are written once, unless they are ``written`` already in a
    form from which they are cheap to take.
    """
    cells = cells if written else staged(cells)
    covered = checked_broadcast(feature_coverage(cells, min_samples).select("feature"))
    n_features = covered.count()
    if n_features == 0:
        return None
    covered_cells = cells.join(covered, "feature", "left_semi")
    kept = checked_broadcast(kept_samples(covered_cells, n_features, max_missing))
    sizes = checkpointed(kept.groupBy("batch").agg(F.count("*").alias("n_samples")))
    if sizes.isEmpty():
        return None
    remaining = covered_cells.join(kept.select("sample"), "sample", "left_semi")
    return Prepared(remaining.withColumn("value", measured()), sizes, n_features)


def batch_statistics(cells: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per feature and batch: n, mean, m2 after mean imputation, without imputing cells.

    With k of n cells known, the n - k imputed cells sit at the feature mean, so
    mean and m2 follow from the known cells' sums.
    """
    known = checkpointed(cells.groupBy("feature", "batch").agg(
        F.count("value").alias("k"),
        F.coalesce(F.avg("value"), F.lit(0.0)).alias("k_mean"),
        F.coalesce(F.var_pop("value") * F.count("value"), F.lit(0.0)).alias("k_m2"),
    ))
    features = known.groupBy("feature").agg(
        F.try_divide(F.sum(F.col("k") * F.col("k_mean")), F.sum("k")).alias("feature_mean"))
    n, k, mu = F.col("n_samples"), F.col("k"), F.col("feature_mean")
    gap = n - k
    mean = (k * F.col("k_mean") + gap * mu) / n
    m2 = (
        F.col("k_m2") + k * F.pow(F.col("k_mean") - F.col("mean"), 2)
        + gap * F.pow(mu - F.col("mean"), 2)
    )
    return (
        known.join(features, "feature").join(F.broadcast(sizes) if _few(sizes) else sizes, "batch")
        .withColumn("mean", mean).withColumn("m2", m2)
        .select("feature", "batch", "feature_mean", n.cast("double").alias("n"), "mean", "m2")
    )


def _few(table: DataFrame, max_rows: int = 100_000) -> bool:
    return table.limit(max_rows + 1).count() <= max_rows


def location_scale(stats: DataFrame) -> DataFrame:
    """Adds alpha and sigma of the feature, gamma and delta (estimated shift and
    variance ratio of the batch). sigma is null for features without variance."""
    totals = stats.groupBy("feature").agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("alpha"),
        F.sqrt(F.sum("m2") / F.sum("n")).alias("_sigma"),
    ).withColumn("sigma", F.when(F.col("_sigma") > 0, F.col("_sigma"))).drop("_sigma")
    return (
        stats.join(totals, "feature")
        .withColumn("gamma", (F.col("mean") - F.col("alpha")) / F.col("sigma"))
        .withColumn("delta", F.try_divide(F.col("m2"), F.col("sigma") * F.col("sigma") * (F.col("n") - 1)))
    )


def priors(estimates: DataFrame) -> DataFrame:
    """Per batch: mean and variance of gamma, inverse-gamma parameters of delta."""
    per_batch = estimates.where(F.col("sigma").isNotNull()).groupBy("batch").agg(
        F.avg("gamma").alias("gamma_bar"), F.var_samp("gamma").alias("tau2"),
        F.avg("delta").alias("_m"), F.var_samp("delta").alias("_s2"),
    )
    m, s2 = F.col("_m"), F.col("_s2")
    return per_batch.select(
        "batch", "gamma_bar", "tau2",
        F.try_divide(2 * s2 + m * m, s2).alias("a"),
        F.try_divide(m * s2 + m * m * m, s2).alias("b"),
    )


def posterior(estimates: DataFrame, prior: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """Shrunken gamma_star and delta_star: the limit of fixed-point steps that start at the
    plain estimates.

    As d -> low + rise * (d / (spread + d)) ** 2, a step grows with d, so the steps run one
    way up to the nearest fixed point. Where ``iterations`` steps do not get there, it is
    halved out of an interval that holds no other: between the turning points of the cubic
    (low - d) * (spread + d) ** 2 + rise * d ** 2, whose zeros the fixed points are.

    Where a prior has no spread to fit (a single feature, or equal estimates), the
    plain estimates are used.
    """
    n, gamma, delta = F.col("n"), F.col("gamma"), F.col("delta")
    scaled_m2 = F.col("m2") / (F.col("sigma") * F.col("sigma"))

    def shift(d: Column) -> Column:
        return F.try_divide(n * F.col("tau2") * gamma + d * F.col("gamma_bar"), n * F.col("tau2") + d)

    def ratio(g: Column) -> Column:
        return (0.5 * (F.col("_scaled_m2") + n * (gamma - g) * (gamma - g)) + F.col("b")) / (n / 2 + F.col("a") - 1)

    def step(state: Column, _: Column) -> Column:
        g = shift(state["d"])
        return F.struct(g.alias("g"), ratio(g).alias("d"), state["d"].alias("before"))

    def halve(ends: Column, _: Column) -> Column:
        mid = (ends["lo"] + ends["hi"]) / 2
        above = ratio(shift(mid)) > mid
        return F.struct(F.when(above, mid).otherwise(ends["lo"]).alias("lo"),
                        F.when(above, ends["hi"]).otherwise(mid).alias("hi"))

    start = F.struct(gamma.alias("g"), delta.alias("d"), delta.alias("before"))
    fitted = F.col("tau2").isNotNull() & F.col("a").isNotNull()
    stepped = F.when(
        fitted, F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, step)
    ).otherwise(start)

    d, before, spread = F.col("_post.d"), F.col("_post.before"), n * F.col("tau2")
    low, rise = ratio(gamma), ratio(F.col("gamma_bar")) - ratio(gamma)
    p, q = F.col("_low") + F.col("_rise") - 2 * spread, spread * (2 * F.col("_low") - spread)
    root = F.when(p * p + 3 * q > 0, F.sqrt(p * p + 3 * q))
    bottom, top = F.col("_bottom"), F.col("_top")
    up = F.when((bottom > d) & (ratio(shift(bottom)) <= bottom), F.struct(d.alias("lo"), bottom.alias("hi"))).otherwise(
        F.struct(F.greatest(d, top).alias("lo"), (F.col("_low") + F.col("_rise")).alias("hi")))
    down = F.when((top < d) & (ratio(shift(top)) >= top), F.struct(top.alias("lo"), d.alias("hi"))).otherwise(
        F.struct(F.col("_low").alias("lo"), F.least(d, bottom).alias("hi")))
    is_open = fitted & (F.abs(d - before) > SETTLED * d) & (d < float("inf"))
    limit = F.when(is_open, F.aggregate(
        F.sequence(F.lit(1), F.lit(HALVINGS)), F.when(d > before, up).otherwise(down), halve,
        lambda ends: (ends["lo"] + ends["hi"]) / 2))
    return (
        estimates.join(F.broadcast(prior) if _few(prior) else prior, "batch", "left")
        .withColumn("_scaled_m2", scaled_m2).withColumn("_post", stepped)
        .withColumn("_low", low).withColumn("_rise", rise)
        .withColumn("_bottom", (p - root) / 3).withColumn("_top", (p + root) / 3)
        .withColumn("_limit", limit)
        .select("feature", "batch", "feature_mean", "alpha", "sigma",
                F.when(F.col("_limit").isNull(), F.col("_post.g")).otherwise(shift(F.col("_limit"))).alias("gamma_star"),
                F.coalesce("_limit", d).alias("delta_star"))
    )


def corrected(value: Column) -> Column:
    scaled = (value - F.col("alpha")) / F.col("sigma")
    shifted = F.try_divide(F.col("sigma"), F.sqrt("delta_star")) * (scaled - F.col("gamma_star"))
    return F.when(F.col("sigma").isNull(), value).otherwise(
        F.coalesce(shifted, F.lit(0.0)) + F.col("alpha"))


def correct_batches(prepared: Prepared, iterations: int = ITERATIONS) -> DataFrame:
    """(feature, sample, batch, value, corrected), missing cells imputed.

    Features without any measured value are left out: nothing can be imputed.
    """
    small = [r["batch"] for r in prepared.sizes.where("n_samples < 2").head(1)]
    if small:
        raise ValueError(f"batch {small[0]!r} has fewer than two samples")
    estimates = checkpointed(location_scale(batch_statistics(prepared.cells, prepared.sizes)))
    # The prior is computed once: it is tiny but sits on top of every feature.
    params = checked_broadcast(posterior(estimates, checkpointed(priors(estimates)), iterations))
    filled = F.coalesce(F.col("value"), F.col("feature_mean"))
    return (
        prepared.cells.join(params, ["feature", "batch"])
        .where(F.col("feature_mean").isNotNull())
        .select("feature", "sample", "batch", filled.alias("value"), corrected(filled).alias("corrected"))
    )


def batch_shift(cells: DataFrame) -> DataFrame:
    """Absolute difference of the batch means before and after, for exactly
    two batches; no row otherwise."""
    per_batch = cells.groupBy("batch").agg(F.avg("value").alias("before"), F.avg("corrected").alias("after"))
    return per_batch.agg(
        F.count("*").alias("_n"),
        (F.max("before") - F.min("before")).alias("shift_before"),
        (F.max("after") - F.min("after")).alias("shift_after"),
    ).where("_n = 2").drop("_n")
