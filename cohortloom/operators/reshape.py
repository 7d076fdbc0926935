"""Wide to long and per-feature scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .lookup import checked_broadcast


def settled(df: DataFrame) -> DataFrame:
    """Evaluate all columns here. The optimizer would move a column that only a
    lambda uses into that lambda and evaluate it for every element."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def unpivot(df: DataFrame, index: list[str], columns: list[str], variable: str, value: str) -> DataFrame:
    """G1 for tables with few columns; nulls stay. Wide text goes through the matrix source."""
    cells = F.array(*[F.struct(F.lit(c).alias(variable), F.col(c).alias(value)) for c in columns])
    return df.select(*index, F.explode(cells).alias("_cell")).select(
        *index, f"_cell.{variable}", f"_cell.{value}")


def fan_out(df: DataFrame, index: list[str], fields: list[tuple[str, Column]], variable: str,
            value: str, position: str) -> DataFrame:
    """Up to one row per field in listed order; null fields give no row."""
    cells = F.array(*[
        F.struct(F.lit(i).alias(position), F.lit(label).alias(variable), col.alias(value))
        for i, (label, col) in enumerate(fields)
    ])
    kept = F.filter(cells, lambda c: c[value].isNotNull())
    return df.select(*index, F.explode(kept).alias("_cell")).select(*index, "_cell.*")


def z_score(value: Column, mean: Column, sigma: Column) -> Column:
    """0.0 where the spread is missing or zero."""
    return F.when(sigma.isNotNull() & (sigma > 0), F.round((value - mean) / sigma, 4)).otherwise(F.lit(0.0))


def spread(population_variance: Column, n_columns: Column) -> Column:
    """The correction uses the number of matched sample columns, not of values."""
    corrected = F.try_divide(population_variance * n_columns, (n_columns - 1).cast("double"))
    return F.when(n_columns > 1, F.sqrt(corrected))


def feature_scores(cells: DataFrame, feature: str, value: str, n_columns: int) -> DataFrame:
    """D5 + E4 on long cells: adds mean, sigma and z_score; null cells are dropped.

    Statistics are partially aggregated per feature, so no feature's cells are
    gathered in one place; the scores come from a join back.
    """
    stats = checked_broadcast(
        cells.groupBy(feature).agg(F.avg(value).alias("mean"), F.var_pop(value).alias("_var"))
    )
    sigma = spread(F.col("_var"), F.lit(n_columns))
    return (
        cells.where(F.col(value).isNotNull()).join(stats, feature)
        .withColumn("sigma", sigma)
        .withColumn("z_score", z_score(F.col(value), F.col("mean"), F.col("sigma")))
        .drop("_var")
    )


def line_scores(lines: DataFrame) -> DataFrame:
    """D5 on matrix lines: adds mean and sigma over all matched columns of a line.

    Needs no shuffle: a line holds all cells of its feature. The running mean and
    squares need one pass and nothing from outside the lambda.
    """
    every = F.flatten(F.transform("samples", lambda s: s["values"]))
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a: Column, x: Column) -> Column:
        n = a["n"] + 1
        mean = a["mean"] + (x - a["mean"]) / n
        grown = F.struct(n.alias("n"), mean.alias("mean"), (a["m2"] + (x - a["mean"]) * (x - mean)).alias("m2"))
        return F.when(x.isNull(), a).otherwise(grown)

    stats = F.struct(F.size("_all").alias("columns"), F.aggregate("_all", zero, add).alias("known"))
    known = F.nullif(F.col("_stats.known.n"), F.lit(0.0))
    return (
        settled(lines.withColumn("_all", every).withColumn("_stats", stats).drop("_all"))
        .withColumn("mean", F.when(known.isNotNull(), F.col("_stats.known.mean")))
        .withColumn("sigma", spread(F.col("_stats.known.m2") / known, F.col("_stats.columns")))
        .drop("_stats")
    )


def explode_samples(lines: DataFrame, pick: Column, keep: list[str]) -> DataFrame:
    """G1 on matrix lines: one row per line and sample; ``pick`` chooses the value
    among ``values``, the columns that share a sample id."""
    return (
        lines.select(*keep, F.explode("samples").alias("_s"))
        .select(*keep, F.col("_s.sample_id").alias("sample_id"), F.col("_s.values").alias("values"))
        .select(*keep, "sample_id", pick.alias("value"))
    )


def first_known(values: str = "values", domain: list | None = None) -> Column:
    """First stored column wins (S1 on the sample key); values may be limited to a domain."""
    def keep(x: Column) -> Column:
        return x.isNotNull() if domain is None else x.isin(domain)

    return F.get(F.filter(values, keep), F.lit(0))


def last_known(values: str = "values") -> Column:
    """Last column overwrites."""
    return F.try_element_at(F.filter(values, lambda x: x.isNotNull()), F.lit(-1))
