"""Counts over tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.lookup import null_label

# (label, table, column) in the order of the summary.
BREAKDOWNS = [
    ("Patients by study", "patients", "study_source"),
    ("Tumors by PAM50", "tumors", "pam50_subtype"),
    ("Mutations by scope", "mutations", "sequencing_scope"),
    ("Mutations by genome build", "mutations", "reference_genome"),
]


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def group_counts(df: DataFrame, key: str, label: str = "value", n: str = "n_rows") -> DataFrame:
    """The null group is shown as NULL."""
    return df.groupBy(null_label(F.col(key).cast("string")).alias(label)).agg(F.count("*").alias(n))


def largest_first(counts: DataFrame, n: str, key: str) -> DataFrame:
    """ties in key order."""
    return counts.orderBy(F.desc(n), F.asc(key))


def latest_row(df: DataFrame, order: list[str]) -> DataFrame:
    """the last row in order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(1)


def condition_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Total, matches and percentage per condition, in one scan."""
    total = F.count("*")
    cells = []
    for name, cond in conditions.items():
        cells += [F.count_if(cond).alias(f"n_{name}"),
                  F.round(F.try_divide(F.count_if(cond) * 100.0, total), 1).alias(f"pct_{name}")]
    return df.agg(total.alias("n_total"), *cells)


def database_summary(tables: Mapping[str, DataFrame], sizes: Mapping[str, int] | None = None) -> DataFrame:
    """V5: (section, value, n_rows) - table sizes and the four breakdowns. Tables whose
    size is known from ``sizes`` are read for their breakdowns only."""
    sizes = sizes or {}
    parts = []
    for name, df in tables.items():
        # Grouped once by all its breakdowns; each combination then counts in every section.
        wanted = [(label, column) for label, table, column in BREAKDOWNS if table == name]
        if name in sizes and not wanted:
            continue
        combos = df.groupBy(*[null_label(F.col(c).cast("string")).alias(c) for _, c in wanted]).agg(
            F.count("*").alias("n_rows"))
        facts = [F.struct(F.lit(label).alias("section"), F.col(c).alias("value")) for label, c in wanted]
        if name not in sizes:
            facts.append(F.struct(F.lit("Rows").alias("section"), F.lit(name).alias("value")))
        parts.append(combos.select(F.explode(F.array(*facts)).alias("_fact"), "n_rows").select("_fact.*", "n_rows"))
    # An empty table has no combination, yet its size is listed.
    spark = next(iter(tables.values())).sparkSession
    listed = [("Rows", name, sizes.get(name, 0)) for name in tables]
    parts.append(spark.createDataFrame(listed, "section string, value string, n_rows long"))
    return reduce(DataFrame.unionByName, parts).groupBy("section", "value").agg(F.sum("n_rows").alias("n_rows"))
