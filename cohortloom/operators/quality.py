"""Constraint checks and ignore-on-conflict loads."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T



@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    """A table and its rules. ``checks`` maps a rule name to a SQL condition."""

    name: str
    schema: T.StructType
    key: list[str]
    not_null: list[str] = field(default_factory=list)
    checks: Mapping[str, str] = field(default_factory=dict)
    foreign_keys: list[ForeignKey] = field(default_factory=list)
    defaults: Mapping[str, object] = field(default_factory=dict)


def enum_check(column: str, values: list) -> dict[str, str]:
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return {column: f"{column} IN ({listed})"}


def violations(spec: TableSpec) -> Column:
    """K1/K2: names of the broken rules; a check on a null passes, as in SQL."""
    broken = [F.when(F.col(c).isNull(), f"not_null:{c}") for c in spec.not_null]
    broken += [
        F.when(~F.coalesce(F.expr(rule), F.lit(True)), f"check:{name}")
        for name, rule in spec.checks.items()
    ]
    if not broken:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*broken))


def with_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """K6: a default fills a column the batch does not have, not a null in it."""
    missing = {}
    for f in spec.schema.fields:
        if f.name not in df.columns:
            value = spec.defaults.get(f.name)
            value = value() if callable(value) else F.lit(value)
            missing[f.name] = value.cast(f.dataType)
    return df.withColumns(missing) if missing else df


def conform(df: DataFrame, spec: TableSpec, extra: list[Column] | None = None) -> DataFrame:
    """Columns and types of the table, in its order, then ``extra`` columns."""
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields]
    return with_defaults(df, spec).select(*typed, *(extra or []))


@dataclass
class Insert:
    """``judged``: every row of the batch with ``reasons`` to drop it, empty for none.
    ``stored``, ``rejected`` and ``attempted`` are read off it, so write it first where
    more than one of them is wanted."""

    judged: DataFrame

    @property
    def stored(self) -> DataFrame:
        """Rows to append."""
        return self.judged.where(F.size("reasons") == 0).drop("reasons")

    @property
    def rejected(self) -> DataFrame:
        """Dropped rows with ``reasons``."""
        return self.judged.where(F.size("reasons") > 0)

    @property
    def attempted(self) -> DataFrame:
        """Every row of the batch."""
        return self.judged.drop("reasons")


def insert_ignore(spec: TableSpec, batch: DataFrame, order: list[str],
                  existing: DataFrame | None = None) -> Insert:
    """Drop rows that break a rule or repeat a key; the first of a batch wins.

    ``order`` names batch columns that form a total order. Without it the keys of
    the batch must be unique already, and no row is shuffled to compare them.
    Rows without a key are never duplicates, as in SQL.
    """
    places = [F.col(c).alias(f"_place{i}") for i, c in enumerate(order)]
    rows = conform(batch, spec, places).withColumn("reasons", violations(spec))
    if order:
        # The first place per key is aggregated before the shuffle, and the join back
        # splits hot keys; a null key finds no partner.
        place = F.struct(*[f"_place{i}" for i in range(len(order))])
        first = rows.where(F.size("reasons") == 0).groupBy(*spec.key).agg(F.min(place).alias("_first"))
        rows = rows.join(first, spec.key, "left").withColumn(
            "reasons", _also(F.col("_first") != place, "duplicate_in_batch"))
    if existing is not None:
        rows = already_stored(spec, rows, existing)
    return Insert(rows.select(*spec.schema.fieldNames(), "reasons"))


def key_certificate(rows: DataFrame, key: list[str]) -> tuple[int, int]:
    """K3: (distinct keys, most rows of a key). Only 128-bit digests of the keys are shuffled, counted before that;
    rows with a null in the key are left out."""
    whole = F.forall(F.array(*(F.col(c).isNotNull() for c in key)), lambda known: known)
    digests = rows.where(whole).select(*(F.xxhash64(F.lit(i), *key).alias(f"h{i}") for i in (1, 2)))
    counts = digests.groupBy("h1", "h2").agg(F.count("*").alias("n"))
    return tuple(counts.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).head())


def already_stored(spec: TableSpec, judged: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows without a reason yet whose key is stored get one."""
    known = existing.select(*spec.key).distinct().withColumn("_known", F.lit(True))
    rows = judged.join(known, spec.key, "left").withColumn("reasons", _also(F.col("_known"), "already_stored"))
    return rows.select(*judged.columns)


def _also(condition: Column, reason: str) -> Column:
    """``reasons`` of a row, or ``reason`` if it has none and meets the condition."""
    return F.when((F.size("reasons") == 0) & condition, F.array(F.lit(reason))).otherwise(F.col("reasons"))


def orphan_keys(child: DataFrame, fk: ForeignKey, parent: DataFrame) -> DataFrame:
    """K4: distinct child keys without a parent; hot keys collapse before the join."""
    keys = child.select(F.col(fk.column).alias(fk.parent_column)).where(
        F.col(fk.parent_column).isNotNull()).distinct()
    return keys.join(parent.select(fk.parent_column), fk.parent_column, "left_anti")


def check_foreign_keys(spec: TableSpec, child: DataFrame, parents: Mapping[str, DataFrame]) -> None:
    """K4: raise on the first orphan."""
    for fk in spec.foreign_keys:
        orphan = orphan_keys(child, fk, parents[fk.parent]).head(1)
        if orphan:
            raise ValueError(
                f"{spec.name}.{fk.column}: {orphan[0][0]!r} is not in {fk.parent}.{fk.parent_column}")


def quarantine_orphans(child: DataFrame, fk: ForeignKey, parent: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K4 without raising: (rows with a parent or no key, orphan rows)."""
    bad = orphan_keys(child, fk, parent).withColumnRenamed(fk.parent_column, fk.column)
    return child.join(bad, fk.column, "left_anti"), child.join(bad, fk.column, "left_semi")


def cascade_delete(child: DataFrame, fk: ForeignKey, deleted: DataFrame) -> DataFrame:
    """K5: child rows that survive the deletion of parent keys."""
    gone = deleted.select(F.col(fk.parent_column).alias(fk.column)).distinct()
    return child.join(gone, fk.column, "left_anti")
