"""K5: what goes with deleted rows, along the graph of foreign keys."""

from __future__ import annotations

from collections.abc import Mapping
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, functions as F

from .quality import ForeignKey, TableSpec


def affected_tables(specs: list[TableSpec], root: str) -> list[TableSpec]:
    """``root`` and all tables that refer to it, parents first. Tables that refer to each other in a circle
    raise CycleError."""
    below = {s.name: {fk.parent for fk in s.foreign_keys} for s in specs}
    by_name = {s.name: s for s in specs}
    reached, order = {root}, []
    for name in TopologicalSorter(below).static_order():
        if name in by_name and (name in reached or below[name] & reached):
            reached.add(name)
            order.append(by_name[name])
    return order


def _keys_of(rows: DataFrame, fk: ForeignKey) -> DataFrame:
    """The values that children hold, each once, so that a hot parent stays one row."""
    return rows.select(F.col(fk.parent_column).alias(fk.column)).where(F.col(fk.column).isNotNull()).distinct()


def doomed_rows(tables: Mapping[str, DataFrame], specs: list[TableSpec], root: str, keys: DataFrame) -> dict[str, DataFrame]:
    """The rows to delete by table: those of ``root`` with one of the ``keys``, and those that refer to a deleted row
    of a table above. A null foreign key refers to nothing.

    One level's keys feed the next. A row that two parents take is one row.
    """
    doomed: dict[str, DataFrame] = {}
    for spec in affected_tables(specs, root):
        rows = tables[spec.name]
        if spec.name == root:
            doomed[root] = rows.join(keys.select(*spec.key).distinct(), spec.key, "left_semi")
            continue
        by = [fk for fk in spec.foreign_keys if fk.parent in doomed]
        marks = [f"_gone{i}" for i in range(len(by))]
        for fk, mark in zip(by, marks):
            rows = rows.join(_keys_of(doomed[fk.parent], fk).withColumn(mark, F.lit(True)), fk.column, "left")
        hit = F.coalesce(*marks, F.lit(False)) if len(marks) > 1 else F.col(marks[0])
        doomed[spec.name] = rows.where(hit).select(*tables[spec.name].columns)
    return doomed


def surviving_rows(tables: Mapping[str, DataFrame], specs: list[TableSpec], root: str, keys: DataFrame) -> dict[str, DataFrame]:
    """The other rows of the same tables."""
    doomed = doomed_rows(tables, specs, root, keys)
    out = {}
    for spec in affected_tables(specs, root):
        rows = tables[spec.name]
        if spec.name == root:
            out[root] = rows.join(keys.select(*spec.key).distinct(), spec.key, "left_anti")
            continue
        for fk in spec.foreign_keys:
            if fk.parent in doomed:
                rows = rows.join(_keys_of(doomed[fk.parent], fk), fk.column, "left_anti")
        out[spec.name] = rows.select(*tables[spec.name].columns)
    return out
