"""Where the target tables live: folders of Parquet files under snapshots, plus load helpers."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.dedupe import sequential_numbers
from ..operators.cascade import doomed_rows
from ..operators.quality import (
    ForeignKey, Insert, TableSpec, already_stored, check_foreign_keys, conform, insert_ignore,
    key_certificate, orphan_keys,
)
from ..session import staged
from ..sources import files
from .schema import HARMONIZATION_LOG, SEED_LOG, TABLES
from .snapshot import Part, Snapshot, TableFolder, latest, publish

# Liftover rewrites one genome build only, so mutations are laid out by build.
PARTITIONS = {"mutations": ["reference_genome"]}

LOG_FIELDS = ["table_name", "study_source", "field_name", "transformation", "source_field", "notes"]


@dataclass
class Load:
    """What became of one batch: its rows by fate, how many there were by reason, and
    the rejected ones. ``skipped`` counts source rows that gave no row of the batch."""

    table: str
    attempted: int
    stored: int
    reasons: dict[str, int]
    rejected: DataFrame
    skipped: dict[str, int]
    #: Distinct keys of a batch whose keys should be unique already, where that was checked.
    distinct_keys: int | None = None


class Store:
    """Tables under one folder of a file system all executors share, for one writer at a time.

    Every change is a new snapshot of all tables. ``loads`` lists what the inserts of this
    object dropped, and why; ``figures`` has what jobs measured beside what they stored.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.loads: list[Load] = []
        self.figures: dict[str, float] = {}
        self._pending: Snapshot | None = None

    def _folder(self, table: str) -> TableFolder:
        return TableFolder(self.spark, self.root, TABLES[table], PARTITIONS.get(table, []))

    def snapshot(self) -> Snapshot:
        """What readers see; within a transaction, what it has done so far."""
        return self._pending or latest(self.spark, self.root)

    @contextmanager
    def transaction(self):
        """Changes within become visible together at the end, or not at all."""
        if self._pending is not None:
            yield self
            return
        self._pending = latest(self.spark, self.root)
        try:
            yield self
            new = self._pending
        finally:
            self._pending = None
        publish(self.spark, self.root, new)

    def _change(self, new: Snapshot) -> None:
        if self._pending is None:
            publish(self.spark, self.root, new)
        else:
            self._pending = new

    def _replace(self, table: str, parts: list[Part]) -> None:
        self._change(self.snapshot().with_parts(table, parts))

    def finished(self, step: str) -> str | None:
        """What a step of the run under way had read when it finished, if it did."""
        return self.snapshot().steps.get(step)

    def finish(self, step: str, inputs: str) -> None:
        """Note a finished step. Those after it, of a run with other inputs, count no more."""
        now = self.snapshot()
        at = list(now.steps).index(step) if step in now.steps else len(now.steps)
        self._change(replace(now, steps=dict(list(now.steps.items())[:at]) | {step: inputs}))

    def finish_run(self) -> None:
        if self.snapshot().steps:
            self._change(replace(self.snapshot(), steps={}))

    def read(self, table: str) -> DataFrame:
        return self._folder(table).rows(self.snapshot().parts(table))

    def append(self, table: str, df: DataFrame) -> None:
        added = self._folder(table).add(conform(df, TABLES[table]))
        self._replace(table, self.snapshot().parts(table) + added)

    def overwrite(self, table: str, df: DataFrame) -> None:
        """S3: replace all rows; ``df`` may read the table."""
        self._replace(table, self._folder(table).add(conform(df, TABLES[table])))

    def truncate(self, table: str) -> None:
        """S3"""
        self._replace(table, [])

    def count(self, table: str) -> int:
        """As noted by the writes, nothing is read."""
        return sum(p.rows for p in self.snapshot().parts(table))

    def vacuum(self) -> None:
        """Delete what the current snapshot does not use: rows that were replaced, and the leavings
        of broken writes. No reader may be at work on an older snapshot."""
        now = latest(self.spark, self.root)
        for table in TABLES:
            self._folder(table).vacuum(now.parts(table))
        for name in files.names(self.spark, f"{self.root}/_snapshots"):
            if name != f"{now.number:012d}.json":
                files.delete(self.spark, f"{self.root}/_snapshots/{name}")

    def insert(self, table: str, batch: DataFrame, order: list[str], on_orphan: str = "raise",
               skipped: dict[str, int] | None = None, unique: bool = False) -> Insert:
        """Append the rows that break no rule and repeat no key.

        Of the stored rows, only files that may hold a key of the batch are read. A row whose parent is
        missing fails the load before anything is stored, or with ``on_orphan="reject"`` joins the
        rejected rows; "trust" skips the check for batches that were joined with their parents.
        Without an ``order`` a repeated key fails the load likewise; ``unique`` skips that check for
        batches of one row per key by construction.
        The judged batch is written once; stored and rejected rows and their counts are read from there.
        """
        spec, folder = TABLES[table], self._folder(table)
        parts = self.snapshot().parts(table)
        result = Insert(staged(insert_ignore(spec, batch, order).judged))
        distinct = None
        if not order and not unique:
            distinct, most = key_certificate(result.stored, spec.key)
            if most > 1:
                raise ValueError(f"{table}: {most} rows of one key ({', '.join(spec.key)}) in a batch without an order")
        if (held := folder.may_hold(parts, result.stored)) is not None:
            result = Insert(staged(already_stored(spec, result.judged, held)))
        parents = self._parents(spec)
        if on_orphan == "raise":
            check_foreign_keys(spec, result.stored, parents)
        elif on_orphan == "reject" and parents:
            result = Insert(staged(reduce(
                lambda rows, fk: _orphans_marked(rows, fk, parents[fk.parent]), spec.foreign_keys, result.judged)))
        self._replace(table, parts + folder.add(result.stored, indexed=True))
        self.loads.append(replace(_counted(table, result, skipped or {}), distinct_keys=distinct))
        return result

    def load_report(self) -> DataFrame:
        """(load, table_name, fate, n_rows): rows attempted, stored, rejected by reason
        and skipped by cause, of every insert of this object."""
        rows = []
        for n, load in enumerate(self.loads, 1):
            fates = {"attempted": load.attempted, "stored": load.stored}
            fates |= {f"rejected: {k}": v for k, v in sorted(load.reasons.items())}
            fates |= {f"skipped: {k}": v for k, v in load.skipped.items()}
            rows += [(n, load.table, fate, count) for fate, count in fates.items()]
        return self.spark.createDataFrame(rows, "load int, table_name string, fate string, n_rows long")

    def _parents(self, spec: TableSpec) -> dict[str, DataFrame]:
        return {fk.parent: self.read(fk.parent) for fk in spec.foreign_keys}

    def move_partition(self, table: str, value: str, rows: DataFrame) -> None:
        """Replace the rows of one partition value by ``rows``, which belong to
        other partitions. New files are written beside the old ones and one snapshot swaps them, so a
        reader sees each row once; a failure before that changes nothing."""
        spec, folder, (column,) = TABLES[table], self._folder(table), PARTITIONS[table]
        parts = self.snapshot().parts(table)
        others = [p for p in parts if f"{column}={value}" not in p.path.split("/")]
        moved = staged(conform(rows, spec))
        # Rows that are there already, as where the source rows were added a second time.
        if (held := folder.may_hold(others, moved)) is not None:
            moved = moved.join(held.select(*spec.key), spec.key, "left_anti")
        self._replace(table, others + folder.add(moved, indexed=True))

    def delete(self, table: str, keys: DataFrame) -> dict[str, int]:
        """K5: delete the rows with one of the ``keys`` (columns of the table's key) and whatever refers to
        them, directly or by way of other tables. Only folders that lose rows are written anew, and all
        tables change in one snapshot. Returns the number of rows deleted by table."""
        now = self.snapshot()
        doomed = doomed_rows({t: self.read(t) for t in TABLES}, list(TABLES.values()), table, keys)
        counts = {}
        for name, rows in doomed.items():
            spec, folder = TABLES[name], self._folder(name)
            gone = staged(rows.select(*spec.key))
            hit = folder.holding(now.parts(name), gone, spec.key)
            if hit:
                kept = folder.add(folder.rows(hit).join(gone, spec.key, "left_anti"), indexed=True)
                now = now.with_parts(name, [p for p in now.parts(name) if p not in hit] + kept)
                counts[name] = sum(p.rows for p in hit) - sum(p.rows for p in kept)
        self._change(now)
        return counts

    def log(self, rows: list[tuple]) -> None:
        """Append audit rows (table, study, field, transformation, source field, notes)."""
        last = self.read("harmonization_log").agg(F.max("log_id")).head()[0] or 0
        self.append("harmonization_log", audit_rows(self.spark, rows, last))

    def create(self) -> "Store":
        """Seed the audit log of a new store."""
        if not self.snapshot().parts("harmonization_log"):
            self.log(SEED_LOG)
        return self


def _orphans_marked(judged: DataFrame, fk: ForeignKey, parent: DataFrame) -> DataFrame:
    """K4: rows without a reason yet whose parent is missing get one."""
    bad = orphan_keys(judged.where(F.size("reasons") == 0), fk, parent).select(
        F.col(fk.parent_column).alias(fk.column), F.lit(True).alias("_orphan"))
    reason: Column = F.array(F.lit(f"foreign_key:{fk.column}"))
    return judged.join(bad, fk.column, "left").withColumn("reasons", F.when(
        (F.size("reasons") == 0) & F.col("_orphan"), reason).otherwise(F.col("reasons"))).select(*judged.columns)


def _counted(table: str, result: Insert, skipped: dict[str, int]) -> Load:
    """Counts by reason; the reasons are the rules of the table, so they are few."""
    fates = {tuple(r["reasons"]): r["n"] for r in result.judged.groupBy("reasons").agg(F.count("*").alias("n")).collect()}
    reasons = {k: sum(n for broken, n in fates.items() if k in broken) for k in sorted({k for broken in fates for k in broken})}
    return Load(table, sum(fates.values()), fates.get((), 0), reasons, result.rejected, skipped)


def audit_rows(spark: SparkSession, rows: list[tuple], last_id: int = 0) -> DataFrame:
    """Numbered audit rows; they are written by hand, a few per job."""
    numbered = [(last_id + i, *r) for i, r in enumerate(rows, 1)]
    fields = ", ".join(f"{f} string" for f in LOG_FIELDS)
    return conform(spark.createDataFrame(numbered, f"log_id long, {fields}"), HARMONIZATION_LOG)


def number_audit_rows(existing: DataFrame, new: DataFrame, order: list[str]) -> DataFrame:
    """S2 on DataFrames: continue the numbering of ``existing`` in ``order``."""
    last = existing.agg(F.coalesce(F.max("log_id"), F.lit(0)).alias("last")).scalar()
    return sequential_numbers(new, "_number", order).withColumn(
        "log_id", last + F.col("_number")).drop("_number")
