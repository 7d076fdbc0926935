"""Snapshots of a store: which folders of files its tables consist of at the moment.

A write puts new folders beside the old ones. The next numbered file in ``_snapshots``,
renamed into place last, makes them part of the tables, all tables at once. Readers follow the
file with the highest number, so between two snapshots nothing changes for them.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import key_index
from ..operators.quality import TableSpec
from ..sources import files
from ..sources.delimited import empty_table

#: Files in question are read without asking their filters where they hold fewer keys than
#: this, or where keys of the batch times files are more. Either way gives the same rows.
FEW_KEYS = 1_000_000
PROBES = 1e9


@dataclass(frozen=True)
class Part:
    """A folder of one write, for tables laid out by a column one per value. ``path`` is below the table's
    data folder; ``n_bitmaps`` is what each of its files has in the key index, 0 without one."""

    path: str
    rows: int
    n_bitmaps: int = 0


@dataclass(frozen=True)
class Snapshot:
    number: int = 0
    tables: dict[str, list[Part]] = field(default_factory=dict)
    #: The steps of a run that is under way, with what they read.
    steps: dict[str, str] = field(default_factory=dict)

    def parts(self, table: str) -> list[Part]:
        return self.tables.get(table, [])

    def with_parts(self, table: str, parts: list[Part]) -> "Snapshot":
        return replace(self, tables=self.tables | {table: parts})


def latest(spark: SparkSession, root: str) -> Snapshot:
    numbers = [int(n.removesuffix(".json")) for n in files.names(spark, f"{root}/_snapshots") if n[0] != "." and n.endswith(".json")]
    if not numbers:
        return Snapshot()
    stored = files.read_json(spark, f"{root}/_snapshots/{max(numbers):012d}.json")
    tables = {t: [Part(**p) for p in parts] for t, parts in stored["tables"].items()}
    return Snapshot(max(numbers), tables, stored["steps"])


def publish(spark: SparkSession, root: str, new: Snapshot) -> Snapshot:
    """Make a snapshot the current one; FileExistsError if another writer was faster."""
    numbered = replace(new, number=new.number + 1)
    files.publish_json(spark, f"{root}/_snapshots/{numbered.number:012d}.json", asdict(numbered))
    return numbered


class TableFolder:
    """The files of one table: ``data`` and, by the same names, ``index``."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, layout: list[str]):
        self.spark, self.spec, self.layout = spark, spec, layout
        self.root = f"{root}/{spec.name}"
        self.data, self.index = f"{self.root}/data", f"{self.root}/index"

    def rows(self, parts: list[Part]) -> DataFrame:
        if not parts:
            return empty_table(self.spark, self.spec.schema)
        return self._scan([p.path for p in parts]).select(*self.spec.schema.fieldNames())

    def _scan(self, paths: list[str]) -> DataFrame:
        reader = self.spark.read.schema(self.spec.schema).option("basePath", self.data)
        return reader.parquet(*(f"{self.data}/{p}" for p in paths))

    def _place(self, levels: int) -> Column:
        """What follows the data folder in a file's path, without the last ``levels`` names."""
        below = F.element_at(F.split("_metadata.file_path", f"/{self.spec.name}/data/"), -1)
        names = F.split(below, "/")
        return F.array_join(F.slice(names, 1, F.size(names) - levels), "/")

    def add(self, df: DataFrame, indexed: bool = False) -> list[Part]:
        """Write new rows, and the index of their keys if later batches are to be compared with them;
        they are in no snapshot yet."""
        batch = f"batch=b{uuid.uuid4().hex}"
        if self.layout:
            # One group of files per value, split where it is large.
            df = df.hint("rebalance", *self.layout)
        writer = df.select(*self.spec.schema.fieldNames()).write
        (writer.partitionBy(*self.layout) if self.layout else writer).parquet(f"{self.data}/{batch}")
        # Counted from the footers of the files: no column is read.
        counts = self._scan([batch]).select(self._place(1).alias("path"), self._place(0).alias("file"))
        found = counts.groupBy("path").agg(F.count("*").alias("n"), F.count_distinct("file").alias("n_files")).collect()
        return [Part(path, r["n"], self._index(path, r["n"], r["n_files"]) if indexed else 0)
                for r in found for path in [unquote(r["path"])]]

    def _index(self, path: str, n_rows: int, n_files: int) -> int:
        n_bitmaps = max(1, -(-n_rows // (n_files * key_index.KEYS_PER_BITMAP)))
        rows = self._scan([path]).select(self._place(0).alias("file"), *self.spec.key)
        key_index.file_ranges(rows, self.spec.key).write.parquet(f"{self.index}/ranges/{path}")
        key_index.file_bitmaps(rows, self.spec.key, n_bitmaps).write.parquet(f"{self.index}/bitmaps/{path}")
        return n_bitmaps

    def _of_index(self, kind: str, parts: list[Part]) -> DataFrame:
        # Their partition columns are not wanted: some bear the names of key columns.
        own = self.spark.read.parquet(f"{self.index}/{kind}/{parts[0].path}").schema
        return self.spark.read.schema(own).option("recursiveFileLookup", True).parquet(
            *(f"{self.index}/{kind}/{p.path}" for p in parts))

    def may_hold(self, parts: list[Part], batch: DataFrame) -> DataFrame | None:
        """The rows of the files that may hold a key of the batch; None if there are none.

        Files out of the range of the batch's keys are passed over, then those whose filter
        no key passes. ``batch`` has the columns of the table and should be written.
        """
        known, paths = [p for p in parts if p.n_bitmaps], [p.path for p in parts if not p.n_bitmaps]
        if known:
            chosen = key_index.in_range(self._of_index("ranges", known), batch, self.spec.key)
            found = chosen.select("file", "n_keys").collect()
            if sum(r["n_keys"] for r in found) >= FEW_KEYS and len(found) * batch.count() <= PROBES:
                sizes = sorted({p.n_bitmaps for p in known})
                found = key_index.may_hold(chosen, self._of_index("bitmaps", known), batch, self.spec.key, sizes).collect()
            paths += [unquote(r["file"]) for r in found]
        return self._scan(paths).select(*self.spec.schema.fieldNames()) if paths else None

    def holding(self, parts: list[Part], keys: DataFrame, key: list[str]) -> list[Part]:
        """The parts with a row whose key is among ``keys``."""
        if not parts:
            return []
        rows = self._scan([p.path for p in parts]).select(self._place(1).alias("path"), *key)
        hit = {unquote(r["path"]) for r in rows.join(keys, key, "left_semi").select("path").distinct().collect()}
        return [p for p in parts if p.path in hit]

    def vacuum(self, parts: list[Part]) -> None:
        """Delete the folders that belong to none of the parts."""
        kept = {p.path for p in parts}
        for top in (self.data, f"{self.index}/ranges", f"{self.index}/bitmaps"):
            for batch in files.names(self.spark, top):
                inside = [f"{batch}/{n}" for n in files.names(self.spark, f"{top}/{batch}") if "=" in n] if self.layout else []
                for path in inside or [batch]:
                    if path not in kept:
                        files.delete(self.spark, f"{top}/{path}")
                if inside and not kept & set(inside):
                    files.delete(self.spark, f"{top}/{batch}")
