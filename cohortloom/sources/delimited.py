"""Tab-separated sources with all-string columns (A1-A10) and stable line order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..operators.lookup import checked_broadcast
from ..session import staged
from .files import exists

# Line order of a file scan. The running id alone follows task packing, so file
# and split offset come first.
LINE_ORDER = ["_file", "_block", "_line"]
#: Lines of a chunk of a compressed file.
CHUNK_LINES = 1_000_000


def pin_splits(spark: SparkSession) -> None:
    """Two scans of a file must be split alike, or the places of its lines differ. Unset,
    the splits follow the executors of the moment; from here on they stay as they are."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def preferred(spark: SparkSession, *paths: str | None) -> str | None:
    """First path that exists."""
    return next((p for p in paths if exists(spark, p)), None)


def with_line_order(scan: DataFrame) -> DataFrame:
    """Tag rows with their place in the source; call directly on a file scan, or on lines that were cut out of one."""
    if set(LINE_ORDER) <= set(scan.columns):
        return scan
    pin_splits(scan.sparkSession)
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A10: the lines of text files. Compressed ones cannot be split, so they are read in one stream
    each and written to chunk files of ``CHUNK_LINES`` lines, which many tasks read from then on. Such lines bring
    their places with them: the file, no block, and the running number of the line."""
    scan = spark.read.text(path)
    if not any(f.endswith((".gz", ".bz2")) for f in scan.inputFiles()):
        return scan
    lines = scan.select(
        "value", F.col("_metadata.file_path").alias("_file"), F.lit(0).cast("bigint").alias("_block"),
        F.monotonically_increasing_id().alias("_line"))
    return staged(lines, max_rows=CHUNK_LINES)


def read_table(spark: SparkSession, path: str, comment: str | None = "#") -> DataFrame:
    """A1/A10: header, tabs, every column a string, empty is null; plain or gzip."""
    options = {"sep": "\t", "escape": '"'}
    if exists(spark, path) and any(f.endswith((".gz", ".bz2")) for f in spark.read.text(path).inputFiles()):
        return _read_chunked(spark, path, comment, options)
    reader = spark.read.options(**options).option("header", True).option("inferSchema", False)
    if comment:
        reader = reader.option("comment", comment)
    return with_line_order(reader.csv(path))


def _read_chunked(spark: SparkSession, path: str, comment: str | None, options: dict[str, str]) -> DataFrame:
    """``read_table`` on chunks of lines, with the same rows: each chunk is parsed by its own task."""
    lines = read_lines(spark, path).where(F.length("value") > 0)
    if comment:
        lines = lines.where(~F.col("value").startswith(comment))
    # The header of each file is its first line; the first file's names the columns.
    heads = lines.groupBy("_file").agg(F.min("_line").alias("_line"), F.min_by("value", "_line").alias("value"))
    first = heads.orderBy("_file").select("value").head()
    if first is None:
        return empty_source(spark, [])
    names = spark.read.options(**options).option("header", True).csv(
        spark.sparkContext.parallelize([first[0]], 1)).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = lines.join(checked_broadcast(heads.select("_file", "_line")), ["_file", "_line"], "left_anti")
    return rows.select(F.from_csv("value", _ddl(schema), options).alias("_row"), *LINE_ORDER).select("_row.*", *LINE_ORDER)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)


def drop_leading_rows(df: DataFrame, rows: int) -> DataFrame:
    """A2: drop the first data rows of every file.

    Ranking keeps at most ``rows`` rows per file on the map side, so the shuffle
    carries a handful of rows; the bulk only passes an anti join against them.
    """
    by_file = Window.partitionBy("_file").orderBy(*LINE_ORDER)
    junk = (
        df.select(*LINE_ORDER).withColumn("_rank", F.row_number().over(by_file))
        .where(F.col("_rank") <= rows).drop("_rank")
    )
    return df.join(junk, LINE_ORDER, "left_anti")


def read_biotab(spark: SparkSession, path: str) -> DataFrame:
    """A2: a header followed by two rows that are no data."""
    return drop_leading_rows(read_table(spark, path, comment=None), 2)


def empty_table(spark: SparkSession, columns: list[str] | T.StructType) -> DataFrame:
    """The typed stand-in for a missing source."""
    if isinstance(columns, list):
        columns = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.createDataFrame([], columns)


def empty_source(spark: SparkSession, columns: list[str]) -> DataFrame:
    """A7 for a bronze table: string columns plus line order."""
    order = [T.StructField("_file", T.StringType()), T.StructField("_block", T.LongType()),
             T.StructField("_line", T.LongType())]
    return empty_table(spark, T.StructType(
        [T.StructField(c, T.StringType()) for c in columns] + order))


def col_or_null(df: DataFrame, name: str) -> Column:
    """The column, or a null string when the source lacks it."""
    # Source headers may hold dots.
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def rename_headers(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Canonical names; two headers for one name are coalesced in listed order."""
    wanted: dict[str, list[str]] = {}
    for header, name in aliases.items():
        if header in df.columns:
            wanted.setdefault(name, []).append(header)
    taken = {h for headers in wanted.values() for h in headers}
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in taken],
        *[F.coalesce(*[F.col(f"`{h}`") for h in headers]).alias(name) for name, headers in wanted.items()],
    )
