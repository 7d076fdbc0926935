"""Wide feature-by-sample text matrices (A5).

A line stays one row until the very end: row labels, duplicate lines and per-line
statistics are handled on lines, so the many cells of a line are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.dedupe import keep_first
from ..operators.lookup import checked_broadcast
from ..operators.reshape import settled
from .delimited import LINE_ORDER, read_lines, with_line_order

LABEL = "Hugo_Symbol"
ENTREZ = "Entrez_Gene_Id"


@dataclass
class Matrix:
    """``lines``: label, entrez_text, value (the raw line) and line order.
    ``header``: pos, sample - one row per sample column."""

    lines: DataFrame
    header: DataFrame


def read_matrix(spark: SparkSession, path: str, label: str | None = LABEL) -> Matrix:
    """Read a matrix, which may lie in several files with a header each. The label column is
    ``label`` if a header has it, else the first column that is not the Entrez column.

    Where headers differ, columns are matched by name, the k-th of a name with the k-th, and
    lines are brought into the order of the first file, followed by the columns of others.
    A cell of a column that a file does not have is empty.
    """
    text = with_line_order(read_lines(spark, path)).where(
        ~F.col("value").startswith("#") & (F.length("value") > 0)
    )
    # One line a file: the same amount Spark's own CSV header handling brings to the driver.
    heads = _first_lines(text)
    names = heads[0][1].split("\t") if heads else []
    layout, places = _layout(names, label), {}
    order = dict.fromkeys(layout)
    for _, line in heads:
        own = _layout(line.split("\t"), label)
        order |= dict.fromkeys(c for c in own if c not in order)
        places[line] = own
    order = list(order)
    wanted = {line: [own[c] if c in own else -1 for c in order] for line, own in places.items()}
    # A file that is laid out like the whole needs no new lines.
    moved = {line: p for line, p in wanted.items() if p != list(range(len(order)))}
    if not moved:
        lines = text.where(F.col("value") != F.lit(heads[0][1] if heads else ""))
    else:
        files = spark.createDataFrame(
            [(f, line, moved.get(line)) for f, line in heads], "_file string, _head string, _places array<int>")
        cells = F.split("value", "\t")
        laid = F.array_join(F.transform("_places", lambda p: F.when(p >= 0, F.get(cells, p))), "\t", "")
        lines = text.join(checked_broadcast(files), "_file").where(F.col("value") != F.col("_head")).withColumn(
            "value", F.when(F.col("_places").isNull(), F.col("value")).otherwise(laid))
    entrez_pos = order.index(_ENTREZ_COLUMN) if _ENTREZ_COLUMN in order else None
    label_pos = order.index(_LABEL_COLUMN) if _LABEL_COLUMN in order else 0
    samples = [(i, c[0]) for i, c in enumerate(order) if c not in (_LABEL_COLUMN, _ENTREZ_COLUMN)]
    return Matrix(lines.select(
        F.nullif(_cell(label_pos), F.lit("")).alias("label"),
        (F.lit(None).cast("string") if entrez_pos is None else _cell(entrez_pos)).alias("entrez_text"),
        "value",
        *LINE_ORDER,
    ), spark.createDataFrame(samples, "pos int, sample string"))


_LABEL_COLUMN, _ENTREZ_COLUMN = ("label", -1), ("entrez", -1)


def _layout(names: list[str], label: str | None) -> dict[tuple[str, int], int]:
    """Columns of a header with their places; a sample is (name, how many of the name stand before)."""
    rest = [n for n in names if n != ENTREZ]
    label_name = label if label in names else (rest[0] if rest else None)
    at, seen = {}, {}
    for i, name in enumerate(names):
        if name == label_name and _LABEL_COLUMN not in at:
            at[_LABEL_COLUMN] = i
        elif name == ENTREZ:
            at.setdefault(_ENTREZ_COLUMN, i)
        else:
            seen[name] = seen.get(name, -1) + 1
            at[name, seen[name]] = i
    return at


def _first_lines(text: DataFrame) -> list[tuple[str, str]]:
    """(file, first line) of every file that has one, in file order."""
    if len(text.inputFiles()) <= 1:
        return [tuple(r) for r in text.where(F.col("_block") == 0).select("_file", "value").head(1)]
    first = text.where(F.col("_block") == 0).groupBy("_file").agg(F.min_by("value", "_line").alias("value"))
    return [tuple(r) for r in first.orderBy("_file").collect()]


def _cell(pos: int) -> Column:
    """One cell near the start of a line, without splitting the rest."""
    return F.get(F.split("value", "\t", pos + 2), F.lit(pos))


def unique_lines(lines: DataFrame) -> DataFrame:
    """The first line of every label in file order."""
    return keep_first(lines, ["label"], LINE_ORDER)


def column_map(header: DataFrame, sample_id: Callable[[str], Column], known: DataFrame) -> DataFrame:
    """(sample_id, positions) of the columns whose id is in ``known``.

    ``known`` has one column ``sample_id``. Bounded by the width of the header.
    """
    return (
        header.withColumn("sample_id", sample_id("sample"))
        .join(known.distinct(), "sample_id", "left_semi")
        .groupBy("sample_id").agg(F.array_sort(F.collect_list("pos")).alias("positions"))
    )


# Lines of which all cells after the first hold only these characters read the same
# as strict numbers and as the engine's own cast, which is far cheaper per cell.
PLAIN_LINE = r"^[^\t]*\t[0-9.eE+\-NA\t]*$"


def with_sample_values(lines: DataFrame, columns: DataFrame, parse: Callable[[Column], Column],
                       number: str) -> DataFrame:
    """Add ``samples``: array of (sample_id, values), one value per matched column.

    ``parse`` turns a cell into a ``number`` or null. The column map is a single-row
    scalar subquery; it is no wider than a line.
    """
    packed = columns.agg(
        F.array_sort(F.collect_list(F.struct("positions", "sample_id"))).alias("columns")
    ).scalar()
    texts = F.split("value", "\t")
    cells = F.when(F.col("value").rlike(PLAIN_LINE), texts.try_cast(f"array<{number}>")).otherwise(
        F.transform(texts, lambda cell: parse(cell)))
    samples = F.transform(
        "_columns",
        lambda c: F.struct(
            c["sample_id"].alias("sample_id"),
            F.transform(c["positions"], lambda p: F.get("_cells", p)).alias("values"),
        ),
    )
    parsed = settled(lines.select("label", "entrez_text", cells.alias("_cells"), packed.alias("_columns")))
    return parsed.select("label", "entrez_text", samples.alias("samples"))
