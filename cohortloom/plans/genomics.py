"""Mutations (P6-P8), expression (G2) and copy number (G3) as target-table rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import clean as c, vocab
from ..operators.dedupe import content_ids
from ..operators.lookup import checked_broadcast, flag_members, members, shared_keys
from ..operators.reshape import explode_samples, first_known, last_known, line_scores, z_score
from ..session import staged
from ..sources.delimited import col_or_null, rename_headers
from ..sources.matrix import Matrix, column_map, unique_lines, with_sample_values

CONTENT = [
    "tumor_id", "gene_symbol", "chromosome", "start_position", "end_position", "reference_allele",
    "variant_allele", "variant_classification", "variant_type", "hgvsp", "vaf",
]


# ---- mutations ----

def panel_genes(source: DataFrame | None, spark: SparkSession) -> DataFrame:
    """(gene_symbol) as spelled in the panel file; a fixed list without one."""
    fallback = spark.createDataFrame([(g,) for g in vocab.FALLBACK_PANEL], "gene_symbol string")
    if source is None:
        return fallback
    genes = source.select(F.col("Hugo_Symbol").alias("gene_symbol")).where(
        F.col("gene_symbol").isNotNull()).distinct()
    return fallback if genes.isEmpty() else genes


def _variants(source: DataFrame, tumor_id: Callable[[Column], Column], tumors: DataFrame, vaf: Column,
              build: str, scope: str) -> DataFrame:
    """C4, then the cleaning, which is spent on rows of known tumors only."""
    def col(name: str) -> Column:
        return col_or_null(source, name)

    named = source.withColumn("tumor_id", tumor_id(col("barcode")))
    return members(named, tumors.select("tumor_id"), "tumor_id").select(
        "tumor_id",
        c.clean_text(col("gene")).alias("gene_symbol"),
        c.clean_text(col("chr")).alias("chromosome"),
        c.clean_long(col("start")).alias("start_position"),
        c.clean_long(col("end")).alias("end_position"),
        F.lit(build).alias("reference_genome"),
        c.clean_text(col("ref")).alias("reference_allele"),
        c.clean_text(col("alt")).alias("variant_allele"),
        c.normalize_variant_class(col("vclass")).alias("variant_classification"),
        c.in_domain(c.clean_text(col("vtype")), vocab.VARIANT_TYPES).alias("variant_type"),
        c.first_clean(col("hgvsp"), col("hgvsp_long")).alias("hgvsp"),
        vaf.alias("vaf"),
        F.lit(scope).alias("sequencing_scope"),
    ).where(F.col("gene_symbol").isNotNull())


def skipped_variants(source: DataFrame, tumor_id: Callable[[Column], Column], tumors: DataFrame) -> dict[str, int]:
    """Source rows without a known tumor, and those of a known tumor without a gene."""
    named = rename_headers(source, vocab.VARIANT_HEADERS)
    known = tumors.select("tumor_id", F.lit(True).alias("_known"))
    rows = named.select(
        tumor_id(col_or_null(named, "barcode")).alias("tumor_id"),
        c.clean_text(col_or_null(named, "gene")).isNull().alias("_nameless")).join(known, "tumor_id", "left")
    counts = rows.agg(F.count_if(F.col("_known").isNull()).alias("unknown tumor"),
                      F.count_if(F.col("_known") & F.col("_nameless")).alias("no gene"))
    return counts.head().asDict()


def exome_variants(source: DataFrame, tumors: DataFrame, panel: DataFrame) -> DataFrame:
    """Variants of known tumors, flagged against the panel."""
    named = rename_headers(source, vocab.VARIANT_HEADERS)
    rows = _variants(named, c.primary_tumor_id, tumors, c.allele_frequency(named.columns),
                     vocab.BUILD_TARGET, "WES")
    flagged = flag_members(rows, panel, "gene_symbol", "in_metabric_panel")
    return content_ids(flagged, "mutation_id", "TCGA-MUT-", CONTENT)


def panel_variants(source: DataFrame, tumors: DataFrame) -> DataFrame:
    """Variants of known tumors; all are on the panel."""
    named = rename_headers(source, vocab.VARIANT_HEADERS)
    rows = _variants(named, c.clean_text, tumors, F.lit(None).cast("double"), vocab.BUILD_SOURCE, "PANEL")
    return content_ids(rows.withColumn("in_metabric_panel", F.lit(1)), "mutation_id", "MB-MUT-", CONTENT)


# ---- matrices ----

def shared_labels(a: Matrix | None, b: Matrix | None) -> DataFrame | None:
    """Labels of both matrices, invalid ones included; None means no filter,
    which is also the answer when nothing is shared."""
    if a is None or b is None:
        return None
    shared = checked_broadcast(shared_keys(a.lines, b.lines, "label"))
    return None if shared.isEmpty() else shared


def _chosen_lines(matrix: Matrix, shared: DataFrame | None) -> DataFrame:
    """B3, B4, E1 on lines, before any cell is split off."""
    lines = matrix.lines.where(c.valid_symbol("label"))
    if shared is not None:
        lines = lines.join(shared, "label", "left_semi")
    return unique_lines(lines)


def skipped_lines(matrix: Matrix, shared: DataFrame | None) -> dict[str, int]:
    """Lines without a valid label, those of labels that are not shared, and those that repeat
    the label of an earlier line."""
    valid = F.coalesce(c.valid_symbol("label"), F.lit(False))
    labels = matrix.lines.select("label", valid.alias("_valid")).groupBy("label", "_valid").agg(F.count("*").alias("_n"))
    known = F.lit(True)
    if shared is not None:
        labels = labels.join(shared.select("label", F.lit(True).alias("_known")), "label", "left")
        known = F.coalesce("_known", F.lit(False))
    n, ok = F.col("_n"), F.col("_valid") & known
    counts = labels.agg(
        F.coalesce(F.sum(F.when(~F.col("_valid"), n)), F.lit(0)).alias("no label"),
        F.coalesce(F.sum(F.when(F.col("_valid") & ~known, n)), F.lit(0)).alias("not shared"),
        F.coalesce(F.sum(F.when(ok, n - 1)), F.lit(0)).alias("repeated label"))
    return counts.head().asDict()


def _no_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def expression_rows(matrix: Matrix, sample_id: Callable[[str], Column], tumors: DataFrame,
                    shared: DataFrame | None, platform: str) -> DataFrame:
    """Values and z-scores per tumor and gene.

    Mean and spread cover all matched columns; of columns that share a tumor, the
    first with a value is stored. Keys are unique by construction.
    """
    columns = column_map(matrix.header, sample_id, tumors.select(F.col("tumor_id").alias("sample_id")))
    lines = line_scores(with_sample_values(_chosen_lines(matrix, shared), columns, c.parse_double, "double"))
    cells = explode_samples(lines, first_known(), ["label", "entrez_text", "mean", "sigma"])
    return cells.where(F.col("value").isNotNull()).select(
        F.col("sample_id").alias("tumor_id"), F.col("label").alias("gene_symbol"),
        c.entrez_id("entrez_text").alias("entrez_id"),
        # A stored NaN reads back as null.
        _no_nan(F.col("value")).alias("expression_value"),
        _no_nan(z_score(F.col("value"), F.col("mean"), F.col("sigma"))).alias("expression_z_score"),
        F.lit(platform).alias("platform"),
    )


def copy_number_rows(matrix: Matrix, sample_id: Callable[[str], Column], tumors: DataFrame,
                     shared: DataFrame | None) -> DataFrame:
    """Discrete values per tumor and gene; values outside the domain give no row."""
    columns = column_map(matrix.header, sample_id, tumors.select(F.col("tumor_id").alias("sample_id")))
    lines = with_sample_values(_chosen_lines(matrix, shared), columns, c.parse_long, "bigint")
    cells = explode_samples(lines, first_known(domain=vocab.GISTIC_VALUES), ["label"])
    return cells.where(F.col("value").isNotNull()).select(
        F.col("sample_id").alias("tumor_id"), F.col("label").alias("gene_symbol"),
        F.col("value").cast("int").alias("gistic_value"), F.lit(None).cast("double").alias("log2_ratio"),
    )


def batch_cells(matrices: list[tuple[Matrix, Callable[[str], Column]]], tumor_study: DataFrame,
                log2p1: bool = False) -> DataFrame | None:
    """I5 input: (feature, sample, batch, value) of the genes all matrices share.

    Of columns that share a tumor the last with a value counts, and a later matrix
    overrides an earlier one. Missing cells stay, with null values. None if a
    matrix matches no sample or nothing is shared.

    What is written are the parsed lines, with the values of a line side by side; the cells are taken
    out of them anew by each pass, which then counts or sums them before anything is shuffled.
    """
    known = tumor_study.select(F.col("tumor_id").alias("sample_id"))
    maps = [column_map(m.header, sid, known) for m, sid in matrices]
    if any(m.isEmpty() for m in maps):
        return None
    valid = [m.lines.where(c.valid_symbol("label")) for m, _ in matrices]
    shared = checked_broadcast(reduce(lambda a, b: shared_keys(a, b, "label"), valid).select("label").distinct())
    if shared.isEmpty():
        return None
    parts = []
    for rank, ((matrix, _), columns) in enumerate(zip(matrices, maps)):
        lines = with_sample_values(_chosen_lines(matrix, shared), columns, c.parse_double, "double")
        parts.append(explode_samples(staged(lines), last_known(), ["label"]).withColumn("_rank", F.lit(rank)))
    cells = reduce(DataFrame.unionByName, parts)
    samples = reduce(DataFrame.unionByName, [m.select("sample_id").distinct() for m in maps])
    if not samples.groupBy("sample_id").count().where("count > 1").isEmpty():
        cells = staged(cells.groupBy("label", "sample_id").agg(
            F.max_by("value", F.when(F.col("value").isNotNull(), F.col("_rank"))).alias("value")))
    value = F.log2(F.col("value") + 1) if log2p1 else F.col("value")
    batch = checked_broadcast(tumor_study.join(
        samples.select(F.col("sample_id").alias("tumor_id")), "tumor_id", "left_semi"))
    return cells.join(batch.withColumnRenamed("tumor_id", "sample_id"), "sample_id").select(
        F.col("label").alias("feature"), F.col("sample_id").alias("sample"),
        F.col("study_source").alias("batch"), value.alias("value"))
