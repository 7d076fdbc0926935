"""The load jobs and their order."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import clean as c, vocab
from ..operators.combat import batch_shift, correct_batches, prepare
from ..operators.liftover import lift_summary, lift_variants
from ..sources.chain import read_chain
from ..session import staged
from ..sources.delimited import empty_source, exists, preferred, read_biotab, read_table
from ..sources.files import fingerprint
from ..sources.matrix import Matrix, read_matrix
from . import clinical, genomics
from .report import database_summary
from .schema import CLINICAL_LOG, TABLES, load_entry
from .store import Store
from .views import tumor_study


@dataclass
class Sources:
    """Paths of the source files; a missing one skips what depends on it."""

    curated_records: str | None = None
    clinical_supplement: str | None = None
    subtypes: str | None = None
    biotab_patients: str | None = None
    drugs: str | None = None
    biotab_drugs: str | None = None
    radiation: str | None = None
    panel_patients: str | None = None
    panel_samples: str | None = None
    exome_mutations: str | None = None
    panel_mutations: str | None = None
    exome_expression: str | None = None
    panel_expression: str | None = None
    exome_copy_number: str | None = None
    panel_copy_number: str | None = None
    chain: str | None = None


def _optional(spark: SparkSession, path: str | None, columns: list[str], reader=read_table) -> DataFrame:
    return reader(spark, path) if exists(spark, path) else empty_source(spark, columns)


def load_clinical(store: Store, src: Sources, on_orphan: str = "raise") -> dict[str, int]:
    """P5: both cohorts, then the audit rows, which are written in any case."""
    spark = store.spark
    supplement = clinical.supplement_lookup(_optional(spark, src.clinical_supplement, ["PATIENT_ID"]))
    exome = None
    if exists(spark, src.curated_records):
        subtypes = clinical.subtype_lookup(_optional(
            spark, src.subtypes, ["sampleID", "Subtype_Selected", "Subtype_mRNA"],
            lambda s, p: read_table(s, p, comment=None)))
        exome = clinical.curated_clinical(
            read_table(spark, src.curated_records, comment=None), supplement, subtypes)
    elif exists(spark, src.biotab_patients):
        exome = clinical.biotab_clinical(read_biotab(spark, src.biotab_patients))
        supplement = None
    if exome is not None:
        drugs = preferred(spark, src.drugs, src.biotab_drugs)
        treatments = clinical.exome_treatments(
            exome.patients,
            _optional(spark, drugs, ["bcr_patient_barcode"], read_biotab),
            _optional(spark, src.radiation, ["bcr_patient_barcode"], read_biotab),
            supplement,
        )
        _insert_clinical(store, exome, treatments, on_orphan)
    if exists(spark, src.panel_patients):
        samples = read_table(spark, src.panel_samples) if exists(spark, src.panel_samples) else None
        records, order = clinical.panel_records(read_table(spark, src.panel_patients), samples)
        _insert_clinical(store, clinical.panel_clinical(records, order),
                         clinical.panel_treatments(records, order), on_orphan)
    store.log(CLINICAL_LOG)
    return {t: store.count(t) for t in ("patients", "tumors", "treatments")}


def _insert_clinical(store: Store, rows: clinical.Clinical, treatments: DataFrame, on_orphan: str) -> None:
    store.insert("patients", rows.patients, rows.order, on_orphan)
    store.insert("tumors", rows.tumors, rows.order, on_orphan)
    # Running numbers are unique within a batch.
    store.insert("treatments", treatments, [], on_orphan)


def load_mutations(store: Store, src: Sources) -> int:
    """Panel cohort first, then exomes flagged against its genes. ``store.loads``
    tells what was skipped or rejected, as after every load."""
    spark = store.spark
    panel_source = read_table(spark, src.panel_mutations) if exists(spark, src.panel_mutations) else None
    panel = genomics.panel_genes(panel_source, spark)
    tumors = store.read("tumors")
    # Both batches were joined with the tumors and have unique ids.
    if panel_source is not None:
        store.insert("mutations", genomics.panel_variants(panel_source, tumors), [], "trust",
                     genomics.skipped_variants(panel_source, c.clean_text, tumors))
    if exists(spark, src.exome_mutations):
        source = read_table(spark, src.exome_mutations)
        store.insert("mutations", genomics.exome_variants(source, tumors, panel), [], "trust",
                     genomics.skipped_variants(source, c.primary_tumor_id, tumors))
    store.log([load_entry("panel", genes=panel.count()), load_entry("build")])
    return store.count("mutations")


def _matrix(spark: SparkSession, path: str | None, label: str | None) -> Matrix | None:
    return read_matrix(spark, path, label) if exists(spark, path) else None


def _cohort_matrices(spark: SparkSession, exome: str | None, panel: str | None, label: str | None):
    """(study, matrix, column name -> tumor id) of both cohorts."""
    return [
        (vocab.STUDY_WES, _matrix(spark, exome, label), c.primary_tumor_id),
        (vocab.STUDY_PANEL, _matrix(spark, panel, label), F.col),
    ]


def load_expression(store: Store, src: Sources, all_genes: bool = False) -> int:
    """G2 for both cohorts; optional, not part of ``run_all``."""
    both = _cohort_matrices(store.spark, src.exome_expression, src.panel_expression, "Hugo_Symbol")
    shared = None if all_genes else genomics.shared_labels(both[0][1], both[1][1])
    tumors = store.read("tumors")
    for (study, matrix, sample_id), platform in zip(both, ["RNA-seq", "microarray"]):
        if matrix is not None:
            rows = genomics.expression_rows(matrix, sample_id, tumors, shared, platform)
            store.insert("gene_expression", rows, [], "trust", genomics.skipped_lines(matrix, shared), unique=True)
            store.log([load_entry("expression", study=study)])
    return store.count("gene_expression")


def load_copy_number(store: Store, src: Sources, all_genes: bool = False) -> int:
    """G3 for both cohorts. The label is the first column of these files."""
    both = _cohort_matrices(store.spark, src.exome_copy_number, src.panel_copy_number, None)
    shared = None if all_genes else genomics.shared_labels(both[0][1], both[1][1])
    tumors = store.read("tumors")
    for study, matrix, sample_id in both:
        if matrix is not None:
            rows = genomics.copy_number_rows(matrix, sample_id, tumors, shared)
            store.insert("copy_number", rows, [], "trust", genomics.skipped_lines(matrix, shared), unique=True)
            store.log([load_entry("copy_number", study=study)])
    return store.count("copy_number")


def liftover_mutations(store: Store, chain: str, dry_run: bool = False) -> dict[str, int]:
    """Lift what is still on the source build; a second run finds nothing."""
    todo = store.read("mutations").where(F.col("reference_genome") == vocab.BUILD_SOURCE)
    lifted = lift_variants(todo, read_chain(store.spark, chain))
    counts = lift_summary(lifted).head().asDict()
    if counts["total"] and not dry_run:
        store.move_partition("mutations", vocab.BUILD_SOURCE, lifted)
        store.log([(
            "mutations", vocab.STUDY_PANEL, "start_position",
            f"{counts['lifted']:,} of {counts['total']:,} rows moved to {vocab.BUILD_TARGET} along the chain alignments",
            "chromosome, start_position, end_position",
            f"The other {counts['failed']:,} keep their place and carry {vocab.BUILD_UNMAPPED}; the ends of "
            f"{counts['cross_chromosome']:,} of them fall on different chromosomes.")])
    return counts


def run_combat(store: Store, src: Sources, min_samples: int = 10, dry_run: bool = False,
               log2p1: bool = False) -> DataFrame | None:
    """Corrected values of the genes both expression matrices share, as stored.

    None when a matrix, a shared gene, a matched sample or a covered gene is missing. Leaves
    shift_before and shift_after, the difference of the batch means, in ``store.figures``.
    """
    both = _cohort_matrices(store.spark, src.exome_expression, src.panel_expression, "Hugo_Symbol")
    if any(m is None for _, m, _ in both):
        return None
    study = tumor_study(store.read("patients"), store.read("tumors"))
    cells = genomics.batch_cells([(m, sid) for _, m, sid in both], study, log2p1)
    prepared = prepare(cells, min_samples, written=True) if cells is not None else None
    if prepared is None:
        return None
    cells = staged(correct_batches(prepared))
    # The difference of the batches before and after, if there are two.
    if shift := batch_shift(cells).head():
        store.figures |= shift.asDict()
    result = cells.select(
        F.col("sample").alias("tumor_id"), F.col("feature").alias("gene_symbol"),
        F.round("corrected", 6).alias("expression_combat"),
    ).where(~F.isnan("expression_combat"))
    if dry_run:
        return result
    store.overwrite("gene_expression_combat", result)
    n_samples = prepared.sizes.agg(F.sum("n_samples")).head()[0]
    store.log([(
        "gene_expression_combat", vocab.STUDY_BOTH, "expression_combat",
        f"Effect of study_source removed by parametric empirical Bayes: {prepared.n_features:,} shared genes, "
        f"{n_samples:,} samples, {store.count('gene_expression_combat'):,} values",
        "expression matrices", "Values are taken to be on a log scale; those of gene_expression stay as they are.")])
    return store.read("gene_expression_combat")


@dataclass(frozen=True)
class Step:
    """A part of a run that is stored whole or not at all, and the fields of Sources that it reads."""

    name: str
    run: Callable[[Store, Sources, str], object]
    inputs: tuple[str, ...] = ()


STEPS = [
    Step("create", lambda store, src, on_orphan: store.create()),
    Step("clinical", load_clinical, (
        "curated_records", "clinical_supplement", "subtypes", "biotab_patients", "drugs", "biotab_drugs", "radiation",
        "panel_patients", "panel_samples")),
    Step("mutations", lambda store, src, on_orphan: load_mutations(store, src), ("exome_mutations", "panel_mutations")),
    Step("copy_number", lambda store, src, on_orphan: load_copy_number(store, src), ("exome_copy_number", "panel_copy_number")),
    Step("liftover", lambda store, src, on_orphan: exists(store.spark, src.chain) and liftover_mutations(store, src.chain), ("chain",)),
    Step("combat", lambda store, src, on_orphan: run_combat(store, src), ("exome_expression", "panel_expression")),
]


def run_all(store: Store, src: Sources, on_orphan: str = "raise") -> DataFrame:
    """Clinical, mutations, copy number, liftover, ComBat, summary.

    The rows and audit rows of a step, and the note that it is done, appear in one snapshot. So a
    run that broke off goes on after its last finished step when it is called again, and stores
    what it would have stored at once. A step whose files have changed since, or that follows
    such a step, is run again. After the last step the notes are cleared: another run loads anew.
    """
    before = on_orphan
    for step in STEPS:
        files_read = [fingerprint(store.spark, getattr(src, name)) for name in step.inputs]
        # What a step has read includes what the steps before it read.
        before = hashlib.sha256(json.dumps([before, files_read]).encode()).hexdigest()
        if store.finished(step.name) != before:
            with store.transaction():
                step.run(store, src, on_orphan)
                store.finish(step.name, before)
    store.finish_run()
    sizes = {name: store.count(name) for name in TABLES}
    return database_summary({name: store.read(name) for name in TABLES}, sizes)
