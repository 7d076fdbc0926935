"""Analytic views (V1-V4) on any tables with the right columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.lookup import checked_broadcast

PATIENT_COLUMNS = [
    "patient_id", "study_source", "age_at_diagnosis", "sex", "menopausal_status", "vital_status",
    "os_months", "os_event", "dfs_months", "dfs_event",
]
TUMOR_COLUMNS = [
    "tumor_id", "histological_type", "tumor_grade", "tumor_stage", "tumor_size_cm",
    "lymph_nodes_positive", "er_status", "pr_status", "her2_status", "tnbc_status",
    "pam50_subtype", "integrative_cluster", "nottingham_prognostic_index",
]
MUTATION_COLUMNS = [
    "mutation_id", "study_source", "tumor_id", "gene_symbol", "variant_classification",
    "variant_type", "hgvsp", "vaf", "sequencing_scope",
]
TREATMENT_FLAGS = {
    "had_chemo": "Chemotherapy", "had_hormone": "Hormone Therapy", "had_radiation": "Radiation",
    "had_surgery": "Surgery", "had_targeted": "Targeted Therapy",
}


def patient_tumor(patients: DataFrame, tumors: DataFrame, patient_columns: list[str] = PATIENT_COLUMNS,
                  tumor_columns: list[str] = TUMOR_COLUMNS) -> DataFrame:
    """V1/C7"""
    joined = tumors.select("patient_id", *tumor_columns).join(patients.select(*patient_columns), "patient_id")
    return joined.select(*patient_columns, *tumor_columns)


def tumor_study(patients: DataFrame, tumors: DataFrame) -> DataFrame:
    """(tumor_id, study_source)."""
    return tumors.select("tumor_id", "patient_id").join(
        patients.select("patient_id", "study_source"), "patient_id").select("tumor_id", "study_source")


def mutations_cross_study(mutations: DataFrame, patients: DataFrame, tumors: DataFrame,
                          columns: list[str] = MUTATION_COLUMNS) -> DataFrame:
    """Panel mutations with their study. The two small sides are joined
    first, so each mutation row is shuffled at most once."""
    panel = mutations.where(F.col("in_metabric_panel") == 1)
    return panel.join(tumor_study(patients, tumors), "tumor_id").select(*columns)


def mutated_tumors(mutations: DataFrame, patients: DataFrame, tumors: DataFrame) -> DataFrame:
    """Distinct (study_source, gene_symbol, tumor_id) on the panel.

    Rows collapse to (tumor, gene) before the join, so no tumor is hot in it.
    """
    pairs = mutations.where(F.col("in_metabric_panel") == 1).select("tumor_id", "gene_symbol").distinct()
    return pairs.join(tumor_study(patients, tumors), "tumor_id")


def mutation_frequency(mutations: DataFrame, patients: DataFrame, tumors: DataFrame,
                       parity: bool = True) -> DataFrame:
    """V3/D3: mutated tumors per study and gene.

    With ``parity`` the total counts the same joined tumors as the numerator, as the
    view has always done, so the percentage is 100. Without it the total is the
    number of tumors of the study.
    """
    # (study, gene, tumor) is unique here, so plain counts are distinct counts.
    counts = mutated_tumors(mutations, patients, tumors).groupBy("study_source", "gene_symbol").agg(
        F.count("*").alias("n_mutated_samples"))
    if parity:
        totals = counts.withColumn("n_total_samples_in_study", F.col("n_mutated_samples"))
    else:
        per_study = tumor_study(patients, tumors).groupBy("study_source").agg(
            F.count("tumor_id").alias("n_total_samples_in_study"))
        totals = counts.join(checked_broadcast(per_study), "study_source")
    pct = F.round(F.col("n_mutated_samples") / F.col("n_total_samples_in_study") * 100, 2)
    return totals.select("study_source", "gene_symbol", "n_mutated_samples",
                         "n_total_samples_in_study", pct.alias("mutation_pct"))


def treatment_summary(treatments: DataFrame, flags: dict[str, str] = TREATMENT_FLAGS) -> DataFrame:
    """One 0/1 flag per treatment type and patient."""
    def flag(kind: str):
        return F.max(F.when((F.col("treatment_type") == kind) & (F.col("received") == 1), 1).otherwise(0))

    return treatments.groupBy("patient_id").agg(*[flag(k).alias(n) for n, k in flags.items()])
