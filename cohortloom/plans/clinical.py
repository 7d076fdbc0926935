"""Patients, tumors and treatments of both cohorts.

Functions take all-string source tables that carry line order and return typed
tables that still carry it, so that loads can keep the first of repeated keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clean as c, vocab
from ..operators.dedupe import sequential_ids
from ..operators.lookup import join_with_suffix, last_value_lookup, members
from ..operators.reshape import fan_out
from ..sources.delimited import LINE_ORDER, col_or_null

COHORT_TYPE = "BRCA"
SUBTYPE_PREFIX = "BRCA."
JOINED_ORDER = [*LINE_ORDER, *[f"{o}_s" for o in LINE_ORDER]]


@dataclass
class Clinical:
    patients: DataFrame
    tumors: DataFrame
    order: list[str]


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


# ---- exome cohort ----

def supplement_lookup(source: DataFrame) -> DataFrame:
    """One row per patient of the clinical supplement, last row wins."""
    def col(name: str) -> Column:
        return col_or_null(source, name)

    rows = source.select(
        c.clean_text(col("PATIENT_ID")).alias("patient_id"),
        c.normalize_receptor(col("ER_STATUS_BY_IHC")).alias("s_er"),
        c.normalize_receptor(col("PR_STATUS_BY_IHC")).alias("s_pr"),
        c.normalize_receptor(col("IHC_HER2")).alias("s_her2"),
        c.normalize_receptor(col("HER2_FISH_STATUS")).alias("s_fish"),
        c.clean_text(col("ETHNICITY")).alias("s_ethnicity"),
        c.normalize_menopause(col("MENOPAUSE_STATUS")).alias("s_menopause"),
        c.clean_int(col("LYMPH_NODE_EXAMINED_COUNT")).alias("s_nodes_examined"),
        c.clean_int(col("LYMPH_NODES_EXAMINED_HE_COUNT")).alias("s_nodes_positive"),
        c.clean_text(col("SURGICAL_PROCEDURE_FIRST")).alias("s_surgery"),
        *LINE_ORDER,
    ).where(F.col("patient_id").isNotNull())
    return last_value_lookup(rows, "patient_id", LINE_ORDER)


def subtype_lookup(source: DataFrame) -> DataFrame:
    """One known subtype per patient; Unknown never overwrites a known one."""
    rows = source.where(col_or_null(source, "Subtype_Selected").startswith(SUBTYPE_PREFIX)).select(
        c.barcode_patient(col_or_null(source, "sampleID")).alias("patient_id"),
        c.normalize_subtype(col_or_null(source, "Subtype_mRNA")).alias("s_subtype"),
        *LINE_ORDER,
    ).where((F.col("patient_id") != "") & (F.col("s_subtype") != c.UNKNOWN))
    return last_value_lookup(rows, "patient_id", LINE_ORDER)


def curated_clinical(records: DataFrame, supplement: DataFrame, subtypes: DataFrame) -> Clinical:
    """Curated records, completed from two lookups keyed by patient."""
    def col(name: str) -> Column:
        return col_or_null(records, name)

    base = records.where(col("type") == COHORT_TYPE).select(
        c.clean_text(col("bcr_patient_barcode")).alias("patient_id"),
        c.clean_double(col("age_at_initial_pathologic_diagnosis")).alias("age"),
        c.clean_int(col("OS")).alias("os_event"),
        c.days_to_months(col("OS.time")).alias("os_months"),
        c.clean_int(col("PFI")).alias("dfs_event"),
        c.days_to_months(col("PFI.time")).alias("dfs_months"),
        c.clean_text(col("race")).alias("race"),
        c.clean_text(col("ethnicity")).alias("ethnicity"),
        c.normalize_receptor(col("er_status_by_ihc")).alias("er"),
        c.normalize_receptor(col("pr_status_by_ihc")).alias("pr"),
        c.normalize_receptor(col("her2_status_by_ihc")).alias("her2"),
        c.normalize_subtype(col("paper_BRCA_Subtype_PAM50")).alias("subtype"),
        c.normalize_histology(col("histological_type")).alias("histological_type"),
        c.clean_int(col("neoplasm_histologic_grade")).alias("tumor_grade"),
        c.normalize_stage(col("ajcc_pathologic_tumor_stage")).alias("tumor_stage"),
        *LINE_ORDER,
    ).where(F.col("patient_id").isNotNull())
    her2 = c.known_or(F.col("her2"), F.col("s_her2"))
    full = (
        base.join(supplement.drop("s_surgery"), "patient_id", "left")
        .join(subtypes, "patient_id", "left")
        .withColumns({
            "er_status": c.known_or(F.col("er"), F.col("s_er")),
            "pr_status": c.known_or(F.col("pr"), F.col("s_pr")),
            "her2_status": c.resolve_equivocal(her2, F.col("s_fish")),
        })
    )
    patients = full.select(
        "patient_id", F.lit(vocab.STUDY_WES).alias("study_source"),
        F.col("age").alias("age_at_diagnosis"), F.lit("F").alias("sex"), "race",
        F.coalesce("ethnicity", "s_ethnicity").alias("ethnicity"),
        F.coalesce("s_menopause", c.menopause_by_age(F.col("age"))).alias("menopausal_status"),
        c.vital_of_event(F.col("os_event")).alias("vital_status"),
        "os_months", "os_event", "dfs_months", "dfs_event", *LINE_ORDER,
    )
    tumors = full.select(
        F.concat("patient_id", F.lit("-01")).alias("tumor_id"), "patient_id",
        "histological_type", "tumor_grade", "tumor_stage",
        F.lit(None).cast("double").alias("tumor_size_cm"),
        F.col("s_nodes_positive").alias("lymph_nodes_positive"),
        F.col("s_nodes_examined").alias("lymph_nodes_examined"),
        "er_status", "pr_status", "her2_status",
        c.triple_negative("er_status", "pr_status", "her2_status").alias("tnbc_status"),
        c.known_or(F.col("subtype"), F.col("s_subtype")).alias("pam50_subtype"),
        _text(None).alias("integrative_cluster"),
        F.lit(None).cast("double").alias("nottingham_prognostic_index"), *LINE_ORDER,
    )
    return Clinical(patients, tumors, LINE_ORDER)


def biotab_clinical(source: DataFrame, examined_as_positive: bool = True) -> Clinical:
    """Fallback for P1. The examined node count has always been used as the
    positive count; ``examined_as_positive=False`` leaves that count unknown."""
    def col(name: str) -> Column:
        return col_or_null(source, name)

    gender = c.clean_text(col("gender")) if "gender" in source.columns else F.lit("F")
    nodes = c.clean_int(col("lymph_node_examined_count"))
    base = source.select(
        c.clean_text(col("bcr_patient_barcode")).alias("patient_id"),
        c.clean_double(col("age_at_initial_pathologic_diagnosis")).alias("age_at_diagnosis"),
        gender.alias("sex"),
        c.clean_text(c.first_nonblank(col("race_list"), col("race"))).alias("race"),
        c.clean_text(col("ethnicity")).alias("ethnicity"),
        c.normalize_vital(col("vital_status")).alias("vital_status"),
        c.clean_double(col("death_days_to")).alias("death_days"),
        c.clean_double(col("last_contact_days_to")).alias("contact_days"),
        c.normalize_histology(col("histological_type")).alias("histological_type"),
        c.clean_int(col("neoplasm_histologic_grade")).alias("tumor_grade"),
        c.normalize_stage(col("ajcc_pathologic_tumor_stage")).alias("tumor_stage"),
        c.clean_double(col("tumor_size")).alias("tumor_size_cm"),
        (nodes if examined_as_positive else F.lit(None).cast("int")).alias("lymph_nodes_positive"),
        c.clean_int(col("lymph_nodes_examined_count")).alias("lymph_nodes_examined"),
        c.normalize_receptor(col("er_status_by_ihc")).alias("er_status"),
        c.normalize_receptor(col("pr_status_by_ihc")).alias("pr_status"),
        c.normalize_receptor(col("her2_status_by_ihc")).alias("her2_status"),
        *LINE_ORDER,
    ).where(F.col("patient_id").isNotNull())
    event = c.event_of_vital(F.col("vital_status"))
    patients = base.select(
        "patient_id", F.lit(vocab.STUDY_WES).alias("study_source"), "age_at_diagnosis", "sex",
        "race", "ethnicity", c.menopause_by_age(F.col("age_at_diagnosis")).alias("menopausal_status"),
        "vital_status",
        c.follow_up_months(event, F.col("death_days"), F.col("contact_days")).alias("os_months"),
        event.alias("os_event"),
        F.lit(None).cast("double").alias("dfs_months"), F.lit(None).cast("int").alias("dfs_event"),
        *LINE_ORDER,
    )
    tumors = base.select(
        F.concat("patient_id", F.lit("-01")).alias("tumor_id"), "patient_id", "histological_type",
        "tumor_grade", "tumor_stage", "tumor_size_cm", "lymph_nodes_positive",
        "lymph_nodes_examined", "er_status", "pr_status", "her2_status",
        c.triple_negative("er_status", "pr_status", "her2_status").alias("tnbc_status"),
        F.lit(c.UNKNOWN).alias("pam50_subtype"), _text(None).alias("integrative_cluster"),
        c.prognostic_index(F.col("tumor_size_cm"), F.col("tumor_grade"), F.col("lymph_nodes_positive"))
        .alias("nottingham_prognostic_index"), *LINE_ORDER,
    )
    return Clinical(patients, tumors, LINE_ORDER)


def exome_treatments(patients: DataFrame, drugs: DataFrame, radiation: DataFrame,
                     supplement: DataFrame | None, prefix: str = "TCGA-TX-") -> DataFrame:
    """Drugs, then radiation, then surgery, numbered in source order.

    Surgery has no file order; it is pinned to patient order.
    """
    ids = patients.select("patient_id").distinct()

    def rows(df: DataFrame, rank: int, pid: Column, kind: Column, name: Column) -> DataFrame:
        return members(
            df.select(pid.alias("patient_id"), kind.alias("treatment_type"),
                      name.alias("treatment_name"), F.lit(rank).alias("_rank"), *LINE_ORDER),
            ids, "patient_id")

    def barcode(df: DataFrame) -> Column:
        return c.clean_text(col_or_null(df, "bcr_patient_barcode"))

    raw_type = c.first_nonblank(
        col_or_null(drugs, "therapy_type"), col_or_null(drugs, "pharmaceutical_therapy_type"))
    raw_name = c.first_nonblank(
        col_or_null(drugs, "drug_name"), col_or_null(drugs, "pharmaceutical_therapy_drug_name"))
    out = rows(drugs, 1, barcode(drugs), c.therapy_type(raw_type), c.clean_text(raw_name)).unionByName(
        rows(radiation, 2, barcode(radiation), F.lit("Radiation"), _text(None)))
    if supplement is not None:
        surgery = supplement.where(F.col("s_surgery").isNotNull()).withColumns({
            "_file": _text(None), "_block": F.lit(None).cast("bigint"), "_line": F.lit(None).cast("bigint")})
        out = out.unionByName(
            rows(surgery, 3, F.col("patient_id"), F.lit("Surgery"), F.col("s_surgery")))
    numbered = sequential_ids(out, "treatment_id", prefix, ["_rank", *LINE_ORDER, "patient_id"])
    return numbered.select("treatment_id", "patient_id", "treatment_type", "treatment_name",
                           F.lit(1).alias("received"))


# ---- panel cohort ----

def panel_records(patients: DataFrame, samples: DataFrame | None) -> tuple[DataFrame, list[str]]:
    """Patient rows with their samples, and the order of the joined rows."""
    if samples is None:
        return patients, LINE_ORDER
    return join_with_suffix(patients, samples, "PATIENT_ID", "_s"), JOINED_ORDER


def panel_clinical(records: DataFrame, order: list[str]) -> Clinical:
    """Patients and tumors of joined patient and sample rows."""
    def col(name: str) -> Column:
        return col_or_null(records, name)

    def either(*names: str) -> Column:
        return c.first_nonblank(*[col(n) for n in names])

    pid = c.clean_text(col("PATIENT_ID"))
    rows = records.where(pid.isNotNull())
    age = c.clean_double(col("AGE_AT_DIAGNOSIS"))
    overall = c.survival_status(col("OS_STATUS"))
    patients = rows.select(
        pid.alias("patient_id"), F.lit(vocab.STUDY_PANEL).alias("study_source"),
        age.alias("age_at_diagnosis"), F.lit("F").alias("sex"), _text(None).alias("race"),
        _text(None).alias("ethnicity"),
        c.menopause_state_or_age(col("INFERRED_MENOPAUSAL_STATE"), age).alias("menopausal_status"),
        overall["vital"].alias("vital_status"),
        c.clean_double(col("OS_MONTHS")).alias("os_months"), overall["event"].alias("os_event"),
        c.clean_double(either("RFS_MONTHS", "DFS_MONTHS")).alias("dfs_months"),
        c.recurrence_event(either("RFS_STATUS", "DFS_STATUS")).alias("dfs_event"), *order,
    )
    named = rows.select(
        c.clean_text(c.first_nonblank(col("SAMPLE_ID"), F.concat(pid, F.lit("-T")))).alias("tumor_id"),
        pid.alias("patient_id"),
        c.normalize_histology(either("TUMOR_TYPE", "HISTOLOGICAL_SUBTYPE")).alias("histological_type"),
        c.clean_int(either("GRADE", "TUMOR_GRADE")).alias("tumor_grade"),
        c.normalize_stage(col("TUMOR_STAGE")).alias("tumor_stage"),
        c.mm_to_cm(c.clean_double(col("TUMOR_SIZE"))).alias("tumor_size_cm"),
        c.clean_int(col("LYMPH_NODES_EXAMINED_POSITIVE")).alias("lymph_nodes_positive"),
        F.lit(None).cast("int").alias("lymph_nodes_examined"),
        c.normalize_receptor(either("ER_STATUS", "ER_IHC")).alias("er_status"),
        c.normalize_receptor(col("PR_STATUS")).alias("pr_status"),
        c.normalize_receptor(either("HER2_STATUS", "HER2_SNP6")).alias("her2_status"),
        c.normalize_subtype(either("CLAUDIN_SUBTYPE", "PAM50_SUBTYPE")).alias("pam50_subtype"),
        c.clean_text(either("INTCLUST", "INTEGRATIVE_CLUSTER")).alias("integrative_cluster"),
        c.clean_double(either("NOTTINGHAM_PROGNOSTIC_INDEX", "NPI")).alias("_npi"), *order,
    )
    tumors = named.withColumn(
        "tnbc_status", c.triple_negative("er_status", "pr_status", "her2_status")
    ).withColumn(
        "nottingham_prognostic_index",
        c.given_or_computed_index(F.col("_npi"), F.col("tumor_size_cm"), F.col("tumor_grade"),
                                  F.col("lymph_nodes_positive")),
    ).drop("_npi")
    return Clinical(patients, tumors, order)


def panel_treatments(records: DataFrame, order: list[str], prefix: str = "MB-TX-") -> DataFrame:
    """Up to three treatments per joined row, numbered row by row."""
    fields = [("Chemotherapy", "CHEMOTHERAPY"), ("Hormone Therapy", "HORMONE_THERAPY"),
              ("Radiation", "RADIO_THERAPY")]
    rows = records.withColumn("patient_id", c.clean_text(col_or_null(records, "PATIENT_ID"))).where(
        F.col("patient_id").isNotNull())
    flags = [(kind, c.received_flag(col_or_null(records, name))) for kind, name in fields]
    long = fan_out(rows, ["patient_id", *order], flags, "treatment_type", "received", "_field")
    return sequential_ids(long, "treatment_id", prefix, [*order, "_field"]).select(
        "treatment_id", "patient_id", "treatment_type", _text(None).alias("treatment_name"), "received")
