"""Whole study loaders (P1, P3, P4, P6, P7) on messy text made from the tables.

Each source is a dict of column -> SQL text that both engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import vocab
from ..operators.quality import insert_ignore
from ..plans import clinical, genomics
from ..plans.schema import PATIENTS, TUMORS
from .registry import query, sql_content_id, sql_list, sql_map, sql_pick
from .scalars import _OS, _RECEPTOR_SQL, _STATES

STAMPS = ["created_at", "updated_at"]


def bronze(df: DataFrame, columns: dict[str, str], line: str) -> DataFrame:
    """All-string source table whose line order is ``line``."""
    order = [F.lit("f").alias("_file"), F.lit(0).cast("bigint").alias("_block"), F.expr(line).cast("bigint").alias("_line")]
    return df.select(*[F.expr(e).cast("string").alias(n) for n, e in columns.items()], *order)


def sql_bronze(table: str, columns: dict[str, str], line: str, where: str = "TRUE") -> str:
    cells = ", ".join(f'CAST({e} AS VARCHAR) AS "{n}"' for n, e in columns.items())
    return f"SELECT {cells}, {line} AS line FROM {table} WHERE {where}"


def sql_clean(column: str) -> str:
    return f"CASE WHEN trim({column}) NOT IN ({sql_list(vocab.NULL_SENTINELS)}) THEN trim({column}) END"


def sql_receptor(column: str) -> str:
    return _RECEPTOR_SQL.replace("(r,", f"({column},").replace("CASE r ", f"CASE {column} ").replace("upper(substr(r", f"upper(substr({column}").replace("lower(substr(r", f"lower(substr({column}")


def sql_tnbc(er: str, pr: str, her2: str) -> str:
    return (f"CASE WHEN 'Unknown' IN ({er}, {pr}, {her2}) THEN NULL "
            f"WHEN {er} = 'Negative' AND {pr} = 'Negative' AND {her2} = 'Negative' THEN 1 ELSE 0 END")


_STATUS = ["Positive", "negative", "Equivocal", "", None, "[Not Evaluated]", "POSITIVE", "Negative"]

# ---- panel cohort (P4) ----

PANEL_PATIENTS = {
    "PATIENT_ID": "CASE WHEN c_custkey % 50 = 7 THEN 'NA' ELSE concat('MB-', c_custkey) END",
    "AGE_AT_DIAGNOSIS": sql_pick(["49.5", "50", "NA", "72"], "c_custkey"),
    "OS_MONTHS": "c_nationkey", "OS_STATUS": sql_pick(_OS, "c_custkey"),
    "RFS_MONTHS": sql_pick(["", None, "12.5"], "c_custkey"), "DFS_MONTHS": "c_nationkey",
    "RFS_STATUS": sql_pick(["", None, "0:Not Recurred", "1:Recurred"], "c_custkey"),
    "DFS_STATUS": sql_pick(["1:Recurred", None], "c_nationkey"),
    "INFERRED_MENOPAUSAL_STATE": sql_pick(_STATES, "c_custkey"),
    "CHEMOTHERAPY": sql_pick(["YES", "no", "NA"], "c_custkey"),
    "HORMONE_THERAPY": sql_pick(["1", "", "0", "y"], "c_custkey"), "RADIO_THERAPY": sql_pick([None, "Y"], "c_nationkey"),
    "CLAUDIN_SUBTYPE": sql_pick(["", "LumA", "claudin-low", "NC"], "c_custkey"), "PAM50_SUBTYPE": "'Basal'",
    "INTCLUST": sql_pick(["4+", "NA", "", "9"], "c_custkey"), "INTEGRATIVE_CLUSTER": "'10'",
}
PANEL_SAMPLES = {
    "PATIENT_ID": "concat('MB-', o_custkey)",
    "SAMPLE_ID": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat('S-', o_orderkey % 5000) END",
    "ER_STATUS": sql_pick(_STATUS, "o_orderkey"), "ER_IHC": "'Positive'", "PR_STATUS": sql_pick(_STATUS, "o_custkey"),
    "HER2_STATUS": sql_pick(_STATUS, "o_orderkey + o_custkey"), "HER2_SNP6": "'GAIN'",
    "TUMOR_SIZE": "CASE WHEN o_orderkey % 7 = 0 THEN 'NA' ELSE concat(o_orderkey % 60, '.0') END",
    "GRADE": sql_pick(["", "1", "3.0", "5", "2"], "o_orderkey"), "TUMOR_GRADE": "'2'",
    "TUMOR_STAGE": sql_pick(["2", "Stage IIIA", "0", "iv", ""], "o_orderkey"),
    "TUMOR_TYPE": sql_pick(["", "IDC", "Rare Type", "MIXED"], "o_orderkey"), "HISTOLOGICAL_SUBTYPE": "'ILC'",
    "LYMPH_NODES_EXAMINED_POSITIVE": sql_pick(["0", "2", "9", "NA"], "o_orderkey"),
    "NOTTINGHAM_PROGNOSTIC_INDEX": sql_pick(["", "4.05", "0", "NA"], "o_custkey"), "NPI": "'0'",
    "INTCLUST": "'clash'",
}
_PANEL_ROWS = f"""
    p AS ({sql_bronze("customer", PANEL_PATIENTS, "c_custkey")}),
    s AS ({sql_bronze("orders", PANEL_SAMPLES, "o_orderkey")}),
    joined AS (SELECT p.*, s.* EXCLUDE (PATIENT_ID, INTCLUST, line), s.line AS line_s, trim(p.PATIENT_ID) AS pid
               FROM p LEFT JOIN s ON p.PATIENT_ID = s.PATIENT_ID WHERE {sql_clean("p.PATIENT_ID")} IS NOT NULL)"""


def _panel_records(t):
    return clinical.panel_records(bronze(t.customer, PANEL_PATIENTS, "c_custkey"), bronze(t.orders, PANEL_SAMPLES, "o_orderkey"))


_AGE = f"TRY_CAST({sql_clean('AGE_AT_DIAGNOSIS')} AS DOUBLE)"
_RFS_RAW = "CASE WHEN RFS_STATUS <> '' THEN RFS_STATUS ELSE coalesce(DFS_STATUS, '') END"


@query("q_p4_patients", f"""
    WITH {_PANEL_ROWS},
    f AS (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY line, line_s) AS rn, {_AGE} AS age,
                 {sql_clean("INFERRED_MENOPAUSAL_STATE")} AS state, {_RFS_RAW} AS rfs,
                 CASE WHEN upper(OS_STATUS) LIKE '%DECEASED%' OR OS_STATUS LIKE '1%' THEN 1
                      WHEN upper(OS_STATUS) LIKE '%LIVING%' OR OS_STATUS LIKE '0%' THEN 0 END AS ev FROM joined)
    SELECT pid AS patient_id, 'METABRIC' AS study_source, age AS age_at_diagnosis, 'F' AS sex, NULL::VARCHAR AS race,
           NULL::VARCHAR AS ethnicity,
           CASE WHEN state IS NULL THEN CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 50 THEN 'Pre' ELSE 'Post' END
                ELSE {sql_map("state", vocab.MENOPAUSE_STATE, "'Unknown'")} END AS menopausal_status,
           CASE ev WHEN 1 THEN 'Deceased' WHEN 0 THEN 'Alive' END AS vital_status, OS_MONTHS::DOUBLE AS os_months,
           ev AS os_event, (CASE WHEN RFS_MONTHS <> '' THEN RFS_MONTHS ELSE DFS_MONTHS END)::DOUBLE AS dfs_months,
           CASE WHEN rfs LIKE '%Not Recurred%' OR rfs LIKE '0%' THEN 0
                WHEN rfs LIKE '%Recurred%' OR rfs LIKE '1%' THEN 1 END AS dfs_event
    FROM f WHERE rn = 1""")
def panel_patients(t):
    rows = clinical.panel_clinical(*_panel_records(t))
    return insert_ignore(PATIENTS, rows.patients, rows.order).stored.drop(*STAMPS)


@query("q_p4", f"""
    WITH {_PANEL_ROWS},
    v AS (SELECT *, coalesce({sql_clean("SAMPLE_ID")}, pid || '-T') AS tumor_id,
                 {sql_receptor("CASE WHEN ER_STATUS <> '' THEN ER_STATUS ELSE coalesce(ER_IHC, '') END")} AS er,
                 {sql_receptor("PR_STATUS")} AS pr,
                 {sql_receptor("CASE WHEN HER2_STATUS <> '' THEN HER2_STATUS ELSE coalesce(HER2_SNP6, '') END")} AS her2,
                 TRY_CAST({sql_clean("TUMOR_SIZE")} AS DOUBLE) / 10.0 AS size,
                 CAST(trunc(TRY_CAST(CASE WHEN GRADE <> '' THEN GRADE ELSE TUMOR_GRADE END AS DOUBLE)) AS INTEGER) AS grd,
                 TRY_CAST({sql_clean("LYMPH_NODES_EXAMINED_POSITIVE")} AS INTEGER) AS nodes,
                 TRY_CAST(CASE WHEN NOTTINGHAM_PROGNOSTIC_INDEX <> '' THEN NOTTINGHAM_PROGNOSTIC_INDEX
                               ELSE NPI END AS DOUBLE) AS given FROM joined),
    w AS (SELECT *, row_number() OVER (PARTITION BY tumor_id ORDER BY line, line_s) AS rn FROM v
          WHERE coalesce(grd IN (1, 2, 3), TRUE) AND er <> 'Equivocal' AND pr <> 'Equivocal')
    SELECT tumor_id, pid AS patient_id,
           {sql_map("(CASE WHEN TUMOR_TYPE <> '' THEN TUMOR_TYPE ELSE HISTOLOGICAL_SUBTYPE END)", vocab.HISTOLOGY,
                    "(CASE WHEN TUMOR_TYPE <> '' THEN TUMOR_TYPE ELSE HISTOLOGICAL_SUBTYPE END)")} AS histological_type,
           grd AS tumor_grade,
           coalesce({sql_map("TUMOR_STAGE", vocab.STAGE)}, {sql_map("upper(TUMOR_STAGE)", vocab.STAGE)}) AS tumor_stage,
           size AS tumor_size_cm, nodes AS lymph_nodes_positive, NULL::INTEGER AS lymph_nodes_examined,
           er AS er_status, pr AS pr_status, her2 AS her2_status, {sql_tnbc("er", "pr", "her2")} AS tnbc_status,
           {sql_map("(CASE WHEN CLAUDIN_SUBTYPE <> '' THEN CLAUDIN_SUBTYPE ELSE PAM50_SUBTYPE END)", vocab.PAM50, "'Unknown'")}
               AS pam50_subtype,
           CASE WHEN INTCLUST = 'NA' THEN NULL WHEN INTCLUST <> '' THEN INTCLUST ELSE INTEGRATIVE_CLUSTER END AS integrative_cluster,
           CASE WHEN given <> 0 THEN given WHEN size IS NULL OR grd IS NULL OR nodes IS NULL THEN NULL
                ELSE round(0.2::DOUBLE * size + grd + CASE WHEN nodes = 0 THEN 1 WHEN nodes <= 3 THEN 2 ELSE 3 END, 2) END
               AS nottingham_prognostic_index
    FROM w WHERE rn = 1""")
def panel_tumors(t):
    rows = clinical.panel_clinical(*_panel_records(t))
    return insert_ignore(TUMORS, rows.tumors, rows.order).stored.drop(*STAMPS)


_FIELDS = {"Chemotherapy": "CHEMOTHERAPY", "Hormone Therapy": "HORMONE_THERAPY", "Radiation": "RADIO_THERAPY"}


@query("q_p4_treatments", f"""
    WITH {_PANEL_ROWS}, long AS ({" UNION ALL ".join(
        f"SELECT pid, line, line_s, {i} AS field, '{k}' AS kind, {sql_clean(c)} AS answer FROM joined"
        for i, (k, c) in enumerate(_FIELDS.items()))})
    SELECT format('MB-TX-{{:06d}}', row_number() OVER (ORDER BY line, line_s NULLS FIRST, field)) AS treatment_id,
           pid AS patient_id, kind AS treatment_type, NULL::VARCHAR AS treatment_name,
           CASE WHEN upper(answer) IN ('YES', '1', 'Y') THEN 1 ELSE 0 END AS received
    FROM long WHERE answer IS NOT NULL""")
def panel_treatments(t):
    return clinical.panel_treatments(*_panel_records(t))


# ---- exome cohort (P1, P3) ----

_BARCODE = "concat('TCGA-X-', c_custkey)"
RECORDS = {
    "bcr_patient_barcode": f"CASE WHEN c_custkey % 40 = 3 THEN '[Unknown]' ELSE {_BARCODE} END",
    "type": "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'LUAD' ELSE 'BRCA' END",
    "age_at_initial_pathologic_diagnosis": sql_pick(["45", "50.5", "NA"], "c_custkey"),
    "OS": sql_pick(["1", "0", "NA", "1.0"], "c_custkey"), "OS.time": "c_custkey",
    "PFI": sql_pick(["0", "1", ""], "c_custkey"), "PFI.time": sql_pick(["100", "x"], "c_nationkey"),
    "race": sql_pick(["WHITE", "[Not Available]", None], "c_custkey"), "ethnicity": sql_pick(["", "H", "NA"], "c_nationkey"),
    "er_status_by_ihc": sql_pick(_STATUS, "c_custkey"), "her2_status_by_ihc": sql_pick(_STATUS, "c_nationkey"),
    "paper_BRCA_Subtype_PAM50": sql_pick(["NA", "Basal-like", "x", "LumB"], "c_custkey"),
    "histological_type": sql_pick(["IDC", "Odd", ""], "c_custkey"),
    "neoplasm_histologic_grade": sql_pick(["1", "2", "3", "4", ""], "c_custkey"),
    "ajcc_pathologic_tumor_stage": sql_pick(["Stage IIA", "Stage X", "III"], "c_custkey"),
}
SUPPLEMENT = {
    "PATIENT_ID": "concat('TCGA-X-', o_custkey)", "ER_STATUS_BY_IHC": sql_pick(_STATUS, "o_orderkey"),
    "PR_STATUS_BY_IHC": sql_pick(["Positive", "Negative", ""], "o_orderkey"),
    "IHC_HER2": sql_pick(_STATUS, "o_orderkey + 3"), "HER2_FISH_STATUS": sql_pick(_STATUS, "o_orderkey + 5"),
    "ETHNICITY": sql_pick(["N", "NA"], "o_orderkey"),
    "MENOPAUSE_STATUS": sql_pick(["Pre (x)", "Indeterminate", "", "peri (y)"], "o_orderkey"),
    "LYMPH_NODE_EXAMINED_COUNT": "o_orderkey % 20", "LYMPH_NODES_EXAMINED_HE_COUNT": sql_pick(["0", "2.0", "NA"], "o_orderkey"),
    "SURGICAL_PROCEDURE_FIRST": sql_pick(["Lumpectomy", "[Not Available]", "Other"], "o_orderkey"),
}
SUBTYPES = {
    "sampleID": "concat('TCGA-X-', user_id, '-01')",
    "Subtype_Selected": "CASE WHEN event_type = 'error' THEN 'LUAD.x' ELSE concat('BRCA.', event_type) END",
    "Subtype_mRNA": sql_pick(["LumA", "Her2", "NC", None], "event_id"),
}
_EXOME_ROWS = f"""
    rec AS ({sql_bronze("customer", RECORDS, "c_custkey")}),
    sup0 AS ({sql_bronze("orders", SUPPLEMENT, "o_orderkey")}),
    sup AS (SELECT PATIENT_ID AS pid, {sql_receptor("ER_STATUS_BY_IHC")} AS s_er, {sql_receptor("PR_STATUS_BY_IHC")} AS s_pr,
                   {sql_receptor("IHC_HER2")} AS s_her2, {sql_receptor("HER2_FISH_STATUS")} AS s_fish,
                   {sql_clean("ETHNICITY")} AS s_eth,
                   CASE WHEN MENOPAUSE_STATUS LIKE 'Pre%' THEN 'Pre' WHEN MENOPAUSE_STATUS LIKE 'peri%' THEN 'Peri'
                        WHEN MENOPAUSE_STATUS = '' THEN NULL ELSE 'Unknown' END AS s_meno,
                   LYMPH_NODE_EXAMINED_COUNT::INTEGER AS s_examined,
                   CAST(TRY_CAST(LYMPH_NODES_EXAMINED_HE_COUNT AS DOUBLE) AS INTEGER) AS s_positive,
                   {sql_clean("SURGICAL_PROCEDURE_FIRST")} AS s_surgery,
                   row_number() OVER (PARTITION BY PATIENT_ID ORDER BY line DESC) AS s_rn FROM sup0),
    sub0 AS ({sql_bronze("events", SUBTYPES, "event_id")}),
    sub AS (SELECT replace(sampleID, '-01', '') AS sub_pid, sampleID, Subtype_mRNA AS s_subtype,
                   row_number() OVER (PARTITION BY sampleID ORDER BY line DESC) AS b_rn FROM sub0
            WHERE Subtype_Selected LIKE 'BRCA.%' AND Subtype_mRNA IN ('LumA', 'Her2')),
    r AS (SELECT rec.*, trim(bcr_patient_barcode) AS patient_id, TRY_CAST(age_at_initial_pathologic_diagnosis AS DOUBLE) AS age,
                 CAST(TRY_CAST("OS" AS DOUBLE) AS INTEGER) AS ev, {sql_receptor("er_status_by_ihc")} AS er0,
                 {sql_receptor("her2_status_by_ihc")} AS her0, {sql_map("paper_BRCA_Subtype_PAM50", vocab.PAM50, "'Unknown'")} AS sub_own
          FROM rec WHERE "type" = 'BRCA' AND {sql_clean("bcr_patient_barcode")} IS NOT NULL),
    full_rows AS (SELECT r.*, sup.*, s_subtype,
                 CASE WHEN er0 <> 'Unknown' THEN er0 ELSE coalesce(s_er, 'Unknown') END AS er, coalesce(s_pr, 'Unknown') AS pr,
                 CASE WHEN her0 <> 'Unknown' THEN her0 ELSE coalesce(s_her2, 'Unknown') END AS her1
          FROM r LEFT JOIN sup ON r.patient_id = sup.pid AND s_rn = 1
                 LEFT JOIN sub ON sub.sampleID = r.patient_id || '-01' AND b_rn = 1)"""


def _supplement(t):
    return clinical.supplement_lookup(bronze(t.orders, SUPPLEMENT, "o_orderkey"))


def _curated(t) -> clinical.Clinical:
    subtypes = clinical.subtype_lookup(bronze(t.events, SUBTYPES, "event_id"))
    return clinical.curated_clinical(bronze(t.customer, RECORDS, "c_custkey"), _supplement(t), subtypes)


@query("q_p1_patients", f"""
    WITH {_EXOME_ROWS}
    SELECT patient_id, 'TCGA-BRCA' AS study_source, age AS age_at_diagnosis, 'F' AS sex, {sql_clean("race")} AS race,
           coalesce({sql_clean("ethnicity")}, s_eth) AS ethnicity,
           coalesce(s_meno, CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 50 THEN 'Pre' ELSE 'Post' END) AS menopausal_status,
           CASE ev WHEN 1 THEN 'Deceased' WHEN 0 THEN 'Alive' END AS vital_status,
           round("OS.time"::DOUBLE / 30.44::DOUBLE, 2) AS os_months, ev AS os_event,
           round(TRY_CAST("PFI.time" AS DOUBLE) / 30.44::DOUBLE, 2) AS dfs_months,
           TRY_CAST("PFI" AS INTEGER) AS dfs_event FROM full_rows""")
def curated_patients(t):
    rows = _curated(t)
    return insert_ignore(PATIENTS, rows.patients, rows.order).stored.drop(*STAMPS)


@query("q_p1", f"""
    WITH {_EXOME_ROWS},
    h AS (SELECT *, CASE WHEN her1 = 'Equivocal' AND s_fish IN ('Positive', 'Negative') THEN s_fish ELSE her1 END AS her2,
                 TRY_CAST({sql_clean("neoplasm_histologic_grade")} AS INTEGER) AS grade FROM full_rows)
    SELECT patient_id || '-01' AS tumor_id, patient_id,
           {sql_map("histological_type", vocab.HISTOLOGY, sql_clean("histological_type"))} AS histological_type,
           grade AS tumor_grade, {sql_map("ajcc_pathologic_tumor_stage", vocab.STAGE)} AS tumor_stage,
           NULL::DOUBLE AS tumor_size_cm, s_positive AS lymph_nodes_positive, s_examined AS lymph_nodes_examined,
           er AS er_status, pr AS pr_status, her2 AS her2_status, {sql_tnbc("er", "pr", "her2")} AS tnbc_status,
           CASE WHEN sub_own <> 'Unknown' THEN sub_own ELSE coalesce(s_subtype, 'Unknown') END AS pam50_subtype,
           NULL::VARCHAR AS integrative_cluster, NULL::DOUBLE AS nottingham_prognostic_index
    FROM h WHERE coalesce(grade IN (1, 2, 3), TRUE) AND er <> 'Equivocal'""")
def curated_tumors(t):
    rows = _curated(t)
    return insert_ignore(TUMORS, rows.tumors, rows.order).stored.drop(*STAMPS)



# ---- fallback source of the exome cohort (P2) ----

_VITAL = ["Dead", "Alive", "LIVING", "", "[Unknown]", None, "1"]
FOLLOW_UP = {
    "bcr_patient_barcode": f"CASE WHEN c_custkey % 30 = 4 THEN 'NA' ELSE {_BARCODE} END",
    "age_at_initial_pathologic_diagnosis": sql_pick(["45", "50.5", "NA"], "c_custkey"),
    "gender": sql_pick(["F", "FEMALE", "NA", "M"], "c_custkey"),
    "race_list": sql_pick(["", None, "WHITE", "NA"], "c_custkey"), "race": sql_pick(["ASIAN", "", None], "c_nationkey"),
    "ethnicity": sql_pick(["", "H", "NA"], "c_nationkey"), "vital_status": sql_pick(_VITAL, "c_custkey"),
    "death_days_to": sql_pick(["0", "304.4", "", "1200"], "c_custkey"), "last_contact_days_to": "c_custkey",
    "histological_type": sql_pick(["IDC", "Odd", ""], "c_custkey"),
    "neoplasm_histologic_grade": sql_pick(["1", "2", "3", "4", ""], "c_custkey"),
    "ajcc_pathologic_tumor_stage": sql_pick(["Stage IIA", "Stage X", "III"], "c_custkey"),
    "tumor_size": sql_pick(["2", "1.5", "", "NA"], "c_custkey + c_nationkey"),
    "lymph_node_examined_count": sql_pick(["0", "2", "9", "NA"], "c_nationkey"),
    "lymph_nodes_examined_count": sql_pick(["4", "", "12"], "c_nationkey"),
    "er_status_by_ihc": sql_pick(_STATUS, "c_custkey"), "pr_status_by_ihc": sql_pick(_STATUS, "c_custkey + c_nationkey"),
    "her2_status_by_ihc": sql_pick(_STATUS, "c_nationkey"),
}
_RACE = "CASE WHEN race_list <> '' THEN race_list ELSE coalesce(race, '') END"
_FOLLOW_UP_ROWS = f"""
    raw AS ({sql_bronze("customer", FOLLOW_UP, "c_custkey")}),
    bio AS (SELECT *, TRY_CAST({sql_clean("age_at_initial_pathologic_diagnosis")} AS DOUBLE) AS age,
                   {sql_map("trim(vital_status)", vocab.VITAL_STATUS)} AS vital,
                   TRY_CAST({sql_clean("death_days_to")} AS DOUBLE) AS death, {sql_clean("gender")} AS sex,
                   TRY_CAST({sql_clean("neoplasm_histologic_grade")} AS INTEGER) AS grade,
                   TRY_CAST({sql_clean("tumor_size")} AS DOUBLE) AS size,
                   TRY_CAST({sql_clean("lymph_node_examined_count")} AS INTEGER) AS n_found,
                   {sql_receptor("er_status_by_ihc")} AS er, {sql_receptor("pr_status_by_ihc")} AS pr,
                   {sql_receptor("her2_status_by_ihc")} AS her2
            FROM raw WHERE {sql_clean("bcr_patient_barcode")} IS NOT NULL)"""


def _follow_up(t, **how) -> clinical.Clinical:
    return clinical.biotab_clinical(bronze(t.customer, FOLLOW_UP, "c_custkey"), **how)


@query("q_p2_patients", f"""
    WITH {_FOLLOW_UP_ROWS}
    SELECT bcr_patient_barcode AS patient_id, 'TCGA-BRCA' AS study_source, age AS age_at_diagnosis, sex,
           {sql_clean(f"({_RACE})")} AS race, {sql_clean("ethnicity")} AS ethnicity,
           CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 50 THEN 'Pre' ELSE 'Post' END AS menopausal_status,
           vital AS vital_status,
           round(CASE WHEN vital = 'Deceased' AND death <> 0 THEN death
                      ELSE last_contact_days_to::DOUBLE END / 30.44::DOUBLE, 2) AS os_months,
           CASE vital WHEN 'Deceased' THEN 1 WHEN 'Alive' THEN 0 END AS os_event,
           NULL::DOUBLE AS dfs_months, NULL::INTEGER AS dfs_event
    FROM bio WHERE sex IS NULL OR sex IN ('M', 'F')""")
def follow_up_patients(t):
    rows = _follow_up(t)
    return insert_ignore(PATIENTS, rows.patients, rows.order).stored.drop(*STAMPS)


def _follow_up_tumors_sql(positive: str) -> str:
    return f"""
    WITH {_FOLLOW_UP_ROWS}, n AS (SELECT *, {positive} AS positive FROM bio)
    SELECT bcr_patient_barcode || '-01' AS tumor_id, bcr_patient_barcode AS patient_id,
           {sql_map("histological_type", vocab.HISTOLOGY, sql_clean("histological_type"))} AS histological_type,
           grade AS tumor_grade, {sql_map("ajcc_pathologic_tumor_stage", vocab.STAGE)} AS tumor_stage,
           size AS tumor_size_cm, positive AS lymph_nodes_positive,
           TRY_CAST({sql_clean("lymph_nodes_examined_count")} AS INTEGER) AS lymph_nodes_examined,
           er AS er_status, pr AS pr_status, her2 AS her2_status, {sql_tnbc("er", "pr", "her2")} AS tnbc_status,
           'Unknown' AS pam50_subtype, NULL::VARCHAR AS integrative_cluster,
           CASE WHEN size IS NOT NULL AND grade IS NOT NULL AND positive IS NOT NULL
                THEN round(0.2::DOUBLE * size + grade + CASE WHEN positive = 0 THEN 1 WHEN positive <= 3 THEN 2 ELSE 3 END, 2)
                END AS nottingham_prognostic_index
    FROM n WHERE coalesce(grade IN (1, 2, 3), TRUE) AND er <> 'Equivocal' AND pr <> 'Equivocal'"""


@query("q_p2", _follow_up_tumors_sql("n_found"))
def follow_up_tumors(t):
    rows = _follow_up(t)
    return insert_ignore(TUMORS, rows.tumors, rows.order).stored.drop(*STAMPS)


@query("q_p2_strict", _follow_up_tumors_sql("NULL::INTEGER"))
def follow_up_tumors_strict(t):
    rows = _follow_up(t, examined_as_positive=False)
    return insert_ignore(TUMORS, rows.tumors, rows.order).stored.drop(*STAMPS)


DRUGS = {
    "bcr_patient_barcode": "concat('TCGA-X-', user_id)",
    "therapy_type": sql_pick(["Chemotherapy", "", None, "Immunotherapy"], "event_id"),
    "pharmaceutical_therapy_type": sql_pick(["Hormone Therapy", "Targeted Molecular therapy", "x"], "user_id"),
    "drug_name": sql_pick(["Taxol", "NA", ""], "event_id"), "pharmaceutical_therapy_drug_name": "event_type",
}
_DRUG_KIND = sql_map("(CASE WHEN therapy_type <> '' THEN therapy_type ELSE pharmaceutical_therapy_type END)",
                     vocab.THERAPY_TYPE, "'Other'")


@query("q_p3", f"""
    WITH {_EXOME_ROWS}, ids AS (SELECT DISTINCT patient_id FROM full_rows),
    drugs AS ({sql_bronze("events", DRUGS, "event_id", "event_type IN ('click', 'signup', 'purchase')")}),
    rad AS ({sql_bronze("events", DRUGS, "event_id", "event_type IN ('view', 'error')")}),
    merged AS (
        SELECT 1 AS src, line, bcr_patient_barcode AS patient_id, {_DRUG_KIND} AS kind,
               {sql_clean("(CASE WHEN drug_name <> '' THEN drug_name ELSE pharmaceutical_therapy_drug_name END)")} AS name FROM drugs
        UNION ALL SELECT 2, line, bcr_patient_barcode, 'Radiation', NULL FROM rad
        UNION ALL SELECT 3, NULL, pid, 'Surgery', s_surgery FROM sup WHERE s_rn = 1 AND s_surgery IS NOT NULL)
    SELECT format('TCGA-TX-{{:06d}}', row_number() OVER (ORDER BY src, line, patient_id)) AS treatment_id, patient_id,
           kind AS treatment_type, name AS treatment_name, 1 AS received
    FROM merged WHERE patient_id IN (SELECT patient_id FROM ids)""")
def exome_treatments(t):
    drugs = bronze(t.events.where("event_type IN ('click', 'signup', 'purchase')"), DRUGS, "event_id")
    radiation = bronze(t.events.where("event_type IN ('view', 'error')"), DRUGS, "event_id")
    return clinical.exome_treatments(_curated(t).patients, drugs, radiation, _supplement(t))


# ---- variants (P6, P7) ----

_GENES = ["TP53", "PIK3CA", "", "NA", " BRCA1 ", "KRAS", None, "GATA3", "ZZZ3"]
VARIANTS = {
    "Hugo_Symbol": sql_pick(_GENES, "l_partkey"), "Chromosome": "l_linenumber",
    "Start_Position": "CASE WHEN l_quantity = 1 THEN 'x' ELSE concat(l_partkey * 37, '.0') END", "End_Position": "l_partkey * 37 + 5",
    "Reference_Allele": sql_pick(["A", "C", "-"], "l_partkey"), "Tumor_Seq_Allele2": sql_pick(["T", ".", "G"], "l_suppkey"),
    "Variant_Classification": sql_pick(["missense_variant", "Custom", "NA", "Silent"], "l_orderkey"),
    "Variant_Type": sql_pick(["SNP", "snp", "DEL", "", None], "l_orderkey"),
    "HGVSp_Short": sql_pick(["p.R1", "NA", ""], "l_orderkey"), "HGVSp": sql_pick(["p.Long", "."], "l_partkey"),
    "t_alt_count": "l_partkey % 5", "t_depth": "CASE WHEN l_suppkey % 7 = 6 THEN 'NA' ELSE CAST(l_suppkey % 7 AS STRING) END",
}
_VARIANT_SQL = f"""
    {sql_clean("Hugo_Symbol")} AS gene_symbol, Chromosome AS chromosome,
    CAST(TRY_CAST(Start_Position AS DOUBLE) AS BIGINT) AS start_position, End_Position::BIGINT AS end_position,
    {sql_clean("Reference_Allele")} AS reference_allele, {sql_clean("Tumor_Seq_Allele2")} AS variant_allele,
    {sql_map("Variant_Classification", vocab.VARIANT_CLASS, sql_clean("Variant_Classification"))} AS variant_classification,
    CASE WHEN Variant_Type IN ({sql_list(vocab.VARIANT_TYPES)}) THEN Variant_Type END AS variant_type,
    coalesce({sql_clean("HGVSp_Short")}, {sql_clean("HGVSp")}) AS hgvsp"""


def sql_with_ids(rows: str, prefix: str) -> str:
    """SQL text: rows of variants with their ids, of which copies are numbered."""
    key = ["vaf_text" if x == "vaf" else x for x in genomics.CONTENT]
    return f"""
    rows AS ({rows}),
    texts AS (SELECT *, CASE WHEN isinf(vaf) THEN 'Infinity' ELSE CAST(vaf AS VARCHAR) END AS vaf_text FROM rows),
    copies AS (SELECT *, row_number() OVER (PARTITION BY {", ".join(key)}) AS n FROM texts)
    SELECT {sql_content_id(prefix, key, "n")} AS mutation_id, * EXCLUDE (n, vaf_text) REPLACE (round(vaf, 4) AS vaf) FROM copies"""


@query("q_p6", f"""
    WITH v AS ({sql_bronze("lineitem", {**VARIANTS, "SAMPLE_ID": "l_orderkey"}, "l_orderkey").replace("l_orderkey AS line", "l_orderkey, l_linenumber, l_partkey, l_suppkey")}),
    panel AS (SELECT DISTINCT Hugo_Symbol FROM v WHERE t_alt_count = '0' AND Chromosome = '1' AND Hugo_Symbol IS NOT NULL),
    {sql_with_ids(f"""SELECT 'TCGA-X-' || l_orderkey || '-01' AS tumor_id, {_VARIANT_SQL}, 'GRCh38' AS reference_genome, 'WES' AS sequencing_scope,
           CASE WHEN TRY_CAST(t_depth AS INTEGER) IS NULL OR (t_depth = '0' AND t_alt_count = '0') THEN NULL
                WHEN t_depth = '0' THEN 'infinity'::DOUBLE ELSE t_alt_count::DOUBLE / t_depth::DOUBLE END AS vaf,
           CASE WHEN trim(Hugo_Symbol) IN (SELECT Hugo_Symbol FROM panel) THEN 1 ELSE 0 END AS in_metabric_panel
    FROM v JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P' WHERE {sql_clean("Hugo_Symbol")} IS NOT NULL""", "TCGA-MUT-")}""")
def exome_variants(t):
    source = bronze(t.lineitem, {**VARIANTS, "Tumor_Sample_Barcode": "concat('TCGA-X-', l_orderkey, '-01A-11')"}, "l_orderkey")
    tumors = t.orders.where("o_orderstatus <> 'P'").select(F.concat(F.lit("TCGA-X-"), "o_orderkey", F.lit("-01")).alias("tumor_id"))
    panel = genomics.panel_genes(source.where("t_alt_count = '0' AND Chromosome = '1'"), t.spark)
    rows = genomics.exome_variants(source, tumors, panel)
    return rows.withColumn("vaf", F.round("vaf", 4))


@query("q_p7", f"""
    WITH v AS ({sql_bronze("lineitem", {**VARIANTS, "barcode": "CASE WHEN l_tax = 0 THEN 'NA' ELSE concat(' MB-', l_orderkey, ' ') END"}, "l_orderkey")}),
    {sql_with_ids(f"""SELECT trim(barcode) AS tumor_id, {_VARIANT_SQL}, 'GRCh37' AS reference_genome, 'PANEL' AS sequencing_scope,
           NULL::DOUBLE AS vaf, 1 AS in_metabric_panel
    FROM v JOIN orders ON line = o_orderkey AND o_orderstatus <> 'P' AND barcode <> 'NA'
    WHERE {sql_clean("Hugo_Symbol")} IS NOT NULL""", "MB-MUT-")}""")
def panel_variants(t):
    barcode = "CASE WHEN l_tax = 0 THEN 'NA' ELSE concat(' MB-', l_orderkey, ' ') END"
    source = bronze(t.lineitem, {**VARIANTS, "Tumor_Sample_Barcode": barcode}, "l_orderkey")
    tumors = t.orders.where("o_orderstatus <> 'P'").select(F.concat(F.lit("MB-"), "o_orderkey").alias("tumor_id"))
    return genomics.panel_variants(source, tumors)
