"""The target tables: columns, keys, rules and seed rows of the audit log."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..functions import vocab
from ..operators.quality import ForeignKey, TableSpec, enum_check

_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(),
    "long": T.LongType(), "time": T.TimestampType(),
}


def _schema(text: str) -> T.StructType:
    pairs = [p.split() for p in text.strip().split(",")]
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in pairs])


_STUDIES = [vocab.STUDY_WES, vocab.STUDY_PANEL]
_NOW = {"created_at": F.current_timestamp, "updated_at": F.current_timestamp}
_TUMOR = ForeignKey("tumor_id", "tumors", "tumor_id")
_PATIENT = ForeignKey("patient_id", "patients", "patient_id")

PATIENTS = TableSpec(
    "patients",
    _schema("""patient_id string, study_source string, age_at_diagnosis double, sex string,
        race string, ethnicity string, menopausal_status string, vital_status string,
        os_months double, os_event int, dfs_months double, dfs_event int,
        created_at time, updated_at time"""),
    key=["patient_id"],
    not_null=["study_source", "created_at", "updated_at"],
    checks={
        **enum_check("study_source", _STUDIES),
        **enum_check("sex", ["M", "F"]),
        **enum_check("menopausal_status", ["Pre", "Post", "Peri", "Unknown"]),
        **enum_check("vital_status", ["Alive", "Deceased"]),
        **enum_check("os_event", [0, 1]),
        **enum_check("dfs_event", [0, 1]),
    },
    defaults=_NOW,
)

TUMORS = TableSpec(
    "tumors",
    _schema("""tumor_id string, patient_id string, histological_type string, tumor_grade int,
        tumor_stage string, tumor_size_cm double, lymph_nodes_positive int,
        lymph_nodes_examined int, er_status string, pr_status string, her2_status string,
        tnbc_status int, pam50_subtype string, integrative_cluster string,
        nottingham_prognostic_index double, created_at time, updated_at time"""),
    key=["tumor_id"],
    not_null=["patient_id", "created_at", "updated_at"],
    checks={
        **enum_check("tumor_grade", [1, 2, 3]),
        **enum_check("er_status", ["Positive", "Negative", "Unknown"]),
        **enum_check("pr_status", ["Positive", "Negative", "Unknown"]),
        **enum_check("her2_status", ["Positive", "Negative", "Equivocal", "Unknown"]),
        **enum_check("tnbc_status", [0, 1]),
        **enum_check("pam50_subtype", ["LumA", "LumB", "Her2", "Basal", "Normal", "Unknown"]),
    },
    foreign_keys=[_PATIENT],
    defaults=_NOW,
)

TREATMENTS = TableSpec(
    "treatments",
    _schema("""treatment_id string, patient_id string, treatment_type string,
        treatment_name string, received int, created_at time"""),
    key=["treatment_id"],
    not_null=["patient_id", "treatment_type", "received", "created_at"],
    checks={
        **enum_check("treatment_type", ["Chemotherapy", "Hormone Therapy", "Radiation", "Surgery",
                                        "Targeted Therapy", "Other"]),
        **enum_check("received", [0, 1]),
    },
    foreign_keys=[_PATIENT],
    defaults={"created_at": F.current_timestamp},
)

GENE_EXPRESSION = TableSpec(
    "gene_expression",
    _schema("""tumor_id string, gene_symbol string, entrez_id long, expression_value double,
        expression_z_score double, platform string"""),
    key=["tumor_id", "gene_symbol"],
    not_null=["tumor_id", "gene_symbol", "platform"],
    checks=enum_check("platform", ["RNA-seq", "microarray"]),
    foreign_keys=[_TUMOR],
)

COPY_NUMBER = TableSpec(
    "copy_number",
    _schema("tumor_id string, gene_symbol string, gistic_value int, log2_ratio double"),
    key=["tumor_id", "gene_symbol"],
    not_null=["tumor_id", "gene_symbol"],
    checks=enum_check("gistic_value", vocab.GISTIC_VALUES),
    foreign_keys=[_TUMOR],
)

MUTATIONS = TableSpec(
    "mutations",
    _schema("""mutation_id string, tumor_id string, gene_symbol string, chromosome string,
        start_position long, end_position long, reference_genome string,
        reference_allele string, variant_allele string, variant_classification string,
        variant_type string, hgvsp string, vaf double, sequencing_scope string,
        in_metabric_panel int"""),
    key=["mutation_id"],
    not_null=["tumor_id", "gene_symbol", "reference_genome", "sequencing_scope", "in_metabric_panel"],
    checks={
        **enum_check("variant_type", vocab.VARIANT_TYPES),
        **enum_check("sequencing_scope", ["WES", "PANEL"]),
        **enum_check("in_metabric_panel", [0, 1]),
    },
    foreign_keys=[_TUMOR],
    defaults={"reference_genome": vocab.BUILD_TARGET, "in_metabric_panel": 0},
)

METHYLATION = TableSpec(
    "methylation",
    _schema("""tumor_id string, probe_id string, gene_symbol string, beta_value double,
        chromosome string, position long"""),
    key=["tumor_id", "probe_id"],
    not_null=["tumor_id", "probe_id"],
    checks={"beta_value": "beta_value >= 0.0 AND beta_value <= 1.0"},
    foreign_keys=[_TUMOR],
)

PROTEIN_EXPRESSION = TableSpec(
    "protein_expression",
    _schema("tumor_id string, antibody_id string, protein_name string, expression_value double"),
    key=["tumor_id", "antibody_id"],
    not_null=["tumor_id", "antibody_id"],
    foreign_keys=[_TUMOR],
)

GENE_EXPRESSION_COMBAT = TableSpec(
    "gene_expression_combat",
    _schema("tumor_id string, gene_symbol string, expression_combat double"),
    key=["tumor_id", "gene_symbol"],
    not_null=["tumor_id", "gene_symbol", "expression_combat"],
    foreign_keys=[_TUMOR],
)

HARMONIZATION_LOG = TableSpec(
    "harmonization_log",
    _schema("""log_id long, table_name string, study_source string, field_name string,
        transformation string, source_field string, notes string, created_at time"""),
    key=["log_id"],
    not_null=["table_name", "study_source", "field_name", "transformation", "created_at"],
    checks=enum_check("study_source", [*_STUDIES, vocab.STUDY_BOTH]),
    defaults={"created_at": F.current_timestamp},
)

# In the order the database summary lists them.
TABLES = {
    s.name: s for s in [
        PATIENTS, TUMORS, TREATMENTS, MUTATIONS, GENE_EXPRESSION, GENE_EXPRESSION_COMBAT,
        COPY_NUMBER, METHYLATION, PROTEIN_EXPRESSION, HARMONIZATION_LOG,
    ]
}

# The audit rows a new store starts with.
# (table, study, field, transformation, source field, notes)
SEED_LOG = [
    ("patients", "TCGA-BRCA", "os_months",
     "days_to_death / 30.44 (or days_to_last_follow_up / 30.44 if censored)",
     "demographic.days_to_death, demographic.days_to_last_follow_up",
     "Use TCGA-CDR (Liu et al., Cell 2018) curated endpoints. PFI recommended over OS for BRCA."),
    ("patients", "TCGA-BRCA", "patient_id",
     "Retained TCGA barcode as-is (e.g. TCGA-A2-A0YF)",
     "submitter_id",
     "First 12 characters of TCGA barcode uniquely identify the patient."),
    ("patients", "METABRIC", "patient_id",
     "Prefixed with MB- to match PATIENT_ID from cBioPortal clinical file",
     "PATIENT_ID",
     "Original METABRIC IDs like MB-0001 are already prefixed."),
    ("patients", "TCGA-BRCA", "menopausal_status",
     "Inferred from age: Pre if age < 50, Post if age >= 50",
     "age_at_diagnosis",
     "This is an approximation. METABRIC records menopausal status directly."),
    ("patients", "METABRIC", "race",
     "Set to NULL - field not available in METABRIC",
     None,
     "METABRIC cohort is predominantly UK/Canadian, individual-level race/ethnicity not collected."),
    ("tumors", "TCGA-BRCA", "tumor_id",
     "Used TCGA sample barcode (first 16 characters)",
     "submitter_id (sample-level)",
     "Format: TCGA-XX-XXXX-01A. The -01 suffix indicates primary solid tumor."),
    ("tumors", "METABRIC", "nottingham_prognostic_index",
     "Used NPI value directly from cBioPortal clinical file",
     "NOTTINGHAM_PROGNOSTIC_INDEX",
     "For TCGA, NPI can be computed: (0.2 * tumor_size_cm) + tumor_grade + lymph_node_score."),
    ("tumors", "BOTH", "tnbc_status",
     "Derived: 1 if er_status = Negative AND pr_status = Negative AND her2_status = Negative",
     "er_status, pr_status, her2_status",
     "Applied consistently to both studies after receptor status harmonization."),
    ("gene_expression", "TCGA-BRCA", "expression_value",
     "Log2(FPKM + 1) from GDC harmonized RNA-seq pipeline",
     "htseq_fpkm files",
     "TCGA values are RNA-seq based. NOT directly comparable to METABRIC microarray values."),
    ("gene_expression", "METABRIC", "expression_value",
     "Log2 intensity values from Illumina HT-12 v3 arrays as provided by cBioPortal",
     "data_mRNA_median_Zscores.txt / raw expression file",
     "Microarray platform. Use z-scores or ComBat for cross-study comparison."),
    ("gene_expression", "BOTH", "gene_symbol",
     "Mapped to HUGO gene symbols using GENCODE v36 annotation",
     "various probe/gene mappings",
     "METABRIC Illumina probe-to-gene mappings may need updating. Ambiguous probes excluded."),
    ("mutations", "TCGA-BRCA", "start_position",
     "Coordinates already in GRCh38 from GDC harmonized MAF files",
     "Start_Position (MAF)",
     "GDC re-aligned all TCGA data to GRCh38."),
    ("mutations", "METABRIC", "start_position",
     "Lifted over from GRCh37 to GRCh38 using UCSC liftOver or CrossMap",
     "Start_Position (cBioPortal mutation file)",
     "Original METABRIC coordinates are GRCh37. Unmappable variants flagged and excluded."),
    ("mutations", "METABRIC", "in_metabric_panel",
     "Set to 1 for all METABRIC mutations (all are within the targeted panel by definition)",
     None,
     "For TCGA, in_metabric_panel = 1 only if the gene appears in the METABRIC ~173-gene panel list."),
    ("mutations", "BOTH", "variant_classification",
     "Standardized to MAF specification vocabulary: Missense_Mutation, Nonsense_Mutation, "
     "Frame_Shift_Del, Frame_Shift_Ins, Splice_Site, etc.",
     "Variant_Classification",
     "METABRIC cBioPortal files use same MAF vocabulary. Verified for consistency."),
    ("copy_number", "BOTH", "gistic_value",
     "Discrete CNA values (-2 to +2) from GISTIC2 output",
     "data_CNA.txt (cBioPortal) / focal_data_by_genes.txt (GDC)",
     "Both studies used Affymetrix SNP6.0 arrays. Most directly comparable data type across studies."),
]

# The audit rows of a clinical load.
CLINICAL_LOG = [
    ("patients", "TCGA-BRCA", "os_months",
     "CDR OS.time (days) / 30.44", "OS.time", "PFI recommended for BRCA."),
    ("patients", "METABRIC", "os_months", "Used OS_MONTHS directly", "OS_MONTHS", None),
    ("tumors", "TCGA-BRCA", "er_status",
     "Merged from cBioPortal data_clinical_patient.txt (ER_STATUS_BY_IHC) where CDR value was missing",
     "ER_STATUS_BY_IHC", "PR and HER2 also merged from same source"),
    ("tumors", "TCGA-BRCA", "pam50_subtype",
     "From PanCanAtlas TCGASubtype.20170308.tsv (Hoadley et al. 2018), Subtype_mRNA column",
     "Subtype_mRNA", "1,097 BRCA patients classified via UCSC Xena hub"),
    ("patients", "TCGA-BRCA", "ethnicity",
     "From cBioPortal data_clinical_patient.txt ETHNICITY column", "ETHNICITY", None),
    ("patients", "TCGA-BRCA", "menopausal_status",
     "Clinical menopause from cBioPortal MENOPAUSE_STATUS, replacing age-based heuristic",
     "MENOPAUSE_STATUS", None),
    ("tumors", "TCGA-BRCA", "lymph_nodes_examined",
     "From cBioPortal LYMPH_NODE_EXAMINED_COUNT and LYMPH_NODES_EXAMINED_HE_COUNT",
     "LYMPH_NODE_EXAMINED_COUNT", None),
    ("tumors", "TCGA-BRCA", "her2_status",
     "IHC Equivocal cases resolved using HER2_FISH_STATUS where available", "HER2_FISH_STATUS", None),
    ("tumors", "METABRIC", "tumor_size_cm",
     "METABRIC TUMOR_SIZE converted from mm to cm (/ 10)", "TUMOR_SIZE", None),
    ("patients", "METABRIC", "dfs_event",
     "METABRIC RFS_STATUS parsing order fixed (check 'Not Recurred' before 'Recurred')",
     "RFS_STATUS", None),
    ("treatments", "TCGA-BRCA", "treatment_type",
     "From GDC biotab clinical archive (drug + radiation) and cBioPortal surgery", "therapy_type", None),
]

# The audit rows of the other loads, with places to fill in.
LOAD_LOG = {
    "panel": ("mutations", "BOTH", "in_metabric_panel",
              "TCGA mutations flagged against {genes}-gene panel derived from METABRIC mutation data",
              "Hugo_Symbol", "Use WHERE in_metabric_panel=1 for cross-study comparisons"),
    "build": ("mutations", "METABRIC", "reference_genome",
              "Stored as GRCh37. Liftover to GRCh38 needed for coordinate comparisons.",
              "Start_Position", "Gene-level analysis works without liftover"),
    "expression": ("gene_expression", "{study}", "expression_z_score",
                   "Z-score per gene across all {study} samples", "expression_value",
                   "Enables rank-based cross-study comparison"),
    "copy_number": ("copy_number", "{study}", "gistic_value",
                    "GISTIC2 discrete values from Affymetrix SNP6.0", "data_cna.txt",
                    "Directly comparable across studies"),
}


def load_entry(name: str, **values) -> tuple:
    """One audit row of a load."""
    return tuple(part.format(**values) for part in LOAD_LOG[name])
