"""Load jobs on small files with answers worked out by hand."""

import dataclasses
import math
import re
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators import combat
from cohortloom.plans import clinical, genomics, jobs, views
from cohortloom.plans.schema import TABLES
from cohortloom.plans.store import Store
from cohortloom.session import checkpointed
from cohortloom.sources.delimited import read_biotab
from conftest import rows
from test_combat import dense_combat


def tsv(header, *lines):
    return "\n".join("\t".join(r) for r in [header.split(), *lines]) + "\n"


JUNK = [["x"], ["CDE_ID:"]]


def biotab(header, *lines):
    n = len(header.split())
    return tsv(header, *[j * n for j in JUNK], *lines)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """The source files, written once."""
    folder = tmp_path_factory.mktemp("sources")

    def write(name, text):
        (folder / name).write_text(text)
        return str(folder / name)
    return source_files(write)


@pytest.fixture
def src(files):
    return dataclasses.replace(files)


def source_files(write):
    records = tsv(
        "bcr_patient_barcode type age_at_initial_pathologic_diagnosis OS OS.time PFI PFI.time race ethnicity "
        "er_status_by_ihc her2_status_by_ihc paper_BRCA_Subtype_PAM50 histological_type "
        "neoplasm_histologic_grade ajcc_pathologic_tumor_stage",
        ["TCGA-A-1", "BRCA", "45", "1", "304.4", "0", "30.44", "WHITE", "NA", "Positive", "Equivocal", "NA",
         "Infiltrating Ductal Carcinoma", "2", "Stage IIA"],
        ["TCGA-A-2", "BRCA", "60", "0", "", "1.0", "x", "", "HISPANIC", "", "Negative", "Basal-like", "Rare", "", "Stage X"],
        ["TCGA-A-3", "LUAD", "60", "0", "1", "1", "1", "", "", "", "", "", "", "", ""],
        ["TCGA-A-2", "BRCA", "61", "1", "", "", "", "", "", "", "", "", "", "", ""],
        ["[Unknown]", "BRCA", "61", "1", "", "", "", "", "", "", "", "", "", "", ""],
        ["TCGA-A-4", "BRCA", "NA", "NA", "", "", "", "", "", "Negative", "Negative", "", "", "9", ""],
        ["TCGA-A-5", "BRCA", "50", "0", "608.8", "0", "0", "", "", "Negative", "Negative", "LumB", "IDC", "3", "iv"],
    )
    supplement = "#c\n" + tsv(
        "PATIENT_ID ER_STATUS_BY_IHC PR_STATUS_BY_IHC IHC_HER2 HER2_FISH_STATUS ETHNICITY MENOPAUSE_STATUS "
        "LYMPH_NODE_EXAMINED_COUNT LYMPH_NODES_EXAMINED_HE_COUNT SURGICAL_PROCEDURE_FIRST",
        ["TCGA-A-1", "Negative", "Positive", "Negative", "Positive", "OLD", "Post (x)", "9", "1", "Old"],
        ["TCGA-A-1", "Negative", "Positive", "Negative", "Negative", "NEW", "Indeterminate (x)", "10", "2.0", "Lumpectomy"],
        ["TCGA-A-2", "Negative", "Negative", "Positive", "", "X", "", "", "", "[Not Available]"],
        ["TCGA-A-5", "", "Negative", "", "", "", "", "", "", "Mastectomy"],
        ["TCGA-Z-9", "", "", "", "", "", "", "", "", "Other"],
    )
    subtypes = tsv(
        "sampleID Subtype_Selected Subtype_mRNA",
        ["TCGA-A-1-01", "BRCA.LumA", "LumA"], ["TCGA-A-1-06", "BRCA.NC", "NC"],
        ["TCGA-A-4-01", "LUAD.x", "Basal"], ["TCGA-A-2-01", "BRCA.LumA", "LumA"],
    )
    drugs = biotab(
        "bcr_patient_barcode therapy_type drug_name",
        ["TCGA-A-1", "Chemotherapy", "Taxol"], ["TCGA-Z-9", "Chemotherapy", "Skip"],
        ["TCGA-A-2", "Targeted Molecular therapy", "NA"], ["TCGA-A-1", "", "Y"], ["TCGA-A-1", "Vaccine", ""],
    )
    radiation = biotab("bcr_patient_barcode dose", ["TCGA-A-2", "1"], ["NA", "2"])
    panel_patients = "#h\n" + tsv(
        "PATIENT_ID AGE_AT_DIAGNOSIS OS_MONTHS OS_STATUS RFS_MONTHS RFS_STATUS INFERRED_MENOPAUSAL_STATE "
        "CHEMOTHERAPY HORMONE_THERAPY RADIO_THERAPY CLAUDIN_SUBTYPE INTCLUST LYMPH_NODES_EXAMINED_POSITIVE "
        "NOTTINGHAM_PROGNOSTIC_INDEX",
        ["MB-1", "49.5", "12.3", "1:DECEASED", "5", "0:Not Recurred", "Post", "YES", "NO", "", "claudin-low", "4+", "0", "0"],
        ["MB-2", "50", "x", "0:LIVING", "", "1:Recurred", "", "", "1", "y", "NC", "", "4", "5.5"],
        ["MB-3", "", "", "", "", "", "odd", "", "", "", "", "NA", "", ""],
    )
    panel_samples = tsv(
        "PATIENT_ID SAMPLE_ID ER_IHC PR_STATUS HER2_STATUS TUMOR_SIZE GRADE TUMOR_STAGE TUMOR_TYPE INTCLUST",
        ["MB-1", "MB-1", "Negative", "Negative", "Negative", "20", "2", "2", "IDC", "other"],
        ["MB-1", "MB-1b", "Positve", "Negative", "Negative", "25", "3.0", "0", "", "x"],
        ["MB-2", "MB-2", "POSITIVE", "Positive", "Equivocal", "NA", "3", "Stage IV", "Breast Mixed Ductal and Lobular Carcinoma", ""],
    )
    panel_mutations = "#v\n" + tsv(
        "Hugo_Symbol Chromosome Start_Position End_Position Reference_Allele Tumor_Seq_Allele2 "
        "Variant_Classification Variant_Type HGVSp_Short Tumor_Sample_Barcode",
        ["TP53", "1", "11", "21", "A", "T", "missense_variant", "SNP", "p.R1", "MB-1"],
        ["TP53", "1", "11", "21", "A", "T", "missense_variant", "SNP", "p.R1", "MB-1"],
        ["PIK3CA", "1", "121", "121.0", "-", "T", "Custom", "XXX", "", "MB-2"],
        ["MAP3K1", "1", "201", "", "A", "", "", "", "", "MB-1b"],
        ["GONE", "1", "1", "1", "A", "T", "", "", "", "MB-99"], ["NA", "1", "1", "1", "A", "T", "", "", "", "MB-1"],
    )
    exome_mutations = tsv(
        "Hugo_Symbol Chromosome Start_Position Tumor_Sample_Barcode HGVSp t_alt_count t_depth Variant_Type",
        ["TP53", "17", "5", "TCGA-A-1-01A-11", "p.Long", "5", "20", "DEL"],
        ["BRCA9", "17", "5", "TCGA-A-2-06A-11", "", "1", "0", ""], ["TP53", "1", "5", "TCGA-Q-1-01", "", "", "", ""],
        ["KRAS", "1", "x", "TCGA-A-5", "NA", "x", "3", "snp"],
    )
    chain = ("chain 1000 chr1 1000 + 0 300 chr1 10000 + 500 850 1\n100 50 100\n150\n\n"
             "chain 2000 chr1 1000 + 180 220 chr2 10000 + 40 80 2\n40\n")
    expression = (
        "Hugo_Symbol\tEntrez_Gene_Id\tTCGA-A-1-01\tTCGA-A-1-06\tTCGA-A-2-01\tTCGA-Q-1-01\n"
        "G1\t11.0\t1\t3\t5\t100\nG2\tNA\tNA\t4\t4\t100\nG1\t12\t9\t9\t9\t9\n?\t1\t1\t1\t1\t1\nONLY\t1\t1\t2\t3\t4\n")
    panel_expression = "Hugo_Symbol\tEntrez_Gene_Id\tMB-1\tMB-2\tMB-99\nG1\t11\t1.5\tnan\t3\nG2\t12\t2\t2\t2\n?\t1\t1\t1\t1\n"
    cna = ("Hugo_Symbol\tEntrez_Gene_Id\tTCGA-A-1-01\tTCGA-A-1-06\tTCGA-A-2-01\n"
           "G1\t1\t3\t-2\t0\nG2\t2\tNA\t\t1.0\nONLY\t1\t1\t1\t1\nG1\t9\t1\t1\t1\n")
    panel_cna = "Hugo_Symbol\tMB-1\tMB-2\nG1\t2\t-1\nG2\t0\t-3\n"
    return jobs.Sources(
        curated_records=write("cdr.tsv", records), clinical_supplement=write("sup.txt", supplement),
        subtypes=write("sub.tsv", subtypes), drugs=write("drug.txt", drugs), radiation=write("rad.txt", radiation),
        panel_patients=write("pp.txt", panel_patients), panel_samples=write("ps.txt", panel_samples),
        panel_mutations=write("pm.txt", panel_mutations), exome_mutations=write("em.txt", exome_mutations),
        chain=write("c.chain", chain), exome_expression=write("ee.txt", expression),
        panel_expression=write("pe.txt", panel_expression), exome_copy_number=write("ec.txt", cna),
        panel_copy_number=write("pc.txt", panel_cna),
    )


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "db"))


@pytest.fixture(scope="module")
def clinical_store(spark, files, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("clinical") / "db")
    jobs.load_clinical(Store(spark, folder), files)
    return folder


@pytest.fixture
def loaded(spark, clinical_store, tmp_path):
    """A store of its own with the clinical tables."""
    shutil.copytree(clinical_store, tmp_path / "db")
    return Store(spark, str(tmp_path / "db"))


PATIENTS = ["patient_id", "study_source", "age_at_diagnosis", "sex", "race", "ethnicity", "menopausal_status",
            "vital_status", "os_months", "os_event", "dfs_months", "dfs_event"]
TUMORS = ["tumor_id", "patient_id", "histological_type", "tumor_grade", "tumor_stage", "tumor_size_cm",
          "lymph_nodes_positive", "lymph_nodes_examined", "er_status", "pr_status", "her2_status", "tnbc_status",
          "pam50_subtype", "integrative_cluster", "nottingham_prognostic_index"]


def test_clinical(loaded):
    w, m = "TCGA-BRCA", "METABRIC"
    assert rows(loaded.read("patients"), *PATIENTS) == [
        ("MB-1", m, 49.5, "F", None, None, "Post", "Deceased", 12.3, 1, 5.0, 0),
        ("MB-2", m, 50.0, "F", None, None, "Post", "Alive", None, 0, None, 1),
        ("MB-3", m, None, "F", None, None, "Unknown", None, None, None, None, None),
        ("TCGA-A-1", w, 45.0, "F", "WHITE", "NEW", "Unknown", "Deceased", 10.0, 1, 1.0, 0),
        ("TCGA-A-2", w, 60.0, "F", None, "HISPANIC", "Post", "Alive", None, 0, None, 1),
        ("TCGA-A-4", w, None, "F", None, None, "Unknown", None, None, None, None, None),
        ("TCGA-A-5", w, 50.0, "F", None, None, "Post", "Alive", 20.0, 0, 0.0, 0),
    ]
    n, p, u = "Negative", "Positive", "Unknown"
    assert rows(loaded.read("tumors"), *TUMORS) == [
        ("MB-1", "MB-1", "IDC", 2, "II", 2.0, 0, None, n, n, n, 1, "Basal", "4+", 3.4),
        ("MB-1b", "MB-1", None, 3, None, 2.5, 0, None, u, n, n, None, "Basal", "4+", 4.5),
        ("MB-2", "MB-2", "Mixed", 3, "IV", None, 4, None, p, p, "Equivocal", 0, u, None, 5.5),
        ("MB-3-T", "MB-3", None, None, None, None, None, None, u, u, u, None, u, None, None),
        ("TCGA-A-1-01", "TCGA-A-1", "IDC", 2, "IIA", None, 2, 10, p, p, n, 0, "LumA", None, None),
        ("TCGA-A-2-01", "TCGA-A-2", "Rare", None, None, None, None, None, n, n, n, 1, "Basal", None, None),
        # Grade 9 breaks its rule: the tumor of TCGA-A-4 is not stored.
        ("TCGA-A-5-01", "TCGA-A-5", "IDC", 3, "IV", None, None, None, n, n, n, 1, "LumB", None, None),
    ]
    assert rows(loaded.read("treatments"), "treatment_id", "patient_id", "treatment_type", "treatment_name", "received") == [
        ("MB-TX-000001", "MB-1", "Chemotherapy", None, 1), ("MB-TX-000002", "MB-1", "Hormone Therapy", None, 0),
        ("MB-TX-000003", "MB-1", "Chemotherapy", None, 1), ("MB-TX-000004", "MB-1", "Hormone Therapy", None, 0),
        ("MB-TX-000005", "MB-2", "Hormone Therapy", None, 1), ("MB-TX-000006", "MB-2", "Radiation", None, 1),
        ("TCGA-TX-000001", "TCGA-A-1", "Chemotherapy", "Taxol", 1),
        ("TCGA-TX-000002", "TCGA-A-2", "Targeted Therapy", None, 1), ("TCGA-TX-000003", "TCGA-A-1", "Other", "Y", 1),
        ("TCGA-TX-000004", "TCGA-A-1", "Other", None, 1), ("TCGA-TX-000005", "TCGA-A-2", "Radiation", None, 1),
        ("TCGA-TX-000006", "TCGA-A-1", "Surgery", "Lumpectomy", 1),
        ("TCGA-TX-000007", "TCGA-A-5", "Surgery", "Mastectomy", 1),
    ]
    assert loaded.count("harmonization_log") == 11


def test_clinical_reload_changes_nothing(loaded, src):
    before = {t: rows(loaded.read(t)) for t in ("patients", "tumors", "treatments")}
    jobs.load_clinical(loaded, src)
    assert {t: rows(loaded.read(t)) for t in before} == before


def test_loads_tell_what_was_dropped(loaded, src):
    """Attempted rows are stored or rejected; skipped ones never were rows of a table."""
    jobs.load_mutations(loaded, src)
    panel, exome = loaded.loads
    assert (panel.table, panel.attempted, panel.skipped) == ("mutations", 4, {"unknown tumor": 1, "no gene": 1})
    assert exome.skipped["unknown tumor"] >= 1
    jobs.load_mutations(loaded, src)
    for load in loaded.loads:
        assert load.attempted == load.stored + load.rejected.count()
    again = loaded.loads[2]
    assert (again.stored, again.reasons) == (0, {"already_stored": 4})
    assert (3, "mutations", "rejected: already_stored", 4) in rows(loaded.load_report())


def test_clinical_without_sources(store):
    assert jobs.load_clinical(store, jobs.Sources()) == {"patients": 0, "tumors": 0, "treatments": 0}
    assert store.count("harmonization_log") == 11


BIOTAB = biotab(
    "bcr_patient_barcode age_at_initial_pathologic_diagnosis vital_status death_days_to last_contact_days_to gender "
    "race_list race tumor_size neoplasm_histologic_grade lymph_node_examined_count er_status_by_ihc",
    ["P1", "40", "Dead", "304.4", "1", "F", "", "WHITE", "2", "2", "0", "Positive"],
    ["P2", "x", "Alive", "", "608.8", "FEMALE", "NA", "WHITE", "1", "1", "2", ""],
    ["", "x", "Alive", "", "608.8", "F", "", "", "", "", "", ""],
)


def test_biotab(spark, write):
    path = write("bt.txt", BIOTAB)
    got = clinical.biotab_clinical(read_biotab(spark, path))
    assert rows(got.patients, "patient_id", "sex", "race", "menopausal_status", "os_months", "os_event") == [
        ("P1", "F", "WHITE", "Pre", 10.0, 1), ("P2", "FEMALE", None, "Unknown", 20.0, 0)]
    cols = ["tumor_id", "lymph_nodes_positive", "nottingham_prognostic_index", "er_status", "pam50_subtype"]
    assert rows(got.tumors, *cols) == [
        ("P1-01", 0, 3.4, "Positive", "Unknown"), ("P2-01", 2, 3.2, "Unknown", "Unknown")]
    strict = clinical.biotab_clinical(read_biotab(spark, path), examined_as_positive=False)
    assert rows(strict.tumors, *cols[:3]) == [("P1-01", None, None), ("P2-01", None, None)]


def test_biotab_orphans(store, write):
    """The raw gender breaks a rule, so its tumor has no patient."""
    src = jobs.Sources(biotab_patients=write("bt.txt", BIOTAB))
    with pytest.raises(ValueError, match="P2"):
        jobs.load_clinical(store, src)
    jobs.load_clinical(store, src, on_orphan="reject")
    assert rows(store.read("tumors"), "tumor_id") == [("P1-01",)]


def test_mutations_and_liftover(loaded, src):
    assert jobs.load_mutations(loaded, src) == 7
    cols = ["tumor_id", "gene_symbol", "chromosome", "start_position", "end_position", "reference_genome",
            "variant_classification", "variant_type", "hgvsp", "vaf", "sequencing_scope", "in_metabric_panel"]
    panel = rows(loaded.read("mutations").where("sequencing_scope = 'PANEL'"), *cols)
    tp53 = ("MB-1", "TP53", "1", 11, 21, "GRCh37", "Missense_Mutation", "SNP", "p.R1", None, "PANEL", 1)
    assert panel == [
        tp53, tp53, ("MB-1b", "MAP3K1", "1", 201, None, "GRCh37", None, None, None, None, "PANEL", 1),
        ("MB-2", "PIK3CA", "1", 121, 121, "GRCh37", "Custom", None, None, None, "PANEL", 1)]
    assert rows(loaded.read("mutations").where("sequencing_scope = 'WES'"), *cols) == [
        ("TCGA-A-1-01", "TP53", "17", 5, None, "GRCh38", None, "DEL", "p.Long", 0.25, "WES", 1),
        ("TCGA-A-2-01", "BRCA9", "17", 5, None, "GRCh38", None, None, None, math.inf, "WES", 0),
        ("TCGA-A-5-01", "KRAS", "1", None, None, "GRCh38", None, None, None, None, "WES", 0)]
    ids = rows(loaded.read("mutations"), "mutation_id")
    assert len(set(ids)) == 7
    jobs.load_mutations(loaded, src)
    assert rows(loaded.read("mutations"), "mutation_id") == ids

    dry = jobs.liftover_mutations(loaded, src.chain, dry_run=True)
    assert dry == {"total": 4, "lifted": 3, "failed": 1, "cross_chromosome": 0, "pct_lifted": 75.0}
    assert loaded.read("mutations").where("reference_genome = 'GRCh37'").count() == 4
    assert jobs.liftover_mutations(loaded, src.chain) == dry
    assert rows(loaded.read("mutations").where("sequencing_scope = 'PANEL'"), *cols[:6]) == [
        ("MB-1", "TP53", "1", 511, 521, "GRCh38"), ("MB-1", "TP53", "1", 511, 521, "GRCh38"),
        ("MB-1b", "MAP3K1", "2", 61, None, "GRCh38"), ("MB-2", "PIK3CA", "1", 121, 121, "GRCh37_UNMAPPED")]
    assert rows(loaded.read("mutations"), "mutation_id") == ids
    assert jobs.liftover_mutations(loaded, src.chain)["total"] == 0


def test_liftover_can_be_repeated_after_a_crash(loaded, src):
    """Moved rows were appended, but the source partition was not dropped."""
    jobs.load_mutations(loaded, src)
    todo = loaded.read("mutations").where("reference_genome = 'GRCh37'")
    todo = checkpointed(todo)
    assert todo.count() == 4
    jobs.liftover_mutations(loaded, src.chain)
    done = rows(loaded.read("mutations"))
    loaded.append("mutations", todo)
    jobs.liftover_mutations(loaded, src.chain)
    assert rows(loaded.read("mutations")) == done


def test_panel_falls_back_to_the_fixed_list(loaded, src):
    src.panel_mutations = None
    jobs.load_mutations(loaded, src)
    assert rows(loaded.read("mutations"), "gene_symbol", "in_metabric_panel") == [("BRCA9", 0), ("KRAS", 1), ("TP53", 1)]


def z(values, n, x):
    known = [v for v in values if v is not None]
    mu = sum(known) / len(known)
    sd = math.sqrt(sum((v - mu) ** 2 for v in known) / len(known) * n / (n - 1))
    return round((x - mu) / sd, 4) if sd > 0 else 0.0


def test_expression(loaded, src):
    assert jobs.load_expression(loaded, src) == 8
    got = rows(loaded.read("gene_expression"), *TABLES["gene_expression"].schema.fieldNames())
    a, b = "TCGA-A-1-01", "TCGA-A-2-01"
    # Three columns match; two share a tumor, whose first value is stored.
    assert got == [
        ("MB-1", "G1", 11, 1.5, None, "microarray"), ("MB-1", "G2", 12, 2.0, 0.0, "microarray"),
        ("MB-2", "G1", 11, None, None, "microarray"), ("MB-2", "G2", 12, 2.0, 0.0, "microarray"),
        (a, "G1", 11, 1.0, z([1, 3, 5], 3, 1), "RNA-seq"), (a, "G2", None, 4.0, z([None, 4, 4], 3, 4), "RNA-seq"),
        (b, "G1", 11, 5.0, z([1, 3, 5], 3, 5), "RNA-seq"), (b, "G2", None, 4.0, 0.0, "RNA-seq")]
    jobs.load_expression(loaded, src)
    assert loaded.count("gene_expression") == 8


def test_expression_spread_counts_missing_columns(loaded, src, write):
    src.exome_expression = write("x.txt", "Hugo_Symbol\tTCGA-A-1-01\tTCGA-A-2-01\tTCGA-A-5-01\nG1\t1\tNA\t4\n")
    src.panel_expression = None
    jobs.load_expression(loaded, src)
    assert rows(loaded.read("gene_expression"), "tumor_id", "expression_z_score") == [
        ("TCGA-A-1-01", z([1, None, 4], 3, 1)), ("TCGA-A-5-01", z([1, None, 4], 3, 4))]


def test_expression_all_genes(loaded, src):
    jobs.load_expression(loaded, src, all_genes=True)
    assert rows(loaded.read("gene_expression").select("gene_symbol").distinct()) == [("G1",), ("G2",), ("ONLY",)]


def test_copy_number(loaded, src):
    jobs.load_copy_number(loaded, src)
    # 3 is outside the domain, so the second column of the tumor is stored; 1.0 is no integer.
    assert rows(loaded.read("copy_number")) == [
        ("MB-1", "G1", 2, None), ("MB-1", "G2", 0, None), ("MB-2", "G1", -1, None),
        ("TCGA-A-1-01", "G1", -2, None), ("TCGA-A-2-01", "G1", 0, None)]
    assert [load.skipped for load in loaded.loads[-2:]] == [
        {"no label": 0, "not shared": 1, "repeated label": 1}, {"no label": 0, "not shared": 0, "repeated label": 0}]
    jobs.load_expression(loaded, src)
    assert [load.skipped for load in loaded.loads[-2:]] == [
        {"no label": 1, "not shared": 1, "repeated label": 1}, {"no label": 1, "not shared": 0, "repeated label": 0}]


def combat_files(loaded, src, write, genes=12):
    rng = np.random.default_rng(5)
    ids = ["TCGA-A-1", "TCGA-A-2", "TCGA-A-5"], ["MB-1", "MB-1b", "MB-2"]
    x = np.concatenate([rng.normal(8, 2, (genes, 3)), rng.normal(3, 1, (genes, 3))], axis=1).round(4)
    for name, cols, part in (("exome_expression", [i + "-01" for i in ids[0]], x[:, :3]),
                             ("panel_expression", ids[1], x[:, 3:])):
        body = "".join(f"G{i:02d}\t" + "\t".join("NA" if (i, j) == (0, 0) else str(v) for j, v in enumerate(r)) + "\n"
                       for i, r in enumerate(part))
        setattr(src, name, write(name, "Hugo_Symbol\t" + "\t".join(cols) + "\n" + body + "?\t" + "\t".join("111") + "\n"))
    x[0, [0, 3]] = x[0, [1, 2, 4, 5]].mean()
    return x, [i + "-01" for i in ids[0]] + ids[1]


def test_combat_from_files(loaded, src, write):
    x, samples = combat_files(loaded, src, write)
    want = dense_combat(x, ["a"] * 3 + ["b"] * 3)
    dry = jobs.run_combat(loaded, src, min_samples=4, dry_run=True)
    assert dry.count() == x.size and loaded.count("gene_expression_combat") == 0
    got = jobs.run_combat(loaded, src, min_samples=4)
    assert loaded.figures["shift_after"] < loaded.figures["shift_before"] / 10
    assert got.count() == x.size
    for tumor, gene, value in rows(got):
        assert abs(value - want[int(gene[1:]), samples.index(tumor)]) < 2e-6
    jobs.run_combat(loaded, src, min_samples=4)
    assert loaded.count("gene_expression_combat") == x.size


def test_cells_of_a_combat_run_are_read_from_lines(loaded, src, write):
    """Every pass explodes written lines; counts per sample and sums per gene and batch are
    formed before the shuffle, so no cell is shuffled or stored as a row."""
    combat_files(loaded, src, write)
    both = jobs._cohort_matrices(loaded.spark, src.exome_expression, src.panel_expression, "Hugo_Symbol")
    study = views.tumor_study(loaded.read("patients"), loaded.read("tumors"))
    cells = genomics.batch_cells([(m, sid) for _, m, sid in both], study)
    prepared = combat.prepare(cells, 4, written=True)
    plan = prepared.cells._jdf.queryExecution().optimizedPlan().toString()
    assert "samples#" in plan and plan.count("Generate explode") == 2 and not re.search(r"LogicalRDD \[[^]]*value", plan)
    for passed in (combat.kept_samples(cells, 3), combat.feature_coverage(cells, 4)):
        physical = passed._jdf.queryExecution().executedPlan().toString()
        partial = physical.index("partial_count")
        # Read upwards, the first shuffle stands above the partial counts.
        assert "hashpartitioning" in physical[:partial] and "hashpartitioning" not in physical[partial:]


def test_combat_needs_both_sides(loaded, src, write):
    assert jobs.run_combat(loaded, src, min_samples=100) is None
    src.panel_expression = write("none.txt", "Hugo_Symbol\tMB-77\tMB-78\nG1\t1\t2\n")
    assert jobs.run_combat(loaded, src, min_samples=1) is None
    src.panel_expression = write("other.txt", "Hugo_Symbol\tMB-1\tMB-2\nZZ\t1\t2\n?\t1\t1\n")
    assert jobs.run_combat(loaded, src, min_samples=1) is None
    src.panel_expression = None
    assert jobs.run_combat(loaded, src) is None


def test_run_all(store, src, write):
    combat_files(store, src, write)
    summary = jobs.run_all(store, src)
    got = {(r["section"], r["value"]): r["n_rows"] for r in summary.collect()}
    assert got[("Rows", "patients")] == 7 and got[("Rows", "mutations")] == 7
    assert got[("Rows", "gene_expression")] == 0
    assert got[("Patients by study", "METABRIC")] == 3
    assert got[("Mutations by genome build", "GRCh38")] == 6
    # 16 seeds, 11 clinical, 2 mutations, 2 copy number, 1 liftover.
    assert got[("Rows", "harmonization_log")] == 32
    log = store.read("harmonization_log").agg(F.min("log_id"), F.max("log_id"), F.countDistinct("log_id")).head()
    assert tuple(log) == (1, 32, 32)

    p, t, m = (store.read(n) for n in ("patients", "tumors", "mutations"))
    assert views.patient_tumor(p, t).count() == 7 and len(views.patient_tumor(p, t).columns) == 23
    assert views.mutations_cross_study(m, p, t).count() == 5
    assert rows(views.mutation_frequency(m, p, t)) == [
        ("METABRIC", "MAP3K1", 1, 1, 100.0), ("METABRIC", "PIK3CA", 1, 1, 100.0), ("METABRIC", "TP53", 1, 1, 100.0),
        ("TCGA-BRCA", "TP53", 1, 1, 100.0)]
    assert rows(views.mutation_frequency(m, p, t, parity=False)) == [
        ("METABRIC", "MAP3K1", 1, 4, 25.0), ("METABRIC", "PIK3CA", 1, 4, 25.0), ("METABRIC", "TP53", 1, 4, 25.0),
        ("TCGA-BRCA", "TP53", 1, 3, 33.33)]
    assert rows(views.treatment_summary(store.read("treatments"))) == [
        ("MB-1", 1, 0, 0, 0, 0), ("MB-2", 0, 1, 1, 0, 0), ("TCGA-A-1", 1, 0, 0, 1, 0),
        ("TCGA-A-2", 0, 0, 1, 0, 1), ("TCGA-A-5", 0, 0, 0, 1, 0)]


def test_a_broken_run_goes_on_after_its_last_step(spark, tmp_path, src, write, monkeypatch):
    """Every step fails once at its end, with all of it written. The rows and audit rows are
    those of a run without a failure, and no finished step runs again."""
    small = jobs.Sources(panel_patients=src.panel_patients, panel_samples=src.panel_samples,
                         panel_mutations=src.panel_mutations, chain=src.chain)
    whole, broken = Store(spark, str(tmp_path / "whole")), Store(spark, str(tmp_path / "broken"))
    want = rows(jobs.run_all(whole, small))
    ran, failed = [], set()

    def failing(step):
        def run(store, sources, on_orphan):
            ran.append(step.name)
            step.run(store, sources, on_orphan)
            if step.name not in failed:
                failed.add(step.name)
                raise OSError(step.name)
        return dataclasses.replace(step, run=run)

    real = jobs.STEPS
    monkeypatch.setattr(jobs, "STEPS", [failing(s) for s in real])
    for step in real:
        with pytest.raises(OSError, match=step.name):
            jobs.run_all(Store(spark, broken.root), small)
        assert list(broken.snapshot().steps) == [s.name for s in real[:real.index(step)]]
    assert rows(jobs.run_all(broken, small)) == want
    assert ran == [s.name for s in real for _ in range(2)] and broken.snapshot().steps == {}
    for table in TABLES:
        names = [c for c in whole.read(table).columns if c not in ("created_at", "updated_at")]
        assert rows(broken.read(table), *names) == rows(whole.read(table), *names)
    broken.vacuum()
    assert rows(broken.read("mutations")) == rows(whole.read("mutations"))


def test_steps_with_other_inputs_run_again(spark, tmp_path, write, monkeypatch):
    """A changed file takes back its step and those after it, not those before."""
    store, ran = Store(spark, str(tmp_path / "db")), []

    def noted(name, field, fail=False):
        def run(store, sources, on_orphan):
            ran.append(name)
            if fail:
                raise OSError(name)
        return jobs.Step(name, run, field)

    monkeypatch.setattr(jobs, "STEPS", [noted("one", ("drugs",)), noted("two", ("chain",)), noted("three", ("radiation",)), noted("four", (), True)])
    src = jobs.Sources(drugs=write("a.txt", "1"), chain=write("b.txt", "1"), radiation=write("c.txt", "1"))
    for change, want in [(None, "one two three four"), (None, "four"), ("b.txt", "two three four"), ("c.txt", "three four"), (None, "four")]:
        if change:
            write(change, "changed " + change * len(ran))
        ran.clear()
        with pytest.raises(OSError):
            jobs.run_all(store, src)
        assert " ".join(ran) == want


def test_sizes_of_plain_tables_are_not_scanned(spark, store, write):
    """The summary of a run reads patients, tumors and mutations for their breakdowns, no other table."""
    store.append("copy_number", spark.createDataFrame([("T", "G", 1)], "tumor_id string, gene_symbol string, gistic_value int"))
    store.append("patients", spark.createDataFrame([("P", "METABRIC"), ("Q", "METABRIC")], "patient_id string, study_source string"))
    from cohortloom.plans.report import database_summary
    tables = {name: store.read(name) for name in TABLES}
    summary = database_summary(tables, {name: store.count(name) for name in TABLES})
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and rows(summary) == rows(database_summary(tables))
