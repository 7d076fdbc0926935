"""Vocabularies, sentinels and constants.

Everything in this module is a fixed value: results are only right when these
equal the published vocabularies of the two cohorts.
"""

# The two cohorts.
STUDY_WES = "TCGA-BRCA"
STUDY_PANEL = "METABRIC"
STUDY_BOTH = "BOTH"

# Constants.
DAYS_PER_MONTH = 30.44
MENOPAUSE_AGE_CUTOFF = 50
BUILD_TARGET = "GRCh38"
BUILD_SOURCE = "GRCh37"
BUILD_UNMAPPED = "GRCh37_UNMAPPED"

# Texts that mean "no value" (case-sensitive, after trimming).
NULL_SENTINELS = [
    "", "NA", "N/A", "na", "n/a", "[Not Available]", "[Not Evaluated]",
    "[Not Applicable]", "[Discrepancy]", "[Unknown]", "null", "NULL",
    "NaN", "nan", "--", ".", "unknown", "Unknown",
]

# Matrix row labels that are no gene symbol.
INVALID_SYMBOLS = ["", "nan", "?"]

# Intrinsic subtype.
PAM50 = {
    "Luminal A": "LumA", "Luminal B": "LumB", "HER2-enriched": "Her2",
    "Basal-like": "Basal", "Normal-like": "Normal",
    "LumA": "LumA", "LumB": "LumB", "Her2": "Her2", "Basal": "Basal", "Normal": "Normal",
    "lumA": "LumA", "lumB": "LumB", "her2": "Her2", "basal": "Basal", "normal": "Normal",
    "claudin-low": "Basal", "NC": "Unknown", "": "Unknown",
}

# Receptor status.
RECEPTOR_STATUS = {
    "Positive": "Positive", "positive": "Positive",
    "Negative": "Negative", "negative": "Negative",
    "Equivocal": "Equivocal", "equivocal": "Equivocal",
    "Indeterminate": "Unknown", "[Not Evaluated]": "Unknown",
    "[Not Available]": "Unknown", "": "Unknown",
}

# Stage. "Stage X" and "0" have no canonical value.
STAGE = {
    "Stage I": "I", "Stage IA": "IA", "Stage IB": "IB",
    "Stage II": "II", "Stage IIA": "IIA", "Stage IIB": "IIB",
    "Stage III": "III", "Stage IIIA": "IIIA", "Stage IIIB": "IIIB", "Stage IIIC": "IIIC",
    "Stage IV": "IV", "Stage X": None,
    "I": "I", "IA": "IA", "IB": "IB", "II": "II", "IIA": "IIA", "IIB": "IIB",
    "III": "III", "IIIA": "IIIA", "IIIB": "IIIB", "IIIC": "IIIC", "IV": "IV",
    "0": None, "1": "I", "2": "II", "3": "III", "4": "IV",
}

# Histology; anything else passes through.
HISTOLOGY = {
    "Infiltrating Ductal Carcinoma": "IDC", "Infiltrating Lobular Carcinoma": "ILC",
    "Medullary Carcinoma": "Medullary", "Metaplastic Carcinoma": "Metaplastic",
    "Mixed Histology (please specify)": "Mixed", "Mucinous Carcinoma": "Mucinous",
    "Other, specify": "Other",
    "Breast Invasive Ductal Carcinoma": "IDC", "Breast Invasive Lobular Carcinoma": "ILC",
    "Breast Mixed Ductal and Lobular Carcinoma": "Mixed",
    "Breast Invasive Mixed Mucinous Carcinoma": "Mucinous",
    "Invasive Ductal Carcinoma": "IDC", "Invasive Lobular Carcinoma": "ILC",
    "IDC": "IDC", "ILC": "ILC", "MIXED": "Mixed",
    "BREAST_METAPLASTIC_CARCINOMA": "Metaplastic", "BREAST_IDC_AND_ILC": "Mixed",
}

# Variant classification; anything else passes through.
VARIANT_CLASS = {
    "Missense_Mutation": "Missense_Mutation", "missense_variant": "Missense_Mutation",
    "Nonsense_Mutation": "Nonsense_Mutation", "stop_gained": "Nonsense_Mutation",
    "Frame_Shift_Del": "Frame_Shift_Del", "frameshift_variant": "Frame_Shift_Del",
    "Frame_Shift_Ins": "Frame_Shift_Ins",
    "Splice_Site": "Splice_Site", "splice_acceptor_variant": "Splice_Site",
    "splice_donor_variant": "Splice_Site",
    "In_Frame_Del": "In_Frame_Del", "inframe_deletion": "In_Frame_Del",
    "In_Frame_Ins": "In_Frame_Ins", "inframe_insertion": "In_Frame_Ins",
    "Translation_Start_Site": "Translation_Start_Site",
    "Nonstop_Mutation": "Nonstop_Mutation",
    "Silent": "Silent", "synonymous_variant": "Silent",
    "5'UTR": "5'UTR", "3'UTR": "3'UTR", "Intron": "Intron",
    "RNA": "RNA", "IGR": "IGR", "5'Flank": "5'Flank", "3'Flank": "3'Flank",
}

# Vital status.
VITAL_STATUS = {
    "Alive": "Alive", "alive": "Alive", "LIVING": "Alive", "Living": "Alive", "0": "Alive",
    "Dead": "Deceased", "dead": "Deceased", "Deceased": "Deceased", "DECEASED": "Deceased",
    "1": "Deceased", "Died of Disease": "Deceased", "Died of Other Causes": "Deceased",
}

# Recorded menopausal state of the panel cohort.
MENOPAUSE_STATE = {"Pre": "Pre", "Post": "Post", "pre": "Pre", "post": "Post"}

# Therapy type; anything else is "Other".
THERAPY_TYPE = {
    "Chemotherapy": "Chemotherapy", "Hormone Therapy": "Hormone Therapy",
    "Targeted Molecular therapy": "Targeted Therapy",
    "Immunotherapy": "Other", "Ancillary": "Other",
}

# Sample type codes of a barcode's fourth part.
SAMPLE_TYPE = {
    "01": "Primary Solid Tumor", "02": "Recurrent Solid Tumor",
    "06": "Metastatic", "10": "Blood Derived Normal", "11": "Solid Tissue Normal",
}

# Domains.
VARIANT_TYPES = ["SNP", "INS", "DEL", "DNP", "TNP", "ONP"]
GISTIC_VALUES = [-2, -1, 0, 1, 2]
RECEIVED_YES = ["YES", "1", "Y"]

# Mutation file headers and the names used from there on.
VARIANT_HEADERS = {
    "Hugo_Symbol": "gene", "Chromosome": "chr", "Start_Position": "start",
    "End_Position": "end", "Reference_Allele": "ref", "Tumor_Seq_Allele2": "alt",
    "Variant_Classification": "vclass", "Variant_Type": "vtype",
    "HGVSp_Short": "hgvsp", "HGVSp": "hgvsp_long",
    "Tumor_Sample_Barcode": "barcode", "SAMPLE_ID": "barcode",
    "t_alt_count": "t_alt", "t_ref_count": "t_ref", "t_depth": "t_depth",
}

# Sequencing panel used when no panel mutation file is at hand.
FALLBACK_PANEL = [
    "AKT1", "AKT2", "AKT3", "ARAF", "ARID1A", "ARID1B", "ARID2",
    "ATM", "ATR", "ATRX", "AXIN1", "BAP1", "BRAF", "BRCA1", "BRCA2",
    "CASP8", "CBFB", "CCND1", "CCNE1", "CDH1", "CDK12", "CDK4",
    "CDK6", "CDKN1A", "CDKN1B", "CDKN2A", "CDKN2B", "CEBPA",
    "CHD4", "CHEK2", "CIC", "CREBBP", "CTCF", "CTNNB1", "CUL3",
    "DAXX", "DDR2", "DNMT3A", "EGFR", "EP300", "ERBB2", "ERBB3",
    "ERBB4", "ESR1", "EZH2", "FAM46C", "FANCA", "FANCC", "FANCD2",
    "FANCI", "FAT1", "FBXW7", "FGFR1", "FGFR2", "FGFR3", "FLT3",
    "FOXA1", "FOXL2", "FOXP1", "GATA3", "GNA11", "GNA13", "GNAQ",
    "GNAS", "GPS2", "HGF", "HIST1H3B", "HNF1A", "HRAS", "IDH1",
    "IDH2", "IGF1R", "JAK1", "JAK2", "JAK3", "KDM5C", "KDM6A",
    "KIT", "KMT2A", "KMT2C", "KMT2D", "KRAS", "MAP2K1", "MAP2K2",
    "MAP2K4", "MAP3K1", "MAP3K13", "MDM2", "MDM4", "MED12", "MEN1",
    "MET", "MLH1", "MRE11", "MSH2", "MSH6", "MTOR", "MYC", "MYCN",
    "MYD88", "NBN", "NCOR1", "NF1", "NF2", "NFE2L2", "NOTCH1",
    "NOTCH2", "NOTCH3", "NOTCH4", "NPM1", "NRAS", "NSD1", "NTRK1",
    "NTRK3", "PALB2", "PBRM1", "PDGFRA", "PDGFRB", "PHF6", "PIK3CA",
    "PIK3CB", "PIK3R1", "PMS2", "POLD1", "POLE", "PPP2R1A", "PRDM1",
    "PTCH1", "PTEN", "PTPN11", "RAD21", "RAD50", "RAD51C", "RAF1",
    "RB1", "RHOA", "RICTOR", "RNF43", "RPTOR", "RUNX1", "SETD2",
    "SF3B1", "SMAD2", "SMAD3", "SMAD4", "SMARCA4", "SMARCB1",
    "SMO", "SOCS1", "SOX9", "SPOP", "SRC", "STAG2", "STK11",
    "TAF1", "TBX3", "TERT", "TET2", "TNFAIP3", "TP53", "TSC1",
    "TSC2", "U2AF1", "VHL", "WT1", "XBP1", "ZFP36L1",
]
