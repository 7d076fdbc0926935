"""Scalar harmonization functions (H1-H30, B10-B13) as Column -> Column helpers.

All of them are built-in expressions, so they stay in the JVM and fuse into the
scan stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from . import vocab

# Every character a text trim removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITE = r"(?i)^[+-]?inf(inity)?$"
NOT_A_NUMBER = r"(?i)^[+-]?nan$"
UNKNOWN = "Unknown"

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(c: ColumnOrName, mapping: dict) -> Column:
    """C11: value -> canonical value, null when unlisted. For fixed vocabularies."""
    table = ", ".join(_sql_text(x) for pair in mapping.items() for x in pair)
    return F.try_element_at(F.expr(f"map({table})"), _col(c))


def _sql_text(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def clean_text(c: ColumnOrName) -> Column:
    """H1: trim, then null for every sentinel."""
    s = F.btrim(_col(c), F.lit(WHITESPACE))
    return F.when(~s.isin(vocab.NULL_SENTINELS), s)


def parse_double(c: ColumnOrName) -> Column:
    """Text -> double, null when it is no number. NaN and infinities are numbers."""
    s = _col(c)
    return (
        F.when(s.rlike(DECIMAL) | s.rlike(INFINITE), s.try_cast("double"))
        .when(s.rlike(NOT_A_NUMBER), F.lit(float("nan")))
    )


def parse_long(c: ColumnOrName) -> Column:
    """Text -> bigint for whole numbers only ("1.0" is null)."""
    s = _col(c)
    return F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("bigint"))


def clean_double(c: ColumnOrName) -> Column:
    """H2: clean, then parse; digit groups may be joined by underscores."""
    return parse_double(F.regexp_replace(clean_text(c), "(?<=[0-9])_(?=[0-9])", ""))


def to_long(number: Column) -> Column:
    """Truncate a double toward zero; NaN and infinities give null."""
    return number.try_cast("bigint")


def clean_long(c: ColumnOrName) -> Column:
    """H3: parse as a double, then truncate ("3.7" -> 3)."""
    return to_long(clean_double(c))


def clean_int(c: ColumnOrName) -> Column:
    return clean_long(c).try_cast("int")


def months_of_days(days: Column) -> Column:
    """H4 on a number."""
    return F.round(days / F.lit(vocab.DAYS_PER_MONTH), 2)


def days_to_months(c: ColumnOrName) -> Column:
    """H4 on text."""
    return months_of_days(clean_double(c))


def normalize_subtype(c: ColumnOrName) -> Column:
    """H5"""
    return F.coalesce(lookup(clean_text(c), vocab.PAM50), F.lit(UNKNOWN))


def normalize_receptor(c: ColumnOrName) -> Column:
    """H6: exact key, then capitalised key, then Unknown."""
    s = clean_text(c)
    return F.coalesce(
        lookup(s, vocab.RECEPTOR_STATUS),
        lookup(F.initcap(s), vocab.RECEPTOR_STATUS),
        F.lit(UNKNOWN),
    )


def triple_negative(er: ColumnOrName, pr: ColumnOrName, her2: ColumnOrName) -> Column:
    """H7: null when any is Unknown, 1 when all are Negative, else 0."""
    statuses = [_col(er), _col(pr), _col(her2)]
    any_unknown = reduce(lambda a, b: a | b, [s.eqNullSafe(UNKNOWN) for s in statuses])
    all_negative = reduce(lambda a, b: a & b, [s.eqNullSafe("Negative") for s in statuses])
    return F.when(~any_unknown, all_negative.cast("int"))


def normalize_stage(c: ColumnOrName) -> Column:
    """H8: exact key, then upper-case key, else null."""
    s = clean_text(c)
    return F.coalesce(lookup(s, vocab.STAGE), lookup(F.upper(s), vocab.STAGE))


def normalize_histology(c: ColumnOrName) -> Column:
    """H9: unlisted values pass through."""
    s = clean_text(c)
    return F.coalesce(lookup(s, vocab.HISTOLOGY), s)


def normalize_variant_class(c: ColumnOrName) -> Column:
    """Unlisted values pass through."""
    s = clean_text(c)
    return F.coalesce(lookup(s, vocab.VARIANT_CLASS), s)


def menopause_by_age(age: Column) -> Column:
    """Age in years as a double."""
    return (
        F.when(age.isNull() | F.isnan(age), UNKNOWN)
        .when(age < vocab.MENOPAUSE_AGE_CUTOFF, "Pre")
        .otherwise("Post")
    )


def normalize_menopause(c: ColumnOrName) -> Column:
    """Verbose clinical text, blank -> null."""
    s = F.lower(clean_text(c))
    return (
        F.when(s.startswith("pre"), "Pre")
        .when(s.startswith("post"), "Post")
        .when(s.startswith("peri"), "Peri")
        .when(s.isNotNull(), UNKNOWN)
    )


def menopause_state_or_age(state: ColumnOrName, age: Column) -> Column:
    """Recorded state if any text is there, else by age."""
    s = clean_text(state)
    recorded = F.coalesce(lookup(s, vocab.MENOPAUSE_STATE), F.lit(UNKNOWN))
    return F.when(s.isNotNull(), recorded).otherwise(menopause_by_age(age))


def normalize_vital(c: ColumnOrName) -> Column:
    """H12"""
    return lookup(clean_text(c), vocab.VITAL_STATUS)


def vital_of_event(event: Column) -> Column:
    """1 -> Deceased, 0 -> Alive."""
    return F.when(event == 1, "Deceased").when(event == 0, "Alive")


def event_of_vital(vital: Column) -> Column:
    return F.when(vital == "Deceased", 1).when(vital == "Alive", 0)


def node_score(nodes: Column) -> Column:
    return F.when(nodes == 0, 1).when(nodes <= 3, 2).otherwise(3)


def prognostic_index(size_cm: Column, grade: Column, nodes: Column) -> Column:
    """0.2 * size + grade + node score, null if any is missing."""
    known = size_cm.isNotNull() & ~F.isnan(size_cm) & grade.isNotNull() & nodes.isNotNull()
    return F.when(known, F.round(F.lit(0.2) * size_cm + grade + node_score(nodes), 2))


def given_or_computed_index(given: Column, size_cm: Column, grade: Column, nodes: Column) -> Column:
    """The given index unless it is missing or 0."""
    return F.when(given.isNotNull() & (given != 0), given).otherwise(
        prognostic_index(size_cm, grade, nodes)
    )


def parse_barcode(barcode: ColumnOrName) -> Column:
    """Struct of the parts of a hyphenated sample barcode."""
    b = _col(barcode)
    parts = F.split(b, "-")
    full = F.size(parts) >= 4
    code = F.substring(F.get(parts, F.lit(3)), 1, 2)
    patient = F.substring_index(b, "-", 3)
    kind = F.coalesce(
        lookup(code, vocab.SAMPLE_TYPE), F.concat(F.lit("Unknown ("), code, F.lit(")"))
    )
    return F.struct(
        b.alias("barcode"),
        patient.alias("patient_id"),
        F.when(full, code).alias("sample_type_code"),
        F.when(full, kind).alias("sample_type"),
        F.when(full, F.substring_index(b, "-", 4)).otherwise(patient).alias("tumor_id"),
    )


def barcode_patient(barcode: ColumnOrName) -> Column:
    return F.substring_index(_col(barcode), "-", 3)


def primary_tumor_id(barcode: ColumnOrName) -> Column:
    """Every sample of a patient maps to the patient's primary tumor."""
    return F.concat(barcode_patient(barcode), F.lit("-01"))


def survival_status(c: ColumnOrName) -> Column:
    """struct(event, vital) of an overall-survival status text."""
    raw = F.coalesce(_col(c), F.lit(""))
    dead = F.upper(raw).contains("DECEASED") | raw.startswith("1")
    alive = F.upper(raw).contains("LIVING") | raw.startswith("0")
    event = F.when(dead, 1).when(alive, 0)
    return F.struct(event.alias("event"), vital_of_event(event).alias("vital"))


def recurrence_event(c: ColumnOrName) -> Column:
    """The negative wording contains the positive one, so it is tested first."""
    raw = _col(c)
    return (
        F.when(raw.contains("Not Recurred") | raw.startswith("0"), 0)
        .when(raw.contains("Recurred") | raw.startswith("1"), 1)
    )


def follow_up_months(event: Column, death_days: Column, contact_days: Column) -> Column:
    """Death days for the dead (0 counts as missing), else last contact."""
    use_death = (event == 1) & death_days.isNotNull() & (death_days != 0)
    return months_of_days(F.when(use_death, death_days).otherwise(contact_days))


def mm_to_cm(mm: Column) -> Column:
    """H21"""
    return mm / F.lit(10.0)


def therapy_type(c: ColumnOrName) -> Column:
    """H24"""
    return F.coalesce(lookup(clean_text(c), vocab.THERAPY_TYPE), F.lit("Other"))


def received_flag(c: ColumnOrName) -> Column:
    """1 or 0, null for blank."""
    return F.upper(clean_text(c)).isin(vocab.RECEIVED_YES).cast("int")


def float_ratio(num: Column, den: Column) -> Column:
    """Division of doubles with float rules: x/0 is infinite, 0/0 is missing."""
    by_zero = F.when(num > 0, F.lit(float("inf"))).when(num < 0, F.lit(float("-inf")))
    ratio = F.when(den == 0, by_zero).otherwise(F.try_divide(num, den))
    return F.when(~F.isnan(ratio), ratio)


def allele_frequency(columns: list[str]) -> Column:
    """Alt / depth, else alt / (alt + ref); chosen by the columns present."""
    alt = parse_double("t_alt") if "t_alt" in columns else None
    if alt is not None and "t_depth" in columns:
        return float_ratio(alt, parse_double("t_depth"))
    if alt is not None and "t_ref" in columns:
        return float_ratio(alt, alt + parse_double("t_ref"))
    return F.lit(None).cast("double")


def entrez_id(c: ColumnOrName) -> Column:
    """Through a double, so "7157.0" is 7157."""
    return to_long(parse_double(c))


def first_nonblank(*cols: ColumnOrName) -> Column:
    """First raw text that is not null and not ''; "NA" counts as text."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cols], F.lit(""))


def first_clean(*cols: ColumnOrName) -> Column:
    """B11"""
    return F.coalesce(*[clean_text(c) for c in cols])


def known_or(primary: Column, secondary: Column) -> Column:
    """Fall back when the primary value is Unknown."""
    return F.when(primary != UNKNOWN, primary).otherwise(F.coalesce(secondary, F.lit(UNKNOWN)))


def resolve_equivocal(status: Column, assay: Column) -> Column:
    """An Equivocal status takes the second assay's clear result."""
    decided = (status == "Equivocal") & assay.isin("Positive", "Negative")
    return F.when(decided, assay).otherwise(status)


def in_domain(c: ColumnOrName, values: list) -> Column:
    """Values outside the domain become null, the row stays."""
    return F.when(_col(c).isin(values), _col(c))


def valid_symbol(c: ColumnOrName) -> Column:
    """B3"""
    return _col(c).isNotNull() & ~_col(c).isin(vocab.INVALID_SYMBOLS)
