"""Tumour, patient and sample identifiers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identifier patterns.
LTX_PATIENT = r"^LTX\d+$"
CRUK_PATIENT = r"^CRUK\d+$"
CANONICAL_TUMOUR = r"^(LTX\d+)-Tumour(\d+)$"
UNDERSCORE_TUMOUR = r"^(LTX\d+)_tumour(\d+)$"
SAMPLE_NAME = r"^(LTX\d+)_([A-Z]+)_([^-]+(?:-[^-]+)?)--([0-9a-f]+)$"

# Patient part of every accepted spelling: -Tumour and -Cluster and bare
# underscore for both families, _tumour in any case for the LTX family.
_ANY_TUMOUR = (
    r"^((?:LTX|CRUK)\d+(?=-Tumour\d+$|-Cluster\d+$|_\d+$)"
    r"|(?i:LTX)\d+(?=(?i:_tumour)\d+$))\D+(\d+)$"
)


def _group(col: Column, pattern: str, index: int) -> Column:
    """Capture group, or null when the pattern does not match."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, index))


def _fail(message: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"{message}: "), value))


def canonical_tumour_id(col: Column) -> Column:
    """``LTX1_tumour2`` to ``LTX1-Tumour2``; every other value passes unchanged."""
    return F.regexp_replace(col, UNDERSCORE_TUMOUR, "$1-Tumour$2")


def strict_tumour_id(col: Column) -> Column:
    """As above in any letter case and without leading zeros; an unknown form fails."""
    loose = "(?i)" + UNDERSCORE_TUMOUR
    ordinal = F.regexp_extract(col, loose, 2).try_cast("bigint").cast("string")
    return (
        F.when(col.isNull() | col.rlike(CANONICAL_TUMOUR), col)
        .when(col.rlike(loose), F.concat(F.regexp_extract(col, loose, 1), F.lit("-Tumour"), ordinal))
        .otherwise(_fail("unrecognised tumour id", col).cast("string"))
    )


def parse_tumour_id(col: Column, strict: bool = True) -> Column:
    """Struct (patient, ordinal) from any of the seven accepted spellings.

    With ``strict`` an unknown form fails the job, otherwise both fields are null.
    """
    # Neither group is ever empty, so what does not match is told by the empty text without a match more.
    patient, ordinal = (F.nullif(F.regexp_extract(col, _ANY_TUMOUR, i), F.lit("")) for i in (1, 2))
    if strict:
        unknown = F.when(col.isNotNull(), _fail("unrecognised tumour id", col).cast("string"))
        patient = F.coalesce(patient, unknown)
    return F.struct(patient.alias("patient"), ordinal.cast("bigint").alias("ordinal"))


def patient_of(tumour_id: Column) -> Column:
    """Patient of a canonical tumour id; any other form fails."""
    return (
        F.when(tumour_id.isNull(), F.lit(None).cast("string"))
        .when(tumour_id.rlike(CANONICAL_TUMOUR), F.regexp_extract(tumour_id, CANONICAL_TUMOUR, 1))
        .otherwise(_fail("not a canonical tumour id", tumour_id).cast("string"))
    )


def ordinal_of(tumour_id: Column) -> Column:
    """Ordinal of a canonical tumour id; any other form fails."""
    return (
        F.when(tumour_id.isNull(), F.lit(None).cast("bigint"))
        .when(
            tumour_id.rlike(CANONICAL_TUMOUR),
            F.regexp_extract(tumour_id, CANONICAL_TUMOUR, 2).cast("bigint"),
        )
        .otherwise(_fail("not a canonical tumour id", tumour_id).cast("bigint"))
    )


def build_tumour_id(patient: Column, ordinal: Column) -> Column:
    """``LTX1`` and 2 to ``LTX1-Tumour2``; null if either part is."""
    return F.concat(patient, F.lit("-Tumour"), ordinal.cast("string"))


def emit_tumour_id(patient: Column, ordinal: Column, convention: str) -> Column:
    """A tumour id in the ``ltx`` or the ``cruk`` convention."""
    if convention == "ltx":
        return build_tumour_id(patient, ordinal)
    if convention == "cruk":
        return F.concat(patient, F.lit("_"), ordinal.cast("string"))
    raise ValueError(f"id convention must be 'ltx' or 'cruk', got {convention!r}")


def trimmed(col: Column) -> Column:
    """Strip any Unicode white space at both ends."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def parse_sample_name(col: Column) -> Column:
    """Struct of the parts of a hashed sample name; all null when it does not parse.

    A tumour region code is ``T<n>-R<n>``. If its second half is not a number the
    first is still kept; if its first half is not a number both are null.
    """
    matched = col.rlike(SAMPLE_NAME)
    region_code = _group(col, SAMPLE_NAME, 3)
    is_normal = region_code.startswith("N")
    halves = F.split(region_code, "-", 2)

    def number(index: int) -> Column:
        return F.substr(F.get(halves, F.lit(index)), F.lit(2)).try_cast("int")

    paired = matched & ~is_normal & region_code.contains("-")
    tumour = F.when(paired, number(0))
    return F.struct(
        _group(col, SAMPLE_NAME, 1).alias("patient_id"),
        _group(col, SAMPLE_NAME, 2).alias("sample_type"),
        region_code.alias("region_code"),
        F.when(matched, is_normal).alias("is_normal"),
        tumour.alias("tumour_ordinal"),
        F.when(tumour.isNotNull(), number(1)).alias("region_ordinal"),
    )
