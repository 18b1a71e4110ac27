"""Text normalisation, classification patterns and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Call-driver classes in order of precedence, the bracket tag and the reference number.
CALL_DRIVERS = [
    ("BILLING", r"(?i)(bill|invoice|charge|refund)"),
    ("ACCESS", r"(?i)(password|login|locked|reset)"),
    ("RETENTION", r"(?i)(cancel|churn|retention)"),
]
DRIVER_TAG = r"^\[([A-Z]{2,5})\]"
DRIVER_OTHER = "OTHER"
EMBEDDED_REF = r"ref#(\d+)"


def upper_trim(col: str) -> Column:
    return F.upper(F.trim(F.col(col))).alias(col)


def first_group(col: Column, pattern: str) -> Column:
    """First capture group, NULL without a match (the pattern's group is never empty)."""
    return F.nullif(F.regexp_extract(col, pattern, 1), F.lit(""))


def call_driver(desc: Column) -> Column:
    (label, pattern), *rest = CALL_DRIVERS
    out = F.when(desc.rlike(pattern), label)
    for label, pattern in rest:
        out = out.when(desc.rlike(pattern), label)
    return out.otherwise(F.coalesce(first_group(desc, DRIVER_TAG), F.lit(DRIVER_OTHER)))


def json_key(col: Column | str, key: str) -> Column:
    """One key of a JSON object held as text."""
    return F.get_json_object(F.col(col) if isinstance(col, str) else col, f"$.{key}")


def utc_text(ts: Column) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss[.fff[fff]]+00``: the text that surrogate keys hash."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    fraction = (
        F.when(micros == 0, "")
        .when(micros % 1000 == 0, F.date_format(ts, ".SSS"))
        .otherwise(F.date_format(ts, ".SSSSSS"))
    )
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), fraction, F.lit("+00"))


def surrogate(*parts: Column) -> Column:
    """Lower-hex MD5 of the parts joined by ``|``; NULL if any part is NULL."""
    joined: list[Column] = []
    for i, part in enumerate(parts):
        joined += ([F.lit("|")] if i else []) + [part.cast("string")]
    return F.md5(F.concat(*joined))
