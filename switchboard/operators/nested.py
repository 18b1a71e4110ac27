"""Unnesting of arrays of structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, keep: Sequence[str], items: str, fields: Sequence[str]) -> DataFrame:
    """One row per array element with ``keep`` and the named element fields.

    Rows whose array is empty or NULL disappear, as in an inner unnest. The fields are picked
    as arrays of their own before they are unnested, so the scan reads no other field of the
    elements: message texts, most of a transcript's bytes, stay on disk.
    """
    picked = df.select(*keep, *[F.col(f"{items}.{f}").alias(f) for f in fields])
    return picked.select(*keep, F.inline(F.arrays_zip(*fields)))
