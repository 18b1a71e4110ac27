"""Ordered string aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.operators.orders import in_ranges


def ordered_join(
    df: DataFrame,
    keys: Sequence[str],
    millis: str,
    text: str,
    sep: str,
    out: str,
    *,
    also: Sequence[Column] = (),
) -> DataFrame:
    """Texts of a key in (``millis``, text) order, joined by ``sep``; NULL texts are skipped.

    ``also`` lists further aggregates of the same groups. Rows are range-partitioned by key and
    order; each range joins its own part of a key, and one part per range is left to concatenate,
    so no task gathers the rows of a key.
    """
    rows = in_ranges(df.select(*keys, millis, text), [F.col(c) for c in (*keys, millis, text)])
    parts = rows.groupBy(*keys, "_range").agg(_join(millis, text, sep).alias("_part"))
    whole = parts.groupBy(*keys).agg(_join("_range", "_part", sep).alias(out))
    return same_groups(whole, df.groupBy(*keys).agg(*also), keys) if also else whole


def same_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join of two results grouped by the same keys; NULL keys match."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(right, cond).drop(*[f"_r_{k}" for k in keys])


def _join(order: str, text: str, sep: str) -> Column:
    known = F.collect_list(F.when(F.col(text).isNotNull(), F.struct(order, text)))
    texts = F.transform(F.sort_array(known), lambda s: s[text])
    return F.when(F.count(text) > 0, F.array_join(texts, sep))
