"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, then by all remaining columns.

    NULLs sort lowest, as in a descending ranking. The remaining columns make the choice
    total, so re-runs agree. Spark turns ``row_number() = 1`` into a per-task limit before
    the shuffle, so a key that holds a third of all rows sends one row per task.
    """
    rest = [c for c in df.columns if c not in {*keys, *order}]
    by = [F.col(c).desc_nulls_last() for c in [*order, *rest]]
    w = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def greatest_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: Sequence[str]
) -> DataFrame:
    """``values`` of the greatest row per key by aggregation, with partial results per task."""
    order = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    best = F.max(F.struct(*order, *values)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{v}").alias(v) for v in values])
