"""Change-feed merge and latest-wins upsert into a current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.operators.dedup import greatest_by

DELETED = "D"


def delta_merge(current: DataFrame | None, delta: DataFrame, pk: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """State after applying a change feed to ``current``.

    ``delta`` holds the target columns plus ``op`` and ``change_ms``; ``current`` has the
    target columns with ``last_change_ts``. The last change per key wins, ties fall to the
    greatest row; a key whose last change is a delete disappears. The state and the feed are
    reduced together by one aggregation with partial results, so a key that changes all the
    time costs one row per task.
    """
    changes = delta.withColumn("last_change_ts", F.timestamp_millis("change_ms"))
    fields = [*columns, "op", "change_ms"]
    changes = changes.select(fields)
    if current is not None:
        state = current.withColumn("op", F.lit("")).withColumn("change_ms", F.unix_millis("last_change_ts"))
        changes = state.select(fields).unionByName(changes)
    rest = [c for c in columns if c not in pk]
    order = [F.col("change_ms"), F.col("op"), *[F.col(c) for c in rest]]
    last = greatest_by(changes, pk, order, [*rest, "op"])
    return last.where(F.coalesce(F.col("op"), F.lit("")) != DELETED).select(*columns)


def upsert(current: DataFrame | None, incoming: DataFrame, pk: Sequence[str], version: str) -> DataFrame:
    """Latest-wins upsert: per key the row with the greatest ``version``, then the greatest row.

    Both inputs have the same columns. Rows that only ``current`` has are kept.
    """
    rows = incoming if current is None else current.select(incoming.columns).unionByName(incoming)
    rest = [c for c in incoming.columns if c not in pk]
    order = [F.col(version), *[F.col(c) for c in rest if c != version]]
    return greatest_by(rows, pk, order, rest).select(incoming.columns)
