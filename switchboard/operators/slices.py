"""Ordered per-key computations whose tasks don't depend on the size of any key.

A window over ``PARTITION BY key`` puts every row of a key, NULL included, into one task. Here rows are
put in ranges of key and time (``orders``), so a key fills as many ranges as it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchboard.operators.orders import Given, in_ranges, neighbour, running_sum

__all__ = ["count_following", "neighbour"]


def count_following(
    df: DataFrame,
    key: str,
    start: str,
    end: str,
    horizon_seconds: int,
    carry: Sequence[str],
    *,
    asks: str | None = None,
    bounds: Given = None,
) -> DataFrame:
    """For each row, the number of rows of the same key that start in ``(end, end + horizon]``.

    This is the size of the interval self-join without its pairs. Starts are points and a
    question has two marks, at ``end`` and at the horizon. In the order of key and time, the
    points up to the second mark less those up to the first are the answer, whatever comes
    before, so one running count over the whole order serves all keys. The result has the
    key, ``end``, ``carry``, ``matches`` and ``rows``, the number of input rows an answer stands for.
    ``asks`` is an optional boolean column: only rows where it holds are answered, all rows are
    counted. A NULL key or NULL ``end`` matches nothing.
    """
    micros = horizon_seconds * 1_000_000
    asked = F.coalesce(F.col(asks), F.lit(False)) if asks else F.lit(True)
    timed = df.select(key, *carry, asked.alias("_asks"), F.unix_micros(start).alias("_s"), F.unix_micros(end).alias("_t"))
    open_ended = F.col(key).isNull() | F.col("_t").isNull()
    nothing = timed.where(F.col("_asks") & open_ended).select(
        key, "_t", *carry, F.lit(1).cast("long").alias("rows"), F.lit(0).cast("long").alias("matches")
    )
    keyed = timed.where(F.col(key).isNotNull())
    # Rows that start together, and questions that agree, are merged before anything is shuffled by time.
    points = keyed.where(F.col("_s").isNotNull()).groupBy(key, F.col("_s").alias("_at")).agg(F.count(F.lit(1)).alias("_w"))
    questions = keyed.where(F.col("_asks") & F.col("_t").isNotNull())
    questions = questions.groupBy(key, "_t", *carry).agg(F.count(F.lit(1)).alias("rows"))
    ends = F.array(
        F.struct(F.col("_t").alias("_at"), F.lit(-1).alias("_sign")),
        F.struct((F.col("_t") + micros).alias("_at"), F.lit(1).alias("_sign")),
    )
    marks = points.unionByName(questions.select("*", F.inline(ends)), allowMissingColumns=True)
    rows = in_ranges(marks, [F.col(key), F.col("_at"), F.col("rows").isNotNull()], bounds)
    answered = running_sum(rows, "_w", "_seen").where(F.col("rows").isNotNull())
    matches = F.sum(F.col("_sign") * F.col("_seen")).cast("long").alias("matches")
    answers = answered.groupBy(key, "_t", *carry, "rows").agg(matches).select(key, "_t", *carry, "rows", "matches")
    return nothing.unionByName(answers).withColumn(end, F.timestamp_micros("_t")).drop("_t")
