"""Ranks over a whole table without moving it into one task.

``ROW_NUMBER() OVER (ORDER BY x)`` has no partition key. Here Spark range-partitions the rows
by the order, each range is numbered by itself, and the rows before it are added. The
numbered ranges are written to the shared folder first: range bounds are sampled, so they
must not be drawn a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from switchboard.operators.skew import spread_join
from switchboard.session import store

# monotonically_increasing_id() holds the partition above, the row in it below this bit.
ROW_BITS = 33


def ascending(col: str) -> list[Column]:
    """Sort parts for ``ORDER BY col ASC``: NULL first."""
    return [F.col(col).isNotNull().alias(f"_known_{col}"), F.col(col).alias(f"_{col}")]


def descending(col: str) -> list[Column]:
    """Sort parts for ``ORDER BY col DESC`` of a numeric column: NULL last."""
    return [F.col(col).isNull().alias(f"_null_{col}"), (-F.col(col)).alias(f"_{col}")]


def row_positions(df: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """Add the 1-based position and ``<out>_total``; ``order`` must identify each row."""
    rows = _ranges(df.withColumn("_k", F.struct(*order)))
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("rows"), F.count(F.lit(1)).alias("keys"))
    return (
        _with_offsets(rows, sizes)
        .withColumn(out, F.col("_rows_before") + F.col("_in") + 1)
        .withColumn(f"{out}_total", F.col("_total"))
        .drop("_k", "_range", "_in", "_rows_before", "_keys_before", "_total")
    )


def tie_ranks(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Add ``<out>`` (rank), ``<out>_dense`` and ``<out>_total``; equal keys share a rank.

    Ranks are computed once per distinct key and joined back, so rows that all tie cost one
    ranked row, and the join back spreads a key that holds many rows.
    """
    df = df.withColumn("_k", F.struct(*order))
    groups = _ranges(df.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")))
    sizes = groups.groupBy("_range").agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("keys"))
    earlier = Window.partitionBy("_range").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    placed = _with_offsets(groups, sizes).select(
        "_k",
        (F.col("_rows_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)) + 1).alias(out),
        (F.col("_keys_before") + F.col("_in") + 1).alias(f"{out}_dense"),
        F.col("_total").alias(f"{out}_total"),
    )
    return spread_join(df, placed, "_k", how="inner").drop("_k")


def percent_rank(rank: Column, total: Column) -> Column:
    return F.when(total > 1, (rank - 1) / (total - 1)).otherwise(F.lit(0.0))


def ntile(tiles: int, position: Column, total: Column) -> Column:
    """Tile of a 1-based position: the first ``total % tiles`` tiles hold one row more."""
    size, extra = F.floor(total / tiles), total % tiles
    wide = extra * (size + 1)
    narrow = extra + 1 + F.floor((position - 1 - wide) / F.nullif(size, F.lit(0)))
    return F.when(position <= wide, F.floor((position - 1) / (size + 1)) + 1).otherwise(narrow).cast("long")


def ordered_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` written in ``order``: its range ``_range`` and its 0-based row ``_in`` there.

    Rows that tie share a range and stand in any order.
    """
    key = [c.alias(f"_{n}") for n, c in enumerate(order)]
    return _ranges(df.withColumn("_k", F.struct(*key))).drop("_k")


def _ranges(keyed: DataFrame) -> DataFrame:
    """``keyed`` written in ``_k`` order: its range ``_range`` and its 0-based row ``_in`` there."""
    numbered = (
        keyed.repartitionByRange("_k")
        .sortWithinPartitions("_k")
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_id", ROW_BITS))
        .withColumn("_in", F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
        .drop("_id")
    )
    return store(numbered, "ranges")


def _with_offsets(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Add the rows and keys of all earlier ranges and the total: one small row per range."""
    spark = rows.sparkSession
    sizes = sorted(sizes.select("_range", "rows", "keys").collect())
    total, before, seen_rows, seen_keys = sum(s.rows for s in sizes), [], 0, 0
    for size in sizes:
        before.append((size["_range"], seen_rows, seen_keys, total))
        seen_rows, seen_keys = seen_rows + size.rows, seen_keys + size["keys"]
    schema = "_range long, _rows_before long, _keys_before long, _total long"
    return rows.join(F.broadcast(spark.createDataFrame(before, schema)), "_range")
