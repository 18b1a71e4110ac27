"""Joins that stay balanced when one key, or NULL, holds a large share of the rows.

Adaptive execution measures the shuffled partitions of a join and splits those that are much
larger than the others: on either side of an inner join, on the left side of a left join. The
forms below arrange the joins so that the large side is one that can be split, at any size and
without a list of hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_join(left: DataFrame, right: DataFrame, key: str, *, how: str = "left") -> DataFrame:
    """Equi join of two large tables on ``key``; left rows with a NULL key are spread."""
    return lookup(left, right, key) if how == "left" else left.join(right, key, how)


def join_many(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join to a table that may repeat a key very often.

    The right side of a left join cannot be split. The matches are therefore an inner join,
    whose sides both can, and left rows without a match are added. Both joins ask for the same
    rows of the left side, so Spark shuffles it once: key and salt are one value, which is never
    NULL itself, as a filter for one of the joins alone would make two inputs of it.
    """
    lhs = left.withColumn("_at", F.struct(F.col(key).alias("key"), _salt(left, key).alias("salt")))
    known = right.where(F.col(key).isNotNull())
    rhs = known.withColumn("_to", F.struct(F.col(key).alias("key"), F.lit(0).cast("long").alias("salt"))).drop(key)
    matched = lhs.join(rhs, F.col("_at") == F.col("_to")).drop("_at", "_to")
    keys = rhs.select("_to").distinct().withColumn("_met", F.lit(True))
    alone = lhs.join(keys, F.col("_at") == F.col("_to"), "left").where("_met is null").drop("_at", "_to", "_met")
    return matched.unionByName(alone, allowMissingColumns=True)


def lookup(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Left join of a fact to a dimension.

    Whether the dimension is broadcast is left to Spark, which checks its size. If it is
    not, fact rows without a key are spread by a hash of the row instead of meeting in one
    task, and adaptive execution splits the partitions of hot keys by their measured size.
    """
    lhs = fact.withColumn("_salt", _salt(fact, key))
    rhs = dim.withColumnRenamed(dim_key or key, "_dim_key").withColumn("_dim_salt", F.lit(0).cast("long"))
    on = (lhs[key] == rhs["_dim_key"]) & (lhs["_salt"] == rhs["_dim_salt"])
    return lhs.join(rhs, on, "left").drop("_dim_key", "_dim_salt", "_salt")


def _salt(rows: DataFrame, key: str) -> Column:
    """A hash of the row where it has no key, else 0."""
    spread = F.xxhash64(*[c for c in rows.columns if c != key])
    return F.when(F.col(key).isNull(), spread).otherwise(F.lit(0))
