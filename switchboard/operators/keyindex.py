"""An index from key to partition beside a change-merged table.

Each key has one entry: the partition that holds it, the time of its last change, and whether that
change deleted it, so an older change that comes late finds the deletion. Entries lie in hash buckets
of the key. A merge looks up the keys that arrive in their buckets and appends a generation with
their new entries; the newest generation counts per key. After ``GENERATIONS`` of them all are
written anew as one, so neither lookups nor deletions grow with the number of runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchboard.operators import files
from switchboard.operators.buckets import BUCKETS, bucket_of, met_by
from switchboard.operators.dedup import greatest_by

NOTES = "_index"
GENERATIONS = 8
VALUES = ["_part", "_change_ms", "_dead"]


def exists(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path}/{NOTES}")


def find(spark: SparkSession, path: str, keys: DataFrame, key_fields: Sequence[T.StructField], part: T.DataType) -> DataFrame:
    """Entries of the ``keys`` (distinct): the key, ``_part``, ``_change_ms`` and ``_dead``."""
    pk = [f.name for f in key_fields]
    _, note = files.newest(spark, f"{path}/{NOTES}", "table")
    rows = _entries(spark, path, note, key_fields, part)
    met = met_by(keys, pk, note["buckets"]) if note else set()
    own = keys.select(*[F.col(k).alias(f"_{k}") for k in pk])
    same = F.lit(True)
    for k in pk:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    hit = rows.where(F.col("bucket").isin(sorted(met))).join(own, same, "left_semi")
    return greatest_by(hit, pk, [F.col("generation")], VALUES)


def append(entries: DataFrame, path: str, key_fields: Sequence[T.StructField], part: T.DataType) -> None:
    """Add a generation; the entries of many generations become one."""
    spark, pk = entries.sparkSession, [f.name for f in key_fields]
    number, note = files.newest(spark, f"{path}/{NOTES}", "table")
    buckets = note.get("buckets", BUCKETS)
    listed = note.get("generations", [])
    name = f"g{uuid.uuid4().hex[:12]}"
    rows = entries.select(*pk, *VALUES)
    if len(listed) + 1 >= GENERATIONS:
        old = _entries(spark, path, note, key_fields, part).select(*pk, *VALUES, "generation")
        both = old.unionByName(rows.withColumn("generation", F.lit(len(listed))))
        rows, listed = greatest_by(both, pk, [F.col("generation")], VALUES), []
    rows = rows.withColumn("bucket", bucket_of(pk, buckets))
    rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *pk).write.partitionBy("bucket").parquet(f"{path}/name={name}")
    files.publish(spark, f"{path}/{NOTES}", "table", number + 1, {"buckets": buckets, "generations": [*listed, name]})
    used = {f"name={g}" for g in [*listed, name, *note.get("generations", [])]}
    for old in files.children(spark, path):
        if old.startswith("name=") and old not in used:
            files.remove(spark, f"{path}/{old}")


def _entries(spark: SparkSession, path: str, note: dict, key_fields: Sequence[T.StructField], part: T.DataType) -> DataFrame:
    """All entries with their bucket and the number of their generation, the oldest first."""
    fields = [T.StructField("_part", part), T.StructField("_change_ms", T.LongType()), T.StructField("_dead", T.BooleanType())]
    stored = T.StructType([*key_fields, *fields, T.StructField("name", T.StringType()), T.StructField("bucket", T.IntegerType())])
    listed = note.get("generations", [])
    if not listed:
        return spark.createDataFrame([], stored).withColumn("generation", F.lit(0))
    rows = spark.read.schema(stored).option("basePath", path).parquet(*[f"{path}/name={g}" for g in listed])
    return rows.withColumn("generation", F.array_position(F.array(*[F.lit(g) for g in listed]), F.col("name")).cast("int") - 1)
