"""Masters in hash buckets of their key: a delivery reads and rewrites only the buckets it meets.

Each bucket lies in the folder of the version that wrote it last. A note names that version per
bucket, so a merge becomes visible at once and a reader never sees half of it. The number of
buckets is fixed when a table is first written and is part of the note.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchboard.operators import files

NOTES = "_buckets"
BUCKETS = 64


def is_bucketed(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path}/{NOTES}")


def bucket_of(pk: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*pk), F.lit(buckets)).cast("int")


def read(spark: SparkSession, path: str, schema: T.StructType, only: set[int] | None = None) -> DataFrame:
    """The rows of all buckets, or of some."""
    _, note = files.newest(spark, f"{path}/{NOTES}", "table")
    at = {int(b): v for b, v in note.get("versions", {}).items() if only is None or int(b) in only}
    if not at:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/version={v}/bucket={b}" for b, v in sorted(at.items())]
    stored = T.StructType([*schema.fields, T.StructField("version", T.StringType()), T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(stored).option("basePath", path).parquet(*folders).select(*schema.names)


def number_of(spark: SparkSession, path: str, default: int = BUCKETS) -> int:
    return files.newest(spark, f"{path}/{NOTES}", "table")[1].get("buckets", default)


def met_by(keys: DataFrame, pk: Sequence[str], buckets: int) -> set[int]:
    """Buckets of the keys: at most as many numbers as there are buckets."""
    return {b for (b,) in keys.select(bucket_of(pk, buckets).alias("b")).distinct().collect()}


def merge(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pk: Sequence[str],
    keys: DataFrame,
    change: Callable[[DataFrame, set[int]], DataFrame],
    buckets: int = BUCKETS,
) -> set[int]:
    """Replace the rows of the buckets that ``keys`` meet by ``change`` of these rows; returns the buckets.

    ``change`` gets the stored rows and the buckets, and returns the new rows of the same buckets.
    """
    buckets = number_of(spark, path, buckets)
    met = met_by(keys, pk, buckets)
    if not met:
        return met
    number, note = files.newest(spark, f"{path}/{NOTES}", "table")
    rows = change(read(spark, path, schema, met), met).select(*schema.names).withColumn("bucket", bucket_of(pk, buckets))
    version = f"v{uuid.uuid4().hex[:12]}"
    laid = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *pk)
    laid.write.partitionBy("bucket").parquet(f"{path}/version={version}")
    made = {n.split("=")[1] for n in files.children(spark, f"{path}/version={version}") if n.startswith("bucket=")}
    versions = {b: v for b, v in note.get("versions", {}).items() if int(b) not in met}
    versions |= {b: version for b in made}
    files.publish(spark, f"{path}/{NOTES}", "table", number + 1, {"buckets": buckets, "versions": versions})
    # What neither this note nor the one before it names goes.
    used = {*versions.values(), *note.get("versions", {}).values(), version}
    for old in files.children(spark, path):
        if old.startswith("version=") and old.split("=")[1] not in used:
            files.remove(spark, f"{path}/{old}")
    return met
