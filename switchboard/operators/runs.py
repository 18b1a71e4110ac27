"""Partitioned tables that know which run delivered which rows.

A run's rows lie in a folder of their own, by partition value, and a note names the folder that
counts. A run that is repeated writes a new folder and then a new note: from that moment its new
rows replace its old ones in *every* partition, also where the new ones have none. Runs of
different dates never touch each other's folders or notes, so they may be run in any order, again,
or at the same time, and the table only depends on what each run delivered last.

Where several runs delivered rows of one partition, the row of a key that the latest run date
delivered is the one that is seen. Partitions with rows of one run are read as they lie; of the
others only the few rows of later runs are shuffled.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchboard.operators import files
from switchboard.operators.dedup import greatest_by
from switchboard.operators.layout import NULL, Value, balanced, folder_value, lay_out, on_disk
from switchboard.schemas import TABLES, Table
from switchboard.session import store

NOTES = "_runs"
FOLDERS = [T.StructField("run", T.DateType()), T.StructField("attempt", T.StringType())]


def spec_of(table: str | Table) -> Table:
    return TABLES[table] if isinstance(table, str) else table


def is_stored_by_run(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path}/{NOTES}")


def deliver(df: DataFrame, path: str, table: str | Table, run: dt.date) -> set[Value]:
    """Store the rows of ``run`` and return the partitions that may look different from before."""
    spark, spec, name = df.sparkSession, spec_of(table), run.isoformat()
    if not is_stored_by_run(spark, path) and files.children(spark, path):
        raise ValueError(f"{path} holds a table that was not stored by run")
    number, before = files.newest(spark, f"{path}/{NOTES}", name)
    attempt = f"a{uuid.uuid4().hex[:12]}"
    folder = f"{path}/run={name}/attempt={attempt}"
    rows = spec.conform(df)
    # Cluster keys need sampled ranges: the rows are then written first, so that their query runs once.
    laid = lay_out(store(rows, f"run-{spec.name}"), spec) if spec.cluster else balanced(rows, spec)
    laid.write.partitionBy(spec.partition).parquet(folder)
    parts = [n for n in files.children(spark, folder) if n.startswith(f"{spec.partition}=")]
    files.publish(spark, f"{path}/{NOTES}", name, number + 1, {"attempt": attempt, "partitions": parts})
    # Readers of the attempt before this one may go on; older ones go.
    for old in files.children(spark, f"{path}/run={name}"):
        if old not in (f"attempt={attempt}", f"attempt={before.get('attempt')}"):
            files.remove(spark, f"{path}/run={name}/{old}")
    return {folder_value(spec, n) for n in {*parts, *before.get("partitions", [])}}


def notes(spark: SparkSession, path: str) -> dict[str, dict]:
    """Per run date: the attempt that counts and the partitions it holds. One short note per run."""
    names = sorted({n.rsplit("~", 1)[0] for n in files.children(spark, f"{path}/{NOTES}")})
    return {name: files.newest(spark, f"{path}/{NOTES}", name)[1] for name in names}


def visible(spark: SparkSession, path: str, table: str | Table) -> DataFrame:
    """The table: per partition and key the row that the latest run date delivered."""
    spec = spec_of(table)
    holders: dict[str, list[str]] = {}
    for name, note in notes(spark, path).items():
        for part in note["partitions"]:
            holders.setdefault(part, []).append(f"{path}/run={name}/attempt={note['attempt']}/{part}")
    alone = [f[0] for f in holders.values() if len(f) == 1]
    parts = [_read(spark, path, spec, alone)] if alone or not holders else []
    for unknown in (False, True):
        shared = [f for part, f in holders.items() if len(f) > 1 and part.endswith(NULL) == unknown]
        if shared:
            first = _read(spark, path, spec, [f[0] for f in shared])
            parts += _resolved(first, _read(spark, path, spec, [folder for f in shared for folder in f[1:]]), spec, unknown)
    return reduce(DataFrame.unionByName, [spec.conform(part) for part in parts])


def _resolved(first: DataFrame, later: DataFrame, spec: Table, unknown: bool) -> list[DataFrame]:
    """Rows of the first runs of some partitions without those that later runs deliver, and the latter."""
    pk = [c for c in spec.pk if c != spec.partition]
    key = [spec.partition, *pk]
    late = greatest_by(later, key, [F.col("run")], [c for c in spec.names if c not in key])
    met = late.select(*[F.col(c).alias(f"_{c}") for c in key])
    # A plain comparison of the partition lets a filter on it reach the scans of both sides.
    same = F.lit(True) if unknown else F.col(spec.partition) == F.col(f"_{spec.partition}")
    for c in pk:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return [first.join(met, same, "left_anti"), late]


def delivered(spark: SparkSession, path: str, table: str | Table, run: dt.date | None = None) -> DataFrame:
    """All rows that count, with their ``run``: of one run, or of every run, repeated keys too."""
    folders = []
    for name, note in notes(spark, path).items():
        if run is None or name == run.isoformat():
            folders += [f"{path}/run={name}/attempt={note['attempt']}/{p}" for p in note["partitions"]]
    return _read(spark, path, spec_of(table), folders).drop("attempt")


def _read(spark: SparkSession, path: str, spec: Table, folders: list[str]) -> DataFrame:
    schema = on_disk(spec, *FOLDERS)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)
