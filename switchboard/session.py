"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every pipeline relies on; all may be set on a running session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "switchboard", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)


_local_dirs: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session. Only a local session that names none
    (tests on one machine) gets a folder of its own.
    """
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="run-")
        configured = _local_dirs[app]
    return f"{configured.rstrip('/')}/switchboard-{app}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def store(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts lineage so that a lost executor re-reads the table instead of recomputing the
    layers below, and gives the optimizer a measured size: whether a later join may
    broadcast this table is decided from the bytes on disk. ``codec`` is the session's unless given.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.mode("error").parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Remove the shuffle files of queries that have ended.

    Spark removes them when the driver collects the garbage that still points to them, which a driver with little to
    do puts off by up to half an hour (``spark.cleaner.periodicGC.interval``): until then they fill the disks. Those of a
    query that ended this moment may go with the next call.
    """
    spark._jvm.System.gc()
