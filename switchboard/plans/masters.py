"""Stored states and what a delivery changes in them: masters, change-merged tables and histories.

Every function reads the rows that a run delivers and the part of the stored state that their keys
meet, and may be run again or out of order: what decides is in the rows (update time, delivery date,
change time), not in the order of runs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchboard.operators import buckets, files, keyindex
from switchboard.operators.layout import Value
from switchboard.operators.merge import DELETED
from switchboard.operators.scd2 import splice
from switchboard.operators.sink import read_table, rewrite_partitions
from switchboard.plans import history, merges
from switchboard.plans.cleanse import loaded
from switchboard.schemas import TABLES
from switchboard.session import store

Get = Callable[[str], DataFrame]
CLOSINGS = T.StructType([T.StructField("ticket_id", T.LongType()), T.StructField("resolved_ts", T.TimestampType())])
SIMPLE = {"ods_client_acid": ("stg_crm_client", merges.client), "ods_invoice_acid": ("stg_fin_invoice", merges.invoice)}
MASTERS = ("ods_client_acid", "ods_agent_acid", "ods_ticket_acid", "ods_invoice_acid")


def load_master(spark: SparkSession, path: str, table: str, get: Get, run_date: dt.date) -> None:
    """Merge the run date's delivery into a master stored in buckets of its key."""
    spec = TABLES[table]
    if table == "ods_ticket_acid":
        return _tickets(spark, path, get, run_date)
    if table == "ods_agent_acid":
        source, merge = "stg_hr_agent", merges.agent_versions
        schema = spec.schema.add("delivered_on", T.DateType())
    else:
        (source, merge), schema = SIMPLE[table], spec.schema
    incoming = loaded(get(source), run_date)
    buckets.merge(spark, path, schema, spec.pk, incoming.select(*spec.pk), lambda stored, met: merge(stored, incoming))


def _tickets(spark: SparkSession, path: str, get: Get, run_date: dt.date) -> None:
    """Tickets, and beside them the last closing of every ticket, also of one that is not known yet."""
    spec, beside = TABLES["ods_ticket_acid"], f"{path}.closings"
    incoming = loaded(get("stg_tkt_ticket"), run_date)
    closed = store(merges.closings(loaded(get("stg_tkt_ticket_event"), run_date)), "closings")

    def last(stored: DataFrame, met: set[int]) -> DataFrame:
        return stored.unionByName(closed).groupBy("ticket_id").agg(F.max("resolved_ts").alias("resolved_ts"))

    buckets.merge(spark, beside, CLOSINGS, spec.pk, closed.select("ticket_id"), last)

    def change(stored: DataFrame, met: set[int]) -> DataFrame:
        return merges.tickets_closed(stored, incoming, buckets.read(spark, beside, CLOSINGS, met))

    keys = incoming.select("ticket_id").union(closed.select("ticket_id"))
    buckets.merge(spark, path, spec.schema, spec.pk, keys, change)


def merge_changes(
    spark: SparkSession, path: str, table: str, feed: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]
) -> set[Value]:
    """Merge a delivery of a change feed into the stored table and return the partitions it rewrote.

    The index beside the table says where the arriving keys lie and which of them were deleted, so
    that no other partition is read. The table is written first, then the index: a run that fails
    between them is repeated whole, and rows it had moved are not kept twice.
    """
    spec, index = TABLES[table], f"{path}.index"
    key_fields = [spec.schema[c] for c in spec.pk]
    kind = spec.schema[spec.partition].dataType
    if not keyindex.exists(spark, index) and files.exists(spark, path):
        keyindex.append(_alive(read_table(spark, path, table), table), index, key_fields, kind)
    feed = store(feed, f"changes-{table}")
    keys = store(feed.select(*spec.pk).distinct(), "keys")
    known = store(keyindex.find(spark, index, keys, key_fields, kind), "known")
    # One value per touched partition: a list as short as the partition list.
    before = {part for (part,) in known.where("not _dead").select("_part").distinct().collect()}
    dead = known.where("_dead").select(*spec.pk, F.col("_change_ms").alias("change_ms"), F.lit(DELETED).alias("op"))
    changes = feed.unionByName(dead, allowMissingColumns=True)
    written, merged = rewrite_partitions(spark, path, table, keys, lambda stored: merge(stored, changes), before)
    alive = _alive(merged.join(keys, spec.pk, "left_semi"), table)
    last = changes.where((F.col("op") == DELETED) & F.col("change_ms").isNotNull()).groupBy(*spec.pk)
    gone = last.agg(F.max("change_ms").alias("_change_ms")).join(alive, spec.pk, "left_anti")
    gone = gone.withColumns({"_part": F.lit(None).cast(kind), "_dead": F.lit(True)})
    keyindex.append(alive.unionByName(gone), index, key_fields, kind)
    return written


def _alive(rows: DataFrame, table: str) -> DataFrame:
    spec = TABLES[table]
    ms = F.unix_millis("last_change_ts").alias("_change_ms")
    return rows.select(*spec.pk, F.col(spec.partition).alias("_part"), ms, F.lit(False).alias("_dead"))


def splice_history(
    spark: SparkSession, path: str, table: str, observed: DataFrame, run_date: dt.date
) -> set[Value]:
    """Splice the observations that the run date delivers into a stored history."""
    h = history.HISTORIES[table]
    return splice(spark, path, f"{path}.seen", table, observed, h.keys, h.tracked, h.ts, h.id_column, run_date)


def observed_on(table: str, get: Get, run_date: dt.date) -> DataFrame:
    """The observations of one delivery."""
    h = history.HISTORIES[table]
    if table == "ods_agent_scd2":
        return h.observed(loaded(get("stg_hr_agent"), run_date), loaded(get("stg_hr_employment_event"), run_date))
    if table == "ods_agent_skill_scd2":
        return h.observed(loaded(get("stg_hr_agent_skill"), run_date), get("stg_hr_skill"))
    seen = get("obs_assignment")
    day = F.lit(run_date).cast("timestamp")
    return h.observed(seen.where((F.col("seen_ts") >= day) & (F.col("seen_ts") < day + F.expr("INTERVAL 1 DAY"))))
