"""Dimensions. Each is rebuilt whole; ``<entity>_sk`` reuses the natural id."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from switchboard.functions.time import date_key
from switchboard.operators import orders, ranking
from switchboard.operators.dedup import greatest_by, latest
from switchboard.operators.sink import replace_table
from switchboard.plans.cleanse import loaded
from switchboard.schemas import conform
from switchboard.sources.feeds import parquet_feed

# Region, country and time zone per site; other sites are unknown.
SITES = {
    "MNL1": ("APAC", "PH", "Asia/Manila"),
    "BLR2": ("APAC", "IN", "Asia/Kolkata"),
    "MTY3": ("LATAM", "MX", "America/Monterrey"),
}
UNKNOWN_SITE = ("UNK", "UNK", "UTC")
DEFAULT_SITE = "UNK"
DEFAULT_BILLING_MODEL = "PER_FTE"
EXECUTED = "EXECUTED"


def dim_date(spark: SparkSession, drop_path: str, table_path: str) -> DataFrame:
    """Bulk-load the delivered calendar and replace the table."""
    replace_table(parquet_feed(spark, drop_path, "dim_date"), table_path, "dim_date")
    return parquet_feed(spark, table_path, "dim_date")


def dim_agent(history: DataFrame, agent: DataFrame, org_unit: DataFrame, run_date: dt.date) -> DataFrame:
    """Current slice of each agent with master data and the day's team and site."""
    current = history.where(F.col("is_current"))
    master = agent.select("agent_id", "full_name", "hire_ts")
    teams = loaded(org_unit, run_date, "snapshot_date").select(
        "org_unit_id", F.col("unit_name").alias("team_name"), "site_code"
    )
    out = (
        current.join(master, "agent_id")
        .join(teams, "org_unit_id", "left")
        .withColumn("agent_sk", F.col("agent_id"))
        .withColumn("site_code", F.coalesce("site_code", F.lit(DEFAULT_SITE)))
        .withColumn("hire_date_key", date_key("hire_ts"))
    )
    return conform(out, "dim_agent")


def dim_client(client: DataFrame, contact: DataFrame, run_date: dt.date) -> DataFrame:
    """Clients with their best contact of the day: primary first, then the newest.

    The contact comes straight from staging; no cleansed contact table exists.
    """
    best = greatest_by(
        loaded(contact, run_date),
        ["client_id"],
        [F.col(c) for c in ("is_primary", "created_ts", "contact_id")],
        ["full_name", "email"],
    ).withColumnsRenamed({"full_name": "primary_contact_name", "email": "primary_contact_email"})
    out = client.join(best, "client_id", "left").withColumn("client_sk", F.col("client_id"))
    return conform(out, "dim_client")


def dim_program(program: DataFrame, contract: DataFrame, run_date: dt.date) -> DataFrame:
    """Programs with the billing model of the latest signed executed contract."""
    executed = loaded(contract, run_date, "snapshot_date").where(F.col("status") == EXECUTED)
    model = greatest_by(
        executed, ["program_id"], [F.col("signed_ts"), F.col("contract_id")], ["billing_model"]
    )
    out = (
        loaded(program, run_date, "snapshot_date")
        .join(model, "program_id", "left")
        .withColumn("program_sk", F.col("program_id"))
        .withColumn("billing_model", F.coalesce("billing_model", F.lit(DEFAULT_BILLING_MODEL)))
        .withColumn("go_live_date_key", date_key("go_live_ts"))
    )
    return conform(out, "dim_program")


def dim_queue(queue: DataFrame, run_date: dt.date) -> DataFrame:
    rows = loaded(queue, run_date, "snapshot_date")
    return conform(rows.withColumn("queue_sk", F.col("queue_id")), "dim_queue")


def dim_site(org_unit: DataFrame, run_date: dt.date) -> DataFrame:
    rows = loaded(org_unit, run_date, "snapshot_date").where(F.col("unit_type") == "SITE")
    out = rows.select(
        F.col("org_unit_id").alias("site_sk"),
        "site_code",
        F.col("unit_name").alias("site_name"),
        *[_site_value(i).alias(name) for i, name in enumerate(("region", "country", "timezone"))],
    )
    return conform(out, "dim_site")


def dim_shift(shift: DataFrame, run_date: dt.date) -> DataFrame:
    """Shifts straight from staging; no cleansed shift table exists."""
    rows = latest(loaded(shift, run_date), ["shift_id"], ["created_epoch"])
    return conform(rows.withColumn("shift_sk", F.col("shift_id")), "dim_shift")


def dim_org(org_unit: DataFrame, run_date: dt.date) -> DataFrame:
    """The unit tree flattened to four names: the unit and three ancestors, each defaulting to
    the unit's own name. The site is that of the unit, its parent or its grandparent."""
    units = loaded(org_unit, run_date, "snapshot_date")
    ancestor = units.select("org_unit_id", "parent_unit_id", "unit_name", "site_code")

    def level(n: int) -> DataFrame:
        return ancestor.select(*[F.col(c).alias(f"_{c}{n}") for c in ancestor.columns])

    out = (
        units.join(level(3), F.col("parent_unit_id") == F.col("_org_unit_id3"), "left")
        .join(level(2), F.col("_parent_unit_id3") == F.col("_org_unit_id2"), "left")
        .join(level(1), F.col("_parent_unit_id2") == F.col("_org_unit_id1"), "left")
        .withColumns({f"level{n}_name": F.coalesce(f"_unit_name{n}", "unit_name") for n in (1, 2, 3)})
        .withColumn("level4_name", F.col("unit_name"))
        .withColumn("site_code", F.coalesce("site_code", "_site_code3", "_site_code2"))
        .withColumn("org_sk", F.col("org_unit_id"))
    )
    return conform(out, "dim_org")


def dim_disposition(disposition: DataFrame, run_date: dt.date) -> DataFrame:
    """Dispositions numbered by code. Codes are unique here, so the position is the dense rank."""
    rows = latest(loaded(disposition, run_date), ["disposition_code"], ["created_epoch"])
    order = ranking.ascending("disposition_code")
    return conform(orders.positions(rows, order, "disposition_sk"), "dim_disposition")


def _site_value(i: int) -> Column:
    out = F.lit(UNKNOWN_SITE[i])
    for code, values in SITES.items():
        out = F.when(F.col("site_code") == code, values[i]).otherwise(out)
    return out
