"""Daily, weekly, hourly and monthly aggregates.

The warehouse defines these tables but no job that loads them; the measures follow the column
names and the queries that read them. Every fact is totalled to the target's grain before it
meets another one, so no join or union carries fact rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.functions import time
from switchboard.functions.numbers import exact_ratio
from switchboard.plans.facts import UNKNOWN
from switchboard.schemas import conform

# State groups, NPS bands and the unknown site.
HANDLE_STATES = ("TALK", "HOLD", "ACW")
READY = "READY"
PROMOTER, DETRACTOR = 9, 6
NO_SITE = "UNK"


def agg_agent_daily(
    interaction: DataFrame, activity: DataFrame, adherence: DataFrame, agent: DataFrame
) -> DataFrame:
    """Per agent and day: interactions, handle time, state seconds, adherence and occupancy.

    Occupancy is handle time over handle plus ready time.
    """
    grain = ["agent_sk", "date_key"]
    handled = interaction.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("handle_seconds").alias("handle"),
        F.count("handle_seconds").alias("handle_n"),
    )
    states = activity.groupBy(*grain).agg(
        _in_states(F.col("state_code") == "TALK").alias("talk"),
        _in_states(F.col("state_code") == "ACW").alias("acw"),
        _in_states(F.col("state_code").startswith("AUX")).alias("aux"),
        _in_states(F.col("state_code").isin(*HANDLE_STATES)).alias("busy"),
        _in_states(F.col("state_code") == READY).alias("ready"),
    )
    days = adherence.groupBy(*grain).agg(
        F.sum("worked_minutes").alias("worked"), F.sum("scheduled_minutes").alias("scheduled")
    )
    merged = handled.unionByName(states, allowMissingColumns=True).unionByName(days, allowMissingColumns=True)
    measures = [c for c in merged.columns if c not in grain]
    rows = merged.groupBy(*grain).agg(*[F.sum(c).alias(c) for c in measures])
    rows = rows.join(agent.select("agent_sk", "site_code"), "agent_sk", "left")
    out = rows.withColumns(
        {
            "site_code": F.coalesce("site_code", F.lit(NO_SITE)),
            "interactions_handled": F.coalesce("n", F.lit(0)),
            "avg_handle_seconds": exact_ratio(F.col("handle"), F.col("handle_n"), 8, 2),
            **{f"{c}_seconds": F.coalesce(c, F.lit(0)) for c in ("talk", "acw", "aux")},
            "adherence_pct": exact_ratio(F.col("worked") * 100, F.col("scheduled"), 5, 2),
            "occupancy_pct": exact_ratio(F.col("busy") * 100, F.col("busy") + F.col("ready"), 5, 2),
        }
    )
    return conform(out, "agg_agent_daily")


def agg_agent_weekly(daily: DataFrame) -> DataFrame:
    """Days of a Monday-based week: handle time weighted by volume, percentages averaged over days."""
    monday = F.date_sub(F.next_day(time.key_to_date("date_key"), "Mon"), 7)
    weight = F.when(F.col("avg_handle_seconds").isNotNull(), F.col("interactions_handled"))
    rows = daily.groupBy("agent_sk", "site_code", time.date_key(monday).alias("week_start_key")).agg(
        F.count(F.lit(1)).alias("days_worked"),
        F.sum("interactions_handled").alias("interactions_handled"),
        F.sum((F.col("avg_handle_seconds") * 100).cast("long") * weight).alias("_handle"),
        F.sum(weight).alias("_weight"),
        *[F.sum((F.col(c) * 100).cast("long")).alias(f"_{c}") for c in ("adherence_pct", "occupancy_pct")],
        *[F.count(c).alias(f"_{c}_n") for c in ("adherence_pct", "occupancy_pct")],
    )
    out = rows.withColumns(
        {
            "avg_handle_seconds": exact_ratio(F.col("_handle"), F.col("_weight") * 100, 8, 2),
            **{
                c: exact_ratio(F.col(f"_{c}"), F.col(f"_{c}_n") * 100, 5, 2)
                for c in ("adherence_pct", "occupancy_pct")
            },
        }
    )
    return conform(out, "agg_agent_weekly")


def agg_queue_hourly(interval: DataFrame, forecast: DataFrame) -> DataFrame:
    """Queue statistics per hour against the summed half-hour forecast."""
    hours = interval.groupBy(
        "queue_sk", "date_key", F.hour("interval_start_ts").cast("long").alias("hour_of_day")
    ).agg(*[F.sum(c).alias(c) for c in ("offered", "answered", "abandoned", "answered_in_sl")])
    start = time.from_seconds("interval_start_epoch")
    planned = forecast.groupBy(
        F.col("queue_id").alias("queue_sk"),
        time.date_key(start).alias("date_key"),
        F.hour(start).cast("long").alias("hour_of_day"),
    ).agg(F.sum("forecast_volume").alias("forecast_volume"))
    rows = hours.join(planned, ["queue_sk", "date_key", "hour_of_day"], "left")
    gap = F.col("offered") - F.col("forecast_volume")
    out = rows.withColumns(
        {
            "sl_pct": exact_ratio(F.col("answered_in_sl") * 100, F.col("answered"), 5, 2),
            "volume_variance_pct": exact_ratio(gap * 100, F.col("forecast_volume"), 7, 2),
        }
    )
    return conform(out, "agg_queue_hourly")


def agg_site_daily(
    interaction: DataFrame,
    interval: DataFrame,
    adherence: DataFrame,
    agent: DataFrame,
    queue: DataFrame,
    program: DataFrame,
) -> DataFrame:
    """Per site and day. Interactions and adherence count for the agent's site, service level for
    the site of the queue's program. Interactions are totalled per agent first, which also
    makes the number of active agents a plain count."""
    sites = agent.select("agent_sk", "site_code")
    queue_sites = queue.join(
        program.select("program_id", F.col("site_code").alias("site_code")), "program_id", "left"
    ).select("queue_sk", "site_code")
    grain = ["site_code", "date_key"]
    site = F.coalesce("site_code", F.lit(NO_SITE)).alias("site_code")

    per_agent = interaction.groupBy("agent_sk", "date_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("handle_seconds").alias("handle"),
        F.count("handle_seconds").alias("handle_n"),
    )
    handled = (
        per_agent.join(sites, "agent_sk", "left")
        .groupBy(site, "date_key")
        .agg(
            F.count(F.when(F.col("agent_sk") != UNKNOWN, 1)).alias("agents_active"),
            *[F.sum(c).alias(c) for c in ("n", "handle", "handle_n")],
        )
    )
    per_queue = interval.groupBy("queue_sk", "date_key").agg(
        F.sum("answered").alias("answered"), F.sum("answered_in_sl").alias("in_sl")
    )
    levels = (
        per_queue.join(queue_sites, "queue_sk", "left")
        .groupBy(site, "date_key")
        .agg(F.sum("answered").alias("answered"), F.sum("in_sl").alias("in_sl"))
    )
    days = (
        adherence.join(sites, "agent_sk", "left")
        .groupBy(site, "date_key")
        .agg(F.sum("worked_minutes").alias("worked"), F.sum("scheduled_minutes").alias("scheduled"))
    )
    merged = handled.unionByName(levels, allowMissingColumns=True).unionByName(days, allowMissingColumns=True)
    measures = [c for c in merged.columns if c not in grain]
    rows = merged.groupBy(*grain).agg(*[F.sum(c).alias(c) for c in measures])
    out = rows.withColumns(
        {
            "agents_active": F.coalesce("agents_active", F.lit(0)),
            "interactions": F.coalesce("n", F.lit(0)),
            "avg_handle_seconds": exact_ratio(F.col("handle"), F.col("handle_n"), 8, 2),
            "sl_pct": exact_ratio(F.col("in_sl") * 100, F.col("answered"), 5, 2),
            "adherence_pct": exact_ratio(F.col("worked") * 100, F.col("scheduled"), 5, 2),
        }
    )
    return conform(out, "agg_site_daily")


def agg_program_monthly(
    interaction: DataFrame, survey: DataFrame, billing: DataFrame, program: DataFrame
) -> DataFrame:
    """Rollup of client, program and line of business per month; ``grouping_level`` 0 is the leaf.

    Client and line of business are those of the program. The three facts are totalled per
    program and month first; only these totals are expanded by the rollup.
    """
    month = time.month_start(time.key_to_date("date_key")).alias("period_month")
    grain = ["program_sk", "period_month"]
    handled = interaction.groupBy("program_sk", month).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("handle_seconds").alias("handle"),
        F.count("handle_seconds").alias("handle_n"),
    )
    rated = survey.groupBy("program_sk", month).agg(
        F.sum("csat_score").alias("csat"), F.count("csat_score").alias("csat_n")
    )
    billed = billing.groupBy(*grain).agg(F.sum("line_amount").alias("billed"))
    merged = handled.unionByName(rated, allowMissingColumns=True).unionByName(billed, allowMissingColumns=True)
    measures = ["n", "handle", "handle_n", "csat", "csat_n", "billed"]
    leaves = merged.groupBy(*grain).agg(*[F.sum(c).alias(c) for c in measures])
    owner = program.select(
        "program_sk",
        F.col("client_id").alias("client_sk"),
        "line_of_business",
    )
    leaves = leaves.join(owner, "program_sk", "left").withColumn(
        "client_sk", F.coalesce("client_sk", F.lit(UNKNOWN))
    )
    rows = monthly_rollup(leaves, ["client_sk", "program_sk", "line_of_business"], measures)
    out = rows.withColumns(
        {
            "interactions": F.coalesce("n", F.lit(0)),
            "avg_handle_seconds": exact_ratio(F.col("handle"), F.col("handle_n"), 8, 2),
            "avg_csat": exact_ratio(F.col("csat"), F.col("csat_n"), 5, 2),
            "billed_amount": F.col("billed"),
            "grouping_level": F.col("_level"),
        }
    )
    return conform(out, "agg_program_monthly")


def agg_csat_rollup_monthly(survey: DataFrame, program: DataFrame) -> DataFrame:
    """Rollup of client, program and site per month with the grouping bit mask.

    Promoters score 9 or more, detractors 6 or less; shares are of all surveys.
    """
    month = time.month_start(time.key_to_date("date_key")).alias("period_month")
    leaves = survey.groupBy("program_sk", month).agg(
        F.count(F.lit(1)).alias("surveys"),
        F.sum("csat_score").alias("csat"),
        F.count("csat_score").alias("csat_n"),
        F.count(F.when(F.col("nps_score") >= PROMOTER, 1)).alias("up"),
        F.count(F.when(F.col("nps_score") <= DETRACTOR, 1)).alias("down"),
    )
    owner = program.select("program_sk", F.col("client_id").alias("client_sk"), "site_code")
    leaves = leaves.join(owner, "program_sk", "left").withColumns(
        {"client_sk": F.coalesce("client_sk", F.lit(UNKNOWN)), "site_code": F.coalesce("site_code", F.lit(NO_SITE))}
    )
    rows = monthly_rollup(
        leaves, ["client_sk", "program_sk", "site_code"], ["surveys", "csat", "csat_n", "up", "down"]
    )
    out = rows.withColumns(
        {
            "avg_csat": exact_ratio(F.col("csat"), F.col("csat_n"), 5, 2),
            "pct_promoters": exact_ratio(F.col("up") * 100, F.col("surveys"), 5, 2),
            "pct_detractors": exact_ratio(F.col("down") * 100, F.col("surveys"), 5, 2),
            "grouping_id": F.col("_level"),
        }
    )
    return conform(out, "agg_csat_rollup_monthly")


def agg_billing_monthly(
    billing: DataFrame, sla_credit: DataFrame, telco: DataFrame, client: DataFrame
) -> DataFrame:
    """Billed amount less service-level credits per client, program and month.

    Carrier cost is known per client and month only; each of the client's programs shows it.
    """
    billed = billing.groupBy("client_sk", "program_sk", "period_month").agg(F.sum("line_amount").alias("billed_amount"))
    credits = sla_credit.groupBy(F.col("program_id").alias("program_sk"), "period_month").agg(
        F.sum("credit_amount").alias("credit")
    )
    cost = (
        telco.groupBy("client_code", time.month_of_text("bill_period").alias("period_month"))
        .agg(F.sum("charge_amount").alias("cost"))
        .join(client.select("client_code", "client_sk"), "client_code")
        .select("client_sk", "period_month", "cost")
    )
    rows = billed.join(credits, ["program_sk", "period_month"], "left").join(
        cost, ["client_sk", "period_month"], "left"
    )
    zero = F.lit(0).cast("decimal(12,2)")
    out = (
        rows.withColumn("sla_credit_amount", F.coalesce("credit", zero))
        .withColumn("telco_cost_amount", F.coalesce("cost", zero))
        .withColumn("net_revenue", F.col("billed_amount") - F.col("sla_credit_amount"))
    )
    return conform(out, "agg_billing_monthly")


def _in_states(cond: Column) -> Column:
    return F.sum(F.when(cond, F.col("state_seconds")).otherwise(0))


def monthly_rollup(
    leaves: DataFrame, levels: list[str], measures: list[str], level: str = "_level"
) -> DataFrame:
    """Rollup over ``levels`` within each month; ``level`` has the leftmost level as its top bit."""
    sets = [["period_month", *levels[:n]] for n in range(len(levels), -1, -1)]
    keys = ["period_month", *levels]
    bits = sum((F.grouping(c) * (1 << i) for i, c in enumerate(reversed(levels))), F.lit(0))
    return leaves.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in keys]).agg(
        *[F.sum(m).alias(m) for m in measures], bits.cast("long").alias(level)
    )
