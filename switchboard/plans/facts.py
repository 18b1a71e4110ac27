"""Facts of one run date. Unknown dimension members get the key -1."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.functions import time
from switchboard.functions.numbers import count_if, exact_ratio, round_long
from switchboard.functions.text import first_group
from switchboard.operators.dedup import greatest_by, latest
from switchboard.operators.skew import lookup, spread_join
from switchboard.plans.cleanse import loaded
from switchboard.schemas import conform

# Default keys, the service-level metric with its default, ticket and PTO rules.
UNKNOWN = -1
SL_METRIC = "SL_20_80"
SL_METRIC_SECONDS = r"^SL_(\d+)_"
DEFAULT_SL_SECONDS = 20
INTERVAL_SECONDS = 1800
DEFAULT_SLA_HOURS = 24
PTO_MINUTES = 480
APPROVED = "APPROVED"


def sk(name: str) -> Column:
    return F.coalesce(name, F.lit(UNKNOWN)).alias(name)


def current_agents(agent: DataFrame) -> DataFrame:
    return agent.where(F.col("is_current")).select("agent_id", "agent_sk")


def fact_interaction(
    interaction: DataFrame,
    agent: DataFrame,
    program: DataFrame,
    queue: DataFrame,
    client: DataFrame,
    run_date: dt.date,
) -> DataFrame:
    rows = loaded(interaction, run_date, "event_date")
    rows = lookup(rows, current_agents(agent), "agent_id")
    rows = lookup(rows, program.select("program_id", "program_sk"), "program_id")
    rows = lookup(rows, queue.select("queue_id", "queue_sk"), "queue_id")
    rows = lookup(rows, client.select("client_code", "client_sk"), "client_code")
    keys = ("client_sk", "program_sk", "queue_sk", "agent_sk")
    out = rows.withColumns({k: sk(k) for k in keys}).withColumn("date_key", time.date_key("start_ts"))
    return conform(out, "fact_interaction")


def fact_agent_activity(
    state: DataFrame, adherence: DataFrame, agent: DataFrame, run_date: dt.date
) -> DataFrame:
    """Seconds per agent and state; approved exceptions are taken off each AUX state.

    Events are totalled per raw agent id before the lookups, so the joins see one row per
    agent and state. Unknown agents share the key -1 and, with it, the largest of their
    exceptions.
    """
    events = (
        loaded(state, run_date)
        .groupBy("agent_id", "state_code")
        .agg(
            F.sum(F.col("end_epoch") - F.col("start_epoch")).alias("_seconds"),
            F.count(F.lit(1)).alias("_n"),
            F.min("start_epoch").alias("_first"),
            F.max("end_epoch").alias("_last"),
        )
    )
    length = time.seconds("end_ts") - time.seconds("start_ts")
    approved = (
        loaded(adherence, run_date, "event_date")
        .where(F.col("approved_flag"))
        .groupBy("agent_id")
        .agg(F.sum(length).alias("_approved"))
    )
    rows = lookup(lookup(events, current_agents(agent), "agent_id"), approved, "agent_id")
    out = (
        rows.groupBy(sk("agent_sk"), "state_code")
        .agg(
            F.sum("_seconds").alias("_seconds"),
            F.max(F.when(F.col("state_code").startswith("AUX"), F.col("_approved"))).alias("_approved"),
            F.sum("_n").alias("occurrence_count"),
            F.min("_first").alias("_first"),
            F.max("_last").alias("_last"),
        )
        .withColumn("state_seconds", F.col("_seconds") - F.coalesce("_approved", F.lit(0)))
        .withColumn("first_state_ts", time.from_seconds("_first"))
        .withColumn("last_state_ts", time.from_seconds("_last"))
        .withColumn("date_key", time.date_key("first_state_ts"))
    )
    return conform(out, "fact_agent_activity")


def fact_queue_interval(call: DataFrame, queue: DataFrame, target: DataFrame, run_date: dt.date) -> DataFrame:
    """Half-hour queue statistics.

    A call is in service level when it was answered within the threshold of its queue: the
    seconds named in the queue's ``SL_20_80`` target, 20 without one. Calls are totalled per
    queue id, interval and ring time class before the lookups, so a hot queue costs one row
    per task and interval; several targets of one queue do not multiply its calls.
    """
    threshold = (
        target.where(F.col("metric_code") == SL_METRIC)
        .groupBy("queue_id")
        .agg(F.max(first_group(F.col("metric_code"), SL_METRIC_SECONDS).cast("long")).alias("_threshold"))
    )
    answered = ~F.col("abandoned_flag")
    calls = (
        loaded(call, run_date, "call_date")
        .groupBy("queue_id", time.bucket("start_ts", INTERVAL_SECONDS).alias("interval_start_ts"), "ring_seconds")
        .agg(
            F.count(F.lit(1)).alias("_offered"),
            count_if(answered).alias("_answered"),
            count_if(F.col("abandoned_flag")).alias("_abandoned"),
            F.sum(F.col("talk_seconds") + F.col("hold_seconds") + F.col("acw_seconds")).alias("_handle"),
            F.count(F.col("talk_seconds") + F.col("hold_seconds") + F.col("acw_seconds")).alias("_handled"),
        )
    )
    rows = lookup(lookup(calls, queue.select("queue_id", "queue_sk"), "queue_id"), threshold, "queue_id")
    limit = F.coalesce("_threshold", F.lit(DEFAULT_SL_SECONDS))
    ring = F.col("ring_seconds")
    out = (
        rows.groupBy(sk("queue_sk"), "interval_start_ts")
        .agg(
            F.sum("_offered").alias("offered"),
            F.sum("_answered").alias("answered"),
            F.sum("_abandoned").alias("abandoned"),
            F.sum(F.when(ring <= limit, F.col("_answered")).otherwise(0)).alias("answered_in_sl"),
            F.coalesce(F.max("_threshold"), F.lit(DEFAULT_SL_SECONDS)).alias("sl_threshold_sec"),
            F.sum(ring * F.col("_answered")).alias("_ring"),
            F.sum(F.when(ring.isNotNull(), F.col("_answered"))).alias("_rung"),
            F.sum("_handle").alias("_handle"),
            F.sum("_handled").alias("_handled"),
        )
        .withColumn("avg_speed_answer_sec", exact_ratio(F.col("_ring"), F.col("_rung"), 8, 2))
        .withColumn("avg_handle_sec", exact_ratio(F.col("_handle"), F.col("_handled"), 8, 2))
        .withColumn("date_key", time.date_key("interval_start_ts"))
    )
    return conform(out, "fact_queue_interval")


def fact_csat_survey(survey: DataFrame, interaction_fact: DataFrame, run_date: dt.date) -> DataFrame:
    """Surveys with the keys of their interaction: a join of two facts, spread over hot references."""
    rows = loaded(survey, run_date, "event_date").withColumnRenamed("interaction_ref", "interaction_id")
    keys = ["client_sk", "program_sk", "agent_sk"]
    out = spread_join(rows, interaction_fact.select("interaction_id", *keys), "interaction_id")
    out = out.withColumns({k: sk(k) for k in keys}).withColumn("date_key", time.date_key("survey_ts"))
    return conform(out, "fact_csat_survey")


def fact_qa_evaluation(evaluation: DataFrame, interaction_fact: DataFrame, run_date: dt.date) -> DataFrame:
    rows = loaded(evaluation, run_date, "event_date").withColumnRenamed("interaction_ref", "interaction_id")
    keys = ["agent_sk", "program_sk"]
    out = spread_join(rows, interaction_fact.select("interaction_id", *keys), "interaction_id")
    out = out.withColumns({k: sk(k) for k in keys}).withColumn("date_key", time.date_key("evaluated_ts"))
    return conform(out, "fact_qa_evaluation")


def fact_billing_line(
    line: DataFrame,
    invoice: DataFrame,
    program: DataFrame,
    client: DataFrame,
    rate_card: DataFrame,
    run_date: dt.date,
    *,
    one_rate_per_program: bool = False,
) -> DataFrame:
    """Invoice lines of the run date's month with client, program and rate-card rate.

    Lines come straight from staging, of all load dates. The rate card is matched by program
    only, so a program with several services repeats the line per service;
    ``one_rate_per_program`` keeps the latest effective rate instead.
    """
    month = run_date.replace(day=1)
    headers = invoice.where(F.col("period_month") == f"{month:%Y-%m}").select(
        "invoice_id", "client_id", "program_id", F.col("status").alias("invoice_status")
    )
    rates = loaded(rate_card, run_date, "snapshot_date")
    if one_rate_per_program:
        order = [F.col(c) for c in ("effective_ts", "rate_card_id")]
        rates = greatest_by(rates, ["program_id"], order, ["service_code", "rate"])
    rates = rates.select("program_id", "service_code", "rate")
    known = client.select("client_id", F.col("client_id").alias("client_sk"))
    details = line.select(
        "invoice_line_id", "invoice_id", "qty", "unit_rate", "line_amount", "adjustment_flag"
    )
    # Program and client are the invoice's: looked up there, the lines, of which there are many more, are not shuffled for them.
    headers = lookup(headers, program.select("program_id", "program_sk"), "program_id")
    headers = lookup(headers, known, "client_id")
    rows = spread_join(details, headers, "invoice_id", how="inner")
    rows = lookup(rows, rates, "program_id")
    out = rows.withColumns(
        {
            "client_sk": F.coalesce("client_sk", "client_id"),
            "program_sk": sk("program_sk"),
            "service_code": F.coalesce("service_code", F.lit("UNKNOWN")),
            "unit_rate": F.coalesce("rate", "unit_rate"),
            "period_month": F.lit(month),
        }
    )
    return conform(out, "fact_billing_line")


def fact_adherence_daily(
    schedule: DataFrame, adherence: DataFrame, timeoff: DataFrame, agent: DataFrame, run_date: dt.date
) -> DataFrame:
    """Scheduled, worked, exception and time-off minutes per agent.

    Every input is totalled per raw agent id before the joins. Agents without a current
    dimension row share the key -1: their schedules add up, of their exceptions and time off
    the largest counts. Occupancy is 0 here; the daily aggregate computes it.
    """
    scheduled = (
        loaded(schedule, run_date, "sched_date").groupBy("agent_id", "sched_date").agg(F.sum("paid_minutes").alias("_paid"))
    )
    exceptions = (
        loaded(adherence, run_date, "event_date").groupBy("agent_id").agg(F.sum("exception_minutes").alias("_exc"))
    )
    today = F.lit(run_date)
    pto = (
        timeoff.where(
            (F.col("status") == APPROVED)
            & (F.to_date("start_date") <= today)
            & (F.to_date("end_date") >= today)
        )
        .groupBy("agent_id")
        .agg((F.count(F.lit(1)) * PTO_MINUTES).alias("_pto"))
    )
    rows = scheduled
    for side in (current_agents(agent), exceptions, pto):
        rows = lookup(rows, side, "agent_id")
    paid, exc = F.col("_paid"), F.col("exception_minutes")
    out = (
        rows.groupBy(sk("agent_sk"), "sched_date")
        .agg(
            F.sum("_paid").alias("_paid"),
            F.coalesce(F.max("_exc"), F.lit(0)).alias("exception_minutes"),
            F.coalesce(F.max("_pto"), F.lit(0)).alias("timeoff_minutes"),
        )
        .withColumns(
            {
                "scheduled_minutes": paid,
                "worked_minutes": paid - exc,
                "adherence_pct": exact_ratio((paid - exc) * 100, paid, 5, 2),
                "occupancy_pct": F.lit(0),
                "date_key": time.date_key("sched_date"),
            }
        )
    )
    return conform(out, "fact_adherence_daily")


def fact_ticket(
    ticket: DataFrame,
    event: DataFrame,
    category: DataFrame,
    agent: DataFrame,
    run_date: dt.date,
    *,
    newest_category: bool = False,
) -> DataFrame:
    """Tickets created on the run date with resolution time, breach flag and touches.

    An open ticket is never breached. Events and categories are not limited to one day, so a
    category delivered on several days repeats its tickets; ``newest_category`` takes only
    the latest delivered row of each category.
    """
    if newest_category:
        category = latest(category, ["category_id"], ["load_date", "created_ms"])
    rows = ticket.where(time.on_day("created_ts", run_date))
    rows = lookup(rows, category.select("category_id", "category_code", "sla_hours"), "category_id")
    agents = current_agents(agent).withColumnRenamed("agent_sk", "assigned_agent_sk")
    rows = lookup(rows, agents, "assigned_agent_id", "agent_id")
    touches = event.groupBy("ticket_id").agg(F.count(F.lit(1)).alias("touch_count"))
    rows = rows.join(touches, "ticket_id", "left")
    spent = time.seconds("resolved_ts") - time.seconds("created_ts")
    allowed = F.coalesce("sla_hours", F.lit(DEFAULT_SLA_HOURS)) * 3600
    out = rows.withColumns(
        {
            "program_sk": F.coalesce("program_id", F.lit(UNKNOWN)),
            "category_code": F.coalesce("category_code", F.lit("UNK")),
            "assigned_agent_sk": sk("assigned_agent_sk"),
            "resolution_minutes": round_long(spent / 60),
            "sla_breached_flag": F.col("resolved_ts").isNotNull() & (spent > allowed),
            "touch_count": F.coalesce("touch_count", F.lit(0)),
            "date_key": time.date_key("created_ts"),
        }
    )
    return conform(out, "fact_ticket")


def fact_ivr_path(session: DataFrame, run_date: dt.date) -> DataFrame:
    rows = loaded(session, run_date, "event_date")
    out = rows.withColumn(
        "duration_seconds", time.seconds("last_event_ts") - time.seconds("first_event_ts")
    ).withColumn("date_key", time.date_key("first_event_ts"))
    return conform(out, "fact_ivr_path")
