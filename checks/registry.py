"""Registered queries and their oracles.

Every entry runs over whole base tables. Tables and analyst queries take their inputs from
`Warehouse`; operators and feed readers run on base or staging tables directly.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracles as sql
from checks.compare import plain
from checks.fixtures import DELIVERY_DAYS, RECIPES, RUN_DATE
from checks.warehouse import Warehouse, warehouse
from switchboard.functions import time
from switchboard.functions.text import EMBEDDED_REF, call_driver, first_group, json_key
from switchboard.operators import dedup, orders, ranking, runs, sink, slices, textagg, tree
from switchboard.plans import aggs, cleanse, history, masters, merges, quality, views
from switchboard.plans.daily import STEPS, VIEWS
from switchboard.schemas import TABLES
from switchboard.session import fresh_path, store
from switchboard.sources import calendar, feeds

Query = Callable[[Warehouse], DataFrame]

# Query name: the table or analyst query it computes.
PIPELINES = {
    "cleanse_program": "ods_program",
    "cleanse_contract": "ods_contract",
    "cleanse_contract_line": "ods_contract_line",
    "cleanse_org_unit": "ods_org_unit",
    "cleanse_queue": "ods_queue",
    "cleanse_schedule": "ods_schedule",
    "cleanse_adherence_event": "ods_adherence_event",
    "cleanse_call": "ods_call",
    "cleanse_ivr_session": "ods_ivr_session",
    "cleanse_chat_session": "ods_chat_session",
    "cleanse_email": "ods_email_interaction",
    "cleanse_survey": "ods_survey_response",
    "cleanse_qa_evaluation": "ods_qa_evaluation",
    "cleanse_interaction": "ods_interaction",
    "cleanse_dialer": "ods_dialer_attempt",
    "load_dim_agent": "dim_agent",
    "load_dim_client": "dim_client",
    "load_dim_program": "dim_program",
    "load_dim_queue": "dim_queue",
    "load_dim_site": "dim_site",
    "load_dim_shift": "dim_shift",
    "load_dim_org": "dim_org",
    "load_dim_disposition": "dim_disposition",
    "load_fact_interaction": "fact_interaction",
    "load_fact_agent_activity": "fact_agent_activity",
    "load_fact_queue_interval": "fact_queue_interval",
    "load_fact_csat_survey": "fact_csat_survey",
    "load_fact_qa_evaluation": "fact_qa_evaluation",
    "load_fact_billing_line": "fact_billing_line",
    "load_fact_adherence_daily": "fact_adherence_daily",
    "load_fact_ticket": "fact_ticket",
    "load_fact_ivr_path": "fact_ivr_path",
    "merge_rate_card": "ods_rate_card",
    "agg_agent_daily": "agg_agent_daily",
    "agg_agent_weekly": "agg_agent_weekly",
    "agg_queue_hourly": "agg_queue_hourly",
    "agg_site_daily": "agg_site_daily",
    "agg_program_monthly": "agg_program_monthly",
    "agg_csat_rollup_monthly": "agg_csat_rollup_monthly",
    "agg_billing_monthly": "agg_billing_monthly",
    **{v: v for v in VIEWS if v not in ("vw_active_agents_ndv", "vw_program_margin")},
}

# Stored states: each is loaded in three deliveries, of which the second comes last, and then read.
MERGES = {
    "merge_timesheet": (merges.timesheet, "stg_fin_timesheet_delta", "ods_timesheet"),
    "merge_payroll_adjustment": (
        merges.payroll_adjustment,
        "stg_fin_payroll_adj_delta",
        "ods_payroll_adjustment",
    ),
    "merge_sla_credit": (merges.sla_credit, "stg_crm_sla_credit_delta", "ods_sla_credit"),
    "merge_callback_request": (
        merges.callback_request,
        "stg_tel_callback_request_delta",
        "ods_callback_request",
    ),
    "merge_shift_swap": (merges.shift_swap, "stg_wfm_shift_swap_delta", "ods_shift_swap"),
    "merge_ticket_worklog": (merges.ticket_worklog, "stg_tkt_worklog_delta", "ods_ticket_worklog"),
    "merge_attrition_event": (merges.attrition_event, "stg_hr_attrition_event_delta", "ods_attrition_event"),
}
UPSERTS = {
    "upsert_client": "ods_client_acid",
    "upsert_agent": "ods_agent_acid",
    "upsert_ticket": "ods_ticket_acid",
    "upsert_invoice": "ods_invoice_acid",
}
SPLICED = {
    "scd2_agent": "ods_agent_scd2",
    "scd2_agent_skill": "ods_agent_skill_scd2",
    "scd2_agent_assignment": "ods_agent_assignment_scd2",
}
REBUILT = ("ods_agent_scd2", "ods_ticket_acid", "ods_timesheet")
# Days that cut the changes and assignments of a month into three deliveries.
CUTS = (dt.date(2024, 1, 11), dt.date(2024, 1, 21))


def _thirds(rows: DataFrame, column: str) -> list[DataFrame]:
    """The first, the last and then the middle part of the month."""
    low, high = (F.lit(d) for d in CUTS)
    day = F.col(column).cast("date")
    return [rows.where(day < low), rows.where(day >= high), rows.where((day >= low) & (day < high))]


def _merged(merge, delta: str, table: str) -> Query:
    def run(w: Warehouse) -> DataFrame:
        path = fresh_path(w.spark, table)
        for feed in _thirds(w.get(delta), "extract_date"):
            masters.merge_changes(w.spark, path, table, feed, merge)
        return sink.read_table(w.spark, path, table)

    return run


def _upserted(table: str) -> Query:
    def run(w: Warehouse) -> DataFrame:
        path = fresh_path(w.spark, table)
        for day in DELIVERY_DAYS:
            masters.load_master(w.spark, path, table, w.get, day)
        return sink.read_table(w.spark, path, table)

    return run


def _spliced(table: str) -> Query:
    def run(w: Warehouse) -> DataFrame:
        path = fresh_path(w.spark, table)
        if table == "ods_agent_assignment_scd2":
            parts = [history.assignments_seen(o) for o in _thirds(w.get("obs_assignment"), "seen_ts")]
        else:
            parts = [masters.observed_on(table, w.get, day) for day in DELIVERY_DAYS]
        for day, observed in zip(DELIVERY_DAYS, parts, strict=True):
            masters.splice_history(w.spark, path, table, observed, day)
        return sink.read_table(w.spark, path, table)

    return run


# --- calendar, margin and approximate counts ---------------------------------------------


def load_dim_date(w: Warehouse) -> DataFrame:
    from switchboard.plans import dims

    drop = fresh_path(w.spark, "calendar-drop")
    calendar.calendar_of(w.get("obs_calendar"), "d").write.parquet(drop)
    return dims.dim_date(w.spark, drop, fresh_path(w.spark, "dim_date"))


def program_margin(w: Warehouse) -> DataFrame:
    """The form with one row per billing row; the literal product is tested on a small input."""
    names = ("agg_billing_monthly", "ods_timesheet", "ods_payroll_adjustment", "ods_contract_line", "ods_contract")
    return views.program_margin(*[w.get(n) for n in names], by_program=True)


def _within(approx: str, exact: str, rsd: float = 0.05) -> Column:
    """Approximate count within three standard errors of the exact one, give or take one."""
    return F.abs(F.col(approx) - F.col(exact)) <= 3 * rsd * F.col(exact) + 1


def active_agents_ndv(w: Warehouse) -> DataFrame:
    fact, agent = w.get("fact_interaction"), w.get("dim_agent")
    approx = views.active_agents_ndv(fact, agent)
    exact = (
        fact.join(agent.select("agent_sk", "site_code"), "agent_sk")
        .groupBy("date_key", "site_code")
        .agg(
            F.count_distinct("agent_sk").alias("agents"),
            F.count_distinct("agent_sk", "channel").alias("pairs"),
        )
    )
    return approx.join(exact, ["date_key", "site_code"]).select(
        "date_key",
        "site_code",
        "interactions",
        _within("approx_active_agents", "agents").alias("agents_within_bound"),
        _within("approx_agent_channel_pairs", "pairs").alias("pairs_within_bound"),
    )


# --- operators ---------------------------------------------------------------------------


def dedup_latest(w: Warehouse) -> DataFrame:
    return dedup.latest(w.base["lineitem"], ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def interval_bucket(w: Warehouse) -> DataFrame:
    rows = w.base["events"].withColumn("at", F.col("ts").cast("timestamp"))
    return rows.groupBy(time.bucket("at", 1800).alias("bucket_ts"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.min("event_id").alias("first_event")
    )


def _spans(w: Warehouse) -> DataFrame:
    """Events as contacts: each lasts as many seconds as its value says."""
    start = F.col("ts").cast("timestamp")
    seconds = F.floor(F.coalesce("value", F.lit(0.0))).cast("long")
    return w.base["events"].select(
        "user_id",
        "event_type",
        start.alias("start_ts"),
        F.timestamp_micros(F.unix_micros(start) + seconds * 1_000_000).alias("end_ts"),
    )


def interval_count(w: Warehouse) -> DataFrame:
    out = slices.count_following(_spans(w), "user_id", "start_ts", "end_ts", 86_400, ["event_type"])
    return out.groupBy("user_id", "end_ts", "event_type").agg(
        F.sum("rows").alias("rows"), F.max("matches").alias("matches")
    )


def previous_contact(w: Warehouse) -> DataFrame:
    rows = w.base["events"].select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    out = slices.neighbour(rows, ["user_id"], "ts", ["event_id"], ["event_id", "ts"], "before")
    return out.select("event_id", "user_id", F.col("before.event_id").alias("before_id"), F.col("before.ts").alias("before_ts"))


def global_rank(w: Warehouse) -> DataFrame:
    placed = w.base["orders"].select("o_orderkey", "o_orderpriority", "o_totalprice")
    order = [*ranking.descending("o_totalprice"), *ranking.ascending("o_orderkey")]
    rows = orders.positions(placed, order, "position")
    rows = orders.ranks(rows, ranking.ascending("o_orderpriority"), "prio_rank")
    return rows.select(
        "o_orderkey",
        "position",
        ranking.ntile(7, F.col("position"), F.col("position_total")).alias("seventh"),
        "prio_rank",
        "prio_rank_dense",
        ranking.percent_rank(F.col("prio_rank"), F.col("prio_rank_total")).alias("prio_pct"),
    )


def rollup_grouping(w: Warehouse) -> DataFrame:
    rows = w.base["orders"].select(
        F.trunc(F.to_date("o_orderdate"), "MM").alias("period_month"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )
    leaves = rows.groupBy("period_month", "status", "priority").agg(F.count(F.lit(1)).alias("orders"))
    return aggs.monthly_rollup(leaves, ["status", "priority"], ["orders"], "grouping_level")


def recursive_tree(w: Warehouse) -> DataFrame:
    keep = ["org_unit_id", "unit_type"]
    units = cleanse.loaded(w.get("stg_hr_org_unit"), RUN_DATE)
    return tree.root_paths(units, "org_unit_id", "parent_unit_id", "unit_code", keep)


def json_map_get(w: Warehouse) -> DataFrame:
    k = json_key("props", "k").cast("long")
    return (
        w.base["events"]
        .groupBy("event_type")
        .agg(F.count(k).alias("with_key"), F.sum(k).alias("key_sum"), F.max(k).alias("key_max"))
    )


def regex_class(w: Warehouse) -> DataFrame:
    text = F.col("text")
    return w.base["documents"].select(
        "doc_id", call_driver(text).alias("call_driver"), first_group(text, EMBEDDED_REF).alias("embedded_ref_no")
    )


def string_agg(w: Warehouse) -> DataFrame:
    return textagg.ordered_join(w.base["conversations"], ["conv_id"], "turn", "role", " > ", "roles")


def pivot_states(w: Warehouse) -> DataFrame:
    kinds = ("click", "error", "purchase", "signup", "view")
    length = F.floor("value").cast("long")
    return (
        w.base["events"]
        .groupBy("user_id")
        .agg(*[F.sum(F.when(F.col("event_type") == k, length).otherwise(0)).alias(f"{k}_total") for k in kinds])
    )


def approx_distinct(w: Warehouse) -> DataFrame:
    counts = (
        w.base["orders"]
        .groupBy("o_orderpriority")
        .agg(F.approx_count_distinct("o_custkey", 0.05).alias("a"), F.count_distinct("o_custkey").alias("e"))
    )
    return counts.select("o_orderpriority", F.col("e").alias("customers"), _within("a", "e").alias("within_bound"))


def partition_replace(w: Warehouse) -> DataFrame:
    """The day's attempts written twice; late rows go to their own day and stay single."""
    path = fresh_path(w.spark, "ods_dialer_attempt")
    for _ in range(2):
        sink.replace_partition(w.build("ods_dialer_attempt"), path, "ods_dialer_attempt", RUN_DATE)
    return sink.read_table(w.spark, path, "ods_dialer_attempt")


def partition_isolation(w: Warehouse) -> DataFrame:
    """Three run dates that deliver rows of each other's days, run out of order and again.

    One run first delivers what it should not have: rows that belong to another run. Running it
    again takes them away from every partition, and what the other runs delivered stays.
    """
    name, path = "ods_dialer_attempt", fresh_path(w.spark, "ods_dialer_attempt")
    dialer = w.get("stg_file_dialer_result")
    before, after = RUN_DATE - dt.timedelta(days=1), RUN_DATE + dt.timedelta(days=1)
    for run, delivered in [(after, after), (before, RUN_DATE), (RUN_DATE, RUN_DATE), (before, before), (after, after)]:
        runs.deliver(cleanse.dialer_attempt(dialer, delivered), path, name, run)
    return sink.read_table(w.spark, path, name)


# --- feeds -------------------------------------------------------------------------------
# Each writes the staging rows as a file feed, adds lines that do not fit, and reads it back.
# A rejected line appears as a row that holds only its text, in the feed's reference column.


def _with_rejects(rows: DataFrame, rejects: DataFrame, column: str) -> DataFrame:
    return rows.unionByName(rejects.select(F.col("line").alias(column)), allowMissingColumns=True)


def feed_csv(w: Warehouse) -> DataFrame:
    path = fresh_path(w.spark, "feed-csv")
    options = {"header": True, "escape": '"', "emptyValue": '""'}
    options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    w.get("stg_file_survey_csat").write.options(**options).csv(path)
    # A second file, with a header line of its own, whose survey time is no number.
    names = TABLES["stg_file_survey_csat"].names
    bad = {"survey_id": F.concat(F.lit("S-"), F.col("doc_id").cast("string"))}
    bad |= {"interaction_ref": F.lit("V"), "survey_ms": F.lit("not-a-number")}
    wrong = w.base["labels"].select(*[bad.get(n, F.lit(None).cast("string")).alias(n) for n in names])
    wrong.write.mode("append").options(**options).csv(path)
    rows, rejects = feeds.csv_feed(w.spark, path, "stg_file_survey_csat")
    return _with_rejects(rows, rejects, "survey_id")


def feed_pipe(w: Warehouse) -> DataFrame:
    path = fresh_path(w.spark, "feed-pipe")
    w.get("stg_fin_timesheet_delta").write.options(sep="|", header=False).csv(path)
    bad = w.base["labels"].select(F.concat(F.lit("no-number-"), F.col("doc_id").cast("string")).alias("value"))
    bad.write.mode("append").text(path)
    rows, rejects = feeds.pipe_feed(w.spark, path, "stg_fin_timesheet_delta")
    return _with_rejects(rows, rejects, "work_date")


def feed_json(w: Warehouse) -> DataFrame:
    path = fresh_path(w.spark, "feed-json")
    w.get("stg_file_chat_transcripts").write.json(path)
    bad = w.base["labels"].select(F.concat(F.lit("{broken "), F.col("doc_id").cast("string")).alias("value"))
    bad.write.mode("append").text(path)
    rows, rejects = feeds.json_feed(w.spark, path, "stg_file_chat_transcripts")
    flat = rows.select(
        "chat_ref",
        "client_code",
        "started_ms",
        json_key("metadata", "lang").alias("lang"),
        F.size("messages").alias("messages"),
        F.aggregate("messages", F.lit(0).cast("long"), lambda a, m: a + F.length(m["text"])).alias("characters"),
        F.array_max(F.transform("messages", lambda m: m["ts_ms"])).alias("last_ms"),
    )
    return _with_rejects(flat, rejects, "chat_ref")


def feed_regex(w: Warehouse) -> DataFrame:
    path = fresh_path(w.spark, "feed-ivr")
    line = F.concat_ws(
        "|",
        F.col("event_ms").cast("string"),
        F.col("session_ref"),
        F.concat(F.lit("MENU:"), F.col("menu_path"), F.lit(";KEY:"), F.col("key_pressed")),
        F.col("raw_tail"),
    )
    w.get("stg_file_ivr_logs").select(line.alias("value")).write.text(path)
    bad = w.base["labels"].select(F.concat(F.lit("noise "), F.col("doc_id").cast("string")).alias("value"))
    bad.write.mode("append").text(path)
    rows, rejects = feeds.ivr_feed(w.spark, path, "CL7", RUN_DATE)
    return _with_rejects(rows, rejects.withColumnRenamed("value", "line"), "raw_tail")


def feed_parquet(w: Warehouse) -> DataFrame:
    path = fresh_path(w.spark, "feed-parquet")
    w.get("stg_file_telco_invoice").write.parquet(path)
    return feeds.parquet_feed(w.spark, path, "stg_file_telco_invoice")


# --- data quality ------------------------------------------------------------------------

CLEANSED = {
    "ods_program": ["program_id"],
    "ods_call": ["call_id"],
    "ods_email_interaction": ["email_ref"],
    "ods_ivr_session": ["session_ref", "client_code"],
    "ods_interaction": ["interaction_id"],
}


def dq_pk_unique(w: Warehouse) -> DataFrame:
    raw = quality.pk_unique(w.get("stg_tel_call"), "stg_tel_call", ["call_id"])
    frames = [quality.pk_unique(w.get(t), t, pk) for t, pk in CLEANSED.items()]
    out = raw
    for f in frames:
        out = out.unionByName(f)
    return out


# Every declared table that the warehouse builds.
POPULATED = [t for t in TABLES if t in RECIPES or t in {s.target for s in STEPS}]


def dq_table_populated(w: Warehouse) -> DataFrame:
    w.fill(POPULATED)
    return quality.table_populated({t: w.get(t) for t in POPULATED})


def dq_epoch_range(w: Warehouse) -> DataFrame:
    invoice = quality.epoch_range(
        w.get("stg_fin_invoice"), "stg_fin_invoice", {"issued_ts_sec": "s", "due_ts_sec": "s"}
    )
    call = quality.epoch_range(
        w.get("stg_tel_call"), "stg_tel_call", {"start_epoch": "s", "answer_epoch": "s", "end_epoch": "s"}
    )
    mail = quality.epoch_range(
        w.get("stg_file_email_interaction"),
        "stg_file_email_interaction",
        {"received_ms": "ms", "first_reply_ms": "ms", "resolved_ms": "ms"},
    )
    return invoice.unionByName(call).unionByName(mail)


def dq_string_date(w: Warehouse) -> DataFrame:
    good = quality.string_dates(w.get("stg_crm_contract"), "stg_crm_contract", ["start_dt", "end_dt", "signed_dt"])
    bad = quality.string_dates(w.get("stg_crm_contract"), "stg_crm_contract", ["contract_no"])
    return good.unionByName(bad)


def dq_fk_default(w: Warehouse) -> DataFrame:
    return quality.fk_default(
        w.get("fact_interaction"),
        "fact_interaction",
        {
            "agent_sk": (w.get("dim_agent"), "agent_sk"),
            "queue_sk": (w.get("dim_queue"), "queue_sk"),
            "client_sk": (w.get("dim_client"), "client_sk"),
        },
    )


MEASURES = {"fact_agent_activity": "state_seconds", "fact_adherence_daily": "worked_minutes"}


def dq_negative_values(w: Warehouse) -> DataFrame:
    out = None
    for t, column in MEASURES.items():
        rows = quality.negative_values(w.get(t), t, [column])
        out = rows if out is None else out.unionByName(rows)
    return out


def dq_schema_contract(w: Warehouse) -> DataFrame:
    out = None
    for t in POPULATED:
        rows = quality.schema_contract(w.get(t), t)
        out = rows if out is None else out.unionByName(rows)
    return out


def dq_contract_faults(w: Warehouse) -> DataFrame:
    """Evaluations with NULL keys, shares that do not fit, events without a day, and a renamed column; calls whose
    partition column is a text and which lack their last time."""
    rows = w.get("ods_qa_evaluation")
    points = F.col("scored_points")
    faults = rows.withColumns(
        {
            "qa_form_id": F.when(points % 3 != 0, F.col("qa_form_id")),
            "overall_pct": F.col("overall_pct").cast("decimal(12,2)") + F.when(points % 5 == 0, 10**6).otherwise(0).cast("decimal(9,2)"),
            "event_date": F.when(points % 2 == 0, F.col("event_date")),
        }
    ).withColumnRenamed("form_version", "version")
    calls = w.get("ods_call").withColumn("call_date", F.col("call_date").cast("string")).withColumn("end_ts", F.lit(None).cast("long"))
    return quality.schema_contract(faults, "ods_qa_evaluation").unionByName(quality.schema_contract(calls, "ods_call"))


HISTORIES = {
    "ods_agent_scd2": (["agent_id"], "agent_history_id"),
    "ods_agent_skill_scd2": (["agent_id", "skill_id"], "agent_skill_history_id"),
    "ods_agent_assignment_scd2": (["agent_id", "program_id"], "assignment_history_id"),
}


def dq_scd2_integrity(w: Warehouse) -> DataFrame:
    out = None
    for t, (keys, id_column) in HISTORIES.items():
        rows = quality.scd2_integrity(w.get(t), t, keys, id_column)
        out = rows if out is None else out.unionByName(rows)
    return out


def dq_edge_values(w: Warehouse) -> DataFrame:
    """Whole documents with extreme numbers, empty and missing texts through three formats."""
    docs = w.base["documents"]
    edge = F.when(F.col("doc_id") % 2 == 0, F.lit(9223372036854775807)).otherwise(F.lit(-9223372036854775808))
    marker = F.when(F.col("doc_id") % 3 == 0, F.lit("")).when(F.col("doc_id") % 3 == 1, F.lit("café\t日本語\n\U0001f389"))
    rows = docs.select("doc_id", "text", "lang", edge.alias("edge_number"), marker.alias("edge_text"))
    return quality.edge_values(rows, fresh_path(w.spark, "edge-values"))


def dq_dim_date_match(w: Warehouse) -> DataFrame:
    source = calendar.calendar_of(w.get("obs_calendar"), "d")
    return quality.dim_date_match(load_dim_date(w), source)


def table_diff(w: Warehouse) -> DataFrame:
    """The day's latest calls against the raw rows of all deliveries of each call. No call is left out on either side."""
    raw = w.get("stg_tel_call").groupBy("call_id").agg(
        F.min("end_epoch").alias("end_epoch"), F.min("recording_id").alias("recording_id"), F.max("agent_id").alias("agent_id")
    )
    clean = w.get("ods_call").select(
        "call_id", time.seconds("end_ts").alias("end_epoch"), "recording_id", "agent_id"
    )
    return quality.table_diff(clean, raw, ["call_id"])


def _tickets(w: Warehouse, *days: dt.date) -> DataFrame:
    rows = w.get("stg_tkt_ticket")
    return rows.where(F.col("load_date").isin([F.lit(d) for d in days])).select("ticket_id", "status", "updated_ms", "priority")


def table_diff_ranges(w: Warehouse) -> DataFrame:
    """The run date's tickets against a copy whose lowest sixteenth of the keys came on an earlier day:
    some with other values, and most not at all. The same tickets, under high numbers, are on one side only."""
    left = _tickets(w, RUN_DATE)
    low = F.floor(w.get("stg_tkt_ticket").agg(F.max("ticket_id")).first()[0] / F.lit(16))
    early = _tickets(w, DELIVERY_DAYS[0]).where(F.col("ticket_id") <= low)
    right = left.where(F.col("ticket_id") > low).unionByName(early)
    lone = early.withColumn("ticket_id", F.col("ticket_id") + 10**7)
    return quality.ranged_diff(store(left, "left"), store(right.unionByName(lone), "right"), "ticket_id")


def dq_scd2_faults(w: Warehouse) -> DataFrame:
    """The skill history with wrong surrogates, keys without a current version and gaps."""
    rows = w.get("ods_agent_skill_scd2")
    agent = F.col("agent_id")
    broken = rows.withColumns(
        {
            "agent_skill_history_id": F.when(agent % 5 == 0, F.lit("x")).otherwise(F.col("agent_skill_history_id")),
            "is_current": F.col("is_current") & (agent % 3 != 0),
            "eff_to_ts": F.when(agent % 4 == 1, F.col("eff_to_ts") + F.expr("INTERVAL 1 SECOND")).otherwise(F.col("eff_to_ts")),
        }
    )
    return quality.scd2_integrity(broken, "ods_agent_skill_scd2", ["agent_id", "skill_id"], "agent_skill_history_id")


def dq_dim_date_faults(w: Warehouse) -> DataFrame:
    """A calendar that lacks the 13th of each month and shows July's weekends as working days."""
    source = calendar.calendar_of(w.get("obs_calendar"), "d")
    loaded = source.where(F.col("date_key") % 100 != 13).withColumn("is_weekend", F.col("is_weekend") & (F.col("month_no") != 7))
    return quality.dim_date_match(loaded, source)


def active_agents_merged(w: Warehouse) -> DataFrame:
    """Agents per site over all days, and over all, from one stored sketch per day and site."""
    daily = store(views.active_agent_sketches(w.get("fact_interaction"), w.get("dim_agent")), "sketches")
    month = F.floor(F.col("date_key") / 100).cast("long").alias("month_key")
    sites = views.active_agents_over(daily, month, F.col("site_code"))
    return sites.unionByName(views.active_agents_over(daily, month).withColumn("site_code", F.lit("all")))


def dq_report(w: Warehouse) -> DataFrame:
    """All checks in one report. Few tables are built at a time, as disk is what the report is short of."""
    w.fill(POPULATED, at_once=2)
    checks = {
        "pk_unique": dq_pk_unique,
        "table_populated": dq_table_populated,
        "epoch_range": dq_epoch_range,
        "string_date": dq_string_date,
        "fk_default": dq_fk_default,
        "negative_values": dq_negative_values,
        "schema_contract": dq_schema_contract,
        "scd2_integrity": dq_scd2_integrity,
        "edge_values": dq_edge_values,
        "dim_date_match": dq_dim_date_match,
        "table_diff": table_diff,
    }
    return quality.report({name: check(w) for name, check in checks.items()})


QUERIES: dict[str, Query] = {
    **{q: (lambda w, t=t: w.build(t)) for q, t in PIPELINES.items()},
    **{q: _merged(m, d, t) for q, (m, d, t) in MERGES.items()},
    **{q: _upserted(t) for q, t in UPSERTS.items()},
    **{q: _spliced(t) for q, t in SPLICED.items()},
    "load_dim_date": load_dim_date,
    "vw_program_margin": program_margin,
    "vw_active_agents_ndv": active_agents_ndv,
    "dedup_latest": dedup_latest,
    "interval_bucket": interval_bucket,
    "interval_count": interval_count,
    "previous_contact": previous_contact,
    "global_rank": global_rank,
    "rollup_grouping": rollup_grouping,
    "recursive_tree": recursive_tree,
    "json_map_get": json_map_get,
    "regex_class": regex_class,
    "string_agg": string_agg,
    "pivot_states": pivot_states,
    "approx_distinct": approx_distinct,
    "partition_replace": partition_replace,
    "partition_isolation": partition_isolation,
    "feed_csv": feed_csv,
    "feed_pipe": feed_pipe,
    "feed_json": feed_json,
    "feed_regex": feed_regex,
    "feed_parquet": feed_parquet,
    "dq_pk_unique": dq_pk_unique,
    "dq_table_populated": dq_table_populated,
    "dq_epoch_range": dq_epoch_range,
    "dq_string_date": dq_string_date,
    "dq_fk_default": dq_fk_default,
    "dq_negative_values": dq_negative_values,
    "dq_schema_contract": dq_schema_contract,
    "dq_scd2_integrity": dq_scd2_integrity,
    "dq_edge_values": dq_edge_values,
    "dq_dim_date_match": dq_dim_date_match,
    "table_diff": table_diff,
    "table_diff_ranges": table_diff_ranges,
    "dq_scd2_faults": dq_scd2_faults,
    "dq_dim_date_faults": dq_dim_date_faults,
    "dq_contract_faults": dq_contract_faults,
    "active_agents_merged": active_agents_merged,
    "dq_report": dq_report,
    # Whole states from all deliveries at once; what one run makes of a delivery is timed apart.
    **{f"rebuild_{t.removeprefix('ods_')}": (lambda w, t=t: w.build(t)) for t in REBUILT},
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, folder, q=query: plain(q(warehouse(spark, folder)))) for name, query in QUERIES.items()
    }


# --- oracles of the entries that are not declared tables ----------------------------------


def _status(ok: str) -> str:
    return f"CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status"


def _pk(table: str, pk: list[str]) -> str:
    keys = ", ".join(pk)
    return (
        f"SELECT '{table}' AS table_name, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS key_count, "
        f"count(*) FILTER (n > 1) AS duplicate_keys, {_status('count(*) FILTER (n > 1) = 0')} "
        f"FROM (SELECT {keys}, count(*) AS n FROM {table} GROUP BY {keys})"
    )


def _epoch(table: str, column: str, unit: str) -> str:
    big = f"count(*) FILTER (abs({column}) >= 100000000000)"
    found = f"CASE WHEN 2 * {big} > count({column}) THEN 'ms' ELSE 's' END"
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{unit}' AS declared_unit, "
        f"count({column}) AS value_count, min({column}) AS min_value, max({column}) AS max_value, "
        f"{big} AS millis_count, {found} AS detected_unit, {_status(found + f' = {chr(39)}{unit}{chr(39)}')} FROM {table}"
    )


def _string_date(column: str) -> str:
    parsed = f"try_strptime({column}, '%Y%m%d%H%M%S')"
    bad = f"count(*) FILTER ({column} IS NOT NULL AND {parsed} IS NULL)"
    return (
        f"SELECT 'stg_crm_contract' AS table_name, '{column}' AS column_name, "
        f"count(*) FILTER ({column} IS NULL) AS null_count, count({parsed}) AS parsed_count, "
        f"{bad} AS rejected_count, {_status(bad + ' = 0')} FROM stg_crm_contract"
    )


def _fk(column: str, dim: str) -> str:
    orphan = f"count(*) FILTER ({column} <> -1 AND {column} NOT IN (SELECT {column} FROM {dim}))"
    return (
        f"SELECT 'fact_interaction' AS table_name, '{column}' AS key_name, count(*) AS row_count, "
        f"count(*) FILTER ({column} = -1) AS unknown_count, count(*) FILTER ({column} IS NULL) AS null_count, "
        f"{orphan} AS orphan_count, {_status(f'count({column}) = count(*) AND {orphan} = 0')} FROM fact_interaction"
    )


def _contract(table: str) -> str:
    spec = TABLES[table]
    count = lambda parts: f"count(*) FILTER ({' OR '.join(parts) or 'false'})"
    no_key, part = count([f"{c} IS NULL" for c in spec.pk]), spec.partition
    sizes = [(c, re.match(r"DECIMAL\((\d+),\s*(\d+)\)$", kind)) for c, kind in spec.columns]
    over = " + ".join(
        ["CAST(0 AS BIGINT)", *[f"count(*) FILTER (abs(CAST({c} AS DOUBLE)) >= 1e{int(m[1]) - int(m[2])})" for c, m in sizes if m]]
    )
    return (
        f"SELECT '{table}' AS table_name, CAST({len(spec.columns)} AS BIGINT) AS declared_columns, "
        f"CAST(0 AS BIGINT) AS schema_differences, {f'typeof(max({part}))' if part else 'CAST(NULL AS VARCHAR)'} AS partition_type, "
        f"{count([f'{part} IS NULL'] if part else [])} AS null_partition_rows, {no_key} AS null_key_rows, "
        f"{over} AS overflow_values, {_status(f'{no_key} = 0 AND {over} = 0')} FROM {table}"
    )


def _history(table: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, count(*) AS version_count, CAST(0 AS BIGINT) AS bad_surrogates, "
        f"CAST(0 AS BIGINT) AS keys_without_one_current, CAST(0 AS BIGINT) AS broken_ranges, 'PASS' AS status FROM {table}"
    )


def _difference(label: str, table: str) -> str:
    return (
        f"SELECT '{label}' AS comparison, count(*) AS row_count, CAST(0 AS BIGINT) AS missing_rows, "
        f"CAST(0 AS BIGINT) AS extra_rows, 'PASS' AS status FROM {table}"
    )


def _all(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


DQ_PK = _all([_pk("stg_tel_call", ["call_id"]), *[_pk(t, pk) for t, pk in CLEANSED.items()]])
DQ_POPULATED = _all(
    [f"SELECT '{t}' AS table_name, count(*) AS row_count, {_status('count(*) > 0')} FROM {t}" for t in POPULATED]
)
DQ_EPOCH = _all(
    [
        *[_epoch("stg_fin_invoice", c, "s") for c in ("issued_ts_sec", "due_ts_sec")],
        *[_epoch("stg_tel_call", c, "s") for c in ("start_epoch", "answer_epoch", "end_epoch")],
        *[_epoch("stg_file_email_interaction", c, "ms") for c in ("received_ms", "first_reply_ms", "resolved_ms")],
    ]
)


def _detail(check: str, query: str, columns: list[str]) -> str:
    text = " || ' ' || ".join(f"'{c}=' || coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in columns)
    return f"SELECT '{check}' AS check_name, {text} AS detail, status FROM ({query})"


DQ_DATES = _all([_string_date(c) for c in ("start_dt", "end_dt", "signed_dt", "contract_no")])
DQ_FK = _all([_fk("agent_sk", "dim_agent"), _fk("queue_sk", "dim_queue"), _fk("client_sk", "dim_client")])
DQ_NEGATIVE = _all(
    [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS value_count, "
        f"count(*) FILTER ({c} < 0) AS negative_count, CAST(min({c}) AS BIGINT) AS min_value, "
        f"{_status(f'count(*) FILTER ({c} < 0) = 0')} FROM {t}"
        for t, c in MEASURES.items()
    ]
)
DQ_CONTRACT = _all([_contract(t) for t in POPULATED])
DQ_HISTORY = _all([_history(t) for t in HISTORIES])
DQ_EDGE = _all([_difference(f, "documents") for f in ("parquet", "csv", "json")])
DQ_CALENDAR = _difference("dim_date", "dim_date")


def _report_lines() -> str:
    """All checks as texts; the columns stand in the order in which each check gives them."""
    bag = "comparison row_count missing_rows extra_rows"
    return _all(
        [
            _detail(check, query, columns.split())
            for check, query, columns in (
                ("pk_unique", DQ_PK, "table_name row_count key_count duplicate_keys"),
                ("table_populated", DQ_POPULATED, "table_name row_count"),
                (
                    "epoch_range",
                    DQ_EPOCH,
                    "column_name declared_unit value_count min_value max_value millis_count table_name detected_unit",
                ),
                ("string_date", DQ_DATES, "table_name column_name null_count parsed_count rejected_count"),
                ("fk_default", DQ_FK, "table_name key_name row_count unknown_count null_count orphan_count"),
                ("negative_values", DQ_NEGATIVE, "table_name column_name value_count negative_count min_value"),
                (
                    "schema_contract",
                    DQ_CONTRACT,
                    "table_name declared_columns schema_differences partition_type null_partition_rows null_key_rows overflow_values",
                ),
                (
                    "scd2_integrity",
                    DQ_HISTORY,
                    "table_name version_count bad_surrogates keys_without_one_current broken_ranges",
                ),
                ("edge_values", DQ_EDGE, bag),
                ("dim_date_match", DQ_CALENDAR, bag),
                ("table_diff", TABLE_DIFF, "column_name compared differing"),
            )
        ]
    )


def _feed(table: str, column: str, line: str, exclude: str = "") -> str:
    """The feed's rows and one row per rejected line, which holds only that line."""
    return f"SELECT * {exclude} FROM ({sql.plain(table)}) UNION ALL BY NAME SELECT {line} AS {column} FROM labels"


def _sides(left: str, right: str, columns: list[str]) -> str:
    """Both sides of a comparison by key, ``same_`` for equal columns; keys that only one side has are there too."""
    same = ", ".join(f"l.{c} IS NOT DISTINCT FROM r.{c} AS same_{c}" for c in columns)
    return (
        f"l AS ({left}), r AS ({right}), pairs AS (SELECT coalesce(l.k, r.k) AS k, l.k IS NOT NULL AND r.k IS NOT NULL AS met, "
        f"{same} FROM l FULL JOIN r ON l.k = r.k)"
    )


def _lines(columns: list[str], where: str = "TRUE") -> str:
    lines = [
        f"SELECT '{c}' AS column_name, count(*) FILTER (met) AS compared, count(*) FILTER (met AND NOT same_{c}) AS differing "
        f"FROM pairs WHERE {where}"
        for c in columns
    ]
    lines.append(f"SELECT '(coverage)', count(*), count(*) FILTER (NOT met) FROM pairs WHERE {where}")
    return " UNION ALL ".join([*lines, f"SELECT '(repeated keys)', count(*), 0 FROM pairs WHERE {where}"])


def _diff(left: str, right: str, columns: list[str]) -> str:
    return f"WITH {_sides(left, right, columns)}, found AS ({_lines(columns)}) SELECT *, {_status('differing = 0')} FROM found"


def _ranged(left: str, right: str, columns: list[str]) -> str:
    """Two levels of 64 ranges, then the rows of the unlike ranges."""
    alike = " AND ".join(["met", *[f"same_{c}" for c in columns]])
    return f"""
        WITH {_sides(left, right, columns)}, cut AS (
            SELECT min(k) AS low, (max(k) - min(k) + 64) // 64 AS w FROM pairs
        ), coarse AS (
            SELECT (k - low) // w AS a, bool_and({alike}) AS alike, any_value(low) AS low, any_value(w) AS w
            FROM pairs, cut GROUP BY a
        ), begun AS (
            SELECT low + min(a) * w AS low, (w + 63) // 64 AS v FROM coarse WHERE NOT alike GROUP BY low, w
        ), fine AS (
            SELECT (k - b.low) // v AS f, bool_and({alike}) AS alike
            FROM pairs, begun b WHERE (k - (SELECT low FROM cut)) // (SELECT w FROM cut) IN (SELECT a FROM coarse WHERE NOT alike)
            GROUP BY f
        ), found AS (
            SELECT '(ranges, level 1)' AS column_name, count(*) AS compared, count(*) FILTER (NOT alike) AS differing FROM coarse
            UNION ALL SELECT '(ranges, level 2)', count(*), count(*) FILTER (NOT alike) FROM fine
            UNION ALL {_lines(columns, '(k - (SELECT low FROM begun)) // (SELECT v FROM begun) IN (SELECT f FROM fine WHERE NOT alike)')}
        ) SELECT *, {_status('differing = 0')} FROM found"""


TICKET = "ticket_id AS k, status, updated_ms, priority"
LOW_TICKET = "(SELECT max(ticket_id) // 16 FROM stg_tkt_ticket)"
SPANS = "SELECT user_id, event_type, ts AS s, ts + to_seconds(CAST(floor(coalesce(value, 0)) AS BIGINT)) AS e FROM events"

TABLE_DIFF = _diff(
    "SELECT call_id AS k, epoch_us(end_ts) // 1000000 AS end_epoch, recording_id, agent_id FROM ods_call",
    "SELECT call_id AS k, min(end_epoch) AS end_epoch, min(recording_id) AS recording_id, max(agent_id) AS agent_id "
    "FROM stg_tel_call GROUP BY call_id",
    ["end_epoch", "recording_id", "agent_id"],
)

ORACLES: dict[str, str] = {
    "load_dim_date": sql.plain("dim_date"),
    "vw_program_margin": "SELECT * FROM vw_program_margin",
    "vw_active_agents_ndv": "SELECT * FROM vw_active_agents_ndv",
    "dedup_latest": """
        SELECT * REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM lineitem QUALIFY 1 = row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
            l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC)""",
    "interval_bucket": """
        SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS bucket_ts, event_type, count(*) AS events,
               min(event_id) AS first_event FROM events GROUP BY ALL""",
    "interval_count": f"""
        WITH spans AS ({SPANS})
        SELECT user_id, e AS end_ts, event_type, count(*) AS rows, any_value(matches) AS matches
        FROM (
            SELECT a.user_id, a.e, a.event_type, a.s,
                   (SELECT count(*) FROM spans b WHERE b.user_id = a.user_id AND b.s > a.e
                    AND b.s <= a.e + INTERVAL 1 DAY) AS matches
            FROM spans a
        ) GROUP BY user_id, e, event_type""",
    "previous_contact": """
        SELECT event_id, user_id, lag(event_id) OVER w AS before_id, lag(ts) OVER w AS before_ts
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "global_rank": """
        SELECT o_orderkey, row_number() OVER p AS position, ntile(7) OVER p AS seventh, rank() OVER k AS prio_rank,
               dense_rank() OVER k AS prio_rank_dense, percent_rank() OVER k AS prio_pct
        FROM orders WINDOW p AS (ORDER BY o_totalprice DESC, o_orderkey), k AS (ORDER BY o_orderpriority)""",
    "rollup_grouping": """
        SELECT strftime(period_month, '%Y-%m-%d') AS period_month, status, priority, count(*) AS orders,
               grouping(status, priority) AS grouping_level
        FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_month, o_orderstatus AS status,
                     o_orderpriority AS priority FROM orders)
        GROUP BY period_month, ROLLUP (status, priority)""",
    "recursive_tree": """
        WITH RECURSIVE walk AS (
            SELECT org_unit_id, unit_type, org_unit_id AS root_unit_id, CAST(0 AS BIGINT) AS depth, unit_code AS path_names
            FROM stg_hr_org_unit_today WHERE parent_unit_id IS NULL
            UNION ALL
            SELECT c.org_unit_id, c.unit_type, w.root_unit_id, w.depth + 1, w.path_names || ' > ' || c.unit_code
            FROM walk w JOIN stg_hr_org_unit_today c ON c.parent_unit_id = w.org_unit_id WHERE w.depth <= 5
        ) SELECT * FROM walk""",
    "json_map_get": """
        SELECT event_type, count(k) AS with_key, CAST(sum(k) AS BIGINT) AS key_sum, max(k) AS key_max
        FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type""",
    "regex_class": f"""
        SELECT doc_id, {sql.DRIVER.format('text')} AS call_driver, {sql.REF.format('text')} AS embedded_ref_no
        FROM documents""",
    "string_agg": "SELECT conv_id, string_agg(role, ' > ' ORDER BY turn, role) AS roles FROM conversations GROUP BY conv_id",
    "pivot_states": "SELECT user_id, "
    + ", ".join(
        f"CAST(coalesce(sum(floor(value)) FILTER (event_type = '{k}'), 0) AS BIGINT) AS {k}_total"
        for k in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM events GROUP BY user_id",
    "approx_distinct": """
        SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers, TRUE AS within_bound
        FROM orders GROUP BY o_orderpriority""",
    "partition_replace": sql.plain("ods_dialer_attempt"),
    "partition_isolation": sql.plain("ods_dialer_attempt", source="dialer_runs"),
    "feed_csv": _feed("stg_file_survey_csat", "survey_id", "'S-' || doc_id || ',V,not-a-number,,,,,,'"),
    "feed_pipe": _feed("stg_fin_timesheet_delta", "work_date", "'no-number-' || doc_id"),
    "feed_json": """
        SELECT chat_ref, client_code, started_ms, json_extract_string(metadata, '$.lang') AS lang, len(messages) AS messages,
               CAST(list_sum(list_transform(messages, lambda m: length(m.text))) AS BIGINT) AS characters,
               list_max(list_transform(messages, lambda m: m.ts_ms)) AS last_ms
        FROM stg_file_chat_transcripts
        UNION ALL BY NAME SELECT '{broken ' || doc_id AS chat_ref FROM labels""",
    "feed_regex": """
        SELECT event_ms, session_ref, menu_path, key_pressed, raw_tail, 'CL7' AS client_code, '2024-01-15' AS feed_date
        FROM stg_file_ivr_logs
        UNION ALL BY NAME SELECT 'noise ' || doc_id AS raw_tail FROM labels""",
    "feed_parquet": sql.plain("stg_file_telco_invoice"),
    "dq_pk_unique": DQ_PK,
    "dq_table_populated": DQ_POPULATED,
    "dq_epoch_range": DQ_EPOCH,
    "dq_string_date": DQ_DATES,
    "dq_fk_default": DQ_FK,
    "dq_negative_values": DQ_NEGATIVE,
    "dq_schema_contract": DQ_CONTRACT,
    "dq_contract_faults": """
        SELECT 'ods_qa_evaluation' AS table_name, CAST(12 AS BIGINT) AS declared_columns, CAST(2 AS BIGINT) AS schema_differences,
               'DATE' AS partition_type, count(*) FILTER (NOT coalesce(scored_points % 2 = 0 AND event_date IS NOT NULL, false)) AS null_partition_rows,
               count(*) FILTER (NOT coalesce(scored_points % 3 <> 0, false)) AS null_key_rows,
               count(*) FILTER (scored_points % 5 = 0 AND overall_pct IS NOT NULL) AS overflow_values, 'FAIL' AS status
        FROM ods_qa_evaluation
        UNION ALL
        SELECT 'ods_call', CAST(16 AS BIGINT), CAST(2 AS BIGINT), 'STRING', count(*) FILTER (call_date IS NULL),
               count(*) FILTER (call_id IS NULL), CAST(0 AS BIGINT), 'FAIL' FROM ods_call""",
    "dq_scd2_integrity": DQ_HISTORY,
    "dq_edge_values": DQ_EDGE,
    "dq_dim_date_match": DQ_CALENDAR,
    "table_diff": TABLE_DIFF,
    "table_diff_ranges": _ranged(
        f"SELECT {TICKET} FROM stg_tkt_ticket WHERE load_date = DATE '2024-01-15'",
        f"""SELECT {TICKET} FROM stg_tkt_ticket WHERE load_date = DATE '2024-01-15' AND ticket_id > {LOW_TICKET}
        UNION ALL SELECT {TICKET} FROM stg_tkt_ticket WHERE load_date = DATE '2024-01-13' AND ticket_id <= {LOW_TICKET}
        UNION ALL SELECT {TICKET.replace('ticket_id AS k', 'ticket_id + 10000000 AS k')} FROM stg_tkt_ticket
        WHERE load_date = DATE '2024-01-13' AND ticket_id <= {LOW_TICKET}""",
        ["status", "updated_ms", "priority"],
    ),
    "dq_scd2_faults": """
        SELECT 'ods_agent_skill_scd2' AS table_name, count(*) AS version_count,
               count(*) FILTER (agent_id % 5 = 0) AS bad_surrogates,
               count(DISTINCT (agent_id, skill_id)) FILTER (agent_id % 3 = 0) AS keys_without_one_current,
               count(*) FILTER (agent_id % 4 = 1 AND eff_to_ts IS NOT NULL) AS broken_ranges, 'FAIL' AS status
        FROM ods_agent_skill_scd2""",
    "dq_dim_date_faults": """
        SELECT 'dim_date' AS comparison, count(*) AS row_count,
               count(*) FILTER (date_key % 100 = 13 OR (month_no = 7 AND is_weekend)) AS missing_rows,
               count(*) FILTER (date_key % 100 <> 13 AND month_no = 7 AND is_weekend) AS extra_rows, 'FAIL' AS status
        FROM dim_date""",
    "active_agents_merged": """
        WITH seen AS (
            SELECT date_key // 100 AS month_key, site_code, agent_sk
            FROM fact_interaction JOIN (SELECT agent_sk, site_code FROM dim_agent) USING (agent_sk)
        )
        SELECT month_key, site_code, count(DISTINCT agent_sk) AS active_agents, count(*) AS interactions
        FROM seen GROUP BY month_key, site_code
        UNION ALL SELECT month_key, 'all', count(DISTINCT agent_sk), count(*) FROM seen GROUP BY month_key""",
    "dq_report": f"""
        SELECT * FROM ({_report_lines()})
        UNION ALL
        SELECT 'coverage', 'checked ' || count(*) || ', failed ' || count(*) FILTER (status = 'FAIL'),
               CASE WHEN count(*) FILTER (status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END FROM ({_report_lines()})""",
}


def oracle_sql() -> dict[str, str]:
    tables = {q: sql.oracle(t) for q, t in PIPELINES.items()}
    rebuilt = {f"rebuild_{t.removeprefix('ods_')}": sql.oracle(t) for t in REBUILT}
    states = rebuilt | {q: sql.oracle(t) for q, t in ({q: t for q, (_, _, t) in MERGES.items()} | UPSERTS | SPLICED).items()}
    return {**tables, **states, **{q: sql.compose(text) for q, text in ORACLES.items()}}
