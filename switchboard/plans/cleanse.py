"""Cleansing: one day of raw staging rows to conformed rows, one function per target table.

Every function takes the staging tables it reads and the run date and returns the target's
declared columns. Staging carries about 0.5 % duplicate keys; the latest row wins, where
latest means the event's own start or creation time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.functions import time
from switchboard.functions.numbers import count_if, exact_ratio, round_long
from switchboard.functions.text import upper_trim
from switchboard.operators import nested
from switchboard.operators.dedup import latest
from switchboard.operators.skew import join_many
from switchboard.operators.textagg import ordered_join, same_groups
from switchboard.schemas import conform

# Segment types, chat senders, the hand-over menu and the path separator.
TALK, HOLD, ACW = "TALK", "HOLD", "ACW"
AGENT, CUSTOMER = "AGENT", "CUSTOMER"
AGENT_MENU = "main.agent"
PATH_SEPARATOR = " > "
CONNECT = "CONNECT"


def loaded(df: DataFrame, run_date: dt.date, column: str = "load_date") -> DataFrame:
    """One day's partition; the bare column lets Spark prune the others."""
    return df.where(F.col(column) == F.lit(run_date))


def program(program: DataFrame, run_date: dt.date) -> DataFrame:
    rows = latest(loaded(program, run_date), ["program_id"], ["go_live_ts"])
    out = rows.select(
        "program_id",
        "client_id",
        "program_code",
        "program_name",
        *[upper_trim(c) for c in ("line_of_business", "channel_mix", "site_code", "status")],
        time.from_seconds("go_live_ts").alias("go_live_ts"),
        time.from_seconds("updated_ts").alias("updated_ts"),
        F.lit(run_date).alias("snapshot_date"),
    )
    return conform(out, "ods_program")


def contract(contract: DataFrame, run_date: dt.date) -> DataFrame:
    rows = latest(loaded(contract, run_date), ["contract_id"], ["start_dt"])
    out = rows.select(
        "contract_id",
        "client_id",
        "program_id",
        "contract_no",
        *[time.from_digits(f"{c}_dt").alias(f"{c}_ts") for c in ("start", "end", "signed")],
        *[upper_trim(c) for c in ("billing_model", "currency", "status")],
        F.lit(run_date).alias("snapshot_date"),
    )
    return conform(out, "ods_contract")


def contract_line(contract_line: DataFrame, run_date: dt.date) -> DataFrame:
    order = ["effective_dt", "unit_rate", "min_commit", "service_code"]
    rows = latest(loaded(contract_line, run_date), ["contract_line_id"], order)
    out = rows.select(
        "contract_line_id",
        "contract_id",
        "line_no",
        upper_trim("service_code"),
        upper_trim("uom"),
        "unit_rate",
        "min_commit",
        time.from_digits("effective_dt").alias("effective_ts"),
        F.lit(run_date).alias("snapshot_date"),
    )
    return conform(out, "ods_contract_line")


def org_unit(org_unit: DataFrame, run_date: dt.date) -> DataFrame:
    rows = latest(loaded(org_unit, run_date), ["org_unit_id"], ["created_ts"])
    rows = rows.withColumn("created_ts", time.from_seconds("created_ts"))
    return conform(rows.withColumn("snapshot_date", F.lit(run_date)), "ods_org_unit")


def queue(queue: DataFrame, run_date: dt.date) -> DataFrame:
    rows = latest(loaded(queue, run_date), ["queue_id"], ["created_epoch"])
    rows = rows.withColumn("created_ts", time.from_seconds("created_epoch"))
    return conform(rows.withColumn("snapshot_date", F.lit(run_date)), "ods_queue")


def schedule(
    schedule: DataFrame, shift: DataFrame, run_date: dt.date, *, newest_shift: bool = False
) -> DataFrame:
    """Schedules with their shift code. The join drops unknown shifts and, as shifts are not
    limited to one day, repeats a schedule per shift row of its id; ``newest_shift`` takes
    only the latest delivered row of each shift."""
    if newest_shift:
        shift = latest(shift, ["shift_id"], ["load_date", "created_epoch"])
    rows = latest(loaded(schedule, run_date), ["schedule_id"], ["start_epoch"])
    rows = rows.join(shift.select("shift_id", "shift_code"), "shift_id")
    out = (
        rows.withColumn("start_ts", time.from_seconds("start_epoch"))
        .withColumn("end_ts", time.from_seconds("end_epoch"))
        .withColumn("sched_date", F.to_date("sched_date"))
    )
    return conform(out, "ods_schedule")


def adherence_event(event: DataFrame, run_date: dt.date) -> DataFrame:
    rows = latest(loaded(event, run_date), ["adherence_event_id"], ["start_epoch"])
    out = (
        rows.withColumn("start_ts", time.from_seconds("start_epoch"))
        .withColumn("end_ts", time.from_seconds("end_epoch"))
        .withColumn("exception_minutes", round_long((F.col("end_epoch") - F.col("start_epoch")) / 60))
        .withColumn("event_date", time.day("start_ts"))
    )
    return conform(out, "ods_adherence_event")


def call(call: DataFrame, segment: DataFrame, run_date: dt.date) -> DataFrame:
    """Calls with their talk, hold and after-call seconds; a call without an answer is abandoned."""
    calls = latest(loaded(call, run_date), ["call_id"], ["end_epoch"])
    length = F.col("end_epoch") - F.col("start_epoch")
    totals = (
        loaded(segment, run_date)
        .groupBy("call_id")
        .agg(*[F.sum(F.when(F.col("segment_type") == t, length)).alias(f"_{t}") for t in (TALK, HOLD, ACW)])
    )
    joined = calls.join(totals, "call_id", "left")
    out = (
        joined.withColumn("start_ts", time.from_seconds("start_epoch"))
        .withColumn("answer_ts", time.from_seconds("answer_epoch"))
        .withColumn("end_ts", time.from_seconds("end_epoch"))
        .withColumn("ring_seconds", F.coalesce("answer_epoch", "end_epoch") - F.col("start_epoch"))
        .withColumn("abandoned_flag", F.col("answer_epoch").isNull())
        .withColumn("call_date", time.day("start_ts"))
        .withColumns({f"{t.lower()}_seconds": F.coalesce(f"_{t}", F.lit(0)) for t in (TALK, HOLD, ACW)})
    )
    return conform(out, "ods_call")


def ivr_session(ivr_log: DataFrame, run_date: dt.date) -> DataFrame:
    """One row per (session, client): span, ordered menu path, containment and exit key.

    The exit key is that of the last event of the whole session, so only the client that
    holds this event has one. Events of one millisecond are ordered by menu path.
    """
    keys = ["session_ref", "client_code"]
    events = loaded(ivr_log, run_date, "feed_date")
    last = F.struct("event_ms", "menu_path", "key_pressed", "client_code")
    totals = [
        F.min("event_ms").alias("first_ms"),
        F.max("event_ms").alias("last_ms"),
        F.count(F.lit(1)).alias("hops"),
        F.max(F.when(F.col("menu_path") == AGENT_MENU, 1).otherwise(0)).alias("_handed"),
        F.max(last).alias("_last"),
    ]
    sessions = ordered_join(events, keys, "event_ms", "menu_path", PATH_SEPARATOR, "menu_path_full", also=totals)
    session_last = sessions.groupBy("session_ref").agg(F.max("_last").alias("_session_last"))
    joined = same_groups(sessions, session_last, ["session_ref"])
    out = (
        joined.withColumn("first_event_ts", time.from_millis("first_ms"))
        .withColumn("last_event_ts", time.from_millis("last_ms"))
        .withColumn("contained_flag", F.col("_handed") == 0)
        .withColumn("exit_key", F.when(F.col("_last") == F.col("_session_last"), F.col("_last.key_pressed")))
        .withColumn("event_date", time.day("first_event_ts"))
    )
    return conform(out, "ods_ivr_session")


def chat_session(chat: DataFrame, run_date: dt.date) -> DataFrame:
    """Chat counts and first response. A chat without messages gives no row.

    Transcripts that repeat all header fields are counted together.
    """
    header = ["chat_ref", "client_code", "queue_code", "agent_email", "started_ms", "ended_ms"]
    messages = nested.unnest(loaded(chat, run_date, "feed_date"), header, "messages", ["sender", "ts_ms"])
    sender = F.col("sender")
    rows = messages.groupBy(*header).agg(
        F.count(sender).alias("message_count"),
        count_if(sender == AGENT).alias("agent_message_count"),
        count_if(sender == CUSTOMER).alias("customer_message_count"),
        F.min(F.when(sender == AGENT, F.col("ts_ms"))).alias("_first"),
    )
    out = (
        rows.withColumn("started_ts", time.from_millis("started_ms"))
        .withColumn("ended_ts", time.from_millis("ended_ms"))
        .withColumn("first_response_seconds", round_long((F.col("_first") - F.col("started_ms")) / 1000))
        .withColumn("event_date", time.day("started_ts"))
    )
    return conform(out, "ods_chat_session")


def email_interaction(email: DataFrame, run_date: dt.date) -> DataFrame:
    rows = latest(loaded(email, run_date, "feed_date"), ["email_ref"], ["received_ms"])
    sla = (F.col("first_reply_ms") - F.col("received_ms")) / 60000
    out = rows.select(
        "*",
        *[time.from_millis(f"{c}_ms").alias(f"{c}_ts") for c in ("received", "first_reply", "resolved")],
        round_long(sla).alias("reply_sla_minutes"),
    ).withColumn("event_date", time.day("received_ts"))
    return conform(out, "ods_email_interaction")


def survey_response(survey: DataFrame, run_date: dt.date) -> DataFrame:
    rows = latest(loaded(survey, run_date, "feed_date"), ["survey_id"], ["survey_ms"])
    out = (
        rows.withColumn("survey_ts", time.from_millis("survey_ms"))
        .withColumn("verbatim", F.trim("verbatim"))
        .withColumn("event_date", time.day("survey_ts"))
    )
    return conform(out, "ods_survey_response")


def qa_evaluation(form: DataFrame, run_date: dt.date) -> DataFrame:
    """Scorecards: section totals and the percentage; an auto-fail scores 0.

    A form without sections gives no row. The percentage on the form itself is not used.
    """
    header = [
        "qa_form_id",
        "client_code",
        "interaction_ref",
        "evaluator_email",
        "evaluated_ms",
        "form_version",
        "auto_fail",
    ]
    fields = ["section_code", "scored_points", "max_points"]
    sections = nested.unnest(loaded(form, run_date, "feed_date"), header, "sections", fields)
    rows = sections.groupBy(*header).agg(
        F.count("section_code").alias("section_count"),
        F.sum("scored_points").alias("scored_points"),
        F.sum("max_points").alias("max_points"),
    )
    pct = exact_ratio(F.col("scored_points") * 100, F.col("max_points"), 5, 2)
    out = (
        rows.withColumn("evaluated_ts", time.from_millis("evaluated_ms"))
        .withColumn("overall_pct", F.when(F.col("auto_fail"), F.lit(0).cast("decimal(5,2)")).otherwise(pct))
        .withColumn("event_date", time.day("evaluated_ts"))
    )
    return conform(out, "ods_qa_evaluation")


def interaction(
    call: DataFrame, chat: DataFrame, email: DataFrame, export: DataFrame, run_date: dt.date
) -> DataFrame:
    """The interaction spine: calls, chats and e-mails of the day under one schema.

    Voice has no client code; chat and e-mail have no program, queue or agent. The customer
    reference comes from the client's export, else the chat agent's address or the mailbox.
    An export that repeats a reference repeats the interaction.
    """
    none = F.lit(None)
    voice = loaded(call, run_date, "call_date").select(
        F.concat(F.lit("V"), F.col("call_id").cast("string")).alias("interaction_id"),
        F.lit("VOICE").alias("channel"),
        none.cast("string").alias("client_code"),
        "program_id",
        "queue_id",
        "agent_id",
        none.cast("string").alias("fallback"),
        "start_ts",
        "end_ts",
        (F.col("talk_seconds") + F.col("hold_seconds") + F.col("acw_seconds")).alias("handle_seconds"),
        (~F.col("abandoned_flag") & (F.col("talk_seconds") > 0)).alias("resolved_flag"),
        F.lit("switch").alias("source_system"),
    )
    chats = loaded(chat, run_date, "event_date").select(
        *_text_channel("C", "chat_ref", "CHAT", "agent_email"),
        F.col("started_ts").alias("start_ts"),
        F.col("ended_ts").alias("end_ts"),
        (time.seconds("ended_ts") - time.seconds("started_ts")).alias("handle_seconds"),
        (F.col("message_count") > 2).alias("resolved_flag"),
        F.lit("chat_feed").alias("source_system"),
    )
    emails = loaded(email, run_date, "event_date").select(
        *_text_channel("E", "email_ref", "EMAIL", "mailbox"),
        F.col("received_ts").alias("start_ts"),
        F.col("resolved_ts").alias("end_ts"),
        (F.col("reply_sla_minutes") * 60).alias("handle_seconds"),
        F.col("resolved_ts").isNotNull().alias("resolved_flag"),
        F.lit("email_feed").alias("source_system"),
    )
    spine = voice.unionByName(chats).unionByName(emails)
    refs = loaded(export, run_date, "feed_date").select(
        F.col("interaction_ref").alias("interaction_id"), "customer_ref"
    )
    out = (
        join_many(spine, refs, "interaction_id")
        .withColumn("customer_ref", F.coalesce("customer_ref", "fallback"))
        .withColumn("event_date", time.day("start_ts"))
    )
    return conform(out, "ods_interaction")


def dialer_attempt(dialer: DataFrame, run_date: dt.date) -> DataFrame:
    rows = latest(loaded(dialer, run_date, "feed_date"), ["attempt_id"], ["attempt_ms"])
    out = (
        rows.withColumn("attempt_ts", time.from_millis("attempt_ms"))
        .withColumn("connected_flag", F.col("result_code") == CONNECT)
        .withColumn("event_date", time.day("attempt_ts"))
    )
    return conform(out, "ods_dialer_attempt")


def _text_channel(prefix: str, ref: str, channel: str, fallback: str) -> list[Column]:
    return [
        F.concat(F.lit(prefix), F.col(ref)).alias("interaction_id"),
        F.lit(channel).alias("channel"),
        F.col("client_code"),
        *[F.lit(None).cast("long").alias(c) for c in ("program_id", "queue_id", "agent_id")],
        F.col(fallback).alias("fallback"),
    ]

