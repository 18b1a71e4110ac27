"""Current-state masters: change-feed merges and latest-wins upserts.

The warehouse defines these tables but no job that loads them; the rules here are ours and
are stated per function. ``current`` is the table as it stands, or None on the first load.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.functions import time
from switchboard.operators.dedup import greatest_by
from switchboard.operators.merge import DELETED, delta_merge, upsert
from switchboard.plans.cleanse import loaded
from switchboard.schemas import TABLES, conform

# Ticket event type and the statuses that close a ticket.
STATUS_EVENT = "STATUS"
CLOSING = ("RESOLVED", "CLOSED")


def _apply(current: DataFrame | None, delta: DataFrame, table: str, **decoded: Column) -> DataFrame:
    spec = TABLES[table]
    if decoded:
        delta = delta.withColumns(decoded)
    return conform(delta_merge(current, delta, spec.pk, spec.names), table)


def timesheet(current: DataFrame | None, delta: DataFrame) -> DataFrame:
    month = time.month_start(F.to_date("work_date"))
    return _apply(current, delta, "ods_timesheet", work_month=month)


def payroll_adjustment(current: DataFrame | None, delta: DataFrame) -> DataFrame:
    return _apply(current, delta, "ods_payroll_adjustment", period_month=time.month_of_text("period_month"))


def sla_credit(current: DataFrame | None, delta: DataFrame) -> DataFrame:
    return _apply(current, delta, "ods_sla_credit", period_month=time.month_of_text("period_month"))


def callback_request(current: DataFrame | None, delta: DataFrame) -> DataFrame:
    requested = time.from_seconds("requested_epoch")
    return _apply(
        current,
        delta,
        "ods_callback_request",
        requested_ts=requested,
        scheduled_ts=time.from_seconds("scheduled_epoch"),
        event_date=time.day(requested),
    )


def shift_swap(current: DataFrame | None, delta: DataFrame) -> DataFrame:
    month = time.month_start(F.to_date("swap_date"))
    return _apply(current, delta, "ods_shift_swap", swap_month=month)


def ticket_worklog(current: DataFrame | None, delta: DataFrame) -> DataFrame:
    logged = time.from_millis("log_ms")
    return _apply(current, delta, "ods_ticket_worklog", log_ts=logged, event_date=time.day(logged))


def attrition_event(current: DataFrame | None, delta: DataFrame) -> DataFrame:
    notice = time.from_seconds("notice_epoch")
    return _apply(
        current,
        delta,
        "ods_attrition_event",
        notice_ts=notice,
        event_month=time.month_start(time.day(notice)),
    )


def rate_card(card: DataFrame, change: DataFrame, run_date: dt.date) -> DataFrame:
    """Rate cards of the day with the new rate of their last change.

    A last change marked as a delete withdraws the change: the card keeps its own rate.
    """
    order = [F.col(c) for c in ("change_ms", "op", "rate_change_id")]
    last = greatest_by(change, ["rate_card_id"], order, ["new_rate", "op", "change_ms"])
    last = last.where(F.coalesce("op", F.lit("")) != DELETED)
    out = (
        loaded(card, run_date)
        .join(last.select("rate_card_id", "new_rate", "change_ms"), "rate_card_id", "left")
        .withColumns(
            {
                "rate": F.coalesce("new_rate", "rate"),
                "effective_ts": time.from_seconds("effective_ts"),
                "expiry_ts": time.from_seconds("expiry_ts"),
                "last_change_ts": time.from_millis("change_ms"),
                "snapshot_date": F.lit(run_date),
            }
        )
    )
    return conform(out, "ods_rate_card")


def client(current: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Clients by latest update."""
    rows = incoming.withColumns({c: time.from_seconds(c) for c in ("created_ts", "updated_ts")})
    return upsert(current, conform(rows, "ods_client_acid"), ["client_id"], "updated_ts")


def agent(current: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Agents by latest delivery. A stored row without ``delivered_on`` gives way to any that arrives."""
    return conform(agent_versions(current, incoming), "ods_agent_acid")


def agent_versions(current: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Agents with the date they were last delivered on, as agents carry no update time."""
    rows = incoming.withColumns(
        {
            "full_name": F.concat("first_name", F.lit(" "), "last_name"),
            "hire_ts": time.from_seconds("hire_ts"),
            "term_ts": time.from_seconds("term_ts"),
        }
    )
    versioned = rows.select(*TABLES["ods_agent_acid"].names, F.col("load_date").alias("delivered_on"))
    if current is not None and "delivered_on" not in current.columns:
        current = current.withColumn("delivered_on", F.lit(None).cast("date"))
    return upsert(current, versioned, ["agent_id"], "delivered_on")


def closings(event: DataFrame) -> DataFrame:
    """The last status event that closes each ticket."""
    closing = event.where((F.col("event_type") == STATUS_EVENT) & F.col("new_value").isin(*CLOSING))
    return closing.groupBy("ticket_id").agg(time.from_millis(F.max("event_ms")).alias("resolved_ts"))


def ticket(current: DataFrame | None, incoming: DataFrame, event: DataFrame) -> DataFrame:
    """Tickets by latest update; resolved at the last status event that closes them."""
    return tickets_closed(current, incoming, closings(event))


def tickets_closed(current: DataFrame | None, incoming: DataFrame, closed: DataFrame) -> DataFrame:
    """Tickets by latest update, with the closings known so far; a closing never gets earlier."""
    rows = incoming.withColumn("created_ts", time.from_millis("created_ms")).withColumn(
        "updated_ts", time.from_millis("updated_ms")
    )
    rows = conform(rows.withColumn("resolved_ts", F.lit(None)), "ods_ticket_acid")
    merged = upsert(current, rows, ["ticket_id"], "updated_ts").withColumnRenamed("resolved_ts", "_known")
    out = merged.join(closed, "ticket_id", "left")
    return conform(out.withColumn("resolved_ts", F.greatest("resolved_ts", "_known")), "ods_ticket_acid")


def invoice(current: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Invoices by latest issue. The two ``_ts_sec`` columns hold milliseconds despite their name."""
    rows = incoming.withColumn("issued_ts", time.from_millis("issued_ts_sec")).withColumn(
        "due_ts", time.from_millis("due_ts_sec")
    )
    return upsert(current, conform(rows, "ods_invoice_acid"), ["invoice_id"], "issued_ts")
