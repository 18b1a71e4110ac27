"""Small hand-made cases for the places where a plausible implementation goes wrong."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from switchboard.functions import text, time
from switchboard.functions.numbers import exact_ratio, round_long
from switchboard.operators import tree
from switchboard.plans import aggs, cleanse, dims, facts, history, merges, views
from switchboard.schemas import TABLES
from switchboard.sources import feeds

DAY = dt.date(2024, 1, 15)
MIDNIGHT = 1705276800  # DAY 00:00 UTC


def table(spark, name, *records):
    """Rows of a declared table from dictionaries; missing columns are NULL."""
    spec = TABLES[name]
    return spark.createDataFrame([tuple(r.get(c) for c in spec.names) for r in records], spec.schema)


def only(df):
    (row,) = df.collect()
    return row


def test_epoch_boundaries(spark):
    df = spark.createDataFrame([(0,), (946684800,), (4102444799,)], "s long")
    want = ["1970-01-01 00:00:00", "2000-01-01 00:00:00", "2099-12-31 23:59:59"]
    for col in (time.from_seconds("s"), time.from_millis(F.col("s") * 1000)):
        assert [r[0] for r in df.select(F.date_format(col, "yyyy-MM-dd HH:mm:ss")).collect()] == want


def test_string_dates(spark):
    df = spark.createDataFrame([("20240315120000",), ("20001231235959",), (None,), ("garbage",)], "d string")
    got = [r[0] for r in df.select(F.date_format(time.from_digits("d"), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2024-03-15 12:00:00", "2000-12-31 23:59:59", None, None]


def test_date_keys_and_buckets(spark):
    df = spark.createDataFrame([(MIDNIGHT + 1799,), (MIDNIGHT + 1800,), (-1,)], "s long")
    df = df.withColumn("ts", time.from_seconds("s"))
    got = [tuple(r) for r in df.select(time.date_key("ts"), time.seconds(time.bucket("ts", 1800))).collect()]
    assert got == [(20240115, MIDNIGHT), (20240115, MIDNIGHT + 1800), (19691231, -1800)]
    key = spark.createDataFrame([(20240229,)], "k long").select(time.key_to_date("k"))
    assert only(key)[0] == dt.date(2024, 2, 29)


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(30,), (90,), (-30,), (29,)], "n long")
    assert [r[0] for r in df.select(round_long(F.col("n") / 60)).collect()] == [1, 2, -1, 0]
    one = spark.createDataFrame([(1, 8, 0)], "a long, b long, z long")
    row = only(one.select(exact_ratio(F.col("a") * 100, F.col("b"), 5, 2), exact_ratio(F.col("a"), F.col("z"), 5, 2)))
    assert tuple(row) == (Decimal("12.50"), None)


def test_exception_minutes_round(spark):
    ev = [
        {"adherence_event_id": i, "agent_id": 1, "start_epoch": MIDNIGHT, "end_epoch": MIDNIGHT + s, "load_date": DAY}
        for i, s in enumerate((30, 89, 90))
    ]
    out = cleanse.adherence_event(table(spark, "stg_wfm_adherence_event", *ev), DAY)
    assert [r[0] for r in out.orderBy("adherence_event_id").select("exception_minutes").collect()] == [1, 1, 2]


def test_dedup_ignores_other_days_and_breaks_ties(spark):
    base = {"program_id": 1, "go_live_ts": 100, "load_date": DAY}
    rows = [
        {**base, "program_name": "a"},
        {**base, "program_name": "b"},
        {**base, "go_live_ts": 99, "program_name": "z"},
        {**base, "go_live_ts": 500, "program_name": "other day", "load_date": dt.date(2024, 1, 14)},
        {**base, "program_id": 2, "go_live_ts": None, "program_name": "n"},
        {**base, "program_id": 2, "go_live_ts": 1, "program_name": "m", "line_of_business": "  sales "},
    ]
    out = cleanse.program(table(spark, "stg_crm_program", *rows), DAY).orderBy("program_id").collect()
    assert [(r.program_id, r.program_name, r.line_of_business) for r in out] == [(1, "b", None), (2, "m", "SALES")]


def test_contract_without_end(spark):
    row = {"contract_id": 1, "start_dt": "20240101000000", "end_dt": None, "load_date": DAY, "status": " executed "}
    out = only(cleanse.contract(table(spark, "stg_crm_contract", row), DAY))
    assert out.end_ts is None and out.start_ts == dt.datetime(2024, 1, 1) and out.status == "EXECUTED"


def test_call_without_segments_or_answer(spark):
    call = {"call_id": 1, "start_epoch": MIDNIGHT, "answer_epoch": None, "end_epoch": MIDNIGHT + 40, "load_date": DAY}
    late = {**call, "call_id": 2, "answer_epoch": MIDNIGHT + 5, "end_epoch": None}
    seg = {"call_id": 2, "segment_type": "TALK", "start_epoch": 10, "end_epoch": 25, "load_date": DAY}
    other_day = {**seg, "load_date": dt.date(2024, 1, 14)}
    out = cleanse.call(
        table(spark, "stg_tel_call", call, late), table(spark, "stg_tel_call_segment", seg, other_day), DAY
    )
    first, second = out.orderBy("call_id").collect()
    assert (first.ring_seconds, first.talk_seconds, first.abandoned_flag) == (40, 0, True)
    assert (second.ring_seconds, second.talk_seconds, second.hold_seconds, second.abandoned_flag) == (5, 15, 0, False)


def test_schedule_drops_unknown_shift_and_repeats_per_shift_row(spark):
    sched = [
        {"schedule_id": i, "shift_id": s, "sched_date": "2024-01-15", "start_epoch": 1, "load_date": DAY}
        for i, s in ((1, 1), (2, 9))
    ]
    shift = [{"shift_id": 1, "shift_code": c, "load_date": d} for c, d in (("A", DAY), ("B", dt.date(2024, 1, 14)))]
    out = cleanse.schedule(table(spark, "stg_wfm_schedule", *sched), table(spark, "stg_wfm_shift", *shift), DAY)
    assert sorted((r.schedule_id, r.shift_code, r.sched_date) for r in out.collect()) == [(1, "A", DAY), (1, "B", DAY)]
    newest = cleanse.schedule(table(spark, "stg_wfm_schedule", *sched), table(spark, "stg_wfm_shift", *shift), DAY, newest_shift=True)
    assert [(r.schedule_id, r.shift_code) for r in newest.collect()] == [(1, "A")]


def test_ticket_category_delivered_twice(spark):
    tickets = table(spark, "ods_ticket_acid", {"ticket_id": 1, "category_id": 1, "created_ts": dt.datetime(2024, 1, 15)})
    days = ((dt.date(2024, 1, 14), "OLD"), (DAY, "NEW"))
    categories = table(spark, "stg_tkt_category", *[{"category_id": 1, "category_code": c, "load_date": d} for d, c in days])
    args = (tickets, table(spark, "stg_tkt_ticket_event"), categories, table(spark, "dim_agent"), DAY)
    assert sorted(r.category_code for r in facts.fact_ticket(*args).collect()) == ["NEW", "OLD"]
    assert [r.category_code for r in facts.fact_ticket(*args, newest_category=True).collect()] == ["NEW"]


def test_ivr_path_order_and_exit_key_across_clients(spark):
    ev = [
        (1000, "b", "1", "X"),
        (1000, "a", "2", "X"),
        (500, "main.agent", "3", "X"),
        (2000, "c", "9", "Y"),
    ]
    rows = [
        {"session_ref": "S", "event_ms": m, "menu_path": p, "key_pressed": k, "client_code": c, "feed_date": DAY}
        for m, p, k, c in ev
    ]
    out = {r.client_code: r for r in cleanse.ivr_session(table(spark, "stg_file_ivr_logs", *rows), DAY).collect()}
    assert out["X"].menu_path_full == "main.agent > a > b" and out["X"].hops == 3
    assert out["X"].contained_flag is False and out["X"].exit_key is None
    assert out["Y"].contained_flag is True and out["Y"].exit_key == "9"


def test_ivr_session_without_client_is_kept(spark):
    row = {"session_ref": "S", "event_ms": 1, "menu_path": None, "key_pressed": "1", "feed_date": DAY}
    out = only(cleanse.ivr_session(table(spark, "stg_file_ivr_logs", row), DAY))
    assert out.client_code is None and out.menu_path_full is None and out.exit_key == "1"


def test_chat_counts(spark):
    def chat(ref, *messages):
        return {"chat_ref": ref, "started_ms": 1_000, "ended_ms": 9_000, "messages": messages, "feed_date": DAY}

    rows = [
        chat("none"),
        chat("silent", ("CUSTOMER", 1_500, "hi")),
        chat("half", ("CUSTOMER", 1_500, "hi"), ("AGENT", 4_000, "x"), ("AGENT", 3_500, "y"), (None, 5, "z")),
        chat("twice", ("AGENT", 2_000, "x")),
        chat("twice", ("AGENT", 1_400, "x"), ("SYSTEM", 1, "y")),
    ]
    out = {r.chat_ref: r for r in cleanse.chat_session(table(spark, "stg_file_chat_transcripts", *rows), DAY).collect()}
    assert set(out) == {"silent", "half", "twice"}
    assert out["silent"].first_response_seconds is None and out["silent"].message_count == 1
    half = out["half"]
    assert (half.message_count, half.agent_message_count, half.customer_message_count) == (3, 2, 1)
    assert half.first_response_seconds == 3  # 2.5 s
    assert (out["twice"].message_count, out["twice"].first_response_seconds) == (3, 0)


def test_qa_percentages(spark):
    def form(ref, auto_fail, *sections):
        return {"qa_form_id": ref, "auto_fail": auto_fail, "sections": sections, "evaluated_ms": 0, "feed_date": DAY}

    rows = [
        form("empty", False),
        form("fail", True, ("A", 10, 10)),
        form("zero", False, ("A", 0, 0)),
        form("third", False, ("A", 3, 1), ("B", 3, 1)),
        form("unknown", None, ("A", None, None)),
    ]
    out = {r.qa_form_id: r for r in cleanse.qa_evaluation(table(spark, "stg_file_qa_forms", *rows), DAY).collect()}
    assert "empty" not in out
    assert out["fail"].overall_pct == 0 and out["zero"].overall_pct is None
    assert out["third"].overall_pct == Decimal("33.33") and out["third"].section_count == 2
    assert out["unknown"].max_points is None and out["unknown"].overall_pct is None


def test_interaction_fallbacks_and_export_fan_out(spark):
    start = dt.datetime(2024, 1, 15, 10)
    call = {"call_id": 1, "start_ts": start, "talk_seconds": 5, "hold_seconds": 1, "acw_seconds": 0, "call_date": DAY}
    calls = table(
        spark,
        "ods_call",
        {**call, "abandoned_flag": False},
        {**call, "call_id": 2, "abandoned_flag": True},
        {**call, "call_id": 3, "abandoned_flag": False, "call_date": dt.date(2024, 1, 14)},
    )
    chats = table(
        spark,
        "ods_chat_session",
        {"chat_ref": "9", "agent_email": "a@x", "started_ts": start, "ended_ts": start, "message_count": 2, "event_date": DAY},
    )
    mails = table(spark, "ods_email_interaction", {"email_ref": "m", "mailbox": "box", "received_ts": start, "event_date": DAY})
    export = table(
        spark,
        "stg_file_interaction_export",
        {"interaction_ref": "V1", "customer_ref": "one", "feed_date": DAY},
        {"interaction_ref": "V1", "customer_ref": "two", "feed_date": DAY},
        {"interaction_ref": "V2", "customer_ref": "old", "feed_date": dt.date(2024, 1, 14)},
    )
    out = cleanse.interaction(calls, chats, mails, export, DAY).orderBy("interaction_id", "customer_ref").collect()
    got = [(r.interaction_id, r.customer_ref, r.resolved_flag) for r in out]
    assert got == [
        ("C9", "a@x", False),
        ("Em", "box", False),
        ("V1", "one", True),
        ("V1", "two", True),
        ("V2", None, False),
    ]
    assert {r.client_code for r in out if r.channel == "VOICE"} == {None}


def test_agent_activity_offsets(spark):
    """Each AUX state loses the whole approved time; unknown agents share the largest offset."""
    ev = [(1, "AUX_A", 100), (1, "AUX_B", 50), (1, "TALK", 70), (7, "AUX_A", 10), (8, "AUX_A", 10)]
    states = table(
        spark,
        "stg_tel_agent_state_event",
        *[
            {"state_event_id": i, "agent_id": a, "state_code": s, "start_epoch": MIDNIGHT, "end_epoch": MIDNIGHT + n, "load_date": DAY}
            for i, (a, s, n) in enumerate(ev)
        ],
    )
    t0 = dt.datetime(2024, 1, 15)
    adherence = table(
        spark,
        "ods_adherence_event",
        *[
            {"agent_id": a, "start_ts": t0, "end_ts": t0 + dt.timedelta(seconds=n), "approved_flag": ok, "event_date": DAY}
            for a, n, ok in ((1, 60, True), (1, 999, False), (7, 5, True), (8, 9, True))
        ],
    )
    agents = table(spark, "dim_agent", {"agent_id": 1, "agent_sk": 1, "is_current": True}, {"agent_id": 7, "agent_sk": 7, "is_current": False})
    out = {(r.agent_sk, r.state_code): r.state_seconds for r in facts.fact_agent_activity(states, adherence, agents, DAY).collect()}
    assert out == {(1, "AUX_A"): 40, (1, "AUX_B"): -10, (1, "TALK"): 70, (-1, "AUX_A"): 11}


def test_queue_interval_threshold_is_per_queue_row(spark):
    t0 = dt.datetime(2024, 1, 15, 9, 10)
    calls = table(
        spark,
        "ods_call",
        *[
            {
                "call_id": i,
                "queue_id": 1,
                "start_ts": t0,
                "ring_seconds": r,
                "abandoned_flag": a,
                "talk_seconds": 10,
                "hold_seconds": 0,
                "acw_seconds": i,
                "call_date": DAY,
            }
            for i, (r, a) in enumerate(((20, False), (21, False), (5, True)))
        ],
    )
    queue = table(spark, "dim_queue", {"queue_id": 1, "queue_sk": 1})
    target = table(spark, "stg_crm_sla_target", *[{"queue_id": 1, "metric_code": "SL_20_80"}] * 2)
    out = only(facts.fact_queue_interval(calls, queue, target, DAY))
    assert (out.offered, out.answered, out.abandoned, out.answered_in_sl, out.sl_threshold_sec) == (3, 2, 1, 1, 20)
    assert (out.avg_speed_answer_sec, out.avg_handle_sec) == (Decimal("20.50"), Decimal("11.00"))
    assert out.interval_start_ts == dt.datetime(2024, 1, 15, 9)


def test_adherence_of_unknown_agents(spark):
    sched = table(
        spark,
        "ods_schedule",
        *[{"schedule_id": i, "agent_id": a, "paid_minutes": 100, "sched_date": DAY} for i, a in enumerate((1, 1, 8, 9))],
    )
    events = table(
        spark,
        "ods_adherence_event",
        *[{"agent_id": a, "exception_minutes": m, "event_date": DAY} for a, m in ((1, 30), (8, 10), (9, 25))],
    )
    pto = table(
        spark,
        "stg_wfm_timeoff_request",
        {"agent_id": 1, "status": "APPROVED", "start_date": "2024-01-15", "end_date": "2024-01-15"},
        {"agent_id": 1, "status": "PENDING", "start_date": "2024-01-15", "end_date": "2024-01-15"},
        {"agent_id": 1, "status": "APPROVED", "start_date": "2024-01-16", "end_date": "2024-01-17"},
    )
    agents = table(spark, "dim_agent", {"agent_id": 1, "agent_sk": 1, "is_current": True})
    out = {r.agent_sk: r for r in facts.fact_adherence_daily(sched, events, pto, agents, DAY).collect()}
    assert (out[1].scheduled_minutes, out[1].worked_minutes, out[1].timeoff_minutes) == (200, 170, 480)
    assert out[1].adherence_pct == Decimal("85.00")
    assert (out[-1].scheduled_minutes, out[-1].exception_minutes) == (200, 25)


def test_ticket_breach(spark):
    t0 = dt.datetime(2024, 1, 15, 1)

    def ticket(i, category, hours):
        done = None if hours is None else t0 + dt.timedelta(hours=hours, seconds=30)
        return {"ticket_id": i, "category_id": category, "created_ts": t0, "resolved_ts": done}

    tickets = table(
        spark, "ods_ticket_acid", ticket(1, 1, 3), ticket(2, 1, 5), ticket(3, 2, 23), ticket(4, 9, 24), ticket(5, 1, None),
        {"ticket_id": 6, "category_id": 1, "created_ts": t0 + dt.timedelta(days=1)},
    )
    categories = table(spark, "stg_tkt_category", {"category_id": 1, "category_code": "A", "sla_hours": 4}, {"category_id": 2, "category_code": "B"})
    events = table(spark, "stg_tkt_ticket_event", {"ticket_id": 1}, {"ticket_id": 1})
    out = {r.ticket_id: r for r in facts.fact_ticket(tickets, events, categories, table(spark, "dim_agent"), DAY).collect()}
    assert set(out) == {1, 2, 3, 4, 5}
    assert [out[i].sla_breached_flag for i in range(1, 6)] == [False, True, False, True, False]
    assert out[1].resolution_minutes == 181 and out[5].resolution_minutes is None
    assert (out[1].touch_count, out[2].touch_count, out[4].category_code) == (2, 0, "UNK")


def test_dim_org_defaults(spark):
    rows = [(1, None, "root", None), (2, 1, "mid", "S2"), (3, 2, "low", None), (4, 3, "leaf", None)]
    units = table(
        spark,
        "ods_org_unit",
        *[{"org_unit_id": i, "parent_unit_id": p, "unit_name": n, "site_code": s, "snapshot_date": DAY} for i, p, n, s in rows],
    )
    out = {r.org_unit_id: r for r in dims.dim_org(units, DAY).collect()}
    assert (out[1].level1_name, out[1].level3_name, out[1].level4_name) == ("root", "root", "root")
    assert (out[4].level1_name, out[4].level2_name, out[4].level3_name) == ("root", "mid", "low")
    assert (out[4].site_code, out[3].site_code, out[1].site_code) == ("S2", "S2", None)


def test_client_contact_choice(spark):
    client = table(spark, "ods_client_acid", {"client_id": 1}, {"client_id": 2})
    contacts = table(
        spark,
        "stg_crm_client_contact",
        {"contact_id": 1, "client_id": 1, "full_name": "new", "is_primary": False, "created_ts": 9, "load_date": DAY},
        {"contact_id": 2, "client_id": 1, "full_name": "old primary", "is_primary": True, "created_ts": 1, "load_date": DAY},
        {"contact_id": 3, "client_id": 2, "full_name": "other day", "load_date": dt.date(2024, 1, 14)},
    )
    out = {r.client_id: r.primary_contact_name for r in dims.dim_client(client, contacts, DAY).collect()}
    assert out == {1: "old primary", 2: None}


def test_site_lookup_defaults(spark):
    units = table(spark, "ods_org_unit", {"org_unit_id": 1, "unit_type": "SITE", "site_code": "XX", "snapshot_date": DAY},
                  {"org_unit_id": 2, "unit_type": "SITE", "snapshot_date": DAY})
    assert {(r.region, r.country, r.timezone) for r in dims.dim_site(units, DAY).collect()} == {("UNK", "UNK", "UTC")}


def test_reconciliation_rounds_or_floors(spark):
    staged = table(
        spark,
        "stg_fin_invoice",
        *[{"invoice_id": i, "invoice_no": str(i), "total_amount": Decimal(a), "issued_ts_sec": m}
          for i, a, m in ((1, "10.00", 1_000_500), (2, "10.00", 1_000_499), (3, "10.02", 1_000_900), (4, "10.01", None))],
    )
    acid = table(
        spark,
        "ods_invoice_acid",
        *[{"invoice_id": i, "total_amount": Decimal("10.00"), "issued_ts": dt.datetime.fromtimestamp(1000, dt.timezone.utc)} for i in (1, 2, 3, 4)],
    )
    out = {r.invoice_no: (r.drift_seconds, r.recon_status) for r in views.billing_reconciliation(staged, acid).collect()}
    assert out == {"1": (-1, "TS_MISMATCH"), "2": (0, "OK"), "3": (-1, "AMOUNT_MISMATCH"), "4": (None, "OK")}
    floored = views.billing_reconciliation(staged, acid, floor_ms=True)
    assert {r.invoice_no: r.recon_status for r in floored.collect()}["1"] == "OK"


def test_first_contact_counts_pairs_and_boundaries(spark):
    t0 = dt.datetime(2024, 1, 1)

    def contact(i, ref, start_days, resolved=True, end=True):
        start = t0 + dt.timedelta(days=start_days)
        return {
            "interaction_id": i, "customer_ref": ref, "program_sk": 1, "date_key": 20240101, "start_ts": start,
            "end_ts": start if end else None, "resolved_flag": resolved,
        }

    rows = [
        contact("a", "x", 0),
        contact("b", "x", 3),
        contact("c", "x", 7),  # exactly seven days after a
        contact("d", "x", 30, end=False),
        contact("e", None, 0),
        contact("f", None, 1),
        contact("g", "y", 0, resolved=False),
        contact("h", "y", 0),  # same instant: not later
    ]
    fact = table(spark, "fact_interaction", *rows)
    out = only(views.first_contact_resolution(fact))
    # pairs: a-b, a-c, b-c; alone: c, d, e, f, h
    assert (out.resolved_interactions, out.fcr_count) == (8, 5)
    single = only(views.first_contact_resolution(fact, per_interaction=True))
    assert (single.resolved_interactions, single.fcr_count) == (7, 5)


def test_repeat_contacts(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", "x", 0), ("b", "x", 259200), ("c", "x", 259200 * 2 + 1), ("d", "", 0), ("e", None, 0)]
    data = table(
        spark, "ods_interaction",
        *[{"interaction_id": i, "customer_ref": c, "start_ts": t0 + dt.timedelta(seconds=s)} for i, c, s in rows],
    )
    out = {r.interaction_id: r.repeat_within_72h for r in views.repeat_contact_window(data).collect()}
    assert out == {"a": 0, "b": 1, "c": 0}


def test_sla_attainment_without_answers_or_target(spark):
    fact = table(
        spark, "fact_queue_interval",
        {"queue_sk": 1, "date_key": 1, "answered": 0, "answered_in_sl": 0},
        {"queue_sk": 2, "date_key": 1, "answered": 4, "answered_in_sl": 4},
        {"queue_sk": 3, "date_key": 1, "answered": 4, "answered_in_sl": 3},
        {"queue_sk": -1, "date_key": 1, "answered": 4, "answered_in_sl": 3},
    )
    queue = table(spark, "dim_queue", *[{"queue_sk": i, "queue_id": i, "queue_code": str(i)} for i in (1, 2, 3)])
    target = table(
        spark, "stg_crm_sla_target",
        {"queue_id": 1, "metric_code": "SL_20_80", "target_value": Decimal(80)},
        {"queue_id": 3, "metric_code": "SL_20_80", "target_value": Decimal(70)},
        {"queue_id": 3, "metric_code": "SL_20_80", "target_value": Decimal(75)},
        {"queue_id": 2, "metric_code": "AHT", "target_value": Decimal(1)},
    )
    out = {r.queue_code: (r.sl_pct, r.attainment) for r in views.queue_sla_attainment(fact, queue, target).collect()}
    assert out == {"1": (None, "MISSED"), "2": (100.0, "MISSED"), "3": (75.0, "MET")}


def test_attrition_bands(spark):
    agents = table(spark, "dim_agent", *[{"agent_sk": i, "agent_id": i, "is_current": True, "status": "ACTIVE"} for i in range(10)])
    adh = table(spark, "fact_adherence_daily", *[{"agent_sk": i, "adherence_pct": Decimal(i)} for i in range(10)])
    notice = table(spark, "ods_attrition_event", {"agent_id": 9}, {"agent_id": 9})
    out = {r.agent_sk: r.attrition_risk for r in views.attrition_risk(adh, notice, agents).collect()}
    assert out == {0: "HIGH", 1: "HIGH", 2: "MEDIUM", 3: "MEDIUM", 9: "HIGH", **{i: "LOW" for i in range(4, 9)}}


def test_shrinkage_repeats_minutes_per_schedule(spark):
    adh = table(spark, "fact_adherence_daily",
                {"agent_sk": 1, "scheduled_minutes": 100, "worked_minutes": 90, "exception_minutes": 10, "timeoff_minutes": 0, "date_key": 20240115},
                {"agent_sk": 2, "scheduled_minutes": 50, "worked_minutes": 50, "exception_minutes": 0, "timeoff_minutes": 5, "date_key": 20240115})
    agents = table(spark, "dim_agent", *[{"agent_sk": i, "agent_id": i, "site_code": "S"} for i in (1, 2)])
    sched = table(spark, "ods_schedule", *[{"schedule_id": i, "agent_id": 1, "shift_id": i % 2, "sched_date": DAY} for i in (1, 2, 3)],
                  {"schedule_id": 9, "agent_id": 2, "shift_id": 1, "sched_date": dt.date(2024, 1, 14)})
    shift = table(spark, "dim_shift", {"shift_sk": 1, "shift_id": 1, "overnight_flag": True}, {"shift_sk": 0, "shift_id": 0, "overnight_flag": False})
    out = only(views.shrinkage_analysis(adh, agents, sched, shift))
    assert (out.scheduled_minutes, out.worked_minutes, out.shrinkage_minutes) == (350, 320, 35)
    assert (out.schedules, out.overnight_shifts, out.shrinkage_pct) == (3, 1, 10.0)


def test_roster_repeats_per_current_assignment(spark):
    versions = table(spark, "ods_agent_scd2",
                     {"agent_id": 1, "eff_from_ts": dt.datetime(2024, 1, 1), "job_grade": "old", "is_current": True},
                     {"agent_id": 1, "eff_from_ts": dt.datetime(2024, 1, 2), "job_grade": "new", "is_current": False},
                     {"agent_id": 2, "eff_from_ts": dt.datetime(2024, 1, 1), "job_grade": "x"})
    assigned = table(spark, "ods_agent_assignment_scd2",
                     *[{"agent_id": 1, "program_id": p, "is_current": c} for p, c in ((5, True), (6, True), (7, False))])
    out = sorted((r.agent_id, r.job_grade, r.current_program_id or 0) for r in views.agent_roster_current(versions, assigned).collect())
    assert out == [(1, "new", 5), (1, "new", 6), (2, "x", 0)]


def test_margin_literal_form_is_the_product(spark):
    """Rows x programs with labour in the month x contracts; an empty contract side keeps all rows."""
    month, other = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    billing = table(spark, "agg_billing_monthly",
                    {"client_sk": 1, "program_sk": 1, "billed_amount": Decimal(100), "net_revenue": Decimal(90), "period_month": month},
                    {"client_sk": 2, "program_sk": 2, "billed_amount": Decimal(10), "net_revenue": Decimal(10), "period_month": other})
    labour = table(spark, "ods_timesheet", *[{"program_id": p, "billable_minutes": m, "work_month": month} for p, m in ((1, 60), (1, 60), (2, 30))])
    adjustments = table(spark, "ods_payroll_adjustment", {"amount": Decimal(5), "period_month": month})
    lines = table(spark, "ods_contract_line", *[{"contract_id": c, "min_commit": Decimal(m)} for c, m in ((7, 1), (7, 2), (8, 4))])
    out = views.program_margin(billing, labour, adjustments, lines, by_program=False)
    got = sorted((r.program_sk, r.est_labor_cost, r.est_margin, r.committed_min) for r in out.collect())
    assert got == [
        (1, 9.25, 75.75, Decimal(3)), (1, 9.25, 75.75, Decimal(4)), (1, 37.0, 48.0, Decimal(3)), (1, 37.0, 48.0, Decimal(4)),
        (2, None, None, Decimal(3)), (2, None, None, Decimal(4)),
    ]
    assert views.program_margin(billing, labour, adjustments, lines.where("false"), by_program=False).count() == 3
    contracts = table(spark, "ods_contract", {"contract_id": 7, "program_id": 1}, {"contract_id": 8, "program_id": 1})
    single = views.program_margin(billing, labour, adjustments, lines, contracts)
    assert sorted((r.program_sk, r.est_margin, r.committed_min) for r in single.collect()) == [(1, 48.0, Decimal(7)), (2, None, None)]


def test_margin_counts_each_minimum_once(spark):
    """Three days of one contract line with minimum 7 commit 7."""
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    billing = table(spark, "agg_billing_monthly", {"program_sk": 1, "net_revenue": Decimal(90), "period_month": days[0]})
    lines = table(spark, "ods_contract_line", *[{"contract_id": 7, "min_commit": Decimal(7), "snapshot_date": d} for d in days])
    contracts = table(spark, "ods_contract", *[{"contract_id": 7, "program_id": 1, "snapshot_date": d} for d in days])
    nothing = [table(spark, n) for n in ("ods_timesheet", "ods_payroll_adjustment")]
    assert [r.committed_min for r in views.program_margin(billing, *nothing, lines, contracts).collect()] == [Decimal(7)]


def test_units_of_several_snapshots_climb_once(spark):
    rows = [{"org_unit_id": i, "parent_unit_id": i - 1 if i > 1 else None, "unit_name": f"n{i}", "snapshot_date": dt.date(2024, 1, d)}
            for d in (1, 2, 3) for i in range(1, 5)]
    units = table(spark, "ods_org_unit", *rows)
    assert views.org_hierarchy(units).count() == 4
    every = tree.root_paths(units, "org_unit_id", "parent_unit_id", "unit_name", ["org_unit_id", "snapshot_date"], within="snapshot_date")
    assert every.count() == 12


def test_values_that_do_not_fit_are_no_reason_to_abort(spark):
    one = spark.createDataFrame([(-450, 30)], "gap long, paid long")
    assert one.select(exact_ratio(F.col("gap") * 100, F.col("paid"), 5, 2).alias("r")).first().r is None
    lines = spark.createDataFrame([("9" * 23 + "|A-1|MENU:x;KEY:1|t",), ("5|A-1|MENU:x;KEY:1|t",)], "value string")
    good, bad = feeds.parse_ivr(lines, "value")
    assert [r.event_ms for r in good.collect()] == [5] and bad.count() == 1


def test_call_driver_classes(spark):
    cases = {
        "Invoice and password": ("BILLING", None),
        "LOCKED out ref#12": ("ACCESS", "12"),
        "wants to CANCEL": ("RETENTION", None),
        "[TECH] router": ("TECH", None),
        "[tech] router": ("OTHER", None),
        "x [TECH]": ("OTHER", None),
        "ref#": ("OTHER", None),
    }
    df = spark.createDataFrame([(c,) for c in cases], "d string")
    got = df.select("d", text.call_driver(F.col("d")), text.first_group(F.col("d"), text.EMBEDDED_REF)).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == cases
    assert only(spark.createDataFrame([(None,)], "d string").select(text.call_driver(F.col("d"))))[0] == "OTHER"


def test_merge_deletes_and_late_changes(spark):
    def change(i, op, ms, minutes):
        return {"timesheet_id": i, "op": op, "change_ms": ms, "billable_minutes": minutes, "work_date": "2024-01-15"}

    first = merges.timesheet(None, table(spark, "stg_fin_timesheet_delta", change(1, "I", 10, 1), change(2, "I", 10, 1), change(3, "I", 50, 5)))
    assert first.count() == 3
    second = merges.timesheet(first, table(spark, "stg_fin_timesheet_delta", change(1, "U", 20, 7), change(2, "D", 20, 0), change(3, "U", 40, 4), change(4, None, 1, 9)))
    out = {r.timesheet_id: (r.billable_minutes, r.work_month) for r in second.collect()}
    assert out == {1: (7, dt.date(2024, 1, 1)), 3: (5, dt.date(2024, 1, 1)), 4: (9, dt.date(2024, 1, 1))}
    again = merges.timesheet(second, table(spark, "stg_fin_timesheet_delta", change(1, "U", 20, 7)))
    assert sorted(again.collect(), key=repr) == sorted(second.collect(), key=repr)


def test_upserts_keep_stored_rows(spark):
    stored = table(spark, "ods_client_acid", {"client_id": 1, "status": "OLD", "updated_ts": dt.datetime(2024, 1, 9)}, {"client_id": 2, "status": "KEPT", "updated_ts": dt.datetime(2024, 1, 9)})
    new = table(spark, "stg_crm_client", {"client_id": 1, "status": "NEW", "updated_ts": MIDNIGHT}, {"client_id": 3, "status": "ADDED", "updated_ts": MIDNIGHT})
    assert {r.client_id: r.status for r in merges.client(stored, new).collect()} == {1: "NEW", 2: "KEPT", 3: "ADDED"}
    agents = table(spark, "ods_agent_acid", {"agent_id": 1, "full_name": "Old Name"}, {"agent_id": 2, "full_name": "Kept"})
    arriving = table(spark, "stg_hr_agent", {"agent_id": 1, "first_name": "New", "last_name": "Name", "load_date": DAY})
    assert {r.agent_id: r.full_name for r in merges.agent(agents, arriving).collect()} == {1: "New Name", 2: "Kept"}


def test_ticket_resolution_from_events(spark):
    def event(t, kind, value, ms):
        return {"ticket_id": t, "event_type": kind, "new_value": value, "event_ms": ms}

    tickets = table(spark, "stg_tkt_ticket", *[{"ticket_id": i, "created_ms": 0, "updated_ms": 0} for i in (1, 2, 3)])
    events = table(spark, "stg_tkt_ticket_event", event(1, "STATUS", "RESOLVED", 1000), event(1, "STATUS", "CLOSED", 2000), event(2, "NOTE", "RESOLVED", 5), event(3, "STATUS", "OPEN", 5))
    out = {r.ticket_id: r.resolved_ts for r in merges.ticket(None, tickets, events).collect()}
    assert out == {1: dt.datetime(1970, 1, 1, 0, 0, 2), 2: None, 3: None}


def test_rate_card_changes(spark):
    cards = table(spark, "stg_fin_rate_card", *[{"rate_card_id": i, "rate": Decimal(1), "load_date": DAY} for i in (1, 2, 3)])
    changes = table(
        spark, "stg_fin_rate_card_change_delta",
        {"rate_change_id": 1, "rate_card_id": 1, "new_rate": Decimal(5), "op": "U", "change_ms": 10},
        {"rate_change_id": 2, "rate_card_id": 1, "new_rate": Decimal(6), "op": "U", "change_ms": 20},
        {"rate_change_id": 3, "rate_card_id": 2, "new_rate": Decimal(9), "op": "D", "change_ms": 20},
    )
    assert {r.rate_card_id: r.rate for r in merges.rate_card(cards, changes, DAY).collect()} == {1: 6, 2: 1, 3: 1}


def test_skill_history_collapses_runs_and_reruns_alike(spark, rows):
    def seen(day, level):
        return {"agent_id": 1, "skill_id": 2, "proficiency": level, "certified": True, "effective_ts": MIDNIGHT + 86400 * day}

    data = table(spark, "stg_hr_agent_skill", seen(0, 1), seen(1, 1), seen(2, 3), seen(3, 1), seen(3, 2))
    skills = table(spark, "stg_hr_skill", {"skill_id": 2, "skill_code": "SK"})
    out = history.agent_skill(data, skills)
    got = [(r.proficiency, r.eff_from_ts.day, r.eff_to_ts and r.eff_to_ts.day, r.is_current) for r in out.orderBy("eff_from_ts").collect()]
    assert got == [(1, 15, 17, False), (3, 17, 18, False), (2, 18, None, True)]
    assert rows(history.agent_skill(data.unionByName(data), skills)) == rows(out)
    first = out.orderBy("eff_from_ts").first()
    import hashlib

    assert first.agent_skill_history_id == hashlib.md5(b"1|2|2024-01-15 00:00:00+00").hexdigest()


def test_weekly_average_is_weighted(spark):
    daily = table(
        spark, "agg_agent_daily",
        {"agent_sk": 1, "site_code": "S", "interactions_handled": 1, "avg_handle_seconds": Decimal(10), "date_key": 20240115},
        {"agent_sk": 1, "site_code": "S", "interactions_handled": 3, "avg_handle_seconds": Decimal(20), "adherence_pct": Decimal(50), "date_key": 20240121},
        {"agent_sk": 1, "site_code": "S", "interactions_handled": 0, "date_key": 20240122},
    )
    out = {r.week_start_key: r for r in aggs.agg_agent_weekly(daily).collect()}
    assert (out[20240115].days_worked, out[20240115].avg_handle_seconds, out[20240115].adherence_pct) == (2, Decimal("17.50"), Decimal(50))
    assert out[20240122].avg_handle_seconds is None


@pytest.mark.parametrize("name", ["MNL1", "BLR2", "MTY3"])
def test_known_sites(spark, name):
    units = table(spark, "ods_org_unit", {"org_unit_id": 1, "unit_type": "SITE", "site_code": name, "snapshot_date": DAY})
    row = only(dims.dim_site(units, DAY))
    assert (row.region, row.country, row.timezone) == dims.SITES[name]
