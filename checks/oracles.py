"""Independent DuckDB SQL for every table and query, composed from named parts.

`oracle(name)` renders one statement over the base tables: a WITH list of the parts the
result needs, then a projection to plain types (decimals as doubles, dates as text).
Ratios that end in a fixed number of digits are rounded in integer arithmetic, so they do not
depend on either engine's decimal division.
"""

from __future__ import annotations

import re

from checks.fixtures import OTHER_DAYS, RECIPES, duck_sql
from switchboard.schemas import TABLES

RUN = "DATE '2024-01-15'"


def ts(x: str) -> str:
    return f"make_timestamp(({x}) * 1000000)"


def ms(x: str) -> str:
    return f"make_timestamp(({x}) * 1000)"


def sec(x: str) -> str:
    return f"(epoch_us({x}) // 1000000)"


def key(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m%d') AS BIGINT)"


def rat(num: str, den: str, digits: int = 2) -> str:
    """num / den rounded half away from zero to ``digits``, NULL where den is 0."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST(nullif({den}, 0) AS HUGEINT)"
    return (
        f"(sign({n}) * ((2 * {10**digits} * abs({n}) + {d}) // (2 * {d})) / CAST({10**digits} AS DOUBLE))"
    )


def newest(table: str, pk: str, order: str, source: str | None = None, where: str = "TRUE") -> str:
    """Rows of a staging table that win per key: by ``order``, then all other columns."""
    names = [n for n in TABLES[table].names if n not in pk.split(", ") and n not in order.split(", ")]
    by = ", ".join(f"{c} DESC NULLS LAST" for c in [*order.split(", "), *names])
    return (
        f"SELECT * FROM {source or table} WHERE {where} "
        f"QUALIFY row_number() OVER (PARTITION BY {pk} ORDER BY {by}) = 1"
    )


def last_change(delta: str, pk: str, decode: str, target: str) -> str:
    """State after a change feed: last change per key, deletes removed."""
    rest = [c for c in TABLES[target].names if c != pk]
    by = ", ".join(f"{c} DESC NULLS LAST" for c in ["change_ms", "op", *rest])
    return (
        f"SELECT * FROM (SELECT * EXCLUDE ({decode_names(decode, delta)} op), op, {decode}, "
        f"{ms('change_ms')} AS last_change_ts FROM {delta}) "
        f"QUALIFY row_number() OVER (PARTITION BY {pk} ORDER BY {by}) = 1 AND coalesce(op, '') <> 'D'"
    )


def decode_names(decode: str, delta: str) -> str:
    """Source columns that a decoded column of the same name replaces."""
    made = re.findall(r"AS (\w+)(?:,|$)", decode)
    return "".join(f"{c}, " for c in made if c in TABLES[delta].names)


def versions(observed: str, keys: str, tracked: str, id_name: str) -> str:
    """History rows of an observation table."""
    names = tracked.split(", ")
    pack = "struct_pack(" + ", ".join(f"{c} := {c}" for c in names) + ")"
    by = ", ".join(f"{c} DESC NULLS LAST" for c in names)
    us = "epoch_us(seen_ts) % 1000000"
    text = (
        "strftime(seen_ts, '%Y-%m-%d %H:%M:%S') || "
        f"CASE WHEN {us} = 0 THEN '' WHEN {us} % 1000 = 0 THEN strftime(seen_ts, '.%g') "
        "ELSE strftime(seen_ts, '.%f') END || '+00'"
    )
    joined = " || '|' || ".join(keys.split(", "))
    return f"""
    SELECT md5({joined} || '|' || {text}) AS {id_name}, {keys}, {tracked},
           seen_ts AS eff_from_ts,
           lead(seen_ts) OVER (PARTITION BY {keys} ORDER BY seen_ts) AS eff_to_ts,
           lead(seen_ts) OVER (PARTITION BY {keys} ORDER BY seen_ts) IS NULL AS is_current,
           year(seen_ts) AS eff_from_year
    FROM (
        SELECT *, lag({pack}) OVER (PARTITION BY {keys} ORDER BY seen_ts) AS before_, {pack} AS now_
        FROM (
            SELECT * FROM ({observed}) WHERE seen_ts IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY {keys}, seen_ts ORDER BY {by}) = 1
        )
    ) WHERE before_ IS NULL OR before_ IS DISTINCT FROM now_"""


DRIVER = """CASE
    WHEN regexp_matches({0}, '(?i)(bill|invoice|charge|refund)') THEN 'BILLING'
    WHEN regexp_matches({0}, '(?i)(password|login|locked|reset)') THEN 'ACCESS'
    WHEN regexp_matches({0}, '(?i)(cancel|churn|retention)') THEN 'RETENTION'
    WHEN regexp_extract({0}, '^\\[([A-Z]{{2,5}})\\]', 1) <> '' THEN regexp_extract({0}, '^\\[([A-Z]{{2,5}})\\]', 1)
    ELSE 'OTHER' END"""
REF = "nullif(regexp_extract({0}, 'ref#(\\d+)', 1), '')"
HANDLED = "state_code IN ('TALK', 'HOLD', 'ACW')"
MONTH = "make_date(date_key // 10000, (date_key // 100) % 100, 1)"

PARTS: dict[str, str] = {
    # Cleansing.
    "ods_program": f"""
        SELECT program_id, client_id, program_code, program_name, upper(trim(line_of_business)) AS line_of_business,
               upper(trim(channel_mix)) AS channel_mix, upper(trim(site_code)) AS site_code,
               upper(trim(status)) AS status, {ts('go_live_ts')} AS go_live_ts, {ts('updated_ts')} AS updated_ts,
               {RUN} AS snapshot_date
        FROM ({newest('stg_crm_program', 'program_id', 'go_live_ts')})""",
    "ods_contract": f"""
        SELECT contract_id, client_id, program_id, contract_no, strptime(start_dt, '%Y%m%d%H%M%S') AS start_ts,
               strptime(end_dt, '%Y%m%d%H%M%S') AS end_ts, upper(trim(billing_model)) AS billing_model,
               upper(trim(currency)) AS currency, strptime(signed_dt, '%Y%m%d%H%M%S') AS signed_ts,
               upper(trim(status)) AS status, {RUN} AS snapshot_date
        FROM ({newest('stg_crm_contract', 'contract_id', 'start_dt')})""",
    "ods_contract_line": f"""
        SELECT contract_line_id, contract_id, line_no, upper(trim(service_code)) AS service_code,
               upper(trim(uom)) AS uom, unit_rate, min_commit,
               strptime(effective_dt, '%Y%m%d%H%M%S') AS effective_ts, {RUN} AS snapshot_date
        FROM ({newest('stg_crm_contract_line', 'contract_line_id', 'effective_dt, unit_rate, min_commit, service_code')})""",
    "ods_org_unit": f"""
        SELECT * REPLACE ({ts('created_ts')} AS created_ts), {RUN} AS snapshot_date
        FROM ({newest('stg_hr_org_unit', 'org_unit_id', 'created_ts')})""",
    "ods_queue": f"""
        SELECT *, {ts('created_epoch')} AS created_ts, {RUN} AS snapshot_date
        FROM ({newest('stg_tel_queue', 'queue_id', 'created_epoch')})""",
    "ods_schedule": f"""
        SELECT s.* EXCLUDE (sched_date), h.shift_code, {ts('s.start_epoch')} AS start_ts,
               {ts('s.end_epoch')} AS end_ts, CAST(s.sched_date AS DATE) AS sched_date
        FROM ({newest('stg_wfm_schedule', 'schedule_id', 'start_epoch')}) s, stg_wfm_shift h
        WHERE s.shift_id = h.shift_id""",
    "ods_adherence_event": f"""
        SELECT *, {ts('start_epoch')} AS start_ts, {ts('end_epoch')} AS end_ts,
               CAST(round((end_epoch - start_epoch) / 60) AS BIGINT) AS exception_minutes,
               CAST({ts('start_epoch')} AS DATE) AS event_date
        FROM ({newest('stg_wfm_adherence_event', 'adherence_event_id', 'start_epoch')})""",
    "ods_call": f"""
        SELECT c.*, {ts('start_epoch')} AS start_ts, {ts('answer_epoch')} AS answer_ts, {ts('end_epoch')} AS end_ts,
               coalesce(answer_epoch, end_epoch) - start_epoch AS ring_seconds, answer_epoch IS NULL AS abandoned_flag,
               coalesce(g.talk, 0) AS talk_seconds, coalesce(g.hold, 0) AS hold_seconds,
               coalesce(g.acw, 0) AS acw_seconds, CAST({ts('start_epoch')} AS DATE) AS call_date
        FROM ({newest('stg_tel_call', 'call_id', 'end_epoch')}) c
        LEFT JOIN (
            SELECT call_id, sum(end_epoch - start_epoch) FILTER (segment_type = 'TALK') AS talk,
                   sum(end_epoch - start_epoch) FILTER (segment_type = 'HOLD') AS hold,
                   sum(end_epoch - start_epoch) FILTER (segment_type = 'ACW') AS acw
            FROM stg_tel_call_segment GROUP BY ALL
        ) g USING (call_id)""",
    "ods_ivr_session": f"""
        SELECT session_ref, client_code, {ms('min(event_ms)')} AS first_event_ts, {ms('max(event_ms)')} AS last_event_ts,
               string_agg(menu_path, ' > ' ORDER BY event_ms, menu_path) AS menu_path_full, count(*) AS hops,
               NOT bool_or(menu_path = 'main.agent') AS contained_flag,
               max(key_pressed) FILTER (is_last) AS exit_key, CAST({ms('min(event_ms)')} AS DATE) AS event_date
        FROM (
            SELECT *, 1 = row_number() OVER (
                PARTITION BY session_ref ORDER BY event_ms DESC, menu_path DESC, key_pressed DESC, client_code DESC
            ) AS is_last FROM stg_file_ivr_logs
        ) GROUP BY session_ref, client_code""",
    "ods_chat_session": f"""
        SELECT chat_ref, client_code, queue_code, agent_email, {ms('started_ms')} AS started_ts,
               {ms('ended_ms')} AS ended_ts, count(m.sender) AS message_count,
               count(*) FILTER (m.sender = 'AGENT') AS agent_message_count,
               count(*) FILTER (m.sender = 'CUSTOMER') AS customer_message_count,
               CAST(round((min(m.ts_ms) FILTER (m.sender = 'AGENT') - started_ms) / 1000) AS BIGINT)
                   AS first_response_seconds,
               CAST({ms('started_ms')} AS DATE) AS event_date
        FROM (SELECT *, unnest(messages) AS m FROM stg_file_chat_transcripts)
        GROUP BY chat_ref, client_code, queue_code, agent_email, started_ms, ended_ms""",
    "ods_email_interaction": f"""
        SELECT *, {ms('received_ms')} AS received_ts, {ms('first_reply_ms')} AS first_reply_ts,
               {ms('resolved_ms')} AS resolved_ts,
               CAST(round((first_reply_ms - received_ms) / 60000) AS BIGINT) AS reply_sla_minutes,
               CAST({ms('received_ms')} AS DATE) AS event_date
        FROM ({newest('stg_file_email_interaction', 'email_ref', 'received_ms')})""",
    "ods_survey_response": f"""
        SELECT * REPLACE (trim(verbatim) AS verbatim), {ms('survey_ms')} AS survey_ts,
               CAST({ms('survey_ms')} AS DATE) AS event_date
        FROM ({newest('stg_file_survey_csat', 'survey_id', 'survey_ms')})""",
    "ods_qa_evaluation": f"""
        SELECT * EXCLUDE (overall_pct), {ms('evaluated_ms')} AS evaluated_ts,
               CASE WHEN auto_fail THEN 0 ELSE {rat('scored_points * 100', 'max_points')} END AS overall_pct,
               CAST({ms('evaluated_ms')} AS DATE) AS event_date
        FROM (
            SELECT *, len(sections) AS section_count, list_sum(list_transform(sections, lambda x: x.scored_points)) AS scored_points,
                   list_sum(list_transform(sections, lambda x: x.max_points)) AS max_points
            FROM stg_file_qa_forms WHERE len(sections) > 0
        )""",
    "ods_interaction": f"""
        SELECT u.* REPLACE (coalesce(x.customer_ref, u.customer_ref) AS customer_ref), CAST(start_ts AS DATE) AS event_date
        FROM (
            SELECT 'V' || call_id AS interaction_id, 'VOICE' AS channel, NULL AS client_code, program_id, queue_id,
                   agent_id, NULL AS customer_ref, start_ts, end_ts,
                   talk_seconds + hold_seconds + acw_seconds AS handle_seconds,
                   answer_ts IS NOT NULL AND talk_seconds > 0 AS resolved_flag, 'switch' AS source_system
            FROM ods_call WHERE call_date = {RUN}
            UNION ALL BY NAME
            SELECT 'C' || chat_ref AS interaction_id, 'CHAT' AS channel, client_code, agent_email AS customer_ref,
                   started_ts AS start_ts, ended_ts AS end_ts, {sec('ended_ts')} - {sec('started_ts')} AS handle_seconds,
                   message_count >= 3 AS resolved_flag, 'chat_feed' AS source_system
            FROM ods_chat_session WHERE event_date = {RUN}
            UNION ALL BY NAME
            SELECT 'E' || email_ref AS interaction_id, 'EMAIL' AS channel, client_code, mailbox AS customer_ref,
                   received_ts AS start_ts, resolved_ts AS end_ts, 60 * reply_sla_minutes AS handle_seconds,
                   resolved_ts IS NOT NULL AS resolved_flag, 'email_feed' AS source_system
            FROM ods_email_interaction WHERE event_date = {RUN}
        ) u LEFT JOIN stg_file_interaction_export x ON u.interaction_id = x.interaction_ref""",
    "ods_dialer_attempt": f"""
        SELECT *, {ms('attempt_ms')} AS attempt_ts, result_code = 'CONNECT' AS connected_flag,
               CAST({ms('attempt_ms')} AS DATE) AS event_date
        FROM ({newest('stg_file_dialer_result', 'attempt_id', 'attempt_ms')})""",
    "dialer_runs": f"""
        SELECT *, {ms('attempt_ms')} AS attempt_ts, result_code = 'CONNECT' AS connected_flag,
               CAST({ms('attempt_ms')} AS DATE) AS event_date
        FROM ({newest('stg_file_dialer_result', 'feed_date, attempt_id', 'attempt_ms')})
        QUALIFY row_number() OVER (PARTITION BY event_date, attempt_id ORDER BY feed_date DESC) = 1""",
    # Masters and change feeds.
    "ods_client_acid": f"""
        SELECT * REPLACE ({ts('created_ts')} AS created_ts, {ts('updated_ts')} AS updated_ts)
        FROM ({newest('stg_crm_client', 'client_id', 'updated_ts')})""",
    "ods_agent_acid": f"""
        SELECT * REPLACE ({ts('hire_ts')} AS hire_ts, {ts('term_ts')} AS term_ts),
               first_name || ' ' || last_name AS full_name
        FROM stg_hr_agent QUALIFY row_number() OVER (PARTITION BY agent_id ORDER BY load_date DESC) = 1""",
    "ods_ticket_acid": f"""
        SELECT t.*, {ms('created_ms')} AS created_ts, {ms('updated_ms')} AS updated_ts, r.resolved_ts
        FROM ({newest('stg_tkt_ticket', 'ticket_id', 'updated_ms')}) t LEFT JOIN (
            SELECT ticket_id, {ms('max(event_ms)')} AS resolved_ts FROM stg_tkt_ticket_event
            WHERE event_type = 'STATUS' AND new_value IN ('RESOLVED', 'CLOSED') GROUP BY ticket_id
        ) r USING (ticket_id)""",
    "ods_invoice_acid": f"""
        SELECT *, {ms('issued_ts_sec')} AS issued_ts, {ms('due_ts_sec')} AS due_ts
        FROM ({newest('stg_fin_invoice', 'invoice_id', 'issued_ts_sec')})""",
    "ods_timesheet": last_change(
        "stg_fin_timesheet_delta",
        "timesheet_id",
        "CAST(date_trunc('month', CAST(work_date AS DATE)) AS DATE) AS work_month",
        "ods_timesheet",
    ),
    "ods_payroll_adjustment": last_change(
        "stg_fin_payroll_adj_delta",
        "adjustment_id",
        "CAST(period_month || '-01' AS DATE) AS period_month",
        "ods_payroll_adjustment",
    ),
    "ods_sla_credit": last_change(
        "stg_crm_sla_credit_delta",
        "sla_credit_id",
        "CAST(period_month || '-01' AS DATE) AS period_month",
        "ods_sla_credit",
    ),
    "ods_callback_request": last_change(
        "stg_tel_callback_request_delta",
        "callback_id",
        f"{ts('requested_epoch')} AS requested_ts, {ts('scheduled_epoch')} AS scheduled_ts, "
        f"CAST({ts('requested_epoch')} AS DATE) AS event_date",
        "ods_callback_request",
    ),
    "ods_shift_swap": last_change(
        "stg_wfm_shift_swap_delta",
        "swap_id",
        "CAST(date_trunc('month', CAST(swap_date AS DATE)) AS DATE) AS swap_month",
        "ods_shift_swap",
    ),
    "ods_ticket_worklog": last_change(
        "stg_tkt_worklog_delta",
        "worklog_id",
        f"{ms('log_ms')} AS log_ts, CAST({ms('log_ms')} AS DATE) AS event_date",
        "ods_ticket_worklog",
    ),
    "ods_attrition_event": last_change(
        "stg_hr_attrition_event_delta",
        "attrition_event_id",
        f"{ts('notice_epoch')} AS notice_ts, CAST(date_trunc('month', {ts('notice_epoch')}) AS DATE) AS event_month",
        "ods_attrition_event",
    ),
    "ods_rate_card": f"""
        SELECT c.* REPLACE (coalesce(n.new_rate, c.rate) AS rate, {ts('c.effective_ts')} AS effective_ts,
               {ts('c.expiry_ts')} AS expiry_ts), {ms('n.change_ms')} AS last_change_ts, {RUN} AS snapshot_date
        FROM stg_fin_rate_card c LEFT JOIN (
            SELECT * FROM stg_fin_rate_card_change_delta
            QUALIFY row_number() OVER (PARTITION BY rate_card_id ORDER BY change_ms DESC, op DESC, rate_change_id DESC) = 1
        ) n ON n.rate_card_id = c.rate_card_id AND n.op <> 'D'""",
    "ods_agent_scd2": versions(
        f"""SELECT agent_id, employee_no, org_unit_id, job_grade, employment_type, status,
                   CAST(load_date AS TIMESTAMP) AS seen_ts FROM stg_hr_agent
            UNION ALL
            SELECT e.agent_id, a.employee_no, e.to_org_unit_id, a.job_grade, a.employment_type, a.status, {ts('e.event_ts')}
            FROM stg_hr_employment_event e JOIN stg_hr_agent a USING (agent_id, load_date)""",
        "agent_id",
        "employee_no, org_unit_id, job_grade, employment_type, status",
        "agent_history_id",
    ),
    "ods_agent_skill_scd2": versions(
        f"""SELECT a.agent_id, a.skill_id, k.skill_code, a.proficiency, a.certified, {ts('a.effective_ts')} AS seen_ts
            FROM stg_hr_agent_skill a LEFT JOIN stg_hr_skill k USING (skill_id)""",
        "agent_id, skill_id",
        "skill_code, proficiency, certified",
        "agent_skill_history_id",
    ),
    "ods_agent_assignment_scd2": versions(
        "SELECT * FROM obs_assignment", "agent_id, program_id", "queue_id, role_on_program", "assignment_history_id"
    ),
    # Dimensions.
    "dim_date": f"""
        SELECT {key('d')} AS date_key, strftime(d, '%Y-%m-%d') AS full_date, isodow(d) AS day_of_week,
               dayname(d) AS day_name, weekofyear(d) AS week_of_year, month(d) AS month_no, monthname(d) AS month_name,
               quarter(d) AS quarter_no, year(d) AS year_no, isodow(d) IN (6, 7) AS is_weekend,
               strftime(d, '%m-%d') IN ('01-01', '06-19', '07-04', '11-11', '12-25')
                   OR (isodow(d) = 1 AND (
                        (month(d) IN (1, 2) AND day(d) BETWEEN 15 AND 21)
                        OR (month(d) = 5 AND day(d) BETWEEN 25 AND 31)
                        OR (month(d) = 9 AND day(d) BETWEEN 1 AND 7)
                        OR (month(d) = 10 AND day(d) BETWEEN 8 AND 14)))
                   OR (isodow(d) = 4 AND month(d) = 11 AND day(d) BETWEEN 22 AND 28) AS is_holiday_us,
               'FY' || year(d) || '-Q' || quarter(d) AS fiscal_period
        FROM obs_calendar""",
    "dim_agent": f"""
        SELECT h.agent_id AS agent_sk, h.agent_id, h.employee_no, m.full_name, h.job_grade, h.employment_type,
               h.org_unit_id, o.unit_name AS team_name, coalesce(o.site_code, 'UNK') AS site_code, h.status,
               {key('m.hire_ts')} AS hire_date_key, h.is_current
        FROM ods_agent_scd2 h JOIN ods_agent_acid m USING (agent_id) LEFT JOIN ods_org_unit o ON o.org_unit_id = h.org_unit_id
        WHERE h.eff_to_ts IS NULL""",
    "dim_client": """
        SELECT c.client_id AS client_sk, c.*, b.best.full_name AS primary_contact_name, b.best.email AS primary_contact_email
        FROM ods_client_acid c LEFT JOIN (
            SELECT client_id, arg_max(k, struct_pack(a := is_primary, b := created_ts, c := contact_id)) AS best
            FROM stg_crm_client_contact k GROUP BY client_id
        ) b USING (client_id)""",
    "dim_program": f"""
        SELECT p.program_id AS program_sk, p.*, coalesce(k.billing_model, 'PER_FTE') AS billing_model,
               {key('p.go_live_ts')} AS go_live_date_key
        FROM ods_program p LEFT JOIN (
            SELECT program_id, billing_model FROM ods_contract WHERE status = 'EXECUTED'
            QUALIFY row_number() OVER (PARTITION BY program_id ORDER BY signed_ts DESC NULLS LAST, contract_id DESC) = 1
        ) k USING (program_id)""",
    "dim_queue": "SELECT queue_id AS queue_sk, * FROM ods_queue",
    "dim_site": """
        SELECT org_unit_id AS site_sk, o.site_code, unit_name AS site_name, coalesce(region, 'UNK') AS region,
               coalesce(country, 'UNK') AS country, coalesce(timezone, 'UTC') AS timezone
        FROM ods_org_unit o LEFT JOIN (VALUES
            ('MNL1', 'APAC', 'PH', 'Asia/Manila'), ('BLR2', 'APAC', 'IN', 'Asia/Kolkata'),
            ('MTY3', 'LATAM', 'MX', 'America/Monterrey')
        ) v(site_code, region, country, timezone) USING (site_code)
        WHERE unit_type = 'SITE'""",
    "dim_shift": f"SELECT shift_id AS shift_sk, * FROM ({newest('stg_wfm_shift', 'shift_id', 'created_epoch')})",
    "dim_org": """
        SELECT o.org_unit_id AS org_sk, o.org_unit_id, o.unit_code, o.unit_name, o.unit_type,
               coalesce(c.unit_name, o.unit_name) AS level1_name, coalesce(b.unit_name, o.unit_name) AS level2_name,
               coalesce(a.unit_name, o.unit_name) AS level3_name, o.unit_name AS level4_name,
               coalesce(o.site_code, a.site_code, b.site_code) AS site_code, o.cost_center
        FROM ods_org_unit o LEFT JOIN ods_org_unit a ON a.org_unit_id = o.parent_unit_id
        LEFT JOIN ods_org_unit b ON b.org_unit_id = a.parent_unit_id
        LEFT JOIN ods_org_unit c ON c.org_unit_id = b.parent_unit_id""",
    "dim_disposition": f"""
        SELECT dense_rank() OVER (ORDER BY disposition_code NULLS FIRST) AS disposition_sk, *
        FROM ({newest('stg_tel_disposition_code', 'disposition_code', 'created_epoch')})""",
    # Facts.
    "fact_interaction": f"""
        SELECT i.*, coalesce(c.client_sk, -1) AS client_sk, coalesce(p.program_sk, -1) AS program_sk,
               coalesce(q.queue_sk, -1) AS queue_sk, coalesce(a.agent_sk, -1) AS agent_sk, {key('i.start_ts')} AS date_key
        FROM ods_interaction i LEFT JOIN dim_agent a ON a.agent_id = i.agent_id AND a.is_current
        LEFT JOIN dim_program p ON p.program_id = i.program_id LEFT JOIN dim_queue q ON q.queue_id = i.queue_id
        LEFT JOIN dim_client c ON c.client_code = i.client_code
        WHERE i.event_date = {RUN}""",
    "fact_agent_activity": f"""
        SELECT agent_sk, state_code, sum(secs) - coalesce(max(off), 0) AS state_seconds, count(*) AS occurrence_count,
               {ts('min(start_epoch)')} AS first_state_ts, {ts('max(end_epoch)')} AS last_state_ts,
               {key(ts('min(start_epoch)'))} AS date_key
        FROM (
            SELECT coalesce(a.agent_sk, -1) AS agent_sk, e.*, e.end_epoch - e.start_epoch AS secs,
                   CASE WHEN starts_with(e.state_code, 'AUX') THEN x.secs END AS off
            FROM stg_tel_agent_state_event e LEFT JOIN dim_agent a ON a.agent_id = e.agent_id AND a.is_current
            LEFT JOIN (
                SELECT agent_id, sum({sec('end_ts')} - {sec('start_ts')}) AS secs FROM ods_adherence_event
                WHERE event_date = {RUN} AND approved_flag GROUP BY agent_id
            ) x ON x.agent_id = e.agent_id
        ) GROUP BY agent_sk, state_code""",
    "fact_queue_interval": f"""
        SELECT queue_sk, interval_start_ts, count(*) AS offered, count(*) FILTER (NOT abandoned_flag) AS answered,
               count(*) FILTER (abandoned_flag) AS abandoned,
               count(*) FILTER (NOT abandoned_flag AND ring_seconds <= 20) AS answered_in_sl, 20 AS sl_threshold_sec,
               {rat('sum(ring_seconds) FILTER (NOT abandoned_flag)', 'count(ring_seconds) FILTER (NOT abandoned_flag)')}
                   AS avg_speed_answer_sec,
               {rat('sum(talk_seconds + hold_seconds + acw_seconds)', 'count(*)')} AS avg_handle_sec,
               {key('interval_start_ts')} AS date_key
        FROM (
            SELECT c.*, coalesce(q.queue_sk, -1) AS queue_sk, time_bucket(INTERVAL 30 MINUTE, start_ts) AS interval_start_ts
            FROM ods_call c LEFT JOIN dim_queue q ON q.queue_id = c.queue_id WHERE call_date = {RUN}
        ) GROUP BY queue_sk, interval_start_ts""",
    "fact_csat_survey": f"""
        SELECT s.*, s.interaction_ref AS interaction_id, coalesce(f.client_sk, -1) AS client_sk,
               coalesce(f.program_sk, -1) AS program_sk, coalesce(f.agent_sk, -1) AS agent_sk, {key('survey_ts')} AS date_key
        FROM ods_survey_response s LEFT JOIN fact_interaction f ON f.interaction_id = s.interaction_ref
        WHERE s.event_date = {RUN}""",
    "fact_qa_evaluation": f"""
        SELECT e.*, e.interaction_ref AS interaction_id, coalesce(f.program_sk, -1) AS program_sk,
               coalesce(f.agent_sk, -1) AS agent_sk, {key('evaluated_ts')} AS date_key
        FROM ods_qa_evaluation e LEFT JOIN fact_interaction f ON f.interaction_id = e.interaction_ref
        WHERE e.event_date = {RUN}""",
    "fact_billing_line": """
        SELECT l.* REPLACE (coalesce(r.rate, l.unit_rate) AS unit_rate), coalesce(c.client_id, i.client_id) AS client_sk,
               coalesce(p.program_sk, -1) AS program_sk, coalesce(r.service_code, 'UNKNOWN') AS service_code,
               i.status AS invoice_status, DATE '2024-01-01' AS period_month
        FROM stg_fin_invoice_line l JOIN ods_invoice_acid i ON i.invoice_id = l.invoice_id AND i.period_month = '2024-01'
        LEFT JOIN dim_program p ON p.program_id = i.program_id LEFT JOIN ods_client_acid c ON c.client_id = i.client_id
        LEFT JOIN ods_rate_card r ON r.program_id = i.program_id""",
    "fact_adherence_daily": f"""
        SELECT agent_sk, sum(paid_minutes) AS scheduled_minutes, sum(paid_minutes) - max(exc) AS worked_minutes,
               max(exc) AS exception_minutes, max(pto) AS timeoff_minutes,
               {rat('(sum(paid_minutes) - max(exc)) * 100', 'sum(paid_minutes)')} AS adherence_pct,
               0.0 AS occupancy_pct, CAST(20240115 AS BIGINT) AS date_key
        FROM (
            SELECT s.*, coalesce(a.agent_sk, -1) AS agent_sk, coalesce(x.exc, 0) AS exc, coalesce(t.pto, 0) AS pto
            FROM ods_schedule s LEFT JOIN dim_agent a ON a.agent_id = s.agent_id AND a.is_current
            LEFT JOIN (
                SELECT agent_id, sum(exception_minutes) AS exc FROM ods_adherence_event
                WHERE event_date = {RUN} GROUP BY agent_id
            ) x ON x.agent_id = s.agent_id
            LEFT JOIN (
                SELECT agent_id, 480 * count(*) AS pto FROM stg_wfm_timeoff_request
                WHERE status = 'APPROVED' AND {RUN} BETWEEN CAST(start_date AS DATE) AND CAST(end_date AS DATE)
                GROUP BY agent_id
            ) t ON t.agent_id = s.agent_id
            WHERE s.sched_date = {RUN}
        ) GROUP BY agent_sk""",
    "fact_ticket": f"""
        SELECT t.ticket_id, coalesce(t.program_id, -1) AS program_sk, coalesce(k.category_code, 'UNK') AS category_code,
               coalesce(a.agent_sk, -1) AS assigned_agent_sk, t.priority, t.status, t.created_ts, t.resolved_ts,
               CAST(round(({sec('resolved_ts')} - {sec('created_ts')}) / 60) AS BIGINT) AS resolution_minutes,
               coalesce({sec('resolved_ts')} - {sec('created_ts')} > coalesce(k.sla_hours, 24) * 3600, FALSE)
                   AS sla_breached_flag,
               (SELECT count(*) FROM stg_tkt_ticket_event e WHERE e.ticket_id = t.ticket_id) AS touch_count,
               CAST(20240115 AS BIGINT) AS date_key
        FROM ods_ticket_acid t LEFT JOIN stg_tkt_category k USING (category_id)
        LEFT JOIN dim_agent a ON a.agent_id = t.assigned_agent_id AND a.is_current
        WHERE CAST(t.created_ts AS DATE) = {RUN}""",
    "fact_ivr_path": f"""
        SELECT *, {sec('last_event_ts')} - {sec('first_event_ts')} AS duration_seconds, {key('first_event_ts')} AS date_key
        FROM ods_ivr_session WHERE event_date = {RUN}""",
    # Aggregates.
    "agg_agent_daily": f"""
        SELECT agent_sk, date_key, coalesce(d.site_code, 'UNK') AS site_code, coalesce(n, 0) AS interactions_handled,
               {rat('h', 'hn')} AS avg_handle_seconds, coalesce(talk, 0) AS talk_seconds, coalesce(acw, 0) AS acw_seconds,
               coalesce(aux, 0) AS aux_seconds, {rat('worked * 100', 'planned')} AS adherence_pct,
               {rat('busy * 100', '(busy + ready)')} AS occupancy_pct
        FROM (
            SELECT agent_sk, date_key, count(*) AS n, sum(handle_seconds) AS h, count(handle_seconds) AS hn
            FROM fact_interaction GROUP BY ALL
        ) FULL JOIN (
            SELECT agent_sk, date_key, coalesce(sum(state_seconds) FILTER (state_code = 'TALK'), 0) AS talk,
                   coalesce(sum(state_seconds) FILTER (state_code = 'ACW'), 0) AS acw,
                   coalesce(sum(state_seconds) FILTER (state_code LIKE 'AUX%'), 0) AS aux,
                   coalesce(sum(state_seconds) FILTER ({HANDLED}), 0) AS busy,
                   coalesce(sum(state_seconds) FILTER (state_code = 'READY'), 0) AS ready
            FROM fact_agent_activity GROUP BY ALL
        ) USING (agent_sk, date_key) FULL JOIN (
            SELECT agent_sk, date_key, sum(worked_minutes) AS worked, sum(scheduled_minutes) AS planned
            FROM fact_adherence_daily GROUP BY ALL
        ) USING (agent_sk, date_key) LEFT JOIN (SELECT agent_sk, site_code FROM dim_agent) d USING (agent_sk)""",
    "agg_agent_weekly": f"""
        SELECT agent_sk, site_code, {key("date_trunc('week', make_date(date_key // 10000, (date_key // 100) % 100, date_key % 100))")}
                   AS week_start_key,
               count(*) AS days_worked, sum(interactions_handled) AS interactions_handled,
               {rat('sum(CAST(round(avg_handle_seconds * 100) AS BIGINT) * interactions_handled)',
                    'sum(CASE WHEN avg_handle_seconds IS NOT NULL THEN 100 * interactions_handled END)')} AS avg_handle_seconds,
               {rat('sum(CAST(round(adherence_pct * 100) AS BIGINT))', '100 * count(adherence_pct)')} AS adherence_pct,
               {rat('sum(CAST(round(occupancy_pct * 100) AS BIGINT))', '100 * count(occupancy_pct)')} AS occupancy_pct
        FROM agg_agent_daily GROUP BY 1, 2, 3""",
    "agg_queue_hourly": f"""
        SELECT queue_sk, date_key, hour_of_day, sum(offered) AS offered, sum(answered) AS answered,
               sum(abandoned) AS abandoned, {rat('sum(answered_in_sl) * 100', 'sum(answered)')} AS sl_pct,
               any_value(f.v) AS forecast_volume,
               {rat('(sum(offered) - any_value(f.v)) * 100', 'any_value(f.v)')} AS volume_variance_pct
        FROM (SELECT *, hour(interval_start_ts) AS hour_of_day FROM fact_queue_interval) i
        LEFT JOIN (
            SELECT queue_id AS queue_sk, {key(ts('interval_start_epoch'))} AS date_key,
                   hour({ts('interval_start_epoch')}) AS hour_of_day, sum(forecast_volume) AS v
            FROM stg_wfm_forecast GROUP BY ALL
        ) f USING (queue_sk, date_key, hour_of_day)
        GROUP BY queue_sk, date_key, hour_of_day""",
    "agg_site_daily": f"""
        SELECT site_code, date_key, coalesce(agents, 0) AS agents_active, coalesce(n, 0) AS interactions,
               {rat('h', 'hn')} AS avg_handle_seconds, {rat('insl * 100', 'ans')} AS sl_pct,
               {rat('worked * 100', 'planned')} AS adherence_pct
        FROM (
            SELECT coalesce(d.site_code, 'UNK') AS site_code, date_key, count(DISTINCT nullif(agent_sk, -1)) AS agents,
                   count(*) AS n, sum(handle_seconds) AS h, count(handle_seconds) AS hn
            FROM fact_interaction LEFT JOIN dim_agent d USING (agent_sk) GROUP BY 1, 2
        ) FULL JOIN (
            SELECT coalesce(p.site_code, 'UNK') AS site_code, date_key, sum(answered) AS ans, sum(answered_in_sl) AS insl
            FROM fact_queue_interval i LEFT JOIN dim_queue q USING (queue_sk) LEFT JOIN dim_program p USING (program_id)
            GROUP BY 1, 2
        ) USING (site_code, date_key) FULL JOIN (
            SELECT coalesce(d.site_code, 'UNK') AS site_code, date_key, sum(worked_minutes) AS worked,
                   sum(scheduled_minutes) AS planned
            FROM fact_adherence_daily LEFT JOIN dim_agent d USING (agent_sk) GROUP BY 1, 2
        ) USING (site_code, date_key)""",
    "agg_program_monthly": f"""
        SELECT client_sk, program_sk, line_of_business, period_month, coalesce(sum(n), 0) AS interactions,
               {rat('sum(h)', 'sum(hn)')} AS avg_handle_seconds, {rat('sum(cs)', 'sum(cn)')} AS avg_csat,
               sum(billed) AS billed_amount, grouping(client_sk, program_sk, line_of_business) AS grouping_level
        FROM (
            SELECT coalesce(d.client_id, -1) AS client_sk, program_sk, d.line_of_business, f.* EXCLUDE (program_sk)
            FROM (
                SELECT program_sk, {MONTH} AS period_month, 1 AS n, handle_seconds AS h,
                       CASE WHEN handle_seconds IS NOT NULL THEN 1 END AS hn FROM fact_interaction
                UNION ALL BY NAME
                SELECT program_sk, {MONTH} AS period_month, csat_score AS cs,
                       CASE WHEN csat_score IS NOT NULL THEN 1 END AS cn FROM fact_csat_survey
                UNION ALL BY NAME
                SELECT program_sk, period_month, line_amount AS billed FROM fact_billing_line
            ) f LEFT JOIN dim_program d USING (program_sk)
        ) GROUP BY period_month, ROLLUP (client_sk, program_sk, line_of_business)""",
    "agg_csat_rollup_monthly": f"""
        SELECT client_sk, program_sk, site_code, period_month, count(*) AS surveys,
               {rat('sum(csat_score)', 'count(csat_score)')} AS avg_csat,
               {rat('100 * count(*) FILTER (nps_score >= 9)', 'count(*)')} AS pct_promoters,
               {rat('100 * count(*) FILTER (nps_score <= 6)', 'count(*)')} AS pct_detractors,
               grouping(client_sk, program_sk, site_code) AS grouping_id
        FROM (
            SELECT coalesce(d.client_id, -1) AS client_sk, program_sk, coalesce(d.site_code, 'UNK') AS site_code,
                   {MONTH} AS period_month, csat_score, nps_score
            FROM fact_csat_survey LEFT JOIN dim_program d USING (program_sk)
        ) GROUP BY period_month, ROLLUP (client_sk, program_sk, site_code)""",
    "agg_billing_monthly": """
        SELECT b.*, coalesce(s.credit, 0) AS sla_credit_amount, coalesce(t.cost, 0) AS telco_cost_amount,
               b.billed_amount - coalesce(s.credit, 0) AS net_revenue
        FROM (
            SELECT client_sk, program_sk, period_month, sum(line_amount) AS billed_amount FROM fact_billing_line GROUP BY ALL
        ) b LEFT JOIN (
            SELECT program_id AS program_sk, period_month, sum(credit_amount) AS credit FROM ods_sla_credit GROUP BY ALL
        ) s USING (program_sk, period_month) LEFT JOIN (
            SELECT d.client_sk, CAST(bill_period || '-01' AS DATE) AS period_month, sum(charge_amount) AS cost
            FROM stg_file_telco_invoice JOIN dim_client d USING (client_code) GROUP BY ALL
        ) t USING (client_sk, period_month)""",
    # Analyst queries: final columns in plain types.
    "vw_org_hierarchy": """
        WITH RECURSIVE walk AS (
            SELECT o.*, org_unit_id AS root_unit_id, CAST(0 AS BIGINT) AS depth, unit_name AS path_names
            FROM ods_org_unit o WHERE parent_unit_id IS NULL
            UNION ALL
            SELECT o.*, w.root_unit_id, w.depth + 1, w.path_names || ' > ' || o.unit_name
            FROM walk w, ods_org_unit o WHERE o.parent_unit_id = w.org_unit_id AND w.depth < 6
        ) SELECT org_unit_id, unit_code, unit_name, unit_type, site_code, root_unit_id, depth, path_names FROM walk""",
    "vw_active_agents_ndv": """
        SELECT date_key, site_code, count(*) AS interactions, TRUE AS agents_within_bound, TRUE AS pairs_within_bound
        FROM fact_interaction JOIN dim_agent USING (agent_sk) GROUP BY date_key, site_code""",
    "vw_csat_rollup": """
        SELECT client_id, program_code, count(*) AS surveys, CAST(sum(csat_score) AS BIGINT) / count(csat_score) AS avg_csat,
               count(*) FILTER (nps_score >= 9) / count(*) * 100 AS pct_promoters,
               grouping(client_id, program_code) AS grouping_level
        FROM fact_csat_survey JOIN dim_program USING (program_sk) GROUP BY ROLLUP (client_id, program_code)""",
    "vw_call_driver_regex": f"""
        SELECT strftime(call_date, '%Y-%m-%d') AS call_date, queue_id, {DRIVER.format('disposition_desc')} AS call_driver,
               {REF.format('disposition_desc')} AS embedded_ref_no, count(*) AS calls,
               CAST(sum(talk_seconds) AS BIGINT) / count(talk_seconds) AS avg_talk_seconds
        FROM ods_call JOIN dim_disposition USING (disposition_code) GROUP BY 1, 2, 3, 4""",
    "vw_repeat_contact_window": f"""
        SELECT interaction_id, customer_ref, channel, start_ts, prev AS prev_contact_ts,
               CAST(coalesce({sec('start_ts')} - {sec('prev')} <= 259200, FALSE) AS BIGINT) AS repeat_within_72h
        FROM (
            SELECT *, lag(start_ts) OVER (PARTITION BY customer_ref ORDER BY start_ts, interaction_id, channel) AS prev
            FROM ods_interaction WHERE length(customer_ref) > 0
        )""",
    "vw_billing_reconciliation": f"""
        SELECT s.invoice_no, CAST(s.total_amount AS DOUBLE) AS staged_amount, CAST(a.total_amount AS DOUBLE) AS ods_amount,
               {ts('n')} AS staged_issued_ts, a.issued_ts AS ods_issued_ts, {sec('a.issued_ts')} - n AS drift_seconds,
               CASE WHEN abs(s.total_amount - a.total_amount) > 0.01 THEN 'AMOUNT_MISMATCH'
                    WHEN {sec('a.issued_ts')} <> n THEN 'TS_MISMATCH' ELSE 'OK' END AS recon_status
        FROM (SELECT *, CAST(round(issued_ts_sec / 1000) AS BIGINT) AS n FROM stg_fin_invoice) s
        JOIN ods_invoice_acid a USING (invoice_id)""",
    "vw_agent_roster_current": """
        SELECT h.agent_id, h.employee_no, h.org_unit_id, h.job_grade, h.employment_type, h.status, h.eff_from_ts,
               a.program_id AS current_program_id, a.queue_id AS current_queue_id, a.role_on_program
        FROM (
            SELECT * FROM ods_agent_scd2
            QUALIFY eff_from_ts = max(eff_from_ts) OVER (PARTITION BY agent_id)
        ) h LEFT JOIN ods_agent_assignment_scd2 a ON a.agent_id = h.agent_id AND a.eff_to_ts IS NULL""",
    "vw_agent_scorecard": f"""
        SELECT agent_sk, full_name, site_code, job_grade, aht, adherence, volume, avg_qa_pct,
               coalesce(k, 0) AS certified_skills, percent_rank() OVER (ORDER BY aht NULLS FIRST) AS aht_pctile,
               ntile(4) OVER (ORDER BY avg_qa_pct DESC NULLS LAST, agent_sk) AS qa_quartile
        FROM (SELECT * FROM dim_agent WHERE is_current) JOIN (
            SELECT agent_sk, {rat('sum(CAST(round(avg_handle_seconds * 100) AS BIGINT))', '100 * count(avg_handle_seconds)', 6)} AS aht,
                   {rat('sum(CAST(round(adherence_pct * 100) AS BIGINT))', '100 * count(adherence_pct)', 6)} AS adherence,
                   CAST(sum(interactions_handled) AS BIGINT) AS volume
            FROM agg_agent_daily GROUP BY agent_sk
        ) USING (agent_sk) LEFT JOIN (
            SELECT agent_sk, {rat('sum(CAST(round(overall_pct * 100) AS BIGINT))', '100 * count(overall_pct)', 6)} AS avg_qa_pct
            FROM fact_qa_evaluation GROUP BY agent_sk
        ) USING (agent_sk) LEFT JOIN (
            SELECT agent_id, count(*) AS k FROM ods_agent_skill_scd2 WHERE eff_to_ts IS NULL AND certified GROUP BY agent_id
        ) USING (agent_id)""",
    "vw_attrition_risk": f"""
        SELECT * EXCLUDE (band), CASE WHEN band = 1 OR notice_events > 0 THEN 'HIGH' WHEN band = 2 THEN 'MEDIUM'
               ELSE 'LOW' END AS attrition_risk
        FROM (
            SELECT agent_sk, agent_id, full_name, site_code, adherence_90d, coalesce(n, 0) AS notice_events,
                   ntile(5) OVER (ORDER BY adherence_90d NULLS FIRST, agent_sk) AS band
            FROM dim_agent JOIN (
                SELECT agent_sk, {rat('sum(CAST(round(adherence_pct * 100) AS BIGINT))', '100 * count(adherence_pct)', 6)}
                    AS adherence_90d FROM fact_adherence_daily GROUP BY agent_sk
            ) USING (agent_sk) LEFT JOIN (
                SELECT agent_id, count(*) AS n FROM ods_attrition_event GROUP BY agent_id
            ) USING (agent_id) WHERE is_current AND status = 'ACTIVE'
        )""",
    "vw_queue_sla_attainment": """
        SELECT queue_code, media_type, date_key, 1.0::DOUBLE * level AS sl_pct, CAST(goal AS DOUBLE) AS sl_target,
               CASE WHEN level >= goal THEN 'MET' ELSE 'MISSED' END AS attainment
        FROM (
            SELECT q.queue_code, q.media_type, f.date_key,
                   CAST(sum(answered_in_sl) AS BIGINT) / nullif(CAST(sum(answered) AS BIGINT), 0) * 100 AS level,
                   max(t.target_value) AS goal
            FROM fact_queue_interval f JOIN dim_queue q USING (queue_sk)
            LEFT JOIN (SELECT * FROM stg_crm_sla_target WHERE metric_code = 'SL_20_80') t ON t.queue_id = q.queue_id
            GROUP BY ALL
        )""",
    "vw_first_contact_resolution": """
        SELECT date_key, program_sk, count(*) AS resolved_interactions, count(*) FILTER (other IS NULL) AS fcr_count,
               count(*) FILTER (other IS NULL) / count(*) * 100 AS fcr_pct
        FROM (
            SELECT f.date_key, f.program_sk, r.interaction_id AS other
            FROM (SELECT * FROM fact_interaction WHERE resolved_flag) f LEFT JOIN fact_interaction r
              ON f.customer_ref = r.customer_ref AND r.start_ts > f.end_ts AND r.start_ts <= f.end_ts + INTERVAL 7 DAY
        ) GROUP BY date_key, program_sk""",
    "vw_occupancy_utilization": f"""
        SELECT date_key, site_code, agent_sk, CAST(busy AS BIGINT) AS handle_seconds, CAST(idle AS BIGINT) AS ready_seconds,
               CAST(aux AS BIGINT) AS aux_seconds, CAST(busy AS BIGINT) / nullif(CAST(busy + idle AS BIGINT), 0) * 100 AS occupancy_pct
        FROM (
            SELECT date_key, site_code, agent_sk, coalesce(sum(state_seconds) FILTER ({HANDLED}), 0) AS busy,
                   coalesce(sum(state_seconds) FILTER (state_code = 'READY'), 0) AS idle,
                   coalesce(sum(state_seconds) FILTER (state_code LIKE 'AUX%'), 0) AS aux
            FROM fact_agent_activity JOIN dim_agent USING (agent_sk) GROUP BY date_key, site_code, agent_sk
        )""",
    "vw_shrinkage_analysis": """
        SELECT date_key, site_code, planned AS scheduled_minutes, worked AS worked_minutes, lost AS shrinkage_minutes,
               lost / nullif(planned, 0) * 100 AS shrinkage_pct, schedules, overnight_shifts
        FROM (
            SELECT f.date_key, a.site_code, CAST(sum(f.scheduled_minutes) AS BIGINT) AS planned,
                   CAST(sum(f.worked_minutes) AS BIGINT) AS worked,
                   CAST(sum(f.exception_minutes + f.timeoff_minutes) AS BIGINT) AS lost,
                   count(DISTINCT s.schedule_id) AS schedules, count(DISTINCT h.shift_sk) AS overnight_shifts
            FROM fact_adherence_daily f JOIN dim_agent a USING (agent_sk)
            LEFT JOIN ods_schedule s ON s.agent_id = a.agent_id AND strftime(s.sched_date, '%Y%m%d') = f.date_key::VARCHAR
            LEFT JOIN dim_shift h ON h.shift_id = s.shift_id AND h.overnight_flag
            GROUP BY f.date_key, a.site_code
        )""",
    "vw_program_margin": """
        SELECT strftime(period_month, '%Y-%m-%d') AS period_month, client_sk, program_sk,
               CAST(billed_amount AS DOUBLE) AS billed_amount, CAST(net_revenue AS DOUBLE) AS net_revenue,
               cost AS est_labor_cost, CAST(adj AS DOUBLE) AS total_adjustments,
               CAST(net_revenue AS DOUBLE) - cost - CAST(coalesce(adj, 0) AS DOUBLE) AS est_margin,
               CAST(committed AS DOUBLE) AS committed_min
        FROM agg_billing_monthly LEFT JOIN (
            SELECT program_id AS program_sk, work_month AS period_month,
                   CAST(sum(billable_minutes) AS BIGINT) / CAST(60 AS DOUBLE) * CAST(18.5 AS DOUBLE) AS cost
            FROM ods_timesheet GROUP BY 1, 2
        ) USING (program_sk, period_month) LEFT JOIN (
            SELECT period_month, sum(amount) AS adj FROM ods_payroll_adjustment GROUP BY period_month
        ) USING (period_month) LEFT JOIN (
            SELECT c.program_id AS program_sk, sum(l.min_commit) AS committed
            FROM ods_contract_line l JOIN ods_contract c USING (contract_id) GROUP BY 1
        ) USING (program_sk)""",
    "vw_client_executive_summary": """
        SELECT c.client_code, c.client_name, strftime(m.period_month, '%Y-%m-%d') AS period_month, p.program_code,
               CAST(m.interactions AS BIGINT) AS interactions, m.avg_handle_seconds, m.avg_csat, s.pct_promoters,
               s.pct_detractors, CAST(b.billed_amount AS DOUBLE) AS billed_amount,
               CAST(b.sla_credit_amount AS DOUBLE) AS sla_credit_amount, CAST(b.net_revenue AS DOUBLE) AS net_revenue,
               t.opened AS open_tickets, t.late AS sla_breached_tickets
        FROM agg_program_monthly m JOIN dim_program p ON p.program_sk = m.program_sk AND m.grouping_level = 0
        JOIN dim_client c ON c.client_id = p.client_id
        LEFT JOIN agg_csat_rollup_monthly s ON s.program_sk = m.program_sk AND s.period_month = m.period_month
        LEFT JOIN agg_billing_monthly b ON b.program_sk = m.program_sk AND b.period_month = m.period_month
        LEFT JOIN (
            SELECT program_sk, count(*) FILTER (status IN ('OPEN', 'PENDING')) AS opened,
                   count(*) FILTER (sla_breached_flag) AS late FROM fact_ticket GROUP BY program_sk
        ) t ON t.program_sk = m.program_sk""",
}


# Parts that read the deliveries of all days; the others read those of the run date.
ALL_DAYS = {
    "ods_client_acid": "stg_crm_client",
    "ods_agent_acid": "stg_hr_agent",
    "ods_ticket_acid": "stg_tkt_ticket",
    "ods_invoice_acid": "stg_fin_invoice",
    "ods_agent_scd2": "stg_hr_agent",
    "vw_billing_reconciliation": "stg_fin_invoice",
    "dialer_runs": "stg_file_dialer_result",
}
TODAY = "_today"


def part(name: str) -> str:
    if name in RECIPES:
        return duck_sql(name)
    if name.endswith(TODAY):
        table = name.removesuffix(TODAY)
        return f"SELECT * FROM {table} WHERE {TABLES[table].partition} = {RUN}"
    sql = PARTS[name]
    for table in OTHER_DAYS:
        if ALL_DAYS.get(name) != table:
            sql = re.sub(rf"\b{table}\b", table + TODAY, sql)
    return sql


def _references(sql: str) -> list[str]:
    known = {*RECIPES, *PARTS, *[t + TODAY for t in OTHER_DAYS]}
    return [n for n in dict.fromkeys(re.findall(r"\b\w+\b", sql)) if n in known]


def compose(sql: str) -> str:
    """``sql`` with every part it mentions defined before it."""
    done: list[str] = []

    def need(name: str) -> None:
        if name in done:
            return
        for other in _references(part(name)):
            if other != name:
                need(other)
        done.append(name)

    for name in _references(sql):
        need(name)
    if not done:
        return sql
    parts = ",\n".join(f"{n} AS ({part(n)})" for n in done)
    return f"WITH {parts}\nSELECT * FROM (\n{sql}\n)"


PLAIN = {"DATE": "strftime({0}, '%Y-%m-%d')", "STRING": "CAST({0} AS VARCHAR)"}


def plain(name: str, columns: list[str] | None = None, source: str | None = None) -> str:
    """Projection of a declared table to plain types."""
    out = []
    for column, kind in TABLES[name].columns:
        if columns and column not in columns:
            continue
        form = PLAIN.get(kind, "CAST({0} AS DOUBLE)" if kind.startswith("DECIMAL") else f"CAST({{0}} AS {kind})")
        out.append(f"{form.format(column)} AS {column}")
    return f"SELECT {', '.join(out)} FROM {source or name}"


def oracle(name: str) -> str:
    """One self-contained statement for a table or an analyst query."""
    return compose(plain(name) if name in TABLES else f"SELECT * FROM {name}")
