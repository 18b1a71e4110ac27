"""Declared tables of the ods layer: column list, primary key, partition column, cluster keys."""

from switchboard.schemas.table import Table

TABLES = [
    Table(
        "ods_adherence_event",
        "adherence_event_id BIGINT, agent_id BIGINT, schedule_id BIGINT, exception_type STRING, "
        "start_ts TIMESTAMP, end_ts TIMESTAMP, exception_minutes BIGINT, approved_flag BOOLEAN, "
        "event_date DATE",
        pk=["adherence_event_id"],
        partition="event_date",
    ),
    Table(
        "ods_agent_acid",
        "agent_id BIGINT, employee_no STRING, full_name STRING, email STRING, "
        "org_unit_id BIGINT, job_grade STRING, employment_type STRING, hire_ts TIMESTAMP, "
        "term_ts TIMESTAMP, status STRING",
        pk=["agent_id"],
        cluster=["agent_id"],
    ),
    Table(
        "ods_agent_assignment_scd2",
        "assignment_history_id STRING, agent_id BIGINT, program_id BIGINT, queue_id BIGINT, "
        "role_on_program STRING, eff_from_ts TIMESTAMP, eff_to_ts TIMESTAMP, is_current BOOLEAN, "
        "eff_from_year BIGINT",
        pk=["assignment_history_id"],
        partition="eff_from_year",
    ),
    Table(
        "ods_agent_scd2",
        "agent_history_id STRING, agent_id BIGINT, employee_no STRING, org_unit_id BIGINT, "
        "job_grade STRING, employment_type STRING, status STRING, eff_from_ts TIMESTAMP, "
        "eff_to_ts TIMESTAMP, is_current BOOLEAN, eff_from_year BIGINT",
        pk=["agent_history_id"],
        partition="eff_from_year",
    ),
    Table(
        "ods_agent_skill_scd2",
        "agent_skill_history_id STRING, agent_id BIGINT, skill_id BIGINT, skill_code STRING, "
        "proficiency BIGINT, certified BOOLEAN, eff_from_ts TIMESTAMP, eff_to_ts TIMESTAMP, "
        "is_current BOOLEAN, eff_from_year BIGINT",
        pk=["agent_skill_history_id"],
        partition="eff_from_year",
    ),
    Table(
        "ods_attrition_event",
        "attrition_event_id BIGINT, agent_id BIGINT, notice_ts TIMESTAMP, last_day STRING, "
        "attrition_type STRING, reason_code STRING, regrettable_flag BOOLEAN, "
        "last_change_ts TIMESTAMP, event_month DATE",
        pk=["attrition_event_id"],
        partition="event_month",
    ),
    Table(
        "ods_call",
        "call_id BIGINT, queue_id BIGINT, agent_id BIGINT, program_id BIGINT, direction STRING, "
        "start_ts TIMESTAMP, answer_ts TIMESTAMP, end_ts TIMESTAMP, ring_seconds BIGINT, "
        "talk_seconds BIGINT, hold_seconds BIGINT, acw_seconds BIGINT, abandoned_flag BOOLEAN, "
        "disposition_code STRING, recording_id STRING, call_date DATE",
        pk=["call_id"],
        partition="call_date",
    ),
    Table(
        "ods_callback_request",
        "callback_id BIGINT, call_id BIGINT, queue_id BIGINT, requested_ts TIMESTAMP, "
        "scheduled_ts TIMESTAMP, completed_flag BOOLEAN, last_change_ts TIMESTAMP, "
        "event_date DATE",
        pk=["callback_id"],
        partition="event_date",
    ),
    Table(
        "ods_chat_session",
        "chat_ref STRING, client_code STRING, queue_code STRING, agent_email STRING, "
        "started_ts TIMESTAMP, ended_ts TIMESTAMP, message_count BIGINT, "
        "agent_message_count BIGINT, customer_message_count BIGINT, "
        "first_response_seconds BIGINT, event_date DATE",
        pk=["chat_ref"],
        partition="event_date",
    ),
    Table(
        "ods_client_acid",
        "client_id BIGINT, client_code STRING, client_name STRING, industry STRING, "
        "hq_country STRING, status STRING, created_ts TIMESTAMP, updated_ts TIMESTAMP",
        pk=["client_id"],
        cluster=["client_id"],
    ),
    Table(
        "ods_contract",
        "contract_id BIGINT, client_id BIGINT, program_id BIGINT, contract_no STRING, "
        "start_ts TIMESTAMP, end_ts TIMESTAMP, billing_model STRING, currency STRING, "
        "signed_ts TIMESTAMP, status STRING, snapshot_date DATE",
        pk=["contract_id"],
        partition="snapshot_date",
    ),
    Table(
        "ods_contract_line",
        "contract_line_id BIGINT, contract_id BIGINT, line_no BIGINT, service_code STRING, "
        "uom STRING, unit_rate DECIMAL(12,4), min_commit DECIMAL(12,2), effective_ts TIMESTAMP, "
        "snapshot_date DATE",
        pk=["contract_line_id"],
        partition="snapshot_date",
    ),
    Table(
        "ods_dialer_attempt",
        "attempt_id STRING, client_code STRING, campaign_code STRING, agent_id BIGINT, "
        "attempt_ts TIMESTAMP, result_code STRING, connected_flag BOOLEAN, talk_seconds BIGINT, "
        "event_date DATE",
        pk=["attempt_id"],
        partition="event_date",
    ),
    Table(
        "ods_email_interaction",
        "email_ref STRING, client_code STRING, mailbox STRING, agent_email STRING, "
        "received_ts TIMESTAMP, first_reply_ts TIMESTAMP, resolved_ts TIMESTAMP, "
        "reply_sla_minutes BIGINT, subject_category STRING, event_date DATE",
        pk=["email_ref"],
        partition="event_date",
    ),
    Table(
        "ods_interaction",
        "interaction_id STRING, channel STRING, client_code STRING, program_id BIGINT, "
        "queue_id BIGINT, agent_id BIGINT, customer_ref STRING, start_ts TIMESTAMP, "
        "end_ts TIMESTAMP, handle_seconds BIGINT, resolved_flag BOOLEAN, source_system STRING, "
        "event_date DATE",
        pk=["interaction_id"],
        partition="event_date",
    ),
    Table(
        "ods_invoice_acid",
        "invoice_id BIGINT, invoice_no STRING, client_id BIGINT, program_id BIGINT, "
        "period_month STRING, issued_ts TIMESTAMP, due_ts TIMESTAMP, currency STRING, "
        "total_amount DECIMAL(14,2), status STRING",
        pk=["invoice_id"],
        cluster=["invoice_id"],
    ),
    Table(
        "ods_ivr_session",
        "session_ref STRING, client_code STRING, first_event_ts TIMESTAMP, "
        "last_event_ts TIMESTAMP, menu_path_full STRING, hops BIGINT, contained_flag BOOLEAN, "
        "exit_key STRING, event_date DATE",
        pk=["session_ref", "client_code"],
        partition="event_date",
    ),
    Table(
        "ods_org_unit",
        "org_unit_id BIGINT, parent_unit_id BIGINT, unit_code STRING, unit_name STRING, "
        "unit_type STRING, site_code STRING, cost_center STRING, created_ts TIMESTAMP, "
        "snapshot_date DATE",
        pk=["org_unit_id"],
        partition="snapshot_date",
    ),
    Table(
        "ods_payroll_adjustment",
        "adjustment_id BIGINT, agent_id BIGINT, adj_type STRING, amount DECIMAL(12,2), "
        "last_change_ts TIMESTAMP, period_month DATE",
        pk=["adjustment_id"],
        partition="period_month",
    ),
    Table(
        "ods_program",
        "program_id BIGINT, client_id BIGINT, program_code STRING, program_name STRING, "
        "line_of_business STRING, channel_mix STRING, site_code STRING, status STRING, "
        "go_live_ts TIMESTAMP, updated_ts TIMESTAMP, snapshot_date DATE",
        pk=["program_id"],
        partition="snapshot_date",
    ),
    Table(
        "ods_qa_evaluation",
        "qa_form_id STRING, client_code STRING, interaction_ref STRING, evaluator_email STRING, "
        "evaluated_ts TIMESTAMP, form_version STRING, section_count BIGINT, "
        "scored_points BIGINT, max_points BIGINT, auto_fail BOOLEAN, overall_pct DECIMAL(5,2), "
        "event_date DATE",
        pk=["qa_form_id"],
        partition="event_date",
    ),
    Table(
        "ods_queue",
        "queue_id BIGINT, queue_code STRING, queue_name STRING, program_id BIGINT, "
        "media_type STRING, priority BIGINT, created_ts TIMESTAMP, snapshot_date DATE",
        pk=["queue_id"],
        partition="snapshot_date",
    ),
    Table(
        "ods_rate_card",
        "rate_card_id BIGINT, program_id BIGINT, service_code STRING, rate DECIMAL(12,4), "
        "currency STRING, effective_ts TIMESTAMP, expiry_ts TIMESTAMP, last_change_ts TIMESTAMP, "
        "snapshot_date DATE",
        pk=["rate_card_id"],
        partition="snapshot_date",
    ),
    Table(
        "ods_schedule",
        "schedule_id BIGINT, agent_id BIGINT, shift_id BIGINT, shift_code STRING, "
        "start_ts TIMESTAMP, end_ts TIMESTAMP, paid_minutes BIGINT, activity_code STRING, "
        "site_code STRING, sched_date DATE",
        pk=["schedule_id"],
        partition="sched_date",
    ),
    Table(
        "ods_shift_swap",
        "swap_id BIGINT, requesting_agent_id BIGINT, accepting_agent_id BIGINT, "
        "schedule_id BIGINT, swap_date STRING, status STRING, last_change_ts TIMESTAMP, "
        "swap_month DATE",
        pk=["swap_id"],
        partition="swap_month",
    ),
    Table(
        "ods_sla_credit",
        "sla_credit_id BIGINT, program_id BIGINT, sla_target_id BIGINT, "
        "credit_amount DECIMAL(12,2), reason STRING, last_change_ts TIMESTAMP, period_month DATE",
        pk=["sla_credit_id"],
        partition="period_month",
    ),
    Table(
        "ods_survey_response",
        "survey_id STRING, client_code STRING, interaction_ref STRING, survey_ts TIMESTAMP, "
        "csat_score BIGINT, nps_score BIGINT, fcr_claimed BOOLEAN, verbatim STRING, "
        "event_date DATE",
        pk=["survey_id"],
        partition="event_date",
    ),
    Table(
        "ods_ticket_acid",
        "ticket_id BIGINT, ticket_no STRING, program_id BIGINT, category_id BIGINT, "
        "assigned_agent_id BIGINT, priority STRING, status STRING, created_ts TIMESTAMP, "
        "updated_ts TIMESTAMP, resolved_ts TIMESTAMP",
        pk=["ticket_id"],
        cluster=["ticket_id"],
    ),
    Table(
        "ods_ticket_worklog",
        "worklog_id BIGINT, ticket_id BIGINT, agent_id BIGINT, minutes_logged BIGINT, "
        "log_ts TIMESTAMP, note STRING, last_change_ts TIMESTAMP, event_date DATE",
        pk=["worklog_id"],
        partition="event_date",
    ),
    Table(
        "ods_timesheet",
        "timesheet_id BIGINT, agent_id BIGINT, work_date STRING, program_id BIGINT, "
        "billable_minutes BIGINT, nonbillable_minutes BIGINT, approved_flag BOOLEAN, "
        "last_change_ts TIMESTAMP, work_month DATE",
        pk=["timesheet_id"],
        partition="work_month",
    ),
]
