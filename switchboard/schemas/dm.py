"""Declared tables of the dm layer: column list, primary key, partition column, cluster keys."""

from switchboard.schemas.table import Table

TABLES = [
    Table(
        "agg_agent_daily",
        "agent_sk BIGINT, site_code STRING, interactions_handled BIGINT, "
        "avg_handle_seconds DECIMAL(8,2), talk_seconds BIGINT, acw_seconds BIGINT, "
        "aux_seconds BIGINT, adherence_pct DECIMAL(5,2), occupancy_pct DECIMAL(5,2), "
        "date_key BIGINT",
        pk=["agent_sk", "date_key"],
        partition="date_key",
    ),
    Table(
        "agg_agent_weekly",
        "agent_sk BIGINT, site_code STRING, days_worked BIGINT, interactions_handled BIGINT, "
        "avg_handle_seconds DECIMAL(8,2), adherence_pct DECIMAL(5,2), "
        "occupancy_pct DECIMAL(5,2), week_start_key BIGINT",
        pk=["agent_sk", "week_start_key"],
        partition="week_start_key",
    ),
    Table(
        "agg_billing_monthly",
        "client_sk BIGINT, program_sk BIGINT, billed_amount DECIMAL(14,2), "
        "sla_credit_amount DECIMAL(12,2), telco_cost_amount DECIMAL(12,2), "
        "net_revenue DECIMAL(14,2), period_month DATE",
        pk=["client_sk", "program_sk", "period_month"],
        partition="period_month",
        sums=["billed_amount", "sla_credit_amount", "telco_cost_amount", "net_revenue"],
    ),
    Table(
        "agg_csat_rollup_monthly",
        "client_sk BIGINT, program_sk BIGINT, site_code STRING, surveys BIGINT, "
        "avg_csat DECIMAL(5,2), pct_promoters DECIMAL(5,2), pct_detractors DECIMAL(5,2), "
        "grouping_id BIGINT, period_month DATE",
        pk=["client_sk", "program_sk", "site_code", "grouping_id", "period_month"],
        partition="period_month",
    ),
    Table(
        "agg_program_monthly",
        "client_sk BIGINT, program_sk BIGINT, line_of_business STRING, interactions BIGINT, "
        "avg_handle_seconds DECIMAL(8,2), avg_csat DECIMAL(5,2), billed_amount DECIMAL(14,2), "
        "grouping_level BIGINT, period_month DATE",
        pk=["client_sk", "program_sk", "line_of_business", "grouping_level", "period_month"],
        partition="period_month",
        sums=["billed_amount"],
    ),
    Table(
        "agg_queue_hourly",
        "queue_sk BIGINT, hour_of_day BIGINT, offered BIGINT, answered BIGINT, abandoned BIGINT, "
        "sl_pct DECIMAL(5,2), forecast_volume BIGINT, volume_variance_pct DECIMAL(7,2), "
        "date_key BIGINT",
        pk=["queue_sk", "date_key", "hour_of_day"],
        partition="date_key",
    ),
    Table(
        "agg_site_daily",
        "site_code STRING, agents_active BIGINT, interactions BIGINT, "
        "avg_handle_seconds DECIMAL(8,2), sl_pct DECIMAL(5,2), adherence_pct DECIMAL(5,2), "
        "date_key BIGINT",
        pk=["site_code", "date_key"],
        partition="date_key",
    ),
    Table(
        "dim_agent",
        "agent_sk BIGINT, agent_id BIGINT, employee_no STRING, full_name STRING, "
        "job_grade STRING, employment_type STRING, org_unit_id BIGINT, team_name STRING, "
        "site_code STRING, status STRING, hire_date_key BIGINT, is_current BOOLEAN",
        pk=["agent_sk"],
    ),
    Table(
        "dim_client",
        "client_sk BIGINT, client_id BIGINT, client_code STRING, client_name STRING, "
        "industry STRING, hq_country STRING, primary_contact_name STRING, "
        "primary_contact_email STRING, status STRING",
        pk=["client_sk"],
    ),
    Table(
        "dim_date",
        "date_key BIGINT, full_date STRING, day_of_week BIGINT, day_name STRING, "
        "week_of_year BIGINT, month_no BIGINT, month_name STRING, quarter_no BIGINT, "
        "year_no BIGINT, is_weekend BOOLEAN, is_holiday_us BOOLEAN, fiscal_period STRING",
        pk=["date_key"],
    ),
    Table(
        "dim_disposition",
        "disposition_sk BIGINT, disposition_code STRING, disposition_desc STRING, "
        "category STRING, billable_flag BOOLEAN",
        pk=["disposition_sk"],
    ),
    Table(
        "dim_org",
        "org_sk BIGINT, org_unit_id BIGINT, unit_code STRING, unit_name STRING, "
        "unit_type STRING, level1_name STRING, level2_name STRING, level3_name STRING, "
        "level4_name STRING, site_code STRING, cost_center STRING",
        pk=["org_sk"],
    ),
    Table(
        "dim_program",
        "program_sk BIGINT, program_id BIGINT, program_code STRING, program_name STRING, "
        "client_id BIGINT, line_of_business STRING, channel_mix STRING, site_code STRING, "
        "billing_model STRING, status STRING, go_live_date_key BIGINT",
        pk=["program_sk"],
    ),
    Table(
        "dim_queue",
        "queue_sk BIGINT, queue_id BIGINT, queue_code STRING, queue_name STRING, "
        "program_id BIGINT, media_type STRING, priority BIGINT",
        pk=["queue_sk"],
    ),
    Table(
        "dim_shift",
        "shift_sk BIGINT, shift_id BIGINT, shift_code STRING, shift_name STRING, "
        "start_hhmm STRING, end_hhmm STRING, overnight_flag BOOLEAN, site_code STRING",
        pk=["shift_sk"],
    ),
    Table(
        "dim_site",
        "site_sk BIGINT, site_code STRING, site_name STRING, region STRING, country STRING, "
        "timezone STRING",
        pk=["site_sk"],
    ),
    Table(
        "fact_adherence_daily",
        "agent_sk BIGINT, scheduled_minutes BIGINT, worked_minutes BIGINT, "
        "exception_minutes BIGINT, timeoff_minutes BIGINT, adherence_pct DECIMAL(5,2), "
        "occupancy_pct DECIMAL(5,2), date_key BIGINT",
        pk=["agent_sk", "date_key"],
        partition="date_key",
    ),
    Table(
        "fact_agent_activity",
        "agent_sk BIGINT, state_code STRING, state_seconds BIGINT, occurrence_count BIGINT, "
        "first_state_ts TIMESTAMP, last_state_ts TIMESTAMP, date_key BIGINT",
        pk=["agent_sk", "state_code", "date_key"],
        partition="date_key",
    ),
    Table(
        "fact_billing_line",
        "invoice_line_id BIGINT, invoice_id BIGINT, client_sk BIGINT, program_sk BIGINT, "
        "service_code STRING, qty DECIMAL(12,2), unit_rate DECIMAL(12,4), "
        "line_amount DECIMAL(14,2), adjustment_flag BOOLEAN, invoice_status STRING, "
        "period_month DATE",
        pk=["invoice_line_id"],
        partition="period_month",
    ),
    Table(
        "fact_csat_survey",
        "survey_id STRING, interaction_id STRING, client_sk BIGINT, program_sk BIGINT, "
        "agent_sk BIGINT, survey_ts TIMESTAMP, csat_score BIGINT, nps_score BIGINT, "
        "fcr_claimed BOOLEAN, date_key BIGINT",
        pk=["survey_id"],
        partition="date_key",
    ),
    Table(
        "fact_interaction",
        "interaction_id STRING, client_sk BIGINT, program_sk BIGINT, queue_sk BIGINT, "
        "agent_sk BIGINT, customer_ref STRING, start_ts TIMESTAMP, end_ts TIMESTAMP, "
        "handle_seconds BIGINT, resolved_flag BOOLEAN, source_system STRING, date_key BIGINT, "
        "channel STRING",
        pk=["interaction_id"],
        partition="date_key",
        cluster=["channel", "agent_sk", "client_sk"],
    ),
    Table(
        "fact_ivr_path",
        "session_ref STRING, client_code STRING, menu_path_full STRING, hops BIGINT, "
        "contained_flag BOOLEAN, exit_key STRING, duration_seconds BIGINT, date_key BIGINT",
        pk=["session_ref", "client_code"],
        partition="date_key",
    ),
    Table(
        "fact_qa_evaluation",
        "qa_form_id STRING, interaction_id STRING, agent_sk BIGINT, program_sk BIGINT, "
        "evaluated_ts TIMESTAMP, scored_points BIGINT, max_points BIGINT, "
        "overall_pct DECIMAL(5,2), auto_fail BOOLEAN, date_key BIGINT",
        pk=["qa_form_id"],
        partition="date_key",
    ),
    Table(
        "fact_queue_interval",
        "queue_sk BIGINT, interval_start_ts TIMESTAMP, offered BIGINT, answered BIGINT, "
        "abandoned BIGINT, answered_in_sl BIGINT, sl_threshold_sec BIGINT, "
        "avg_speed_answer_sec DECIMAL(8,2), avg_handle_sec DECIMAL(8,2), date_key BIGINT",
        pk=["queue_sk", "interval_start_ts", "date_key"],
        partition="date_key",
    ),
    Table(
        "fact_ticket",
        "ticket_id BIGINT, program_sk BIGINT, category_code STRING, assigned_agent_sk BIGINT, "
        "priority STRING, status STRING, created_ts TIMESTAMP, resolved_ts TIMESTAMP, "
        "resolution_minutes BIGINT, sla_breached_flag BOOLEAN, touch_count BIGINT, "
        "date_key BIGINT",
        pk=["ticket_id"],
        partition="date_key",
    ),
]
