"""Staging-shaped test inputs derived from the base tables, for Spark and for DuckDB.

One recipe per staging table, in SQL that both engines read after a few names are swapped.
The results are cast to the declared schema. ``DUPLICATES`` adds about 0.5 % repeated keys
whose copy is later and carries one changed value.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession

from switchboard.schemas import TABLES

RUN_DATE = dt.date(2024, 1, 15)
BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

RECIPES = {
    "stg_crm_client": """
        SELECT c_custkey AS client_id,
               'CL' || c_custkey AS client_code,
               c_name AS client_name,
               c_mktsegment AS industry,
               'N' || c_nationkey AS hq_country,
               CASE WHEN c_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
               1600000000 + c_custkey * 3600 AS created_ts,
               1700000000 + c_custkey * 60 AS updated_ts,
               DATE '2024-01-15' AS load_date
        FROM customer
    """,
    "stg_crm_client_contact": """
        SELECT o_orderkey AS contact_id,
               o_custkey AS client_id,
               'Contact ' || o_orderkey AS full_name,
               'c' || o_orderkey || '@x.test' AS email,
               '+1' || o_orderkey AS phone,
               o_orderpriority AS role,
               o_orderpriority = '1-URGENT' AS is_primary,
               ep(o_orderdate) + o_orderkey % 86400 AS created_ts,
               DATE '2024-01-15' AS load_date
        FROM orders
    """,
    "stg_crm_contract": """
        SELECT o_orderkey AS contract_id,
               o_custkey AS client_id,
               o_orderkey % 200 AS program_id,
               'K' || o_orderkey AS contract_no,
               fmt14(o_orderdate) AS start_dt,
               CASE WHEN o_orderstatus = 'O' THEN NULL ELSE fmt14(o_orderdate + INTERVAL '365' DAY) END AS end_dt,
               CASE WHEN o_orderkey % 2 = 0 THEN 'per_fte ' ELSE ' per_call' END AS billing_model,
               'usd' AS currency,
               fmt14(o_orderdate) AS signed_dt,
               CASE o_orderstatus WHEN 'F' THEN 'executed' WHEN 'O' THEN 'draft' ELSE 'pending' END AS status,
               DATE '2024-01-15' AS load_date
        FROM orders
    """,
    "stg_crm_contract_line": """
        SELECT l_orderkey * 10 + l_linenumber AS contract_line_id,
               l_orderkey AS contract_id,
               l_linenumber AS line_no,
               ' ' || lower(l_returnflag) AS service_code,
               'hr ' AS uom,
               CAST(l_extendedprice AS DECIMAL(12,4)) AS unit_rate,
               CAST(l_quantity AS DECIMAL(12,2)) AS min_commit,
               fmt14(l_shipdate) AS effective_dt,
               DATE '2024-01-15' AS load_date
        FROM lineitem
    """,
    "stg_crm_program": """
        SELECT p_partkey AS program_id,
               p_partkey % 150 AS client_id,
               'PR' || p_partkey AS program_code,
               p_name AS program_name,
               '  ' || lower(p_type) || ' ' AS line_of_business,
               lower(p_brand) AS channel_mix,
               lower(CASE p_partkey % 3 WHEN 0 THEN 'MNL1' WHEN 1 THEN 'BLR2' ELSE 'MTY3' END) AS site_code,
               CASE WHEN p_size > 25 THEN ' active' ELSE 'paused ' END AS status,
               1600000000 + p_partkey * 7200 AS go_live_ts,
               1700000000 + p_partkey * 60 AS updated_ts,
               DATE '2024-01-15' AS load_date
        FROM part
    """,
    "stg_crm_sla_credit_delta": """
        SELECT event_id % 400 AS sla_credit_id,
               user_id AS program_id,
               user_id % 25 AS sla_target_id,
               CASE WHEN event_id % 2 = 0 THEN '2024-01' ELSE '2023-12' END AS period_month,
               CAST(value AS DECIMAL(12,2)) AS credit_amount,
               event_type AS reason,
               CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op,
               ep(ts) * 1000 + event_id % 1000 AS change_ms,
               CAST(ts AS DATE) AS extract_date
        FROM events
    """,
    "stg_crm_sla_target": """
        SELECT n_nationkey AS sla_target_id,
               n_nationkey AS program_id,
               n_nationkey AS queue_id,
               CASE WHEN n_nationkey % 5 = 4 THEN 'AHT' ELSE 'SL_20_80' END AS metric_code,
               CAST(60 + n_nationkey AS DECIMAL(10,4)) AS target_value,
               CAST(2.5 AS DECIMAL(5,2)) AS penalty_pct,
               1600000000 AS effective_ts,
               DATE '2024-01-15' AS load_date
        FROM nation
    """,
    "stg_file_chat_transcripts": """
        SELECT 'CH' || conv_id AS chat_ref,
               'Q' || (conv_id % 25) AS queue_code,
               'a' || (conv_id % 100) || '@x.test' AS agent_email,
               1705276800000 + conv_id * 60000 AS started_ms,
               1705276800000 + conv_id * 60000 + mt * 15500 AS ended_ms,
               msgs AS messages,
               '{"lang":"' || (conv_id % 4) || '"}' AS metadata,
               'CL' || (conv_id % 150) AS client_code,
               DATE '2024-01-15' AS feed_date
        FROM (SELECT conv_id, array_agg(struct_pack(sender := CASE role WHEN 'user' THEN 'CUSTOMER' WHEN 'assistant' THEN 'AGENT' ELSE 'SYSTEM' END, ts_ms := 1705276800000 + conv_id * 60000 + turn * 15500, text := text)) AS msgs, max(turn) AS mt FROM conversations GROUP BY conv_id) t
    """,
    "stg_file_dialer_result": """
        SELECT 'D' || event_id AS attempt_id,
               'CMP' || (event_id % 7) AS campaign_code,
               md5(CAST(event_id AS VARCHAR)) AS phone_hash,
               user_id % 100 AS agent_id,
               (1705276800 + (event_id * 137) % 86400 - CASE WHEN event_id % 97 = 0 THEN 86400 ELSE 0 END) * 1000 AS attempt_ms,
               CASE WHEN event_type IN ('click', 'purchase') THEN 'CONNECT' ELSE 'NOANSWER' END AS result_code,
               CAST(floor(value) AS BIGINT) AS talk_seconds,
               'CL' || (event_id % 150) AS client_code,
               DATE '2024-01-15' AS feed_date
        FROM events
    """,
    "stg_file_email_interaction": """
        SELECT 'M' || event_id AS email_ref,
               'box' || (event_id % 30) AS mailbox,
               'a' || (user_id % 100) || '@x.test' AS agent_email,
               (1705276800 + (event_id * 137) % 86400 - CASE WHEN event_id % 97 = 0 THEN 86400 ELSE 0 END) * 1000 AS received_ms,
               (1705276800 + (event_id * 137) % 86400 - CASE WHEN event_id % 97 = 0 THEN 86400 ELSE 0 END) * 1000 + (event_id * 7919) % 7200000 AS first_reply_ms,
               CASE WHEN event_type = 'error' THEN NULL ELSE (1705276800 + (event_id * 137) % 86400 - CASE WHEN event_id % 97 = 0 THEN 86400 ELSE 0 END) * 1000 + 9000000 END AS resolved_ms,
               event_type AS subject_category,
               'CL' || (event_id % 150) AS client_code,
               DATE '2024-01-15' AS feed_date
        FROM events
    """,
    "stg_file_interaction_export": """
        SELECT 'V' || o_orderkey AS interaction_ref,
               'VOICE' AS channel,
               'X' || o_orderkey AS client_interaction_id,
               'a' || (o_orderkey % 100) || '@x.test' AS agent_email,
               (1705276800 + (o_orderkey * 137) % 86400 - CASE WHEN o_orderkey % 97 = 0 THEN 86400 ELSE 0 END) * 1000 AS start_ms,
               (1705276800 + (o_orderkey * 137) % 86400 - CASE WHEN o_orderkey % 97 = 0 THEN 86400 ELSE 0 END) * 1000 + 200000 AS end_ms,
               o_orderstatus AS outcome,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'CU' || (o_custkey % 400) END AS customer_ref,
               'CL' || (o_orderkey % 150) AS client_code,
               DATE '2024-01-15' AS feed_date
        FROM orders
    """,
    "stg_file_ivr_logs": """
        SELECT (1705276800 + (event_id * 137) % 86400 - CASE WHEN event_id % 97 = 0 THEN 86400 ELSE 0 END) * 1000 + event_id % 1000 AS event_ms,
               'IVR-' || (event_id % 1500) AS session_ref,
               CASE event_type WHEN 'error' THEN 'main.agent' ELSE 'main.' || event_type END AS menu_path,
               CAST(event_id % 10 AS VARCHAR) AS key_pressed,
               props AS raw_tail,
               'CL' || ((event_id % 1500) % 150) AS client_code,
               DATE '2024-01-15' AS feed_date
        FROM events
    """,
    "stg_file_qa_forms": """
        SELECT 'QF' || l_orderkey AS qa_form_id,
               'V' || l_orderkey AS interaction_ref,
               'qa@x.test' AS evaluator_email,
               (1705276800 + (l_orderkey * 137) % 86400 - CASE WHEN l_orderkey % 97 = 0 THEN 86400 ELSE 0 END) * 1000 AS evaluated_ms,
               'v' || (l_orderkey % 3) AS form_version,
               sec AS sections,
               l_orderkey % 20 = 0 AS auto_fail,
               CAST(0 AS DECIMAL(5,2)) AS overall_pct,
               'CL' || (l_orderkey % 150) AS client_code,
               DATE '2024-01-15' AS feed_date
        FROM (SELECT l_orderkey, array_agg(struct_pack(section_code := 'SEC' || l_linenumber, max_points := CAST(50 AS BIGINT), scored_points := CAST(l_quantity AS BIGINT))) AS sec FROM lineitem GROUP BY l_orderkey) t
    """,
    "stg_file_roster": """
        SELECT 'E' || s_suppkey AS employee_no,
               'a' || s_suppkey || '@x.test' AS agent_email,
               'u' || s_suppkey AS client_login,
               CASE WHEN s_suppkey % 9 = 0 THEN 'LEAD' ELSE 'AGENT' END AS role_on_program,
               s_acctbal >= 0 AS active_flag,
               1705276800000 AS as_of_ms,
               'CL' || (s_suppkey % 150) AS client_code,
               DATE '2024-01-15' AS feed_date
        FROM supplier
    """,
    "stg_file_speech_analytics": """
        SELECT 'R' || doc_id AS recording_id,
               'V' || doc_id AS call_ref,
               1705276800000 + doc_id * 1000 AS analyzed_ms,
               (doc_id % 200 - 100) / 100.0 AS sentiment_score,
               (n_chars % 100) / 1.0 AS silence_pct,
               tox AS talk_over_count,
               string_split(lang || ' ' || source, ' ') AS keywords,
               'CL' || (doc_id % 150) AS client_code,
               DATE '2024-01-15' AS feed_date
        FROM (SELECT d.*, coalesce(b.toxic, 0) AS tox FROM documents d LEFT JOIN labels b ON b.doc_id = d.doc_id) t
    """,
    "stg_file_survey_csat": """
        SELECT 'S' || event_id AS survey_id,
               'V' || event_id AS interaction_ref,
               (1705276800 + (event_id * 137) % 86400 - CASE WHEN event_id % 97 = 0 THEN 86400 ELSE 0 END) * 1000 + 500 AS survey_ms,
               event_id % 5 + 1 AS csat_score,
               event_id % 11 AS nps_score,
               event_id % 2 = 0 AS fcr_claimed,
               '  ' || event_type || ' ' AS verbatim,
               'CL' || (event_id % 150) AS client_code,
               DATE '2024-01-15' AS feed_date
        FROM events
    """,
    "stg_file_telco_invoice": """
        SELECT 'TI' || o_orderkey AS telco_invoice_id,
               'CARR' || (o_orderkey % 4) AS carrier,
               'CKT' || (o_orderkey % 50) AS circuit_id,
               o_orderkey % 5000 AS usage_minutes,
               CAST(o_totalprice AS DECIMAL(12,2)) AS charge_amount,
               CASE WHEN o_orderkey % 3 = 0 THEN '2023-12' ELSE '2024-01' END AS bill_period,
               (1705276800 + (o_orderkey * 137) % 86400 - CASE WHEN o_orderkey % 97 = 0 THEN 86400 ELSE 0 END) * 1000 AS billed_ms,
               'CL' || (o_orderkey % 150) AS client_code,
               DATE '2024-01-15' AS feed_date
        FROM orders
    """,
    "stg_fin_invoice": """
        SELECT o_orderkey AS invoice_id,
               'INV' || o_orderkey AS invoice_no,
               o_custkey AS client_id,
               o_orderkey % 200 AS program_id,
               CASE WHEN o_orderkey % 3 = 0 THEN '2023-12' ELSE '2024-01' END AS period_month,
               ep(o_orderdate) * 1000 + o_orderkey % 1000 AS issued_ts_sec,
               (ep(o_orderdate) + 2592000) * 1000 AS due_ts_sec,
               'USD' AS currency,
               CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount,
               o_orderstatus AS status,
               DATE '2024-01-15' AS load_date
        FROM orders
    """,
    "stg_fin_invoice_line": """
        SELECT l_orderkey * 10 + l_linenumber AS invoice_line_id,
               l_orderkey AS invoice_id,
               l_orderkey * 10 + l_linenumber AS contract_line_id,
               CAST(l_quantity AS DECIMAL(12,2)) AS qty,
               CAST(l_extendedprice AS DECIMAL(12,4)) AS unit_rate,
               CAST(l_extendedprice AS DECIMAL(14,2)) AS line_amount,
               l_returnflag = 'R' AS adjustment_flag,
               ep(l_shipdate) * 1000 AS created_ms,
               DATE '2024-01-15' AS load_date
        FROM lineitem
    """,
    "stg_fin_payroll_adj_delta": """
        SELECT event_id % 500 AS adjustment_id,
               user_id % 100 AS agent_id,
               '2024-01' AS period_month,
               event_type AS adj_type,
               CAST(value - 50 AS DECIMAL(12,2)) AS amount,
               CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op,
               ep(ts) * 1000 + event_id % 1000 AS change_ms,
               CAST(ts AS DATE) AS extract_date
        FROM events
    """,
    "stg_fin_rate_card": """
        SELECT p_partkey AS rate_card_id,
               CAST(floor(p_partkey / 3) AS BIGINT) AS program_id,
               p_brand AS service_code,
               CAST(p_retailprice / 100 AS DECIMAL(12,4)) AS rate,
               'USD' AS currency,
               1600000000 AS effective_ts,
               CAST(NULL AS BIGINT) AS expiry_ts,
               DATE '2024-01-15' AS load_date
        FROM part
    """,
    "stg_fin_rate_card_change_delta": """
        SELECT event_id AS rate_change_id,
               event_id % 200 AS rate_card_id,
               CAST(value AS DECIMAL(12,4)) AS old_rate,
               CAST(value * 1.1 AS DECIMAL(12,4)) AS new_rate,
               event_type AS change_reason,
               CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op,
               ep(ts) * 1000 + event_id % 1000 AS change_ms,
               CAST(ts AS DATE) AS extract_date
        FROM events
    """,
    "stg_fin_timesheet_delta": """
        SELECT event_id % 1000 AS timesheet_id,
               user_id % 100 AS agent_id,
               ymd(ts) AS work_date,
               user_id AS program_id,
               CAST(floor(value) AS BIGINT) AS billable_minutes,
               event_id % 60 AS nonbillable_minutes,
               event_id % 3 <> 0 AS approved_flag,
               CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op,
               ep(ts) * 1000 + event_id % 1000 AS change_ms,
               CAST(ts AS DATE) AS extract_date
        FROM events
    """,
    "stg_hr_agent": """
        SELECT s_suppkey AS agent_id,
               'E' || s_suppkey AS employee_no,
               'F' || s_suppkey AS first_name,
               'L' || s_nationkey AS last_name,
               'a' || s_suppkey || '@x.test' AS email,
               1000 + s_suppkey AS org_unit_id,
               'G' || (s_suppkey % 5) AS job_grade,
               CASE WHEN s_suppkey % 4 = 0 THEN 'PART' ELSE 'FULL' END AS employment_type,
               1500000000 + s_suppkey * 86400 AS hire_ts,
               CASE WHEN s_acctbal < 0 THEN 1700000000 ELSE NULL END AS term_ts,
               CASE WHEN s_acctbal < 0 THEN 'TERM' ELSE 'ACTIVE' END AS status,
               DATE '2024-01-15' AS load_date
        FROM supplier
    """,
    "stg_hr_agent_skill": """
        SELECT event_id AS agent_skill_id,
               user_id % 100 AS agent_id,
               event_id % 25 AS skill_id,
               event_id % 5 + 1 AS proficiency,
               event_id % 3 = 0 AS certified,
               ep(ts) AS effective_ts,
               ep(ts) + 31536000 AS expiry_ts,
               DATE '2024-01-15' - CAST(event_id % 3 AS INT) AS load_date
        FROM events
    """,
    "stg_hr_attrition_event_delta": """
        SELECT event_id % 60 AS attrition_event_id,
               user_id % 100 AS agent_id,
               ep(ts) AS notice_epoch,
               ymd(ts) AS last_day,
               CASE WHEN event_id % 2 = 0 THEN 'VOLUNTARY' ELSE 'INVOLUNTARY' END AS attrition_type,
               event_type AS reason_code,
               event_id % 4 = 0 AS regrettable_flag,
               CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op,
               ep(ts) * 1000 + event_id % 1000 AS change_ms,
               CAST(ts AS DATE) AS extract_date
        FROM events
    """,
    "stg_hr_employment_event": """
        SELECT event_id AS event_id,
               user_id % 100 AS agent_id,
               event_type AS event_type,
               ep(ts) AS event_ts,
               1000 + user_id % 10 AS from_org_unit_id,
               1000 + (user_id + 1) % 10 AS to_org_unit_id,
               event_type AS reason_code,
               DATE '2024-01-15' - CAST(event_id % 3 AS INT) AS load_date
        FROM events
    """,
    "stg_hr_org_unit": """
        SELECT id AS org_unit_id,
               pid AS parent_unit_id,
               'U' || id AS unit_code,
               nm AS unit_name,
               ty AS unit_type,
               sc AS site_code,
               'CC' || (id % 10) AS cost_center,
               1500000000 + id AS created_ts,
               DATE '2024-01-15' AS load_date
        FROM (SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, CAST(NULL AS BIGINT) AS pid, r_name AS nm, 'REGION' AS ty, CAST(NULL AS VARCHAR) AS sc FROM region UNION ALL SELECT 100 + n_nationkey, n_regionkey + 1, n_name, 'SITE', CASE n_nationkey % 3 WHEN 0 THEN 'MNL1' WHEN 1 THEN 'BLR2' ELSE 'MTY3' END FROM nation UNION ALL SELECT 1000 + s_suppkey, 100 + s_nationkey, s_name, 'TEAM', NULL FROM supplier) t
    """,
    "stg_hr_skill": """
        SELECT n_nationkey AS skill_id,
               'SK' || n_nationkey AS skill_code,
               n_name AS skill_name,
               'FAM' || n_regionkey AS skill_family,
               1500000000 AS created_ts,
               DATE '2024-01-15' AS load_date
        FROM nation
    """,
    "stg_tel_agent_state_event": """
        SELECT event_id AS state_event_id,
               user_id % 110 AS agent_id,
               CASE event_type WHEN 'click' THEN 'TALK' WHEN 'view' THEN 'READY' WHEN 'error' THEN 'AUX_BREAK' WHEN 'signup' THEN 'ACW' ELSE 'HOLD' END AS state_code,
               1705276800 + (event_id * 137) % 86400 - CASE WHEN event_id % 97 = 0 THEN 86400 ELSE 0 END AS start_epoch,
               1705276800 + (event_id * 137) % 86400 - CASE WHEN event_id % 97 = 0 THEN 86400 ELSE 0 END + CAST(floor(value * 10) AS BIGINT) AS end_epoch,
               event_type AS reason_code,
               DATE '2024-01-15' AS load_date
        FROM events
    """,
    "stg_tel_call": """
        SELECT o_orderkey AS call_id,
               '+1' || o_custkey AS ani,
               '800' AS dnis,
               o_orderkey % 27 AS queue_id,
               o_orderkey % 110 AS agent_id,
               o_orderkey % 200 AS program_id,
               1705276800 + (o_orderkey * 137) % 86400 - CASE WHEN o_orderkey % 97 = 0 THEN 86400 ELSE 0 END AS start_epoch,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 1705276800 + (o_orderkey * 137) % 86400 - CASE WHEN o_orderkey % 97 = 0 THEN 86400 ELSE 0 END + o_orderkey % 45 END AS answer_epoch,
               1705276800 + (o_orderkey * 137) % 86400 - CASE WHEN o_orderkey % 97 = 0 THEN 86400 ELSE 0 END + o_orderkey % 45 + 200 AS end_epoch,
               o_orderpriority AS disposition_code,
               'IN' AS direction,
               'R' || o_orderkey AS recording_id,
               DATE '2024-01-15' AS load_date
        FROM orders
    """,
    "stg_tel_call_segment": """
        SELECT l_orderkey * 10 + l_linenumber AS segment_id,
               l_orderkey AS call_id,
               l_linenumber AS segment_no,
               CASE l_returnflag WHEN 'A' THEN 'TALK' WHEN 'N' THEN 'HOLD' ELSE 'ACW' END AS segment_type,
               ep(l_shipdate) AS start_epoch,
               ep(l_shipdate) + CAST(l_quantity AS BIGINT) * 7 AS end_epoch,
               l_suppkey AS agent_id,
               DATE '2024-01-15' AS load_date
        FROM lineitem
    """,
    "stg_tel_callback_request_delta": """
        SELECT event_id % 700 AS callback_id,
               event_id AS call_id,
               user_id % 25 AS queue_id,
               ep(ts) AS requested_epoch,
               ep(ts) + 3600 AS scheduled_epoch,
               event_id % 2 = 0 AS completed_flag,
               CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op,
               ep(ts) * 1000 + event_id % 1000 AS change_ms,
               CAST(ts AS DATE) AS extract_date
        FROM events
    """,
    "stg_tel_disposition_code": """
        SELECT c AS disposition_code,
               CASE c WHEN '1-URGENT' THEN 'Invoice dispute ref#4411' WHEN '2-HIGH' THEN 'password LOCKED' WHEN '3-MEDIUM' THEN 'Churn save' WHEN '5-LOW' THEN '[TECH] router ref#7' ELSE 'general' END AS disposition_desc,
               'CAT' AS category,
               c <> '5-LOW' AS billable_flag,
               CAST(1500000000 AS BIGINT) AS created_epoch,
               DATE '2024-01-15' AS load_date
        FROM (SELECT DISTINCT o_orderpriority AS c FROM orders) t
    """,
    "stg_tel_queue": """
        SELECT n_nationkey AS queue_id,
               'Q' || n_nationkey AS queue_code,
               n_name AS queue_name,
               n_nationkey AS program_id,
               CASE WHEN n_nationkey % 2 = 0 THEN 'VOICE' ELSE 'CHAT' END AS media_type,
               n_nationkey % 3 AS priority,
               1500000000 + n_nationkey AS created_epoch,
               DATE '2024-01-15' AS load_date
        FROM nation
    """,
    "stg_tkt_category": """
        SELECT CAST(substr(c, 1, 1) AS BIGINT) AS category_id,
               c AS category_code,
               c AS category_name,
               CASE WHEN c = '5-LOW' THEN NULL ELSE CAST(substr(c, 1, 1) AS BIGINT) * 4 END AS sla_hours,
               CAST(1500000000000 AS BIGINT) AS created_ms,
               DATE '2024-01-15' AS load_date
        FROM (SELECT DISTINCT o_orderpriority AS c FROM orders) t
    """,
    "stg_tkt_ticket": """
        SELECT o_orderkey AS ticket_id,
               'T' || o_orderkey AS ticket_no,
               CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderkey % 200 END AS program_id,
               CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS category_id,
               o_orderkey % 100 AS opened_by_agent_id,
               o_orderkey % 110 AS assigned_agent_id,
               'V' || o_orderkey AS interaction_ref,
               o_orderpriority AS priority,
               CASE o_orderstatus WHEN 'F' THEN 'RESOLVED' WHEN 'O' THEN 'OPEN' ELSE 'PENDING' END AS status,
               (1705276800 + (o_orderkey * 137) % 86400 - CASE WHEN o_orderkey % 97 = 0 THEN 86400 ELSE 0 END) * 1000 AS created_ms,
               (1705276800 + (o_orderkey * 137) % 86400 - CASE WHEN o_orderkey % 97 = 0 THEN 86400 ELSE 0 END) * 1000 + 60000 AS updated_ms,
               DATE '2024-01-15' AS load_date
        FROM orders
    """,
    "stg_tkt_ticket_event": """
        SELECT l_orderkey * 10 + l_linenumber AS ticket_event_id,
               l_orderkey AS ticket_id,
               CASE WHEN l_linestatus = 'F' THEN 'STATUS' ELSE 'NOTE' END AS event_type,
               (1705276800 + (l_orderkey * 137) % 86400 - CASE WHEN l_orderkey % 97 = 0 THEN 86400 ELSE 0 END) * 1000 + CAST(l_quantity AS BIGINT) * 1800000 AS event_ms,
               l_suppkey AS actor_agent_id,
               'OPEN' AS old_value,
               CASE WHEN l_linestatus = 'F' THEN 'RESOLVED' ELSE 'OPEN' END AS new_value,
               DATE '2024-01-15' - CAST(l_linenumber % 3 AS INT) AS load_date
        FROM lineitem
    """,
    "stg_tkt_worklog_delta": """
        SELECT event_id % 900 AS worklog_id,
               event_id % 500 AS ticket_id,
               user_id % 100 AS agent_id,
               event_id % 45 AS minutes_logged,
               ep(ts) * 1000 AS log_ms,
               props AS note,
               CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op,
               ep(ts) * 1000 + event_id % 1000 AS change_ms,
               CAST(ts AS DATE) AS extract_date
        FROM events
    """,
    "stg_wfm_adherence_event": """
        SELECT event_id AS adherence_event_id,
               user_id % 100 AS agent_id,
               event_id AS schedule_id,
               event_type AS exception_type,
               1705276800 + (event_id * 137) % 86400 - CASE WHEN event_id % 97 = 0 THEN 86400 ELSE 0 END AS start_epoch,
               1705276800 + (event_id * 137) % 86400 - CASE WHEN event_id % 97 = 0 THEN 86400 ELSE 0 END + (event_id * 31) % 1800 AS end_epoch,
               event_id % 3 <> 0 AS approved_flag,
               DATE '2024-01-15' AS load_date
        FROM events
    """,
    "stg_wfm_forecast": """
        SELECT q * 48 + h AS forecast_id,
               q AS queue_id,
               1705276800 + h * 1800 AS interval_start_epoch,
               (q + h) % 20 AS forecast_volume,
               300 + q AS forecast_aht_sec,
               CAST((q + h) / 3.0 AS DECIMAL(8,2)) AS required_fte,
               DATE '2024-01-15' AS load_date
        FROM (SELECT DISTINCT event_id % 25 AS q, CAST(floor(event_id / 25) AS BIGINT) % 48 AS h FROM events) t
    """,
    "stg_wfm_schedule": """
        SELECT o_orderkey AS schedule_id,
               o_orderkey % 100 AS agent_id,
               o_orderkey % 4 AS shift_id,
               '2024-01-15' AS sched_date,
               1705276800 + (o_orderkey % 24) * 3600 AS start_epoch,
               1705276800 + (o_orderkey % 24) * 3600 + 28800 AS end_epoch,
               450 + o_orderkey % 31 AS paid_minutes,
               'WORK' AS activity_code,
               DATE '2024-01-15' AS load_date,
               CASE o_orderkey % 3 WHEN 0 THEN 'MNL1' WHEN 1 THEN 'BLR2' ELSE 'MTY3' END AS site_code
        FROM orders
    """,
    "stg_wfm_shift": """
        SELECT CAST(i AS BIGINT) AS shift_id,
               c AS shift_code,
               n AS shift_name,
               s AS start_hhmm,
               e AS end_hhmm,
               o AS overnight_flag,
               'MNL1' AS site_code,
               CAST(1500000000 + i AS BIGINT) AS created_epoch,
               DATE '2024-01-15' AS load_date
        FROM (SELECT * FROM (VALUES (0,'D','Day','0800','1600',FALSE),(1,'E','Evening','1600','0000',FALSE),(2,'N','Night','2200','0600',TRUE)) v(i,c,n,s,e,o)) t
    """,
    "stg_wfm_shift_swap_delta": """
        SELECT event_id % 300 AS swap_id,
               user_id % 100 AS requesting_agent_id,
               (user_id + 7) % 100 AS accepting_agent_id,
               event_id AS schedule_id,
               ymd(ts) AS swap_date,
               CASE WHEN event_id % 2 = 0 THEN 'APPROVED' ELSE 'OPEN' END AS status,
               CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op,
               ep(ts) * 1000 + event_id % 1000 AS change_ms,
               CAST(ts AS DATE) AS extract_date
        FROM events
    """,
    "stg_wfm_timeoff_request": """
        SELECT c_custkey AS timeoff_id,
               c_custkey % 100 AS agent_id,
               1700000000 + c_custkey AS request_epoch,
               CASE WHEN c_custkey % 2 = 0 THEN '2024-01-14' ELSE '2024-01-16' END AS start_date,
               CASE WHEN c_custkey % 3 = 0 THEN '2024-01-15' ELSE '2024-01-17' END AS end_date,
               c_mktsegment AS timeoff_type,
               CASE WHEN c_custkey % 5 = 0 THEN 'APPROVED' ELSE 'PENDING' END AS status,
               DATE '2024-01-15' AS load_date
        FROM customer
    """,
    # Not a declared table: observations for the assignment history, which no feed defines.
    "obs_assignment": """
        SELECT user_id % 100 AS agent_id,
               event_id % 40 AS program_id,
               event_id % 27 AS queue_id,
               event_type AS role_on_program,
               ts AS seen_ts
        FROM events
    """,
    "obs_calendar": """
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
        UNION
        SELECT DISTINCT CAST(ts AS DATE) AS d FROM events
    """,
}

# table: (rows that are repeated, {column: its value in the later copy})
DUPLICATES = {
    "stg_crm_client": (
        "client_id % 200 = 0",
        {"updated_ts": "updated_ts + 60", "client_name": "client_name || ' v2'"},
    ),
    "stg_crm_contract": (
        "contract_id % 200 = 0",
        {"start_dt": "CAST(CAST(start_dt AS BIGINT) + 1 AS VARCHAR)", "contract_no": "contract_no || 'b'"},
    ),
    "stg_crm_program": (
        "program_id % 200 = 0",
        {"go_live_ts": "go_live_ts + 60", "program_name": "program_name || ' v2'"},
    ),
    "stg_file_dialer_result": (
        "CAST(substr(attempt_id, 2) AS BIGINT) % 200 = 0",
        {"attempt_ms": "attempt_ms + 60000", "result_code": "'CONNECT'"},
    ),
    "stg_file_email_interaction": (
        "CAST(substr(email_ref, 2) AS BIGINT) % 200 = 0",
        {"received_ms": "received_ms + 60000", "subject_category": "subject_category || '2'"},
    ),
    "stg_file_survey_csat": (
        "CAST(substr(survey_id, 2) AS BIGINT) % 200 = 0",
        {"survey_ms": "survey_ms + 60000", "verbatim": "verbatim || 'again '"},
    ),
    "stg_hr_org_unit": (
        "org_unit_id % 200 = 0",
        {"created_ts": "created_ts + 60", "cost_center": "cost_center || 'x'"},
    ),
    "stg_tel_call": (
        "call_id % 200 = 0",
        {"end_epoch": "end_epoch + 60", "recording_id": "recording_id || 'b'"},
    ),
    "stg_tel_disposition_code": (
        "disposition_code = '1-URGENT'",
        {"created_epoch": "created_epoch + 60", "category": "'CAT2'"},
    ),
    "stg_tel_queue": (
        "queue_id % 200 = 0",
        {"created_epoch": "created_epoch + 60", "priority": "priority + 1"},
    ),
    "stg_wfm_adherence_event": (
        "adherence_event_id % 200 = 0",
        {"start_epoch": "start_epoch + 60", "exception_type": "exception_type || '2'"},
    ),
    "stg_wfm_schedule": (
        "schedule_id % 200 = 0",
        {"start_epoch": "start_epoch + 60", "paid_minutes": "paid_minutes + 5"},
    ),
}

# Deliveries of other days: table: [(day, rows that came on it, {column: its value then})]. The masters' values of some
# keys are newer in an earlier delivery. The other tables are read by the run date alone.
_OTHERS = ("2024-01-14", "2024-01-16")
OTHER_DAYS = {
    "stg_crm_client": [
        ("2024-01-13", "client_id % 3 <> 0", {"updated_ts": "updated_ts - 7200", "status": "'NEW'"}),
        ("2024-01-14", "client_id % 2 = 0", {"updated_ts": "updated_ts + 3600 * (client_id % 4 - 1)", "industry": "'OTHER'"}),
    ],
    "stg_hr_agent": [
        ("2024-01-13", "agent_id % 5 <> 1", {"job_grade": "'G' || ((agent_id + 1) % 5)", "status": "'ACTIVE'"}),
        ("2024-01-14", "agent_id % 7 <> 2", {"job_grade": "'G' || ((agent_id + agent_id % 2) % 5)"}),
    ],
    "stg_tkt_ticket": [
        ("2024-01-13", "ticket_id % 8 = 0", {"updated_ms": "updated_ms + 50000", "status": "'PENDING'"}),
        ("2024-01-14", "ticket_id % 3 = 0", {"updated_ms": "updated_ms - 50000", "status": "'NEW'"}),
    ],
    "stg_fin_invoice": [
        ("2024-01-13", "invoice_id % 9 = 0", {"issued_ts_sec": "issued_ts_sec + 86400000", "status": "'X'"}),
        ("2024-01-14", "invoice_id % 6 = 0", {"issued_ts_sec": "issued_ts_sec - 86400000", "total_amount": "total_amount - 1"}),
    ],
    **{
        table: [(day, where, changed) for day in _OTHERS]
        for table, where, changed in [
            ("stg_crm_client_contact", "contact_id % 40 = 3", {"created_ts": "created_ts + 999", "full_name": "'other'"}),
            ("stg_crm_contract", "contract_id % 40 = 3", {"status": "'executed'", "billing_model": "'other'"}),
            ("stg_crm_contract_line", "contract_line_id % 40 = 3", {"min_commit": "min_commit + 1", "uom": "'other'"}),
            ("stg_crm_program", "program_id % 40 = 3", {"go_live_ts": "go_live_ts + 999", "status": "'other'"}),
            ("stg_file_chat_transcripts", "started_ms % 40 = 0", {"client_code": "'CL1'"}),
            ("stg_file_dialer_result", "CAST(substr(attempt_id, 2) AS BIGINT) % 9 = 3", {"result_code": "'BUSY'", "attempt_ms": "attempt_ms + 120000"}),
            ("stg_file_email_interaction", "received_ms % 40 = 0", {"received_ms": "received_ms + 999", "mailbox": "'other'"}),
            ("stg_file_interaction_export", "length(interaction_ref) % 2 = 0", {"customer_ref": "'other'"}),
            ("stg_file_ivr_logs", "event_ms % 40 = 0", {"event_ms": "event_ms + 999", "menu_path": "'other'"}),
            ("stg_file_qa_forms", "length(qa_form_id) % 2 = 0", {"interaction_ref": "'other'"}),
            ("stg_file_survey_csat", "CAST(substr(survey_id, 2) AS BIGINT) % 40 = 3", {"survey_ms": "survey_ms + 999", "csat_score": "1"}),
            ("stg_fin_rate_card", "rate_card_id % 4 = 3", {"rate": "rate + 1"}),
            ("stg_hr_org_unit", "org_unit_id % 7 = 3", {"created_ts": "created_ts + 999", "unit_name": "'other'"}),
            ("stg_tel_agent_state_event", "state_event_id % 40 = 3", {"end_epoch": "end_epoch + 999"}),
            ("stg_tel_call", "call_id % 40 = 3", {"end_epoch": "end_epoch + 999", "recording_id": "'other'"}),
            ("stg_tel_call_segment", "call_id % 40 = 3", {}),
            ("stg_tel_disposition_code", "TRUE", {"created_epoch": "created_epoch + 999", "category": "'other'"}),
            ("stg_tel_queue", "queue_id % 7 = 3", {"created_epoch": "created_epoch + 999", "queue_name": "'other'"}),
            ("stg_wfm_adherence_event", "adherence_event_id % 40 = 3", {"start_epoch": "start_epoch + 999"}),
            ("stg_wfm_schedule", "schedule_id % 40 = 3", {"start_epoch": "start_epoch + 999", "paid_minutes": "paid_minutes + 1"}),
        ]
    },
}
# Deliveries in the order in which the stored forms of masters, histories and merges take them: one comes late.
DELIVERY_DAYS = [dt.date(2024, 1, 13), RUN_DATE, dt.date(2024, 1, 14)]


def duck_sql(name: str) -> str:
    """Recipe as DuckDB SQL over the base tables."""
    return _all_rows(name, duck=True)


def staging(spark: SparkSession, base: dict[str, DataFrame], name: str) -> DataFrame:
    """Recipe as a Spark DataFrame over the base tables."""
    used = {t: df for t, df in base.items() if re.search(rf"\b{t}\b", RECIPES[name])}
    sql = _all_rows(name, duck=False).replace("VARCHAR", "STRING")
    sql = sql.replace("{", "{{").replace("}", "}}")
    for table in used:
        sql = re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", sql)
    return spark.sql(sql, **used)


def _recipe(name: str, duck: bool) -> str:
    sql = RECIPES[name]
    if duck:
        sql = _call(sql, "ep", "CAST(floor(epoch({0})) AS BIGINT)")
        sql = _call(sql, "fmt14", "strftime({0}, '%Y%m%d%H%M%S')")
        sql = _call(sql, "ymd", "strftime({0}, '%Y-%m-%d')")
    else:
        sql = _call(sql, "ep", "unix_seconds(CAST({0} AS TIMESTAMP))")
        sql = _call(sql, "fmt14", "date_format({0}, 'yyyyMMddHHmmss')")
        sql = _call(sql, "ymd", "date_format({0}, 'yyyy-MM-dd')")
        sql = sql.replace("string_split(", "split(").replace("VARCHAR", "STRING")
        sql = re.sub(r"array_agg\(struct_pack\(", "collect_list(named_struct(", sql)
        sql = re.sub(r"(\w+) := ", r"'\1', ", sql)
    if name not in TABLES:
        return sql
    casts = [c if t.startswith("ARRAY") else f"CAST({c} AS {t}) AS {c}" for c, t in TABLES[name].columns]
    if duck:
        casts = [c.replace("AS STRING)", "AS VARCHAR)") for c in casts]
    return f"SELECT {', '.join(casts)} FROM ({sql}) r"


def _all_rows(name: str, duck: bool) -> str:
    """The recipe, the changed copies of its day, and the rows of other days."""
    sql = first = _recipe(name, duck)
    if name in DUPLICATES:
        where, changed = DUPLICATES[name]
        sql = f"SELECT * FROM ({first}) a UNION ALL {_copies(name, first, where, changed)}"
    for day, where, changed in OTHER_DAYS.get(name, []):
        sql += f" UNION ALL {_copies(name, first, where, changed | {TABLES[name].partition: f'DATE {chr(39)}{day}{chr(39)}'})}"
    return sql


def _copies(name: str, sql: str, where: str, changed: dict[str, str]) -> str:
    types = dict(TABLES[name].columns)
    copy = [f"CAST({changed[c]} AS {types[c]}) AS {c}" if c in changed else c for c in types]
    copy = [c.replace("AS STRING)", "AS VARCHAR)") for c in copy]
    return f"SELECT {', '.join(copy)} FROM ({sql}) b WHERE {where}"


def _call(sql: str, name: str, template: str) -> str:
    """Replace ``name(argument)``, where the argument holds no nested call of ``name``."""
    out, pos = "", 0
    for m in re.finditer(rf"\b{name}\(", sql):
        depth, end = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        out += sql[pos : m.start()] + template.format(sql[m.end() : end - 1])
        pos = end
    return out + sql[pos:]
