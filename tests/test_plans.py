"""Physical plans: nothing runs in one task, in Python, or as a product of two tables."""

import datetime as dt
import re

import pytest
from conftest import FOLDER
from pyspark.sql import functions as F

import __spark_entry__
from switchboard.functions import time
from switchboard.operators import dedup
from switchboard.plans import cleanse, facts, views

QUERIES = __spark_entry__.queries()
DAY = dt.date(2024, 1, 15)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_products_no_python_no_global_windows(spark, name):
    plan = physical(QUERIES[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF", "MapInPandas"):
        assert bad not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if " Window [" in line or "Window [" in line.lstrip(" +-:"):
            assert "Exchange SinglePartition" not in "\n".join(lines[i : i + 4]), line


def test_dedup_limits_rows_before_the_shuffle(spark, wh):
    plan = physical(dedup.latest(wh.base["lineitem"], ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    assert plan.index("row_number(), 1, Final") < plan.index("hashpartitioning") < plan.index("row_number(), 1, Partial")


def test_chat_texts_are_not_read(spark, wh, tmp_path):
    path = str(tmp_path / "chat")
    wh.get("stg_file_chat_transcripts").write.parquet(path)
    plan = formatted(spark, cleanse.chat_session(spark.read.parquet(path), DAY))
    assert "messages:array<struct<sender:string,ts_ms:bigint>>" in plan and "text:string" not in plan


def test_calls_and_segments_share_one_partitioning(spark, wh, tmp_path):
    """Both sides of the call join are shuffled by call id once, for their own reduction."""
    wh.get("stg_tel_call").write.parquet(str(tmp_path / "c"))
    wh.get("stg_tel_call_segment").write.parquet(str(tmp_path / "s"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(cleanse.call(spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "s")), DAY))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning(call_id") == 2
    assert "load_date = 2024-01-15" in plan or "EqualTo(load_date,2024-01-15)" in plan


def test_day_filter_on_a_timestamp_is_pushed_down(spark, wh):
    rows = wh.get("ods_ticket_acid").where(time.on_day("created_ts", DAY))
    plan = formatted(spark, rows)
    assert "GreaterThanOrEqual(created_ts,2024-01-15" in plan and "LessThan(created_ts,2024-01-16" in plan


def test_views_read_only_the_columns_they_need(spark, wh):
    plan = physical(views.csat_rollup(wh.get("fact_csat_survey"), wh.get("dim_program")))
    assert "ReadSchema: struct<program_sk:bigint,csat_score:bigint,nps_score:bigint>" in plan


def test_states_are_reduced_before_the_lookups(wh):
    plan = optimized(
        facts.fact_agent_activity(wh.get("stg_tel_agent_state_event"), wh.get("ods_adherence_event"), wh.get("dim_agent"), DAY)
    )
    joins = [i for i, line in enumerate(plan.splitlines()) if "Join LeftOuter" in line]
    below = "\n".join(plan.splitlines()[joins[-1] :])
    assert "Aggregate [agent_id" in below


def test_first_contacts_need_no_pairs_and_no_task_per_customer(spark, wh):
    plan = physical(views.first_contact_resolution(wh.get("fact_interaction")))
    # Customers are only shuffled as partial sums.
    lines = plan.splitlines()
    shuffled = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(customer_ref" in line]
    assert shuffled and all("functions=[partial_" in lines[i + 1] for i in shuffled)
    # The only join adds one row per range; windows run within ranges.
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin [") == plan.count("BroadcastHashJoin [_range")
    assert "windowspecdefinition(customer_ref" not in plan and "windowspecdefinition(_range" in plan


def test_runtime_settings(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.range(1).select(F.current_timezone()).first()[0] == "UTC"


@pytest.mark.parametrize("table", ["fact_csat_survey", "fact_qa_evaluation"])
def test_days_keys_filter_whole_tables_at_the_scan(spark, wh, table):
    """Spark's own run-time filter: beyond broadcast size, the few keys of the day thin out the large side before its shuffle."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        plan = wh.build(table)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert re.search(rf"might_contain\(scalar-subquery#\d+ \[[^\]]*\], xxhash64\((coalesce\()?interaction_id#", plan)


def test_invoice_lines_are_not_shuffled_for_what_the_invoice_tells(spark, wh):
    """Programs and clients are looked up for invoices; their lines are shuffled for the invoice and for the rates alone."""
    names = ("stg_fin_invoice_line", "ods_invoice_acid", "dim_program", "ods_client_acid", "ods_rate_card")
    frames = [wh.get(n) for n in names]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = physical(facts.fact_billing_line(*frames, DAY)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    depth = [len(re.match(r"[ :+-]*", line)[0]) for line in lines]
    below = lambda i: next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
    shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(" in line]
    wide = [lines[i] for i in shuffles if any("invoice_line_id" in x for x in lines[i : below(i)])]
    assert len(shuffles) > len(wide) == 2 and not any("client_id" in x for x in wide)
