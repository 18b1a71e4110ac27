"""Schemas, feeds and the calendar."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from switchboard.schemas import LAYERS, TABLES, conform
from switchboard.session import fresh_path, store, work_dir
from switchboard.sources import calendar, feeds


def test_declared_tables():
    assert {layer: len(t) for layer, t in LAYERS.items()} == {"staging": 45, "ods": 30, "dm": 25}
    assert sum(len(t.columns) for t in TABLES.values()) == 916
    kinds = [kind for t in TABLES.values() for _, kind in t.columns]
    assert kinds.count("BIGINT") == 362 and kinds.count("TIMESTAMP") == 65 and kinds.count("BOOLEAN") == 37
    for t in TABLES.values():
        assert len(set(t.names)) == len(t.names)
        assert set(t.pk) | set(t.cluster) | ({t.partition} if t.partition else set()) <= set(t.names)


def test_column_text_agrees_with_spark(spark):
    for t in TABLES.values():
        assert t.names == [f.name for f in t.schema.fields]
        assert all(f.nullable for f in t.schema.fields)
    decimals = {
        (f.dataType.precision, f.dataType.scale)
        for t in TABLES.values()
        for f in t.schema.fields
        if isinstance(f.dataType, T.DecimalType)
    }
    assert decimals == {(14, 2), (12, 4), (12, 2), (10, 4), (8, 2), (7, 2), (5, 2)}


def test_conform_orders_casts_and_drops(spark):
    df = spark.createDataFrame([("x", 1, 2, 3)], "queue_code string, queue_id int, extra int, priority int")
    df = df.withColumns({c: F.lit(None) for c in ("queue_sk", "queue_name", "program_id", "media_type")})
    out = conform(df, "dim_queue")
    assert out.schema.names == TABLES["dim_queue"].names
    assert out.schema["queue_id"].dataType == T.LongType()


def write_lines(spark, lines):
    path = fresh_path(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_csv_tells_null_from_empty_and_keeps_rejects(spark):
    lines = [
        "survey_id,interaction_ref,survey_ms,csat_score,nps_score,fcr_claimed,verbatim,client_code,feed_date",
        'S1,V1,1000,5,9,true,"said ""hi"", left",CL1,2024-01-15',
        'S2,V2,1000,5,,false,"",,2024-01-15',
        "S3,V3,late,5,1,false,x,CL1,2024-01-15",
        "S4,V4,1",
    ]
    rows, rejects = feeds.csv_feed(spark, write_lines(spark, lines), "stg_file_survey_csat")
    out = {r.survey_id: r for r in rows.collect()}
    assert set(out) == {"S1", "S2"}
    assert out["S1"].verbatim == 'said "hi", left' and out["S1"].fcr_claimed is True
    assert out["S2"].verbatim == "" and out["S2"].nps_score is None and out["S2"].client_code is None
    assert sorted(r.line for r in rejects.collect()) == lines[3:]
    assert rows.select("survey_id").count() == 2, "the split does not depend on the columns read"


def test_csv_with_line_breaks(spark):
    lines = [",".join(TABLES["stg_file_survey_csat"].names), 'S1,V1,1,1,1,true,"two', 'lines",C,2024-01-15']
    rows, rejects = feeds.csv_feed(spark, write_lines(spark, lines), "stg_file_survey_csat", multi_line=True)
    assert [r.verbatim for r in rows.collect()] == ["two\nlines"] and rejects.isEmpty()


def test_pipe_feed(spark):
    lines = ["1|2|2024-01-15|3|60|0|true|U|1705276800123|2024-01-15", "x|2|2024-01-15|3|60|0|true|U|1|2024-01-15"]
    rows, rejects = feeds.pipe_feed(spark, write_lines(spark, lines), "stg_fin_timesheet_delta")
    (row,) = rows.collect()
    assert (row.timesheet_id, row.billable_minutes, row.op, row.extract_date) == (1, 60, "U", dt.date(2024, 1, 15))
    assert [r.line for r in rejects.collect()] == lines[1:]


def test_json_feed_keeps_malformed_lines(spark):
    good = '{"recording_id":"R1","sentiment_score":0.5,"keywords":["a","b"],"feed_date":"2024-01-15"}'
    lines = [good, "{broken", '{"recording_id":"R2","analyzed_ms":"soon"}']
    rows, rejects = feeds.json_feed(spark, write_lines(spark, lines), "stg_file_speech_analytics")
    (row,) = rows.collect()
    assert row.keywords == ["a", "b"] and row.sentiment_score == 0.5 and row.call_ref is None
    assert sorted(r.line for r in rejects.collect()) == sorted(lines[1:])


def test_ivr_lines(spark):
    lines = [
        "1705276800123|IVR-42|MENU:main.agent;KEY:5|tail|more",
        "1705276800123|IVR-42|MENU:;KEY:#|",
        "1705276800123|ivr-42|MENU:main;KEY:5|lower case",
        "x|IVR-1|MENU:main;KEY:5|no number",
        "1|IVR-1|MENU:main;KEY:55|two keys",
        "",
    ]
    rows, rejects = feeds.ivr_feed(spark, write_lines(spark, lines), "CL1", dt.date(2024, 1, 15))
    got = sorted((r.event_ms, r.session_ref, r.menu_path, r.key_pressed, r.raw_tail) for r in rows.collect())
    assert got == [(1705276800123, "IVR-42", "", "#", ""), (1705276800123, "IVR-42", "main.agent", "5", "tail|more")]
    assert rejects.count() == 4
    assert rows.schema == TABLES["stg_file_ivr_logs"].schema or rows.schema.names == TABLES["stg_file_ivr_logs"].names


def test_calendar(spark):
    days = {r.full_date: r for r in calendar.calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31)).collect()}
    assert len(days) == 366
    assert days["2024-02-29"].date_key == 20240229 and days["2024-02-29"].day_name == "Thursday"
    holidays = [d for d, r in sorted(days.items()) if r.is_holiday_us]
    assert holidays == [
        "2024-01-01", "2024-01-15", "2024-02-19", "2024-05-27", "2024-06-19", "2024-07-04",
        "2024-09-02", "2024-10-14", "2024-11-11", "2024-11-28", "2024-12-25",
    ]
    sunday = days["2024-03-31"]
    assert (sunday.day_of_week, sunday.is_weekend, sunday.quarter_no, sunday.fiscal_period) == (7, True, 1, "FY2024-Q1")


def test_store_keeps_rows_and_uses_the_named_folder(spark, tmp_path, monkeypatch):
    df = store(spark.range(10), "numbers")
    assert df.count() == 10 and work_dir(spark) in df.inputFiles()[0]
    spark.conf.set("spark.sql.session.timeZone", "UTC")

    class Conf:
        def get(self, key, default=None):
            return str(tmp_path) if key == "spark.checkpoint.dir" else default

    class Session:
        sparkContext = spark.sparkContext
        conf = Conf()

    assert work_dir(Session()).startswith(str(tmp_path))


def test_cluster_without_a_shared_folder_is_refused(spark):
    class Context:
        applicationId, master = "app", "yarn"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError):
        work_dir(Session())
