"""Quality jobs find what is wrong and pass what is right."""

import datetime as dt
import re
import threading
import time
from decimal import Decimal

import pytest
from conftest import FOLDER
from pyspark.sql import functions as F

from checks import registry
from checks.warehouse import Warehouse
from switchboard.operators.tree import root_paths
from switchboard.plans import quality, views
from switchboard.schemas import TABLES
from switchboard.session import fresh_path


def one(df):
    (row,) = df.collect()
    return row


def test_pk_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c")], "k long, v string")
    assert one(quality.pk_unique(df, "t", ["k", "v"])) == ("t", 4, 3, 1, "FAIL")
    assert one(quality.pk_unique(df.distinct(), "t", ["k", "v"])) == ("t", 3, 3, 0, "PASS")
    assert one(quality.pk_unique(df.where("false"), "t", ["k"])) == ("t", 0, 0, 0, "PASS")


def test_table_populated(spark):
    out = quality.table_populated({"a": spark.range(3), "b": spark.range(0)})
    assert sorted(tuple(r) for r in out.collect()) == [("a", 3, "PASS"), ("b", 0, "FAIL")]


def test_epoch_units(spark):
    df = spark.createDataFrame([(0, 0, None), (946684800, 946684800000, None), (4102444799, 4102444799000, None)], "s long, lie_sec long, empty long")
    out = {r.column_name: r for r in quality.epoch_range(df, "t", {"s": "s", "lie_sec": "s", "empty": "ms"}).collect()}
    assert (out["s"].detected_unit, out["s"].status) == ("s", "PASS")
    assert (out["lie_sec"].detected_unit, out["lie_sec"].status) == ("ms", "FAIL")
    assert out["empty"].status == "PASS" and out["s"].max_value == 4102444799


def test_string_dates_and_rejects(spark):
    df = spark.createDataFrame([("20240315120000",), ("20241301000000",), (None,), ("2024",)], "d string")
    out = one(quality.string_dates(df, "t", ["d"]))
    assert (out.null_count, out.parsed_count, out.rejected_count, out.status) == (1, 1, 2, "FAIL")
    assert quality.string_date_rejects(df, ["d"]).count() == 2


def test_fk_default(spark):
    fact = spark.createDataFrame([(1,), (1,), (-1,), (9,), (None,)], "k long")
    dim = spark.createDataFrame([(1,), (1,)], "sk long")
    out = one(quality.fk_default(fact, "f", {"k": (dim, "sk")}))
    assert (out.row_count, out.unknown_count, out.null_count, out.orphan_count, out.status) == (5, 1, 1, 1, "FAIL")


def test_negative_values(spark):
    df = spark.createDataFrame([(1, -1), (0, -5), (None, 3)], "a long, b long")
    out = [tuple(r) for r in quality.negative_values(df, "t", ["a", "b"]).collect()]
    assert out == [("t", "a", 2, 0, 0, "PASS"), ("t", "b", 3, 2, -5, "FAIL")]


def test_schema_contract(spark):
    spec = TABLES["ods_qa_evaluation"]
    good = spark.createDataFrame([tuple("k" if c == "qa_form_id" else None for c in spec.names)], spec.schema)
    assert one(quality.schema_contract(good, spec.name)).status == "PASS"
    assert one(quality.schema_contract(good.withColumn("qa_form_id", F.lit(None).cast("string")), spec.name)).null_key_rows == 1
    assert one(quality.schema_contract(good.drop("event_date"), spec.name)).schema_differences == 1
    wide = good.withColumn("overall_pct", F.lit(Decimal("12345.67")).cast("decimal(10,2)"))
    out = one(quality.schema_contract(wide, spec.name))
    assert (out.schema_differences, out.overflow_values, out.status) == (1, 1, "FAIL")


def test_history_integrity(spark, wh):
    good = wh.get("ods_agent_skill_scd2")
    args = ("h", ["agent_id", "skill_id"], "agent_skill_history_id")
    assert one(quality.scd2_integrity(good, *args)).status == "PASS"
    bad_id = one(quality.scd2_integrity(good.withColumn("agent_skill_history_id", F.lit("x")), *args))
    assert bad_id.bad_surrogates == bad_id.version_count
    no_current = one(quality.scd2_integrity(good.where("not is_current"), *args))
    assert no_current.keys_without_one_current > 0 and no_current.broken_ranges > 0
    gap = good.withColumn("eff_to_ts", F.col("eff_to_ts") - F.expr("INTERVAL 1 SECOND"))
    assert one(quality.scd2_integrity(gap, *args)).broken_ranges > 0


def test_edge_values_survive(spark):
    edge = [
        (1, 9223372036854775807, "café — 日本語 — 🎉\tTAB\nnewline", None),
        (2, -9223372036854775808, "", dt.date(2024, 1, 1)),
        (3, None, None, None),
        (4, 0, 'quote " comma , backslash \\ pipe |', dt.date(1970, 1, 1)),
        (5, 0, " spaces ", None),
    ]
    df = spark.createDataFrame(edge, "id long, n long, t string, d date")
    out = {r.comparison: r for r in quality.edge_values(df, fresh_path(spark, "edge")).collect()}
    assert {k: (r.row_count, r.missing_rows, r.extra_rows) for k, r in out.items()} == {
        "parquet": (5, 0, 0),
        "csv": (5, 0, 0),
        "json": (5, 0, 0),
    }


def test_difference_counts_bags(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "a long")
    right = spark.createDataFrame([(1,), (3,), (None,), (None,)], "a long")
    assert one(quality.difference(left, right, "x")) == ("x", 4, 2, 2, "FAIL")
    assert one(quality.difference(left, left, "x")).status == "PASS"


def test_table_diff(spark):
    left = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "k long, v string, n long")
    right = spark.createDataFrame([(1, "a", None), (2, "x", None), (4, "d", 1)], "k long, v string, n long")
    out = {r.column_name: (r.compared, r.differing, r.status) for r in quality.table_diff(left, right, ["k"]).collect()}
    assert out == {"v": (2, 1, "FAIL"), "n": (2, 1, "FAIL"), "(coverage)": (4, 2, "FAIL"), "(repeated keys)": (4, 0, "PASS")}


def test_table_diff_with_repeated_and_missing_keys(spark):
    left = spark.createDataFrame([(1, "a")] * 50 + [(None, "n")], "k long, v string")
    right = spark.createDataFrame([(1, "a")] * 40 + [(None, "n")], "k long, v string")
    out = {r.column_name: (r.compared, r.differing) for r in quality.table_diff(left, right, ["k"]).collect()}
    assert out == {"v": (2, 0), "(coverage)": (2, 0), "(repeated keys)": (2, 1)}


def test_report_lists_failures_first(spark):
    df = spark.createDataFrame([(1,), (1,)], "k long")
    lines = quality.report({"b": quality.pk_unique(df, "t", ["k"]), "a": quality.table_populated({"t": df})}).collect()
    assert [(r.check_name, r.status) for r in lines] == [("b", "FAIL"), ("a", "PASS"), ("coverage", "FAIL")]
    assert lines[-1].detail == "checked 2, failed 1"


@pytest.fixture(scope="module")
def units(spark):
    """A chain of nine, a cycle, an orphan and a second root; one unit twice."""
    rows = [(i, i - 1 if i > 1 else None) for i in range(1, 10)]
    rows += [(20, 21), (21, 20), (30, 99), (40, None), (41, 40), (41, 40)]
    return spark.createDataFrame([(i, p, f"U{i}", f"n{i}", "T", None) for i, p in rows],
                                 "org_unit_id long, parent_unit_id long, unit_code string, unit_name string, unit_type string, site_code string")


def test_tree_depth_cycles_and_orphans(units):
    out = {r.org_unit_id: r for r in views.org_hierarchy(units).collect()}
    assert set(out) == {*range(1, 8), 40, 41}
    assert (out[7].depth, out[7].root_unit_id, out[7].path_names) == (6, 1, "n1 > n2 > n3 > n4 > n5 > n6 > n7")


def test_tree_equals_recursive_query(spark, units, rows):
    units.createOrReplaceTempView("units")
    recursive = spark.sql("""
        WITH RECURSIVE t(id, root, depth, path) AS (
            SELECT org_unit_id, org_unit_id, 0, unit_name FROM units WHERE parent_unit_id IS NULL
            UNION ALL
            SELECT u.org_unit_id, t.root, t.depth + 1, concat(t.path, ' > ', u.unit_name)
            FROM units u JOIN t ON u.parent_unit_id = t.id WHERE t.depth < 6
        ) SELECT * FROM t""")
    walked = root_paths(units, "org_unit_id", "parent_unit_id", "unit_name", ["org_unit_id"])
    assert rows(walked, "org_unit_id", "root_unit_id", "depth", "path_names") == rows(recursive)


def test_table_diff_compares_every_call(wh):
    lines = {r.column_name: r for r in registry.table_diff(wh).collect()}
    calls = wh.get("ods_call").count()
    assert calls and all(r.compared == calls for r in lines.values())
    assert lines["(coverage)"].differing == 0


def test_every_built_table_is_looked_at():
    assert set(TABLES) - set(registry.POPULATED) == {"dim_date"}


def test_schema_contract_of_nested_types_and_null_partitions(spark):
    spec = TABLES["ods_qa_evaluation"]
    rows = spark.createDataFrame([tuple("k" if c == "qa_form_id" else None for c in spec.names)] * 2, spec.schema)
    out = one(quality.schema_contract(rows, spec.name))
    assert (out.partition_type, out.null_partition_rows, out.status) == ("DATE", 2, "PASS")
    text = one(quality.schema_contract(rows.withColumn("event_date", F.lit("2024-01-15")), spec.name))
    assert (text.partition_type, text.schema_differences, text.status) == ("STRING", 1, "FAIL")
    chats = TABLES["stg_file_chat_transcripts"]
    empty = spark.createDataFrame([], chats.schema)
    assert one(quality.schema_contract(empty, chats.name)).status == "PASS"
    less = F.transform("messages", lambda m: m.dropFields("text"))
    assert one(quality.schema_contract(empty.withColumn("messages", less), chats.name)).schema_differences == 1


def test_populated_builds_tables_at_once_and_after_their_inputs(spark, monkeypatch):
    """Two masters wait for each other while they are built, and a dimension finds its inputs stored."""
    w, met, built = Warehouse(spark, FOLDER), threading.Barrier(2, timeout=60), []

    def build(name):
        if name in ("ods_org_unit", "ods_queue"):
            met.wait()
        assert all(i in w.stored for i in w.steps[name].inputs if i in w.steps)
        built.append(name)
        return spark.range(len(name)).toDF("n")

    monkeypatch.setattr(w, "build", lambda name: build(name) if name in w.steps else Warehouse.build(w, name))
    monkeypatch.setattr(registry, "POPULATED", ["stg_tel_queue", "dim_org", "dim_queue", "ods_queue"])
    out = {r.table_name: r.row_count for r in registry.dq_table_populated(w).collect()}
    assert out == {"stg_tel_queue": w.get("stg_tel_queue").count(), "dim_org": 7, "dim_queue": 9, "ods_queue": 9}
    assert sorted(built) == ["dim_org", "dim_queue", "ods_org_unit", "ods_queue"]


def test_populated_tells_when_a_table_cannot_be_built(spark, monkeypatch):
    w = Warehouse(spark, FOLDER)
    monkeypatch.setattr(w, "build", lambda name: spark.range(1).select(F.raise_error(F.lit(f"no {name}"))))
    with pytest.raises(Exception, match="no ods_queue"):
        w.fill(["ods_queue"])
    assert not w.stored


def test_report_leaves_no_shuffle_files(spark):
    """Of each check the shuffle files go, at the latest when the next is written; the report has the rows of all checks."""
    first = spark.sparkContext._jsc.sc().newShuffleId()

    def left():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {int(n) for n in re.findall(r"shuffle_(\d+)_", files) if int(n) > first}

    def check(n):
        rows = spark.range(0, 1000 * n, 1, 4).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        return rows.select("k", "n", F.when(F.col("k") < n - 2, "FAIL").otherwise("PASS").alias("status"))

    out = quality.report({"abc"[n - 1]: check(n) for n in (1, 2, 3)})
    end = time.monotonic() + 20
    while len(left()) > 1 and time.monotonic() < end:
        time.sleep(0.2)
    assert len(left()) <= 1
    lines = [tuple(r) for r in out.collect()]
    assert len(lines) == 22 and lines[0] == ("c", "k=0 n=429", "FAIL") and lines[-1] == ("coverage", "checked 21, failed 1", "FAIL")


def test_stored_tables_are_packed(wh):
    assert all(f.endswith(".zstd.parquet") for f in wh.get("ods_queue").inputFiles())
