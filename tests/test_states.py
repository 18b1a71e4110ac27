"""Run tables, bucketed masters, the key index, spliced histories, and views over kept bounds."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from switchboard.operators import buckets, keyindex, orders, runs, sink
from switchboard.operators.scd2 import history, splice
from switchboard.plans import daily, masters, merges, quality
from switchboard.schemas import TABLES
from switchboard.session import fresh_path

D1, D2, D3 = (dt.date(2024, 1, d) for d in (14, 15, 16))
NAME = "ods_dialer_attempt"


@pytest.fixture
def path(spark):
    return fresh_path(spark, "table")


def attempts(spark, *rows):
    spec = TABLES[NAME]
    made = [{"attempt_id": i, "event_date": d, "result_code": r} for i, d, r in rows]
    return spark.createDataFrame([tuple(m.get(c) for c in spec.names) for m in made], spec.schema)


def content(spark, path):
    return sorted((r.attempt_id, str(r.event_date), r.result_code) for r in sink.read_table(spark, path, NAME).collect())


def test_runs_in_any_order_and_again_give_one_table(spark, path):
    """Each run delivers rows of its own day, late ones and early ones; keys arrive again."""
    delivered = {
        D1: [("a", D1, "1"), ("b", D1, "1"), ("c", D2, "1"), ("n", None, "1")],
        D2: [("d", D2, "2"), ("b", D1, "2"), ("e", D1, "2"), ("n", None, "2")],
        D3: [("f", D3, "3"), ("b", D1, "3"), ("d", D2, "3")],
    }
    frames = {d: attempts(spark, *r) for d, r in delivered.items()}
    for d in (D1, D2, D3):
        runs.deliver(frames[d], f"{path}-in", NAME, d)
    want = content(spark, f"{path}-in")
    assert want == sorted([("a", str(D1), "1"), ("b", str(D1), "3"), ("e", str(D1), "2"), ("c", str(D2), "1"), ("d", str(D2), "3"),
                           ("f", str(D3), "3"), ("n", "None", "2")])
    # The middle run first delivers rows of all days that it should not have.
    wrong = attempts(spark, ("x", D1, "9"), ("y", D3, "9"), ("b", D1, "9"))
    assert runs.deliver(wrong, path, NAME, D2) == {D1, D3}
    for d in (D3, D1, D2, D1):
        runs.deliver(frames[d], path, NAME, d)
    assert content(spark, path) == want
    assert runs.deliver(frames[D2], path, NAME, D2) == {D1, D2, None}
    assert content(spark, path) == want
    # A run without rows takes its own away, everywhere.
    assert runs.deliver(attempts(spark), path, NAME, D3) == {D1, D2, D3}
    assert ("b", str(D1), "2") in content(spark, path) and ("f", str(D3), "3") not in content(spark, path)


def test_runs_leave_each_others_files_alone(spark, path):
    def files(day):
        return sorted(os.path.join(d, f) for d, _, names in os.walk(f"{path}/run={day}") for f in names)

    runs.deliver(attempts(spark, ("a", D1, "1")), path, NAME, D1)
    before = files(D1)
    for _ in range(3):
        runs.deliver(attempts(spark, ("a", D1, "2"), ("b", D2, "2")), path, NAME, D2)
    assert files(D1) == before
    # Of a run's attempts the one that counts and the one before it stay.
    assert len(os.listdir(f"{path}/run={D2}")) == 2 and len(runs.notes(spark, path)) == 2


def test_a_day_of_a_run_table_is_pruned(spark, path):
    runs.deliver(attempts(spark, ("a", D1, "1"), ("b", D2, "1")), path, NAME, D1)
    runs.deliver(attempts(spark, ("b", D2, "2")), path, NAME, D2)
    rows = sink.read_table(spark, path, NAME).where(F.col("event_date") == F.lit(D2))
    scans = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in line]
    filters = [line.split("PartitionFilters: [")[1].split("]")[0] for line in scans]
    assert len(filters) > 2 and all("= 2024-01-15" in f for f in filters), filters
    assert [r.result_code for r in rows.collect()] == ["2"]


def test_run_tables_are_not_mixed_with_others(spark, path):
    sink.replace_partition(attempts(spark, ("a", D1, "1")), path, NAME, D1)
    with pytest.raises(ValueError):
        runs.deliver(attempts(spark, ("a", D1, "1")), path, NAME, D1)


def clients(spark, *rows):
    spec = TABLES["stg_crm_client"]
    made = [{"client_id": i, "client_name": n, "updated_ts": u, "load_date": d} for i, n, u, d in rows]
    return spark.createDataFrame([tuple(m.get(c) for c in spec.names) for m in made], spec.schema)


def test_a_delivery_rewrites_the_buckets_it_meets(spark, path):
    rows = clients(spark, *[(i, "old", 100, D1) for i in range(300)], (7, "new", 200, D2), (8, "older", 50, D2), (900, "x", 1, D2))
    for day in (D1, D2, D2):
        masters.load_master(spark, path, "ods_client_acid", lambda name: rows, day)
    out = {r.client_id: r.client_name for r in sink.read_table(spark, path, "ods_client_acid").collect()}
    assert len(out) == 301 and (out[7], out[8], out[900]) == ("new", "old", "x")
    spec = TABLES["ods_client_acid"]
    met = buckets.met_by(rows.where("client_id in (7, 8, 900)"), spec.pk, buckets.BUCKETS)
    note = buckets.files.newest(spark, f"{path}/_buckets", "table")[1]
    newest = note["versions"][str(min(met))]
    assert {int(b) for b, v in note["versions"].items() if v == newest} == met and len(met) <= 3
    plan = buckets.read(spark, path, spec.schema, met)._jdf.queryExecution().executedPlan().toString()
    assert f"({len(met)} paths)" in plan


def test_agents_of_an_earlier_day_do_not_win(spark, path):
    spec = TABLES["stg_hr_agent"]
    made = [{"agent_id": 1, "first_name": "A", "last_name": n, "load_date": d} for n, d in (("one", D1), ("two", D2))]
    rows = spark.createDataFrame([tuple(m.get(c) for c in spec.names) for m in made], spec.schema)
    for day in (D2, D1):
        masters.load_master(spark, path, "ods_agent_acid", lambda name: rows, day)
    assert [r.full_name for r in sink.read_table(spark, path, "ods_agent_acid").collect()] == ["A two"]


def timesheets(spark, *rows):
    spec = TABLES["stg_fin_timesheet_delta"]
    made = [dict(zip(("timesheet_id", "op", "change_ms", "work_date", "billable_minutes"), r)) for r in rows]
    return spark.createDataFrame([tuple(m.get(c) for c in spec.names) for m in made], spec.schema)


def test_merges_by_index_equal_a_merge_of_all_changes(spark, path, monkeypatch):
    """Inserts, moves, deletes and older changes in ten deliveries out of order; the index is compacted on the way."""
    monkeypatch.setattr(keyindex, "GENERATIONS", 3)
    rng = random.Random(4)
    changes = [(rng.randrange(25), rng.choice("IUUD"), ms, f"2024-0{rng.randint(1, 3)}-05", ms) for ms in range(200)]
    rng.shuffle(changes)
    for k in range(0, 200, 50):
        feed = timesheets(spark, *changes[k : k + 50])
        masters.merge_changes(spark, path, "ods_timesheet", feed, merges.timesheet)
    want = merges.timesheet(None, timesheets(spark, *changes))
    got = sink.read_table(spark, path, "ods_timesheet")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert len([n for n in os.listdir(f"{path}.index") if n.startswith("name=")]) <= 4


def test_merges_by_index_read_only_the_partitions_they_touch(spark, path):
    masters.merge_changes(spark, path, "ods_timesheet", timesheets(
        spark, (1, "I", 1, "2024-01-05", 1), (2, "I", 1, "2024-02-06", 2), (3, "I", 1, "2024-03-01", 3)), merges.timesheet)
    stamps = {m: os.stat(f"{path}/work_month=2024-0{m}-01").st_mtime_ns for m in (1, 2, 3)}
    written = masters.merge_changes(
        spark, path, "ods_timesheet", timesheets(spark, (2, "U", 2, "2024-02-06", 9), (4, "D", 2, None, 0)), merges.timesheet)
    assert written == {dt.date(2024, 2, 1)}
    assert {m for m in stamps if os.stat(f"{path}/work_month=2024-0{m}-01").st_mtime_ns == stamps[m]} == {1, 3}
    # The key that was only ever deleted stays deleted.
    masters.merge_changes(spark, path, "ods_timesheet", timesheets(spark, (4, "U", 1, "2024-02-06", 9)), merges.timesheet)
    assert sorted(r.timesheet_id for r in sink.read_table(spark, path, "ods_timesheet").collect()) == [1, 2, 3]


TRACKED = ["queue_id", "role_on_program"]
KEYS = ["agent_id", "program_id"]


def seen(spark, rows):
    at = [(a, p, q, r, dt.datetime(2023, 12, 1) + dt.timedelta(days=t)) for a, p, q, r, t in rows]
    return spark.createDataFrame(at, "agent_id long, program_id long, queue_id long, role_on_program string, seen_ts timestamp")


@pytest.mark.parametrize("seed", [1, 2])
def test_spliced_history_equals_a_rebuild(spark, path, rows, seed):
    """Late, repeated and corrected observations of few keys, a hot one and a NULL one among them."""
    rng = random.Random(seed)
    table, ids = "ods_agent_assignment_scd2", "assignment_history_id"
    made = lambda n: [
        (rng.choice([1, 1, 1, 2, None]), rng.randrange(2), rng.randrange(3), rng.choice("ab"), rng.randrange(60)) for _ in range(n)
    ]
    delivered = {}
    for day in (D2, D1, D3, D1):  # the second comes late, the last corrects it
        delivered[day] = made(40)
        splice(spark, path, f"{path}.seen", table, seen(spark, delivered[day]), KEYS, TRACKED, "seen_ts", ids, day)
        every = [r for part in delivered.values() for r in part]
        want = TABLES[table].conform(history(seen(spark, every), KEYS, TRACKED, "seen_ts", ids))
        assert rows(sink.read_table(spark, path, table)) == rows(want)


def test_a_splice_touches_only_what_changes(spark, path):
    table, ids = "ods_agent_assignment_scd2", "assignment_history_id"
    old = seen(spark, [(1, 1, 1, "a", -400), (2, 1, 1, "a", -400), (1, 1, 2, "a", 5)])
    put = lambda df, day: splice(spark, path, f"{path}.seen", table, df, KEYS, TRACKED, "seen_ts", ids, day)
    assert put(old, D1) == {2022, 2023}
    # Nothing new: no year is written. A change of one key: the year of its open version, and the new one's.
    assert put(seen(spark, [(1, 1, 2, "a", 9), (2, 1, 1, "a", 9)]), D2) == set()
    assert put(seen(spark, [(1, 1, 3, "a", 40)]), D3) == {2023, 2024}


def test_planned_orders_do_not_depend_on_bounds(spark, rows):
    df = spark.range(400).select("id", (F.col("id") % 7).alias("g"), (F.col("id") * 37 % 101).cast("double").alias("x"))
    df = df.withColumn("x", F.when(F.col("id") % 11 != 0, F.col("x")))
    by = [F.col("x"), F.col("id")]
    few, none = orders.bounds_of(df.limit(30), by), orders.Bounds(orders.bounds_of(df, by).schema, ())
    many = orders.Bounds(few.schema, tuple(r.j for r in df.select(F.to_json(F.struct(*orders.key_of(df, by))).alias("j"), "x", "id")
                                           .orderBy("x", "id").select("j").collect()))
    assert len(many.values) == 400 > orders.LEAVES
    first = rows(orders.positions(df, by, "p", none))
    for bounds in (few, many, None):
        assert rows(orders.positions(df, by, "p", bounds)) == first
        a = rows(orders.neighbour(df.where("x is not null"), ["g"], "x", ["id"], ["id"], "before", bounds=None))
        assert rows(orders.neighbour(df.where("x is not null"), ["g"], "x", ["id"], ["id"], "before")) == a
    assert [r.p for r in orders.positions(df, by, "p", few).orderBy("p").collect()] == list(range(1, 401))


def test_a_view_registered_once_shows_the_next_day(spark, path):
    def contacts(day, n):
        spec = TABLES["ods_interaction"]
        at = dt.datetime(day.year, day.month, day.day, 9)
        made = [{"interaction_id": f"V{n}{k}", "customer_ref": f"c{k}", "channel": "V", "start_ts": at, "event_date": day} for k in range(5)]
        return spark.createDataFrame([tuple(m.get(c) for c in spec.names) for m in made], spec.schema)

    def get(name):
        if name.startswith("stg_"):
            return spark.createDataFrame([], TABLES[name].schema)
        return sink.read_table(spark, daily.table_path(path, name), name)

    table = daily.table_path(path, "ods_interaction")
    runs.deliver(contacts(D1, 1), table, "ods_interaction", D1)
    daily.register_views(spark, get, f"{path}/bounds")
    count = "SELECT count(*) AS n, count(prev_contact_ts) AS again, sum(repeat_within_72h) AS soon FROM vw_repeat_contact_window"
    assert tuple(spark.sql(count).first()) == (5, 0, 0)
    kept = sorted(os.listdir(f"{path}/bounds"))
    runs.deliver(contacts(D2, 2), table, "ods_interaction", D2)
    daily.run_day(spark, path, get, D3, only=set())
    assert tuple(spark.sql(count).first()) == (10, 5, 5)
    assert sorted(os.listdir(f"{path}/bounds")) == kept


def test_equal_key_ranges_are_not_read(spark):
    left = spark.range(100_000).withColumn("v", F.col("id") * 3)
    right = left.withColumn("v", F.when(F.col("id").between(70_010, 70_020), 0).otherwise(F.col("v"))).where("id <> 12")
    spans, found = quality.unlike_ranges(left, right, "id")
    assert found[0] == (64, 2) and found[1][1] == 2 and all(b - a < 30 for a, b in spans)
    lines = {r.column_name: (r.compared, r.differing) for r in quality.ranged_diff(left, right, "id").collect()}
    assert lines["v"][1] == 11 and lines["(coverage)"][1] == 1 and lines["v"][0] < 100
    assert quality.unlike_ranges(left, left, "id")[0] == []
    same = {r.column_name: (r.compared, r.differing) for r in quality.ranged_diff(left, left, "id").collect()}
    assert same["(coverage)"] == (0, 0) and same["(ranges, level 1)"] == (64, 0)
