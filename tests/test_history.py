"""Histories read what they are made of once, and a splice compares its versions in one grouping."""

import datetime as dt

from switchboard.operators import scd2
from switchboard.operators.scd2 import history, splice
from switchboard.operators.sink import read_table
from switchboard.schemas import TABLES

KEYS, TRACKED = ["agent_id", "program_id"], ["queue_id", "role_on_program"]
TABLE, IDS = "ods_agent_assignment_scd2", "assignment_history_id"
COLUMNS = "agent_id long, program_id long, queue_id long, role_on_program string, seen_ts timestamp"


def seen(spark, rows):
    at = [(a, p, q, r, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for a, p, q, r, h in rows]
    return spark.createDataFrame(at, COLUMNS)


def test_a_history_does_not_read_its_observations_again(spark, tmp_path, rows):
    given = [(a, a, h // 4 % 2, None if h % 5 == 0 else "x", h) for a in (1, 2, None) for h in range(30)]
    seen(spark, given).write.parquet(f"{tmp_path}/given")
    made = history(spark.read.parquet(f"{tmp_path}/given"), KEYS, TRACKED, "seen_ts", IDS)
    assert not [f for f in made.inputFiles() if "/given/" in f]
    want, last = [], {}
    for a, p, q, r, h in sorted(given, key=lambda x: x[-1]):
        if last.get(a, "none") != (q, r):
            want.append((a, p, q, r, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)))
        last[a] = (q, r)
    assert rows(made, *KEYS, *TRACKED, "eff_from_ts") == sorted(want, key=repr)
    assert made.where("is_current").count() == 3 and made.where("is_current <> (eff_to_ts is null)").isEmpty()


def test_a_corrected_run_takes_its_versions_back(spark, tmp_path, rows, monkeypatch):
    """A first delivery, a repeat of it without some of its rows, and a later one: one grouping each tells what differs."""
    stored, store = [], scd2.store
    monkeypatch.setattr(scd2, "store", lambda df, label: stored.append(label) or store(df, label))
    day, next_day = dt.date(2024, 1, 15), dt.date(2024, 1, 16)
    first = [(1, 1, 1, "a", 0), (1, 1, 2, "a", 9), (1, 1, 1, None, 20), (None, 2, 1, "b", 3), (None, 2, 1, "b", 3)]
    delivered = {}
    for when, given in ((day, first), (day, first[:1] + first[2:]), (next_day, [(1, 1, 2, "a", 30), (2, 1, 1, "a", 1)])):
        delivered[when] = given
        splice(spark, f"{tmp_path}/t", f"{tmp_path}/t.seen", TABLE, seen(spark, given), KEYS, TRACKED, "seen_ts", IDS, when)
        every = [r for part in delivered.values() for r in part]
        want = TABLES[TABLE].conform(history(seen(spark, every), KEYS, TRACKED, "seen_ts", IDS))
        assert rows(read_table(spark, f"{tmp_path}/t", TABLE)) == rows(want)
    assert stored.count("differing") == 3
