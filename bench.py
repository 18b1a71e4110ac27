"""Time the headline queries: one warm-up, then the median of three full materialisations.

The warm-up also writes the tables a query reads, as the daily batch would; the measured runs
cover the query itself, from building its plan to its last row. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import registry  # noqa: E402
from switchboard.session import local_session  # noqa: E402

HEADLINE = [
    "cleanse_call",
    "cleanse_ivr_session",
    "cleanse_chat_session",
    "cleanse_qa_evaluation",
    "cleanse_interaction",
    "load_fact_interaction",
    "load_fact_agent_activity",
    "load_fact_queue_interval",
    "load_fact_csat_survey",
    "load_fact_billing_line",
    "rebuild_timesheet",
    "rebuild_agent_scd2",
    "rebuild_ticket_acid",
    "agg_agent_daily",
    "agg_program_monthly",
    "vw_org_hierarchy",
    "vw_csat_rollup",
    "vw_call_driver_regex",
    "vw_repeat_contact_window",
    "vw_first_contact_resolution",
    "vw_agent_scorecard",
    "vw_client_executive_summary",
    "dedup_latest",
    "interval_count",
    "global_rank",
    "table_diff",
]
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, app="bench", **{"spark.ui.showConsoleProgress": "false"})
    queries = registry.queries()
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    total = round(sum(seconds.values()), 3)
    sf = float(os.path.basename(folder.rstrip("/")).removeprefix("sf"))
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
