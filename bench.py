"""Headline queries, timed: one JSON line on stdout.

Each query runs once to warm up and then three times; its figure is the median. Results go to the
``noop`` sink, so all rows and columns are produced and none are sent to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from meterhouse.plans import catalog  # noqa: E402
from meterhouse.session import build_session  # noqa: E402

HEADLINE = [
    "agg1_token_usage_hourly",
    "agg2_api_slo_hourly",
    "agg4_plan_utilisation",
    "agg5_budget_burndown",
    "cdc2_scd2_from_snapshots",
    "cdc5_scd2_from_changes",
    "cdc6_scd1_from_changes",
    "dq5_quality_report",
    "join2_limit_as_of",
    "quo2_validate_requests",
    "quo3_record_usage",
    "quo5_replay_gate",
    "rd6_chat_history",
    "str3_dedup_batch",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "6g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    seconds: dict[str, float] = {}
    for name in wanted:
        times = []
        for n in range(runs + 1):
            began = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            if n:
                times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times), 3)
    scale = Path(folder).name.removeprefix("sf")
    line = {
        "metric": "total_seconds_headline_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    spark.stop()
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
