"""Headline queries at one scale; prints one JSON line.

`BENCH_SF_DIR` names the tables (default sf0.1), `BENCH_CPUS` the local cores. Each query is
run once to warm the session and then timed; results are consumed in full by a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerlens.catalogue.queries import REGISTRY  # noqa: E402
from ledgerlens.session import session  # noqa: E402

HEADLINE = [
    "loan_master", "portfolio_months", "portfolio_metrics", "exposure_quarantine",
    "contract_input_split", "contract_assertions", "rwa_monthly_trend", "capital_by_grade",
    "reconcile_breaks", "txn_contract_split", "sweep_alerts", "velocity_alerts",
    "structuring_alerts", "alerts_by_rule", "rule_scorecard", "watchlist_screen",
    "drift_breaches", "profile_columns", "amount_stats", "dedupe_stream", "read_as_of",
    "partition_rerun", "stream_sweep", "stream_velocity",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench", f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
