"""Headline queries at one scale, timed; prints one JSON line.

Queries run twice and the better time counts, so that starting the JVM, compiling
the first plan and forking the first Python worker are not charged to one of them.
The whole run goes once. Results are computed in full and thrown away (the
``noop`` sink); streams and the whole run also write and read their tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tapewell.catalog import QUERIES
from tapewell.catalog.base import market_events
from tapewell.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

TWICE = (
    "gold_window_metrics",
    "vwap_moving_average",
    "dedup_trades",
    "silver_ticker",
    "contract_reasons",
    "contract_report",
    "expected_windows",
    "completeness",
    "latency_p95",
    "check_recompute",
    "compute_windows",
    "out_of_order",
    "late_flags",
    "closed_windows_by_clock",
    "coinbase_trades",
    "binance_trades",
    "event_json_roundtrip",
    "stream_windows",
    "stream_normalize",
)
ONCE = ("medallion_run",)


def timed(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name].run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = market_events(spark, SF_DIR).count()
    seconds = {}
    for name in TWICE:
        seconds[name] = round(min(timed(spark, name) for _ in range(2)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    for name in ONCE:
        seconds[name] = round(timed(spark, name), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "events": rows,
                "stream_rows_per_sec": round(rows / seconds["stream_windows"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
