"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the threads. Every query runs
once to warm up (but for the stream, which is warm by then) and once for the clock, and its whole result is produced.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from tallywire import build_session  # noqa: E402

HEADLINE = (
    "dedup_exact",
    "continuity_status",
    "continuity_skewed",
    "ordering_report",
    "anomalies",
    "sensor_summary",
    "log_totals",
    "summary_report",
    "validation_errors",
    "dead_letters",
    "run_stats",
    "audit_log",
    "reading_records",
    "stream_summary",
)


def clock(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        if not name.startswith("stream"):
            clock(spark, name, sf_dir)
        seconds[name] = round(clock(spark, name, sf_dir), 3)
    records = QUERIES["dedup_exact"](spark, sf_dir).count()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name,
                "log_records": records,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
