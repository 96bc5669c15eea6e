"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR is the data directory, BENCH_CPUS the local cores, BENCH_RUNS the
timed runs per query after one warm-up (their median counts). Each query is run
to the end into a no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cuadre.catalog.queries import QUERIES  # noqa: E402
from cuadre.session import build_session  # noqa: E402

HEADLINE = [
    "r1", "r2", "r3", "r4", "r5", "r6", "r7",
    "e1_invoices_v1", "e2_invoices_v2", "e10_requisition_bridge", "e15_withholding",
    "a1_tax_pivot", "a5_distinct_list", "a11_distributions", "a13_payments", "a14_prepayments",
    "j3_fanout", "j8_receipts", "q1_profile", "q2_summary",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    settings = {"spark.sql.shuffle.partitions": cpus.strip("*") or "8", "spark.driver.memory": "8g"}
    spark = build_session(f"local[{cpus}]", "bench", settings)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    line = {
        "metric": "sum of median query times, warm",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
