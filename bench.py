"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and fully executed (``noop`` sink: every row is produced,
nothing is collected to the driver), $BENCH_RUNS times (3). ``queries`` has the
median wall seconds of building and running, ``build`` and ``run`` those of either,
``range`` the fastest and slowest.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from almacen.queries import QUERIES  # noqa: E402
from almacen.session import local_session  # noqa: E402

HEADLINE = (
    "silver_ri_accepted",
    "fact_sales",
    "fact_inventory",
    "fact_returns",
    "rfm_segments",
    "view_daily_sales",
    "dq_metrics",
)


def run_one(spark, name: str, sf_dir: str) -> tuple[float, float]:
    """(seconds to build the query, jobs that it starts included; seconds to run it)."""
    t = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    built = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return built - t, time.perf_counter() - built


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    run_one(spark, "silver_suppliers", sf_dir)  # JVM warm-up, not timed
    took = {n: [run_one(spark, n, sf_dir) for _ in range(runs)] for n in names}
    total = {n: sorted(a + b for a, b in t) for n, t in took.items()}
    times = {n: round(t[len(t) // 2], 3) for n, t in total.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_wall_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "build": {n: round(sorted(a for a, _ in t)[len(t) // 2], 3) for n, t in took.items()},
        "run": {n: round(sorted(b for _, b in t)[len(t) // 2], 3) for n, t in took.items()},
        "range": {n: [round(t[0], 3), round(t[-1], 3)] for n, t in total.items()},
        "runs": runs,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
