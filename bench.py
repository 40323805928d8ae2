"""Benchmark: run the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is fully executed into Spark's ``noop`` sink (all rows computed,
nothing collected to the driver), after one warm-up query that loads the JVM
code paths.  Every query runs ``BENCH_REPEAT`` times (default 2) and the
fastest run is reported: the test VM's timings vary by about 30 % from run
to run.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulsegraph import build_session  # noqa: E402
from pulsegraph.plans import queries  # noqa: E402

HEADLINE = [
    "top5_total",
    "heat_cumulative_series",
    "leaderboard_json",
    "top_influence",
    "period_membership",
    "posts_by_month",
    "account_totals",
    "at_edges",
    "mention_counts",
    "degree_in_named",
    "triangle_count",
    "pagerank",
    "pagerank_weighted",
    "scc",
    "stream_account_totals",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:] or HEADLINE
    ckpt = tempfile.mkdtemp(prefix="pulsegraph-bench-", dir="/tmp")
    spark = build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=max(cpus, 8),
        extra_conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "16g"},
    )
    qs = queries()
    qs["monthly_measures"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in only:
        runs = []
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
        except Exception as e:  # noqa: BLE001 - report and keep benchmarking the rest
            errors[name] = str(e)[:300]
            print(f"{name}: FAILED {errors[name]}", file=sys.stderr, flush=True)
            continue
        times[name] = round(min(runs), 3)
        print(f"{name}: {[round(r, 2) for r in runs]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_headline_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
        "stat": "min",
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
