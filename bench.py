"""Benchmark: run the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_KEYS`` (comma list, or ``all`` for every registered key;
default: the dashboard cards, trends and estimate gap, i.e. the query shapes
is the median of its repeats; nothing is cached between them, and each includes
the transfer of the whole result to Python as Arrow batches
(``DataFrame.toArrow``).  Untimed set-up first defines the lazy tables (the
equivalent of registering views) and runs one small query to warm the JVM.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelscope.plans import registry  # noqa: E402
from parcelscope.schema import TABLES  # noqa: E402
from parcelscope.session import build_session  # noqa: E402

HEADLINE = re.compile(r"^(q\d|trend_|estimate_gap$)")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", app="parcelscope-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    qs = registry.queries()
    keys = os.environ.get("BENCH_KEYS")
    if keys == "all":
        keys = list(qs)
    else:
        keys = keys.split(",") if keys else [k for k in qs if HEADLINE.match(k)]

    # untimed set-up: table definitions (no data is read or cached) and a JVM warm-up
    for text in (False, True):
        lake = registry.lake_for(spark, sf_dir, text)
        for name in TABLES:
            lake.split(name)
    qs["q1c_on_time_counts"](spark, sf_dir).toArrow()

    times = {}
    for k in keys:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            qs[k](spark, sf_dir).toArrow()
            runs.append(time.perf_counter() - t0)
        times[k] = round(median(runs), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
