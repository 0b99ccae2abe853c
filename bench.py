"""Benchmark the headline queries.

Runs each headline query end to end (scan -> result fully computed, written
to Spark's ``noop`` sink so nothing is collected on the driver) on
``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` and prints ONE JSON line.
Each query is run once to warm up, then ``$BENCH_REPEAT`` times; the median
is reported. ``$BENCH_QUERIES`` (comma-separated) picks other registered
queries than the headline set.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top10_per_day",
    "top10_per_month",
    "most_decline",
    "most_growth",
    "change_table",
    "only_first_pair",
    "wide_enrich",
    "json_roundtrip",
    "stream_top10",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from footfall.plans import catalog
    from footfall.session import local_session

    spark = local_session(cpus, app="footfall-bench")
    times: dict[str, float] = {}
    for name in names:
        fn = catalog.QUERIES.get(name)
        if fn is None:
            continue
        runs = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # first run warms up the JVM and file listing caches
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 4)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_sec_headline_queries",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
