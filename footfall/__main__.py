"""Command line: ``python -m footfall SENSORS_CSV COUNTS OUT_DIR [options]``.

Runs the four reports (top-n per day and per month, most decline, most
growth) and writes one CSV per report. Uses the active/cluster session when
launched with spark-submit; ``--master`` builds a local one.
"""

from __future__ import annotations

import argparse
import json


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="footfall", description=__doc__)
    p.add_argument("sensors")
    p.add_argument("counts")
    p.add_argument("out_dir")
    p.add_argument("--format", default="json", choices=["json", "jsonl", "csv", "parquet"])
    p.add_argument("--n", type=int, default=10)
    p.add_argument("--decline-years", default="2020,2021,2022")
    p.add_argument("--growth-years", default="2021,2022")
    p.add_argument("--ties", default="all", choices=["all", "first"])
    p.add_argument("--master", default=None, help="e.g. local[8]; default: spark-submit's")
    a = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from .plans.reports import run_reports
    from .session import local_session

    spark = local_session(a.master[6:-1] or "*") if a.master and a.master.startswith("local[") \
        else SparkSession.builder.getOrCreate()
    written = run_reports(
        spark, a.sensors, a.counts, a.out_dir, counts_format=a.format, n=a.n,
        decline_years=tuple(int(y) for y in a.decline_years.split(",")),
        growth_years=tuple(int(y) for y in a.growth_years.split(",")),
        ties=a.ties,
    )
    print(json.dumps(written))


if __name__ == "__main__":
    main()
