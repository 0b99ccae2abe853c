"""Write PLANS.md: the physical plans of the headline queries.

Usage: python tools/plans.py [sf_dir]

For each query the plan tree plus the scan lines (pushed filters, read
schema) of ``explain("formatted")`` are recorded, so the plan shape —
exchanges, partial aggregation, WindowGroupLimit, broadcast — can be
reviewed without running anything.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

QUERIES = ["top10_per_day", "top10_per_month", "most_decline", "most_growth", "change_table",
           "only_first_pair", "wide_enrich", "semi_lookup", "page_decode_replayed"]


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(text: str) -> str:
    tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
    keep = [ln for ln in text.splitlines()
            if ln.startswith(("PushedFilters", "ReadSchema", "PartitionFilters"))]
    return tree + "\n\n" + "\n".join(dict.fromkeys(keep))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from footfall.plans import catalog
    from footfall.session import local_session

    spark = local_session(8)
    out = ["# PLANS", "",
           f"Physical plans (`explain(\"formatted\")`, before AQE re-planning) of the headline "
           f"queries over `{sf_dir}`. Generated by `tools/plans.py`.", ""]
    for name in QUERIES:
        df = catalog.QUERIES[name](spark, sf_dir)
        out += [f"## {name}", "", "```", summary(formatted(df)).rstrip(), "```", ""]
    spark.stop()
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
