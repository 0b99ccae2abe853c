"""File sinks (SNK-1, SNK-3, SNK-4).

Results are written by executors straight to the target URI (local path,
HDFS or an object store such as ``s3a://bucket/key``); nothing is collected
on the driver, so publishing to a bucket is just the path argument.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, single: bool = True, mode: str = "overwrite",
              header: bool = True, order_by: list | None = None) -> None:
    """Write ``df`` as CSV with a header.

    ``single=True`` produces one part file (SNK-1). Everything before it stays
    parallel. With ``order_by`` the rows are range-partitioned first and one
    task then writes range after range, so it never holds or sorts more than
    one range; without, it streams the rows as they come. ``single=False``
    (SNK-3) also writes in parallel; take it for large outputs.
    """
    if single and order_by:
        df = df.orderBy(*order_by).coalesce(1)
    elif single:
        df = df.repartition(1)
    elif order_by:
        df = df.orderBy(*order_by)
    df.write.mode(mode).option("header", header).csv(path)


def write_pages_json(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write each page (a JSON array text column ``value``) as one line.

    A file of array lines is read back with ``read_counts_json(...,
    multi_line=False)``; each line is a whole page.
    """
    pages.select("value").write.mode(mode).text(path)
