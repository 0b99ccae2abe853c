"""footfall: sensor-count analytics on Spark.

The public API in one place; every function builds a lazy DataFrame (or
starts a streaming query); table rows are not collected on the driver. The
exceptions are ``run_reports``, which writes files and reads back a few ids.
"""

from .operators.change import (
    aligned_difference,
    extremum,
    most_decline,
    most_growth,
    period_change,
    present_only,
    year_matrix,
    yearly_totals,
)
from .operators.enrich import duplicate_keys, enrich, is_subset, orphans, wide_enrich
from .operators.rank import period_totals, top_n, top_n_per_period
from .plans.reports import build_reports, reports_from_day_totals, run_reports
from .sinks.files import write_csv, write_pages_json
from .sinks.messages import encode_pages, kafka_sink_options, publish, to_feed_records
from .sources.counts import normalize_counts, read_counts_csv, read_counts_json, read_sensors
from .sources.messages import dedup_messages, dedup_records, decode_pages, kafka_options, page_rejects, read_topic

__all__ = [
    "aligned_difference", "build_reports", "decode_pages", "dedup_messages", "dedup_records",
    "duplicate_keys", "encode_pages", "enrich", "extremum", "is_subset", "kafka_options",
    "kafka_sink_options", "most_decline", "most_growth", "normalize_counts", "orphans", "page_rejects",
    "period_change", "period_totals", "present_only", "publish", "read_counts_csv",
    "read_counts_json", "read_sensors", "read_topic", "reports_from_day_totals", "run_reports",
    "to_feed_records", "top_n", "top_n_per_period", "wide_enrich", "write_csv",
    "write_pages_json", "year_matrix", "yearly_totals",
]
