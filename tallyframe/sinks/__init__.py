"""Parquet, CSV, run-log and report outputs."""

from tallyframe.sinks.reports import export_run_log, quality_markdown, write_quality  # noqa: F401
from tallyframe.sinks.runlog import log_run, logged_write  # noqa: F401
from tallyframe.sinks.tables import (  # noqa: F401
    Clustering,
    analysed_table,
    buckets_for,
    read_clustered,
    read_table,
    refresh_statistics,
    replace_table,
    save_table,
    write_csv,
    write_text,
    write_tier,
)
