"""Quality report and run-log exports. Reports hold one row per check."""

from __future__ import annotations

import codecs
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.sinks.runlog import read_run_log
from tallyframe.sinks.tables import read_table, replace_table, write_csv

REPORT_COLUMNS = (
    "layer", "table_name", "check_name", "observed_value", "expectation", "status", "interpretation",
)


def _single_csv(df: DataFrame, path: str, order: str, columns: Sequence[str]) -> None:
    """A small result as one ordered CSV part; the header starts with a BOM."""
    df = df.coalesce(1).sortWithinPartitions(order).select(*columns)
    first, *rest = df.columns
    bom = codecs.BOM_UTF8.decode("utf-8")
    (
        df.withColumnRenamed(first, bom + first)
        .write.mode("overwrite")
        .option("header", True)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def write_quality(report: DataFrame, root: str) -> DataFrame:
    """Replace the stored quality results and their CSV copy."""
    path = f"{root}/data_quality_results"
    stamped = report.withColumnRenamed("check_order", "result_id").withColumn("generated_at", F.current_timestamp())
    replace_table(stamped, path)
    stored = read_table(report.sparkSession, path, stamped.schema)
    _single_csv(stored, f"{root}/data_quality_report_csv", "result_id", REPORT_COLUMNS)
    return stored


def quality_markdown(report: DataFrame, title: str = "Data-quality report") -> str:
    """The report as Markdown: totals, the overall result, one line per check."""
    order = "result_id" if "result_id" in report.columns else "check_order"
    rows = report.orderBy(order).select(*REPORT_COLUMNS).collect()  # one row per declared check
    totals = {s: sum(r["status"] == s for r in rows) for s in ("PASS", "FAIL", "INFO")}
    overall = "FAIL" if totals["FAIL"] else "PASS"

    def cell(value: object) -> str:
        return str(value).replace("|", "\\|").replace("\n", " ")

    lines = [
        f"# {title}",
        "",
        f"Generated: {datetime.now(timezone.utc):%Y-%m-%d %H:%M:%S} UTC",
        "",
        f"Overall: **{overall}** ({totals['PASS']} passed, {totals['FAIL']} failed, {totals['INFO']} informational)",
        "",
        "| Layer | Table | Check | Observed | Expectation | Status | Interpretation |",
        "|---|---|---|---:|---|---|---|",
    ]
    lines += ["| " + " | ".join(cell(v) for v in r) + " |" for r in rows]
    return "\n".join(lines) + "\n"


def export_run_log(spark: SparkSession, log_path: str, out_path: str) -> None:
    """The run log in time order as CSV; a long one in several parts."""
    write_csv(read_run_log(spark, log_path).orderBy("logged_at", "run_id", "log_id"), out_path)
