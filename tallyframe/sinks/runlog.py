"""The run log: one row per table load, kept for failures too."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.sinks.tables import Clustering, read_clustered, read_table, replace_table
from tallyframe.sources import literal_rows

LOG_SCHEMA = (
    "log_id bigint, run_id string, pipeline_stage string, source_file string, target_table string, row_count bigint,"
    " duration_seconds decimal(12,2), status string, message string"
)

_numbers: dict[tuple[str, str], itertools.count] = {}


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA + ", logged_at timestamp").parquet(path)


def log_run(
    spark: SparkSession,
    path: str,
    stage: str,
    target: str | None,
    rows: int | None,
    seconds: float,
    status: str,
    message: str = "",
    source: str | None = None,
) -> None:
    """Append one row to the run log, with the whole message.

    ``run_id`` is the application's; ``log_id`` counts its rows from 1, so runs
    that write at the same time share no pair of both.
    """
    run = spark.sparkContext.applicationId
    number = next(_numbers.setdefault((run, path), itertools.count(1)))
    row = (number, run, stage, source, target, rows, Decimal(f"{seconds:.2f}"), status, message)
    (
        literal_rows(spark, [row], LOG_SCHEMA)
        .withColumn("logged_at", F.current_timestamp())
        .coalesce(1)
        .write.mode("append")
        .parquet(path)
    )


def logged_write(
    spark: SparkSession,
    plan: Callable[[], DataFrame],
    path: str,
    log_path: str,
    stage: str,
    target: str,
    expected_rows: int | None = None,
    source: str | None = None,
    partition_by: Sequence[str] = (),
    cluster: Clustering | None = None,
) -> DataFrame:
    """Build a table, publish it if its row count is right, log the outcome, and read it back.

    A clustered table is read back as the catalogue table ``tallyframe_<target>``.
    ``plan`` is called here, so that steps it runs by itself are timed and logged too.
    """
    started, rows = time.perf_counter(), None
    try:
        df = plan()
        rows = replace_table(df, path, partition_by, expected_rows, cluster)
    except Exception as error:
        rows = getattr(error, "rows", rows)
        log_run(spark, log_path, stage, target, rows, time.perf_counter() - started, "FAILED", str(error), source)
        raise
    message = "Rows written." if expected_rows is None else "Row count matched the expected count."
    log_run(spark, log_path, stage, target, rows, time.perf_counter() - started, "SUCCESS", message, source)
    return read_clustered(spark, f"tallyframe_{target}", path, df.schema) if cluster else read_table(spark, path, df.schema)
