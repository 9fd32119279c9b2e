"""Rows that come from the program rather than a file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def day_range(spark: SparkSession, first: int, last: int, name: str = "day") -> DataFrame:
    """Whole numbers from ``first`` to ``last``, both included."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows written out in the program, such as a batch of corrections.

    They become constants of the plan: no Python worker reads them, and Spark
    knows how few they are when it plans a join.
    """
    if not rows:
        return spark.createDataFrame([], schema)
    fields = DataType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
