"""First row per key, top-k, dense keys and running totals.

None of these sorts a whole table, or a whole group of it, in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.session import materialise


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key. Columns outside ``order`` break ties.

    Spark keeps one row per key and task before the shuffle, so a key with very
    many rows sends few of them. Nulls sort last.
    """
    named = [c for c in order if isinstance(c, str)]
    rest = [c for c in df.columns if c not in keys and c not in named]
    wanted = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in [*order, *rest]]
    rank = Window.partitionBy(*keys).orderBy(*(wanted or [F.lit(1)]))
    return df.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").drop("_rank")


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The ``k`` first rows in the given order; each task keeps at most ``k``."""
    return df.orderBy(*order).limit(k)


def _sliced(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``df`` range-partitioned and sorted, with each row's slice and place in it.

    The rows are written out, because the slice borders come from a sample and
    every later pass must see the same ones. Sampling reads all rows, so they are
    stored before it, and what they are made of is worked out once.
    """
    placed = (
        materialise(df, label)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    return materialise(placed, label).withColumn("_slice", F.shiftright("_at", 33))


def surrogate_key(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """Dense keys 1..n in the order of the (unique) columns ``order``.

    Row numbers are counted inside each range slice and moved by the number of
    rows in the slices before it. Only the slice totals, one row per slice, pass
    through a single task and are broadcast.
    """
    sliced = _sliced(df, order, name)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    starts = totals.select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return sliced.join(F.broadcast(starts), "_slice").select(
        (F.col("_start") + place + 1).alias(name), *[F.col(c) for c in df.columns]
    )


def running_total(df: DataFrame, group: str, value: str, measure: str, name: str = "running") -> DataFrame:
    """Running sum of ``measure`` in ``value`` order within each ``group``.

    A group may span many slices; each slice is summed by itself and moved by
    the group's total in the slices before it (one row per group and slice).
    """
    sliced = _sliced(df, [group, value], "running")
    before = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = sliced.groupBy(group, "_slice").agg(F.sum(measure).alias("_sum"))
    starts = totals.select(group, "_slice", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, "_slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return (
        sliced.withColumn("_inside", F.sum(measure).over(inside))
        .join(starts, [group, "_slice"])
        .select(*[F.col(c) for c in df.columns], (F.col("_start") + F.col("_inside")).alias(name))
    )
