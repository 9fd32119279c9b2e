"""Exact distinct counts by bitmaps, which can be stored and merged.

A value is one bit of the bitmap of its bucket (32,768 values, at most 4 KB; a
bitmap ends with its highest bit). All values are read in one pass: rows are not
copied for each distinct count. Bitmaps of one key and bucket are united by
``OR``, so counts of coarser keys (all weeks of a presentation, all presentations
of a module) come from stored bitmaps and not from the rows.

Spark sorts rows by key and bucket inside their tasks before it fills bitmaps, one
after the other. Where the rows are stored clustered by the keys (see
``sinks.Clustering``), nothing is shuffled. Else each task sends a bitmap for each
of its keys and buckets, which suits few large groups; for many small groups of
unclustered rows ``aggregates.engagement`` is the better way.

Values are whole numbers of any sign. Bitmaps are small if values are dense; texts
and sparse numbers are numbered first (``dense_codes``). Nulls are not counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.ordering import surrogate_key
from tallyframe.session import materialise

WHOLE = ("byte", "short", "integer", "long")
_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}
#: Added to days, so that those of some decades before and after day 0 share a bucket.
DAY_SHIFT = 16_384
#: How the totals that go with engagement bitmaps are merged.
TOTALS = {"total_clicks": "sum", "first_active_day": "min", "last_active_day": "max"}


def value_bitmaps(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, str], aggregates: Mapping[str, Column] | None = None
) -> DataFrame:
    """For each key and combination of buckets, a bitmap for each of ``values`` (name to column), and the ``aggregates``.

    The result has ``<name>_bucket`` and ``<name>_bits`` for each value.
    """
    numbers = {n: F.col(c).cast("bigint") for n, c in values.items()}
    buckets = [F.bitmap_bucket_number(v).alias(f"{n}_bucket") for n, v in numbers.items()]
    bits = [F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias(f"{n}_bits") for n, v in numbers.items()]
    # The highest bit of each bitmap: what lies behind it is not stored.
    tops = [F.max(F.bitmap_bit_position(v)).alias(f"{n}_top") for n, v in numbers.items()]
    made = df.groupBy(*keys, *buckets).agg(*bits, *tops, *[a.alias(n) for n, a in (aggregates or {}).items()])
    size = lambda n: F.coalesce(F.shiftright(f"{n}_top", 3) + 1, F.lit(0)).cast("int")
    cut = [F.substring(f"{n}_bits", F.lit(1), size(n)).alias(f"{n}_bits") for n in values]
    return made.select(*keys, *[f"{n}_bucket" for n in values], *cut, *(aggregates or {}))


def merged_counts(
    bitmaps: DataFrame, keys: Sequence[str], names: Mapping[str, str], aggregates: Mapping[str, str] | None = None
) -> DataFrame:
    """Distinct values for each key, which may be coarser than the keys of ``bitmaps``.

    ``names`` maps the names of values to result columns, ``aggregates`` other
    columns to how they are merged: ``sum``, ``min`` or ``max``.
    """
    how = dict(aggregates or {})
    rows = []
    for k, value in enumerate(names):
        # The other aggregates stand in the rows of the first value only.
        others = [(F.col(n) if k == 0 else F.lit(None).cast(bitmaps.schema[n].dataType)).alias(n) for n in how]
        bucket, bits = F.col(f"{value}_bucket").alias("_bucket"), F.col(f"{value}_bits").alias("_bits")
        rows.append(F.struct(F.lit(k).alias("_value"), bucket, bits, *others))
    each = bitmaps.select(*keys, F.inline(F.array(*rows)))
    others = [_MERGE[h](n).alias(n) for n, h in how.items()]
    merged = each.groupBy(*keys, "_value", "_bucket").agg(F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_n"), *others)
    counts = [F.coalesce(F.sum(F.when(F.col("_value") == k, F.col("_n"))), F.lit(0)).alias(r) for k, r in enumerate(names.values())]
    return merged.groupBy(*keys).agg(*counts, *others)


def dense_codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """The different values of a column with numbers from 1, in value order; null has none."""
    values = df.select(column).distinct().where(F.col(column).isNotNull())
    return surrogate_key(values, name, [column])


def with_codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the dense number of a column's value; the values are stored, so the join is planned from their real size."""
    return df.join(materialise(dense_codes(df, column, name), name), column, "left")


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], rows: str | None = None) -> DataFrame:
    """Distinct values of several columns (result name to column) for each key; ``rows`` names the number of rows.

    Columns that are no whole numbers are numbered first. Each row sends a word of
    64 values for each column, united by ``OR`` in hash tables before the shuffle,
    so a task holds the words it met and not its rows, nor pairs of words of
    different columns. Without keys, the result is one row.
    """
    words = []
    for k, column in enumerate(columns.values()):
        if df.schema[column].dataType.typeName() not in WHOLE:
            df, column = with_codes(df, column, f"_code{k}"), f"_code{k}"
        words.append(F.struct(F.lit(k).alias("_value"), *word_of(column), F.lit(int(k == 0)).cast("bigint").alias("_rows")))
    each = df.select(*keys, F.inline(F.array(*words)))
    united = each.groupBy(*keys, "_value", "_word").agg(F.bit_or("_bits").alias("_bits"), F.sum("_rows").alias("_rows"))
    counts = [F.sum(F.when(F.col("_value") == k, F.bit_count("_bits"))) for k in range(len(columns))]
    total = lambda c, name: F.coalesce(c, F.lit(0)).cast("bigint").alias(name)
    return united.groupBy(*keys).agg(
        *[total(c, name) for c, name in zip(counts, columns, strict=True)], *([total(F.sum("_rows"), rows)] if rows else [])
    )


def word_of(column: str) -> tuple[Column, Column]:
    """``_word``, the word of 64 numbers that a whole number lies in, and ``_bits``, its bit there; both null for null."""
    number = F.col(column).cast("bigint")
    bit = F.expr(f"shiftleft(1L, CAST(CAST(`{column}` AS BIGINT) & 63 AS INT))")
    return F.shiftright(number, 6).alias("_word"), bit.alias("_bits")


def engagement_bitmaps(df: DataFrame, keys: Sequence[str], measure: str, day: str, resource: str) -> DataFrame:
    """Days and resources of each key as bitmaps, with its clicks, first and last day; to be stored.

    For rows that are stored clustered by the keys, or by some of them. ``pieces``
    is the number of rows of a key: one, unless its values lie in several buckets.
    """
    totals = {"total_clicks": F.sum(measure), "first_active_day": F.min(day), "last_active_day": F.max(day)}
    shifted = df.withColumn("_day", F.col(day) + DAY_SHIFT)
    made = value_bitmaps(shifted, keys, {"days": "_day", "resources": resource}, totals)
    return made.withColumn("pieces", F.count(F.lit(1)).over(Window.partitionBy(*keys)))


def engagement_counts(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The columns of ``aggregates.engagement`` for the keys of stored bitmaps.

    The bitmaps of a key in one piece are counted as they are; others are merged.
    """
    names = {"days": "active_days", "resources": "distinct_resources"}
    columns = [*keys, "total_clicks", *names.values(), "first_active_day", "last_active_day"]
    whole = stored.where("pieces = 1").withColumns({r: F.bitmap_count(f"{n}_bits") for n, r in names.items()})
    return whole.select(*columns).unionByName(coarser_engagement(stored.where("pieces > 1"), keys).select(*columns))


def coarser_engagement(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same counts for coarser keys: bitmaps of the finer ones are merged."""
    counted = merged_counts(stored, keys, {"days": "active_days", "resources": "distinct_resources"}, TOTALS)
    return counted.select(*keys, "total_clicks", "active_days", "distinct_resources", "first_active_day", "last_active_day")
