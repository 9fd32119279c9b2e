"""Consolidation, engagement, completion and performance aggregates.

Each is a hash aggregate with map-side partial results; distinct counts are
spread over (group, value) pairs before the final count, so a group that holds
a large share of the rows is not counted in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import pct, rounded_mean, rounded_ratio, week_floor
from tallyframe.operators.bitmaps import WHOLE, word_of
from tallyframe.operators.joins import spread, union_all


def row_count(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def consolidate(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """One row per key, measures added up. Clean the keys first."""
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in sums])


def consolidation_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after consolidation, rows collapsed, and their share in percent."""
    counts = union_all(
        [
            row_count(before, "n").withColumn("side", F.lit("raw_rows")),
            row_count(after, "n").withColumn("side", F.lit("clean_rows")),
        ]
    )
    collapsed = F.col("raw_rows") - F.col("clean_rows")
    return spread(counts, "side", "n", ["raw_rows", "clean_rows"]).select(
        "raw_rows",
        "clean_rows",
        collapsed.alias("collapsed_rows"),
        F.coalesce(pct(collapsed, F.col("raw_rows")), F.lit(0)).alias("collapsed_pct"),
    )


def collapse_entity(df: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """One row per entity, with the greatest recorded value of each attribute."""
    return df.groupBy(*keys).agg(*[F.max(a).alias(a) for a in attributes])


def engagement(
    df: DataFrame, keys: Sequence[str], measure: str, day: str, resource: str, day_span: bool = True,
    resources_name: str = "distinct_resources",
) -> DataFrame:
    """Per key: clicks, active days, distinct resources, first and last active day.

    Whole numbers are united in words of 64 values: the rows of a key become one
    for each pair of words, and only those are copied for the two counts. Other
    values are counted by copying each row for each distinct count.
    """
    span = {"first_active_day": F.min, "last_active_day": F.max} if day_span else {}
    if not all(df.schema[c].dataType.typeName() in WHOLE for c in (measure, day, resource)):
        return df.groupBy(*keys).agg(
            F.sum(measure).alias("total_clicks"),
            F.countDistinct(day).alias("active_days"),
            F.countDistinct(resource).alias(resources_name),
            *[f(day).alias(n) for n, f in span.items()],
        )
    (day_word, day_bit), (resource_word, resource_bit) = word_of(day), word_of(resource)
    totals = {"total_clicks": F.sum, **span}
    pairs = df.groupBy(*keys, day_word.alias("_days"), resource_word.alias("_resources")).agg(
        F.bit_or(day_bit).alias("_day_bits"),
        F.bit_or(resource_bit).alias("_resource_bits"),
        *[f(measure if n == "total_clicks" else day).alias(n) for n, f in totals.items()],
    )
    # The totals stand in the rows of the days only.
    of_days = [F.col(n) for n in totals]
    of_resources = [F.lit(None).cast(pairs.schema[n].dataType).alias(n) for n in totals]
    words = F.array(
        F.struct(F.lit(0).alias("_value"), F.col("_days").alias("_word"), F.col("_day_bits").alias("_bits"), *of_days),
        F.struct(F.lit(1).alias("_value"), F.col("_resources").alias("_word"), F.col("_resource_bits").alias("_bits"), *of_resources),
    )
    merged = [f(n).alias(n) for n, f in totals.items()]
    united = pairs.select(*keys, F.inline(words)).groupBy(*keys, "_value", "_word").agg(F.bit_or("_bits").alias("_bits"), *merged)
    counted = [
        F.coalesce(F.sum(F.when(F.col("_value") == k, F.bit_count("_bits"))), F.lit(0)).cast("bigint").alias(n)
        for k, n in enumerate(("active_days", resources_name))
    ]
    return united.groupBy(*keys).agg(merged[0], *counted, *merged[1:])


def popularity(df: DataFrame, keys: Sequence[str], measure: str, actor: str) -> DataFrame:
    """Per resource: clicks and distinct students."""
    return df.groupBy(*keys).agg(
        F.sum(measure).alias("total_clicks"), F.countDistinct(actor).alias("distinct_students")
    )


def weekly_trend(
    df: DataFrame, keys: Sequence[str], day: str, measure: str, actor: str, week=week_floor
) -> DataFrame:
    """Per week: clicks and distinct students. ``week`` maps a day to its week."""
    return popularity(
        df.withColumn("presentation_week", week(day)), [*keys, "presentation_week"], measure, actor
    )


def conditional_counts(df: DataFrame, groups: Sequence[str], conditions: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*groups).agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def completion(
    df: DataFrame, groups: Sequence[str], outcome: str, counts: Mapping[str, str], success: Sequence[str]
) -> DataFrame:
    """Per group: registrations, one count per outcome, and the success rate in percent.

    ``counts`` maps result columns to outcome labels.
    """
    successful = F.count_if(F.col(outcome).isin(*success))
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("registered_students"),
        *[F.count_if(F.col(outcome) == label).alias(name) for name, label in counts.items()],
        successful.alias("successful_students"),
        pct(successful, F.count(F.lit(1))).cast("decimal(5,2)").alias("successful_completion_rate_pct"),
    )


def performance(
    parent: DataFrame,
    child: DataFrame,
    key: str,
    groups: Sequence[str],
    score: str,
    flag: str,
    how: str = "left",
) -> DataFrame:
    """Per group of ``parent``: submissions, missing scores, mean score, flagged percent.

    Results are totalled per ``key`` first, so the join handles one row per
    assessment. ``how="left"`` keeps groups without submissions (0, null mean);
    ``how="inner"`` leaves them out.
    """
    per_key = child.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(score).alias("_scored"),
        F.sum(score).alias("_score"),
        F.count(flag).alias("_flags"),
        F.sum(flag).alias("_flagged"),
    )
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return (
        parent.select(key, *groups)
        .join(per_key, key, how)
        .groupBy(*groups)
        .agg(
            total("_rows").alias("submissions"),
            (total("_rows") - total("_scored")).alias("missing_scores"),
            rounded_ratio(F.sum("_score").cast("decimal(28,4)"), F.sum("_scored")).cast("decimal(5,2)").alias("average_score"),
            pct(F.sum("_flagged"), F.sum("_flags")).cast("decimal(5,2)").alias("banked_result_rate_pct"),
        )
    )


def engagement_mart(
    registrations: DataFrame,
    clicks: DataFrame,
    marks: DataFrame,
    keys: Sequence[str],
    labels: Sequence[str],
    measure: str,
    day: str,
    resource: str,
    score: str,
    totals: DataFrame | None = None,
) -> DataFrame:
    """One row per registration with its click and mark totals.

    Clicks and marks are totalled by ``keys`` before the joins; the joins then
    use the partitioning of those totals. ``totals`` is a stored result of
    ``engagement``, which saves going through the clicks again. Missing totals
    are 0, a missing mean score stays null.
    """
    keys = list(keys)
    if totals is None:
        totals = engagement(clicks, keys, measure, day, resource, day_span=False)
    used = totals.select(*keys, "total_clicks", "active_days", F.col("distinct_resources").alias("resources_used"))
    marked = marks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("assessment_submissions"),
        rounded_mean(score).cast("decimal(5,2)").alias("average_score"),
    )
    zeros = ["total_clicks", "active_days", "resources_used", "assessment_submissions"]
    return (
        registrations.select(*keys, *labels)
        .join(used, keys, "left")
        .join(marked, keys, "left")
        .select(*keys, *labels, *[F.coalesce(c, F.lit(0)).alias(c) for c in zeros], "average_score")
    )


def engagement_by_result(mart: DataFrame, outcome: str, with_score: bool = True) -> DataFrame:
    """Means over the registrations of each outcome.

    The mean score is the mean of the already rounded per-registration means.
    """
    means = {
        "average_total_clicks": rounded_mean("total_clicks").cast("decimal(12,2)"),
        "average_active_days": rounded_mean("active_days").cast("decimal(8,2)"),
        "average_resources_used": rounded_mean("resources_used").cast("decimal(8,2)"),
    }
    if with_score:
        means["average_assessment_submissions"] = rounded_mean("assessment_submissions").cast("decimal(8,2)")
        means["average_score"] = rounded_mean("average_score").cast("decimal(5,2)")
    return mart.groupBy(outcome).agg(
        F.count(F.lit(1)).alias("registrations"), *[c.alias(name) for name, c in means.items()]
    )


def availability(df: DataFrame, groups: Sequence[str], start: str, end: str) -> DataFrame:
    """Per group: resources, those lacking a week, earliest and latest week."""
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("resources"),
        F.count_if(F.col(start).isNull() | F.col(end).isNull()).alias("resources_missing_week_information"),
        F.min(start).alias("earliest_week"),
        F.max(end).alias("latest_week"),
    )


def string_list(
    df: DataFrame,
    keys: Sequence[str],
    value: Column | str,
    name: str,
    sep: str = ", ",
    order: Column | str | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Per key, the values as one text, in order of ``order`` and then of the value.

    With ``distinct``, equal values of a key stand once, in the place of the
    first, and are made one before they are gathered. Nulls are left out. A
    result row holds all the values of its key, so its size is that of the list.
    """
    value = F.col(value) if isinstance(value, str) else value
    place = F.lit(0) if order is None else F.col(order) if isinstance(order, str) else order
    entries = df.select(*keys, value.alias("_value"), place.alias("_place"))
    if distinct:
        entries = entries.groupBy(*keys, "_value").agg(F.min("_place").alias("_place"))
    entry = F.struct("_place", "_value")
    listed = F.sort_array(F.collect_list(F.when(F.col("_value").isNotNull(), entry)))
    texts = F.transform(listed, lambda e: e["_value"].cast("string"))
    joined = F.when(F.size(texts) > 0, F.array_join(texts, sep))
    return entries.groupBy(*keys).agg(joined.alias(name))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "number_of_records") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def count_report(tables: Mapping[str, DataFrame], expected: DataFrame | None = None) -> DataFrame:
    """One row per table with its row count, and the difference from an expected
    count if ``expected`` (table_name, expected_rows) is given."""
    counts = union_all(
        [row_count(df).select(F.lit(name).alias("table_name"), "total_rows") for name, df in tables.items()]
    )
    if expected is None:
        return counts
    return counts.join(expected, "table_name", "left").withColumn(
        "difference", F.col("total_rows") - F.col("expected_rows")
    )


def count_difference(a: DataFrame, b: DataFrame, name: str = "difference") -> DataFrame:
    """Rows of ``a`` minus rows of ``b``, as one row."""
    signed = row_count(a, "n").unionByName(row_count(b, "n").select((-F.col("n")).alias("n")))
    return signed.agg(F.sum("n").alias(name))
