"""Profiles of raw tables: gaps, ranges, categories, consistency, statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import is_missing, is_present, null_markers
from tallyframe.operators.selection import exact_medians
from tallyframe.sources.generated import literal_rows


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of missing values of each column, in one scan."""
    return df.agg(*[F.count_if(is_missing(c)).alias(f"missing_{c}") for c in columns])


def unparsable(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One row per text column: present values that cannot be cast to its type, in one scan."""
    counted = df.agg(
        *[F.count_if(is_present(c) & null_markers(c).try_cast(kind).isNull()).alias(c) for c, kind in columns.items()]
    )
    return counted.unpivot([], list(columns), "column_name", "unparsable_values")


def numeric_profile(df: DataFrame, measures: Mapping[str, Column], groups: Sequence[str] = ()) -> DataFrame:
    """Any set of named aggregates over cast text, in one scan."""
    return df.groupBy(*groups).agg(*[c.alias(name) for name, c in measures.items()])


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Category counts of several text columns, stacked, in one scan."""
    return (
        df.unpivot([], list(columns), "column_name", "category")
        .groupBy("column_name", "category")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def consistency(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Per attribute, how many entities have more than one recorded value.

    An entity has several values exactly if its least and greatest differ, which
    needs no distinct counts.
    """
    per_entity = df.groupBy(key).agg(
        *[(F.min(F.trim(F.col(a))) < F.max(F.trim(F.col(a)))).alias(a) for a in attributes]
    )
    return per_entity.agg(*[F.count_if(F.col(a)).alias(f"inconsistent_{a}") for a in attributes])


def varying_entities(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """Entities with more than one recorded value of an attribute."""
    return df.groupBy(key).agg(F.min(attribute).alias("_lo"), F.max(attribute).alias("_hi")).where("_lo < _hi").select(key)


def column_stats(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """One row per column: centre, spread, range and missing values.

    Numbers get mean, median, most frequent value (the least one of several) and
    coefficient of variation; categories get the most frequent label and the
    entropy of the label counts. One scan gives the moments, some more the medians
    (``operators/selection.py``), and one the value counts of all columns, which are
    summed up as they come and neither stored nor sorted. ``df`` must give the same
    rows each time it is read.
    """
    rows = []
    if numeric:
        doubles = df.select(*[F.col(c).cast("double").alias(c) for c in numeric])
        moments = doubles.agg(
            *[
                F.struct(
                    F.avg(c).alias("mean"),
                    F.try_divide(F.stddev_pop(c), F.avg(c)).alias("dispersion"),
                    F.min(c).alias("min"),
                    F.max(c).alias("max"),
                    F.count(c).alias("present"),
                    F.count_if(F.col(c).isNull()).alias("missing"),
                ).alias(c)
                for c in numeric
            ]
        ).first()
        medians = exact_medians(doubles, {c: moments[c].present for c in numeric})
        for c in numeric:
            m = moments[c]
            rows.append((c, "numeric", m.mean, medians[c], m.dispersion, m.min, m.max, m.missing))
    rows += [(c, "category", None, None, None, None, None, None) for c in categorical]
    known = literal_rows(
        df.sparkSession,
        rows,
        "column_name string, kind string, mean double, median double, _dispersion double, min double, max double, _missing bigint",
    )
    present = F.coalesce(F.col("value").isNotNull() | F.col("category").isNotNull(), F.lit(False))
    n = F.when(present, F.col("n"))
    summary = _value_counts(df, numeric, categorical).groupBy("column_name").agg(
        (F.log(F.sum(n)) - F.sum(n * F.log(n)) / F.sum(n)).alias("_entropy"),
        F.min(F.when(present, F.struct((-F.col("n")).alias("less"), "value", "category"))).alias("_top"),
        F.sum(F.when(~present, F.col("n"))).alias("_absent"),
    )
    is_category = F.col("kind") == "category"
    return known.join(summary, "column_name", "left").select(
        "column_name", "kind", "mean", "median", F.col("_top.value").alias("mode"), F.col("_top.category").alias("mode_label"),
        F.when(is_category, F.col("_entropy")).otherwise(F.col("_dispersion")).alias("dispersion"), "min", "max",
        F.coalesce("_missing", "_absent", F.lit(0)).alias("missing"),
    )


def _value_counts(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Rows per column and value; a number stands in ``value``, a label in ``category``."""
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    cell = lambda c, v, k: F.struct(F.lit(c).alias("column_name"), v.alias("value"), k.alias("category"))
    cells = [cell(c, F.col(c).cast("double"), text) for c in numeric]
    cells += [cell(c, none, F.col(c).cast("string")) for c in categorical]
    stacked = df.select(F.inline(F.array(*cells)))
    if numeric:
        stacked = stacked.where(~F.col("column_name").isin(*numeric) | F.col("value").isNotNull())
    return stacked.groupBy("column_name", "value", "category").agg(F.count(F.lit(1)).alias("n"))
