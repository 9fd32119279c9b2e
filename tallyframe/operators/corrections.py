"""Keyed corrections and inserts that are published only if they are valid.

A correction batch is itself a DataFrame. The original table is never changed:
each step returns the corrected table, so undoing one means using the original.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.aggregates import duplicate_keys, row_count
from tallyframe.operators.joins import orphan_counts, orphans, spread, union_all
from tallyframe.operators.ordering import first_per_key
from tallyframe.operators.quality import Check, ForeignKey, NotNull, Rule, Unique, parent_keys


def _proposed(df: DataFrame, fixes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` with the fix's new values beside them and ``_hit`` set where one applies."""
    columns = [c for c in fixes.columns if c not in keys]
    renamed = fixes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    return df.join(renamed, list(keys), "left")


def _applied(proposed: DataFrame, columns: Sequence[str], fixed: Sequence[str], when: Column) -> DataFrame:
    return proposed.select(
        *[
            F.when(when, F.coalesce(f"_new_{c}", c)).otherwise(F.col(c)).alias(c) if c in fixed else F.col(c)
            for c in columns
        ]
    )


def apply_corrections(
    df: DataFrame, fixes: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()
) -> DataFrame:
    """Set the columns of ``fixes`` where its key matches; a null leaves the value.

    Of several fixes of a key, the first in ``order`` counts. ``order`` may use a
    column that the table lacks, such as a time stamp (descending: latest wins).
    """
    fixes = first_per_key(fixes, keys, order)  # so that a batch can never multiply rows
    fixed = [c for c in fixes.columns if c not in keys and c in df.columns]
    return _applied(_proposed(df, fixes.select(*keys, *fixed), keys), df.columns, fixed, F.col("_hit"))


def rows_corrected(df: DataFrame, fixes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows of ``df`` a batch matches."""
    hits = df.join(fixes.select(*keys), list(keys), "left_semi")
    return hits.agg(F.count(F.lit(1)).alias("rows_corrected"))


def _judged(
    df: DataFrame, fixes: DataFrame, keys: Sequence[str], checks: Sequence[Check | NotNull]
) -> DataFrame:
    """Every different fix that meets a row of ``df``, with a flag per rule that it would break there."""
    fixed = [c for c in fixes.columns if c not in keys and c in df.columns]
    extra = [c for c in fixes.columns if c not in df.columns]
    renamed = fixes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in [*fixed, *extra]])
    met = df.join(renamed, list(keys))
    changed = met.select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in fixed else F.col(c) for c in df.columns],
        *[F.col(f"_new_{c}") for c in [*fixed, *extra]],
    )
    flags = [F.max(rule.broken).alias(f"_broken_{i}") for i, rule in enumerate(checks)]
    grouped = changed.groupBy(*keys, *[f"_new_{c}" for c in [*fixed, *extra]])
    judged = grouped.agg(*flags, F.count(F.lit(1)).alias("_hits"))
    return judged.withColumnsRenamed({f"_new_{c}": c for c in [*fixed, *extra]}).select(
        *fixes.columns, *[f"_broken_{i}" for i in range(len(checks))]
    )


def apply_valid_corrections(
    df: DataFrame,
    fixes: DataFrame,
    keys: Sequence[str],
    checks: Sequence[Check | NotNull],
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """Apply the corrections whose result keeps every row rule; skip the others.

    Every fix is judged by itself. Of the valid ones of a key, the first in
    ``order`` counts; ``order`` may use a column that the table lacks.
    """
    judged = _judged(df, fixes, keys, checks)
    for i in range(len(checks)):
        judged = judged.where(~F.col(f"_broken_{i}"))
    return apply_corrections(df, judged.select(*fixes.columns), keys, order)


def rejected_corrections(
    df: DataFrame, fixes: DataFrame, keys: Sequence[str], checks: Sequence[Check | NotNull]
) -> DataFrame:
    """Corrections that would break a row rule, with the rule's name, one row per broken rule."""
    judged = _judged(df, fixes, keys, checks)
    names = F.array(*[F.when(F.col(f"_broken_{i}"), F.lit(rule.name)) for i, rule in enumerate(checks)])
    return judged.select(*fixes.columns, F.explode(F.array_compact(names)).alias("broken_rule"))


def _split(
    df: DataFrame, new: DataFrame, rules: Sequence[Rule], tables: Mapping[str, DataFrame] | None
) -> tuple[DataFrame, list[DataFrame]]:
    """The new rows that keep all rules, and those that break one, by the first rule broken.

    Rows are judged by values and parents first. Keys must be unused, and unique
    among the rows still standing then, so a bad row cannot take a good one with it.
    """
    accepted, rejected = new, []
    for rule in sorted(rules, key=lambda r: isinstance(r, Unique)):
        if isinstance(rule, Unique):
            taken = df.select(*rule.keys).unionByName(duplicate_keys(accepted, rule.keys).select(*rule.keys))
            bad, accepted = (accepted.join(taken, list(rule.keys), how) for how in ("left_semi", "left_anti"))
        elif isinstance(rule, ForeignKey):
            known = parent_keys(rule, tables or {})
            tested = F.lit(True)
            for c in rule.keys:
                tested = tested & F.col(c).isNotNull()
            bad = orphans(accepted.where(tested), known, rule.keys)
            accepted = accepted.where(~tested).unionByName(accepted.join(known, list(rule.keys), "left_semi"))
        else:
            bad, accepted = accepted.where(rule.broken), accepted.where(~rule.broken)
        rejected.append(bad.select(*new.columns, F.lit(rule.name).alias("broken_rule")))
    return accepted.select(*new.columns), rejected


def append_valid(
    df: DataFrame, new: DataFrame, rules: Sequence[Rule], tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Add the new rows that keep all rules: values, existing parents, then unused keys."""
    return df.unionByName(_split(df, new, rules, tables)[0])


def rejected_rows(
    df: DataFrame, new: DataFrame, rules: Sequence[Rule], tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The new rows that ``append_valid`` leaves out, with the first rule that each breaks."""
    return union_all(_split(df, new, rules, tables)[1])


def correction_evidence(before: DataFrame, after: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before and after, and rows whose key the source does not know."""
    counts = union_all(
        [
            row_count(before, "n").withColumn("side", F.lit("rows_before")),
            row_count(after, "n").withColumn("side", F.lit("rows_after")),
            orphan_counts(after, source, keys, name="n").withColumn("side", F.lit("rows_foreign_to_source")),
        ]
    )
    return spread(counts, "side", "n", ["rows_before", "rows_after", "rows_foreign_to_source"])
