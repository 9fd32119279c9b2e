"""Declared rules (null, unique, reference, check) and reports over them.

Rules are queries, not constraints: a report counts violations, a gate raises
on them, and ``violations`` returns the rows themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.aggregates import duplicate_keys
from tallyframe.operators.joins import orphans, union_all
from tallyframe.operators.references import KeySet, key_set, marked
from tallyframe.session import materialise


class QualityError(RuntimeError):
    """A gate found failing checks."""


@dataclass(frozen=True)
class NotNull:
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"not null: {', '.join(self.columns)}"

    @property
    def broken(self) -> Column:
        broken = F.lit(False)
        for c in self.columns:
            broken = broken | F.col(c).isNull()
        return broken


@dataclass(frozen=True)
class Check:
    """A condition in SQL. A null outcome passes, as for SQL constraints."""

    name: str
    condition: str

    @property
    def broken(self) -> Column:
        return ~F.coalesce(F.expr(self.condition), F.lit(True))


@dataclass(frozen=True)
class Unique:
    keys: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"unique: {', '.join(self.keys)}"


@dataclass(frozen=True)
class ForeignKey:
    """``keys`` must exist in ``parent``; a key with a null part is not tested."""

    keys: tuple[str, ...]
    parent: str
    parent_keys: tuple[str, ...] | None = None

    @property
    def name(self) -> str:
        return f"reference: {', '.join(self.keys)} in {self.parent}"


Rule = NotNull | Check | Unique | ForeignKey


def one_of(column: str, values: Iterable[str]) -> str:
    """The condition that a column holds one of the given labels."""
    quoted = ("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return f"{column} IN ({', '.join(quoted)})"


def parent_keys(rule: ForeignKey, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The parent's keys under the child's column names."""
    pairs = zip(rule.parent_keys or rule.keys, rule.keys, strict=True)
    return tables[rule.parent].select(*[F.col(p).alias(k) for p, k in pairs])


def violations(df: DataFrame, rule: Rule, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows (for ``Unique``: the keys with their counts) that break a rule."""
    if isinstance(rule, Unique):
        return duplicate_keys(df, rule.keys)
    if isinstance(rule, ForeignKey):
        return orphans(df.dropna(subset=list(rule.keys)), parent_keys(rule, tables or {}), rule.keys)
    return df.where(rule.broken)


def surplus_rows(df: DataFrame, keys: Sequence[str], digest: Column | None = None) -> DataFrame:
    """Rows beyond the first of each key, as one row, with 8 bytes of each key shuffled.

    Keys are counted by a 64-bit hash (``digest``, if given). Rows whose hash
    occurs more than once, and only those, are counted again by the keys
    themselves, so that different keys of one hash are told apart.
    """
    hashed = df.select(*keys, (F.xxhash64(*keys) if digest is None else digest).alias("_hash"))
    several = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    suspects = hashed.join(materialise(several, "hashes"), "_hash", "left_semi")
    per_key = suspects.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("violations"))


def _surplus(df: DataFrame, rule: Unique, clustered: Sequence[str]) -> DataFrame:
    """Grouped in place where the table is clustered by some of the keys or has one key column, else by hashes."""
    if len(rule.keys) > 1 and not (clustered and set(clustered) <= set(rule.keys)):
        return surplus_rows(df, rule.keys)
    per_key = df.groupBy(*rule.keys).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("violations"))


def rule_report(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, Sequence[Rule]],
    clustered: Mapping[str, Sequence[str]] | None = None,
    also: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """One row per rule with its number of violating rows.

    All null, check and reference rules of a table share one scan, to which the
    parents' key sets are joined. Keys are counted for uniqueness without a
    shuffle of the rows where ``clustered`` names columns that the table is
    stored clustered by. ``also`` has further conditions (SQL) to count in the
    same scan, by table and name; in them ``in_<parent>`` says whether a row's
    key is in that parent, and is null if a part of the key is.
    """
    parts = []
    sets: dict[tuple, KeySet] = {}
    for table, table_rules in rules.items():
        df = tables[table]
        counts = {r.name: r.broken for r in table_rules if isinstance(r, NotNull | Check)}
        joined = {}
        for rule in table_rules:
            if isinstance(rule, ForeignKey):
                wanted = (rule.parent, rule.parent_keys or rule.keys, rule.keys)
                if wanted not in sets:
                    sets[wanted] = key_set(parent_keys(rule, tables), rule.keys)
                joined[f"in_{rule.parent}"] = sets[wanted]
                counts[rule.name] = F.col(f"in_{rule.parent}") == F.lit(False)
        counts |= {name: F.expr(condition) for name, condition in (also or {}).get(table, {}).items()}
        if counts:
            counted = marked(df, joined).agg(*[F.count_if(c).alias(f"r{i}") for i, c in enumerate(counts.values())])
            lines = [
                F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
                for i, name in enumerate(counts)
            ]
            parts.append(counted.select(F.inline(F.array(*lines))))
        for rule in table_rules:
            if isinstance(rule, Unique):
                surplus = _surplus(df, rule, (clustered or {}).get(table, ()))
                parts.append(surplus.select(F.lit(table).alias("table_name"), F.lit(rule.name).alias("rule"), "violations"))
    return union_all(parts)


@dataclass(frozen=True)
class ReportLine:
    """One line of a quality report.

    ``value`` is an aggregate over the table; ``frame`` a one-row, one-column
    DataFrame for values that need grouping or a join. An exact line passes when
    the value equals ``expected``; with ``expected=None`` and ``exact`` the
    expectation is looked up by table and check name. An inexact line informs.
    """

    layer: str
    table: str
    check: str
    interpretation: str
    value: Column | None = None
    frame: DataFrame | None = None
    expected: int | None = None
    exact: bool = True


def exact_check(layer, table, check, interpretation, expected=0, value=None, frame=None) -> ReportLine:
    return ReportLine(layer, table, check, interpretation, value, frame, expected)


def info_check(layer, table, check, interpretation, value=None, frame=None) -> ReportLine:
    return ReportLine(layer, table, check, interpretation, value, frame, exact=False)


def _line_struct(order: int, line: ReportLine, observed: Column) -> Column:
    return F.struct(
        F.lit(order).alias("check_order"),
        F.lit(line.layer).alias("layer"),
        F.lit(line.table).alias("table_name"),
        F.lit(line.check).alias("check_name"),
        F.coalesce(observed.cast("bigint"), F.lit(0)).alias("observed"),
        F.lit(line.expected).cast("bigint").alias("expected"),
        F.lit(line.exact).alias("exact"),
        F.lit(line.interpretation).alias("interpretation"),
    )


def quality_report(
    tables: Mapping[str, DataFrame], lines: Sequence[ReportLine], expectations: DataFrame | None = None
) -> DataFrame:
    """Evaluate report lines: status PASS, FAIL or INFO per line.

    Lines with ``value`` share one scan per table. ``expectations`` (table_name,
    check_name, expected_value) supplies counts not fixed in the lines. A null
    observation counts as 0.
    """
    by_table: dict[str, list[tuple[int, ReportLine]]] = {}
    parts = []
    for order, line in enumerate(lines, start=1):
        if line.frame is None:
            by_table.setdefault(line.table, []).append((order, line))
        else:
            observed = F.col(line.frame.columns[0])
            parts.append(line.frame.select(_line_struct(order, line, observed).alias("line")).select("line.*"))
    for table, numbered in by_table.items():
        scanned = tables[table].agg(*[line.value.alias(f"c{order}") for order, line in numbered])
        structs = [_line_struct(order, line, F.col(f"c{order}")) for order, line in numbered]
        parts.append(scanned.select(F.inline(F.array(*structs))))
    result = union_all(parts)
    if expectations is not None:
        result = (
            result.join(expectations, ["table_name", "check_name"], "left")
            .withColumn("expected", F.coalesce("expected", "expected_value"))
            .drop("expected_value")
        )
    known = F.col("exact") & F.col("expected").isNotNull()
    return result.select(
        "check_order",
        "layer",
        "table_name",
        "check_name",
        F.col("observed").cast("string").alias("observed_value"),
        F.when(known, F.concat(F.lit("Exactly "), F.col("expected").cast("string")))
        .otherwise("Documented source characteristic")
        .alias("expectation"),
        F.when(~known, "INFO")
        .when(F.col("observed") == F.col("expected"), "PASS")
        .otherwise("FAIL")
        .alias("status"),
        "interpretation",
    )


def gate(report: DataFrame) -> None:
    """Raise if a report line failed, naming the failing checks."""
    failed = report.where("status = 'FAIL'").orderBy("check_order").collect()  # at most one row per line
    if failed:
        raise QualityError(
            "; ".join(f"{r.table_name}: {r.check_name} is {r.observed_value} ({r.expectation})" for r in failed)
        )
