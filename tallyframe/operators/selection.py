"""Exact order statistics by selection.

A value of a wanted rank is closed in by brackets: an approximate quantile sketch
proposes two values near the rank, and a counting pass says exactly how many rows
lie below, at, between and above them. Either a proposed value has the rank, or the
part that holds it is the next, much smaller bracket. Counts come to the driver, a
few numbers per wanted rank; no rows are sorted, stored or shuffled until a bracket
holds at most ``few`` of them. Any ties and skew are right, as all counts are exact.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Accuracy of the sketch: its ranks are off by one row in so many.
ACCURACY = 10_000
#: Rows of a bracket that one task may sort.
FEW_ROWS = 1_000_000


@dataclass(frozen=True)
class Bracket:
    """The wanted value is number ``rank`` of the ``rows`` values of a column strictly between ``low`` and ``high``."""

    column: str
    rank: int
    rows: int
    low: float | None = None
    high: float | None = None

    def inside(self) -> Column:
        """The value where it lies in the bracket, else null."""
        value = F.col(f"`{self.column}`").cast("double")
        holds = value.isNotNull()
        if self.low is not None:
            holds = holds & (value > self.low)
        if self.high is not None:
            holds = holds & (value < self.high)
        return F.when(holds, value)


def _proposed(df: DataFrame, brackets: list[Bracket], accuracy: int) -> list[list[float]]:
    """Two values of each bracket, most likely one on either side of its rank.

    Ranks are taken in steps, so that neighbours in one bracket share a sketch and the counts.
    """
    sketches = []
    for k, b in enumerate(brackets):
        step = b.rank * accuracy // b.rows
        near = [max(0, step - 2) / accuracy, min(accuracy, step + 3) / accuracy]
        sketches.append(F.percentile_approx(b.inside(), near, accuracy).alias(f"s{k}"))
    return list(df.agg(*sketches).first())


def _narrowed(df: DataFrame, brackets: list[Bracket], proposed: list[list[float]]) -> list[Bracket | float]:
    """The part of each bracket that holds the rank: one of the proposed values, or a bracket beside or between them."""
    counts = []
    for k, (b, (low, high)) in enumerate(zip(brackets, proposed, strict=True)):
        value = b.inside()
        tests = [value < low, value == low, (value > low) & (value < high), (value == high) & (value > low)]
        counts.append(F.array(*[F.count_if(t) for t in tests]).alias(f"n{k}"))
    out: list[Bracket | float] = []
    for b, (low, high), (below, at_low, between, at_high) in zip(brackets, proposed, df.agg(*counts).first(), strict=True):
        above = b.rows - below - at_low - between - at_high
        rank, found = b.rank, None
        for rows, part in (
            (below, replace(b, high=low)), (at_low, low), (between, replace(b, low=low, high=high)), (at_high, high), (above, replace(b, low=high)),
        ):
            if found is None and rank <= rows:
                found = replace(part, rank=rank, rows=rows) if isinstance(part, Bracket) else part
            rank -= rows
        out.append(found)
    return out


def _picked(df: DataFrame, brackets: list[Bracket]) -> list[float]:
    """The wanted values of brackets of few rows, by counts of their different values."""
    places = {place: k for k, place in enumerate(dict.fromkeys((b.column, b.low, b.high) for b in brackets))}
    parts = {places[b.column, b.low, b.high]: b for b in brackets}
    cells = F.array(*[F.struct(F.lit(k).alias("part"), b.inside().alias("value")) for k, b in sorted(parts.items())])
    counts = df.select(F.inline(cells)).where("value IS NOT NULL").groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    reached = [
        F.min(F.when((F.col("part") == places[b.column, b.low, b.high]) & (F.col("upto") >= b.rank), F.col("value"))).alias(f"v{k}")
        for k, b in enumerate(brackets)
    ]
    return list(counts.withColumn("upto", F.sum("n").over(upto)).agg(*reached).first())


def select_ranks(
    df: DataFrame, wanted: Mapping[object, Bracket], few: int = FEW_ROWS, accuracy: int = ACCURACY
) -> dict[object, float]:
    """The value of each wanted rank. ``df`` must give the same rows each time it is read.

    Each round reads the columns twice and leaves some thousandth of a bracket.
    """
    found: dict[object, float] = {}
    open_ = dict(wanted)
    while large := {k: b for k, b in open_.items() if b.rows > few}:
        brackets = list(large.values())
        for k, part in zip(large, _narrowed(df, brackets, _proposed(df, brackets, accuracy)), strict=True):
            if isinstance(part, Bracket):
                open_[k] = part
            else:
                found[k] = part
                del open_[k]
    if open_:
        found |= zip(open_, _picked(df, list(open_.values())), strict=True)
    return found


def exact_medians(df: DataFrame, rows: Mapping[str, int], few: int = FEW_ROWS, accuracy: int = ACCURACY) -> dict[str, float | None]:
    """Median of each column; ``rows`` are its non-null values. Null for a column without values."""
    wanted = {(c, r): Bracket(c, r, n) for c, n in rows.items() for r in {(n + 1) // 2, n // 2 + 1} if n}
    values = select_ranks(df, wanted, few, accuracy)
    return {c: (values[c, (n + 1) // 2] + values[c, n // 2 + 1]) / 2 if n else None for c, n in rows.items()}
