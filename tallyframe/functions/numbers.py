"""Week numbers, exact rounding and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions.text import _col


def week_floor(day: Column | str) -> Column:
    """Week of a day offset, rounding down: day -3 lies in week -1."""
    return F.floor(_col(day) / F.lit(7))


def week_trunc(day: Column | str) -> Column:
    """Week of a day offset, rounding toward zero: day -3 lies in week 0."""
    return F.call_function("div", _col(day), F.lit(7))


def day_gap(later: Column | str, earlier: Column | str) -> Column:
    """Days from ``earlier`` to ``later``; null if either is unknown."""
    return _col(later) - _col(earlier)


def rounded_ratio(a: Column, b: Column, scale: int = 2) -> Column:
    """``a / b`` in decimal arithmetic, halves rounded away from zero.

    Takes whole numbers or decimals. Null when ``b`` is zero or null.
    """
    whole = "decimal(20,0)"
    return F.round(F.try_divide(a, b.cast(whole)), scale)


def rounded_mean(c: Column | str, scale: int = 2) -> Column:
    """Mean of a whole-number or decimal column, nulls skipped, exactly rounded."""
    c = _col(c)
    return rounded_ratio(F.sum(c).cast("decimal(28,4)"), F.count(c), scale)


def pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """``part`` as a percentage of ``whole``."""
    return rounded_ratio(part.cast("decimal(20,0)") * F.lit(100), whole, scale)
