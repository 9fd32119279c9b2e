"""Text cleaning, format tests and category codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for a missing value once trimmed.
MISSING_MARKERS = ("", "?")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_markers(c: Column | str, markers: Sequence[str] = MISSING_MARKERS) -> Column:
    """Trimmed text, with missing-value markers turned into null."""
    text = F.trim(_col(c))
    return F.when(~text.isin(*markers), text)


def is_missing(c: Column | str, markers: Sequence[str] = MISSING_MARKERS) -> Column:
    """True for null, blank and marker text; never null."""
    return null_markers(c, markers).isNull()


def is_present(c: Column | str, markers: Sequence[str] = MISSING_MARKERS) -> Column:
    return null_markers(c, markers).isNotNull()


def to_int(c: Column | str) -> Column:
    """Whole number from text. Markers and text that is no number become null."""
    return null_markers(c).try_cast("bigint")


def to_decimal(c: Column | str, precision: int = 5, scale: int = 2) -> Column:
    return null_markers(c).try_cast(f"decimal({precision},{scale})")


def standardise(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Trimmed label with the variants in ``mapping`` replaced, markers as null."""
    label = null_markers(c)
    result = label
    for variant, standard in mapping.items():
        result = F.when(label == variant, F.lit(standard)).otherwise(result)
    return result


def bad_format(c: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    """True where the trimmed text does not match the pattern."""
    return ~F.trim(_col(c)).rlike(f"(?i){pattern}" if ignore_case else pattern)


def composite(*parts: Column | str, sep: str = "-") -> Column:
    """Joined label; null when any part is null."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(_col(part))
    return F.concat(*pieces)


def coded(c: Column | str, codes: Mapping[str, object], default: object = None) -> Column:
    """Code of a category, ``default`` for a label outside ``codes``."""
    label, result = _col(c), F.lit(default)
    for name, code in codes.items():
        result = F.when(label == name, F.lit(code)).otherwise(result)
    return result


def presentation_year(c: Column | str) -> Column:
    return F.left(_col(c), F.lit(4)).try_cast("int")


def presentation_term(c: Column | str) -> Column:
    return F.right(_col(c), F.lit(1))
