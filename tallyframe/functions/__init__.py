"""Column expressions: text cleaning, numbers, categories, predicates."""

from tallyframe.functions.numbers import (  # noqa: F401
    day_gap,
    pct,
    rounded_mean,
    rounded_ratio,
    week_floor,
    week_trunc,
)
from tallyframe.functions.text import (  # noqa: F401
    MISSING_MARKERS,
    bad_format,
    coded,
    composite,
    is_missing,
    is_present,
    null_markers,
    presentation_term,
    presentation_year,
    standardise,
    to_decimal,
    to_int,
)
