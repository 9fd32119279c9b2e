"""CSV and generated sources, header preflight and count gates."""

from tallyframe.sources.files import (  # noqa: F401
    MALFORMED,
    CountMismatch,
    assert_counts,
    load_staging,
    preflight,
    preview,
    read_csv,
)
from tallyframe.sources.generated import day_range, literal_rows  # noqa: F401
