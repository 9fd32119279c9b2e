import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyframe.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[*]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted by the given columns or as a whole."""
    if order:
        return [tuple(r) for r in df.orderBy(*order).collect()]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(df):
    """The only row, as a dict."""
    (row,) = df.collect()
    return row.asDict()
