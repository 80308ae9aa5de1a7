import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidewater.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.streaming.metricsEnabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A fresh folder per test; left behind for inspection."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def rows(df, *columns):
    """Sorted tuples of the given columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
