from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from opslog.session import build_session  # noqa: E402

DATA = os.environ.get("OPSLOG_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "opslog-tests",
        "local[*]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


def rows(df, *cols):
    """Rows as sorted tuples."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
