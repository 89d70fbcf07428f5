from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidelog.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", 4,
        {"spark.ui.enabled": "false", "spark.driver.memory": "6g",
         "spark.sql.streaming.metricsEnabled": "false"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def at(seconds: float) -> datetime:
    """Instant so many seconds after a fixed start."""
    return datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=seconds)


def rows(df, *columns):
    """Sorted tuples of the chosen columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def spread(spark, path: str, frames) -> None:
    """Write one file per frame, so that a stream reads them one after another."""
    for n, df in enumerate(frames):
        df.coalesce(1).write.mode("append").parquet(path)
