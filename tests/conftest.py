"""Shared fixtures: one local session per test run, sample bars."""

from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
for place in (HERE, HERE.parent):
    if str(place) not in sys.path:
        sys.path.insert(0, str(place))

from bars import BARS_CSV  # noqa: E402

from tickhouse.session import build_session  # noqa: E402

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        4,
        app_name="tickhouse-tests",
        extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample_csv_path(tmp_path_factory) -> str:
    d = tmp_path_factory.mktemp("sample")
    p = d / "daily_prices.csv"
    p.write_text(BARS_CSV)
    return str(p)


@pytest.fixture(scope="session")
def sample_bars(spark, sample_csv_path):
    """Sample bars with one load time."""
    from pyspark.sql import functions as F

    from tickhouse.sources.files import read_prices_csv

    df = read_prices_csv(spark, sample_csv_path)
    return df.withColumn(
        "ingested_at", F.lit(dt.datetime(2023, 3, 10)).cast("timestamp")
    )

