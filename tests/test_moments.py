"""Gold from mergeable moments: equal to the summary of Silver, exact where sums would not be."""

from __future__ import annotations

import datetime as dt
import statistics

import pytest

from tickhouse.operators.medallion import gold_daily_summary
from tickhouse.operators.moments import month_moments, summary_of_moments
from tickhouse.plans.monthly import MonthLayers

SCHEMA = "symbol string, date date, open double, high double, low double, close double, volume bigint"
DAY = dt.date(2024, 1, 1)


def bars(symbol, closes, step=11):
    return [(symbol, DAY + dt.timedelta(days=step * i), c, c + 1, c - 1, c, 3 * i)
            for i, c in enumerate(closes)]


def rows(df):
    return {r.symbol: r.asDict() for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for symbol, row in want.items():
        for name, value in row.items():
            assert got[symbol][name] == (
                pytest.approx(value, rel=1e-9) if isinstance(value, float) else value
            ), (symbol, name)


def test_equal_to_the_summary_of_silver(spark):
    silver = spark.createDataFrame(
        bars("A", [3.25, 4.5, 1.0625, 9.0, 2.5, 2.75, 8.125]) + bars("B", [7.0])
        + bars(None, [1.0, 2.0]) + [("A", None, 5.0, 50.0, 0.5, 6.0, 4)]
        + [("C", DAY, 1.0, 2.0, 0.5, None, None)],
        SCHEMA,
    )
    got = summary_of_moments(month_moments(silver))
    want = gold_daily_summary(silver)
    assert got.dtypes == want.dtypes
    same(rows(got), rows(want))


def test_small_spread_around_a_large_price(spark):
    closes = [98765432.1 + k / 10000 for k in (0, 1, 1, 2, 5, 3, 2, 0, 1)]
    got = rows(summary_of_moments(month_moments(spark.createDataFrame(bars("A", closes), SCHEMA))))
    mean = statistics.fmean(closes)
    two_pass = (sum((c - mean) ** 2 for c in closes) / (len(closes) - 1)) ** 0.5
    exact = statistics.stdev([0, 1, 1, 2, 5, 3, 2, 0, 1]) / 10000
    assert got["A"]["std_close"] == pytest.approx(exact, rel=1e-12)
    assert got["A"]["std_close"] == pytest.approx(two_pass, rel=1e-3)
    squares = sum(c * c for c in closes) / len(closes) - mean * mean  # what doubles would give
    assert squares != pytest.approx(exact**2, rel=0.5)


def test_no_rows(spark):
    empty = month_moments(spark.createDataFrame([], SCHEMA))
    assert summary_of_moments(empty).count() == 0


def test_a_corrected_month_is_replaced_and_others_stay(spark, tmp_path):
    layers = MonthLayers(spark, str(tmp_path))
    full = SCHEMA + ", ingested_at timestamp"

    def load(data, hour):
        when = dt.datetime(2025, 1, 1, hour)
        frame = spark.createDataFrame([(*b, when) for b in data], full)
        months = layers.load_bars(frame, loaded_at=when, source_file="x")
        layers.refresh_silver(months)
        layers.refresh_moments(months)
        same(rows(layers.gold()), rows(gold_daily_summary(layers.silver.read())))

    load(bars("A", [3.0, 4.0, 5.0, 6.0, 7.0, 8.0]) + bars("B", [1.0, 2.0, 3.0]), 1)
    january, february = layers.moments.files(202401), layers.moments.files(202402)
    # the newest bar of February goes, the earlier one is corrected
    date = [b[1] for b in bars("A", [0] * 6) if b[1].month == 2]
    load([("A", date[-1], -1.0, 1.0, 1.0, 1.0, 5), ("A", date[0], 2.0, 40.0, 1.0, 2.0, 5)], 2)
    assert layers.moments.files(202401) == january
    assert layers.moments.files(202402) != february
    assert rows(layers.gold())["A"]["all_time_high"] == 40.0
