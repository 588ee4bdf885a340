"""Indicators in slices and from buckets equal those of whole histories."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tickhouse.operators.indicators import fact_daily_performance, price_indicators
from tickhouse.operators.intervals import LEAD
from tickhouse.operators.slices import placed, sliced, sliced_indicators
from tickhouse.operators.staging import clean_staging
from tickhouse.sources.bucketed import BucketedBars

SCHEMA = (
    "symbol string, date date, open double, high double, low double, close double, "
    "volume bigint, ingested_at timestamp"
)
DAY0 = dt.date(1998, 11, 2)
NAMES = [("KOPA", 700, 1), ("LIND", 130, 5), ("MURR", 1, 1), (None, 60, 2)]


def bar(symbol, day, when=0):
    close = 20 + (day * 37 % 101) / 8 + day / 64
    date = None if day is None else DAY0 + dt.timedelta(days=day)
    return (symbol, date, close, close + 1, close - 0.5, close, 1000 + day * 13 % 700,
            dt.datetime(2025, 1, 1) + dt.timedelta(hours=when))


def content(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def raw(spark):
    rows = [bar(s, i * gap) for s, n, gap in NAMES for i in range(n)]
    rows += [bar("KOPA", i, 1) for i in range(0, 700, 9)]  # loaded again
    rows.append(("LIND", None, 9.0, 9.5, 8.0, 9.0, 5, dt.datetime(2025, 1, 2)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(("rows", "days"), [(1, 7), (10, 40), (50, 365), (4096, 4096)])
def test_slices_equal_whole_histories(raw, rows, days):
    stg = clean_staging(raw)
    assert content(sliced_indicators(stg, rows, days)) == content(price_indicators(stg))


def test_places_number_a_history(raw):
    stg = clean_staging(raw)
    found = {}
    for r in placed(stg, 30).select("symbol", "trade_date", "place").collect():
        found.setdefault(r.symbol, []).append((r.place, r.trade_date or dt.date.max))
    assert {s: len(v) for s, v in found.items()} == {"KOPA": 700, "LIND": 131, "MURR": 1, None: 60}
    for places in found.values():
        assert [p for p, _ in sorted(places)] == list(range(len(places)))
        dates = [d for _, d in sorted(places)]
        assert dates == sorted(dates)


def test_no_task_holds_more_than_a_slice_and_its_lead(raw):
    rows = 100
    parts = sliced(placed(clean_staging(raw), 30), rows)
    sizes = parts.groupBy("symbol", "slice").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("own").alias("own")
    )
    top = sizes.agg(F.max("n"), F.max("own"), F.sum("own")).first()
    assert top[0] == rows + LEAD and top[1] == rows and top[2] == 892
    plan = sliced_indicators(clean_staging(raw), rows, 30)._jdf.queryExecution().toString()
    windows = [line for line in plan.split("== Physical")[1].splitlines() if "Window [" in line]
    # what orders rows by date is a slice or a block, never a whole symbol
    dated = [w for w in windows if "trade_date" in w and "LAST" in w]
    assert dated and all("slice#" in w or "block#" in w for w in dated)


def test_slices_of_nothing(raw):
    stg = clean_staging(raw.limit(0))
    assert sliced_indicators(stg).collect() == []
    with pytest.raises(ValueError, match="one row"):
        sliced_indicators(stg, rows=0)


def bucketed(spark, tmp_path):
    return BucketedBars(spark, f"bars_{uuid.uuid4().hex[:8]}", str(tmp_path / "bars"))


def test_the_fact_mart_of_buckets_needs_no_exchange(spark, raw, tmp_path):
    bars = bucketed(spark, tmp_path)
    assert bars.write(raw, buckets=4) == 4
    fact = bars.fact(updated_at=False)
    whole = fact_daily_performance(price_indicators(clean_staging(raw)), updated_at=False)
    assert content(fact) == content(whole)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan
    # the write is a replacement, also by fewer rows and of another number of buckets
    assert bars.write(raw.where("symbol = 'MURR'"), buckets=2) == 2
    assert bars.read().count() == 1


def test_buckets_follow_from_the_rows(spark, raw, tmp_path, monkeypatch):
    monkeypatch.setattr("tickhouse.sources.bucketed.BUCKET_ROWS", 300)
    bars = bucketed(spark, tmp_path)
    assert bars.write(raw) == 3  # 892 bars after the dedup
    assert content(bars.staging()) == content(clean_staging(raw))
    assert bars.write(raw.limit(0)) == 1 and bars.fact(updated_at=False).collect() == []
