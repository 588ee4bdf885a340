"""Layers in month folders: what a load touches, redoes and leaves alone."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickhouse.operators.indicators import fact_daily_performance, price_indicators
from tickhouse.operators.intervals import LEAD, redo_intervals
from tickhouse.operators.medallion import silver_frame
from tickhouse.operators.staging import clean_staging
from tickhouse.operators.weekly import weekly_performance
from tickhouse.plans.monthly import MonthLayers
from tickhouse.sources.months import MonthTable, months_in

SCHEMA = (
    "symbol string, date date, open double, high double, low double, close double, "
    "volume bigint, ingested_at timestamp"
)
DAY0 = dt.date(2024, 1, 1)


def bar(symbol, day, close, when):
    return (symbol, DAY0 + dt.timedelta(days=day), close, close + 1, close - 0.5, close,
            1000 + 7 * day, dt.datetime(2025, 1, 1) + dt.timedelta(hours=when))


def content(df, drop=("updated_at", "_silver_loaded_at", "_bronze_loaded_at")):
    columns = sorted(c for c in df.columns if c not in drop)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def expected(layers):
    bronze = layers.bronze.read()
    fact = fact_daily_performance(price_indicators(clean_staging(bronze)), updated_at=False)
    return content(silver_frame(bronze)), content(fact), content(weekly_performance(fact, grain="week"))


def found(layers):
    return content(layers.silver.read()), content(layers.fact.read()), content(layers.weekly.read())


def stamp(hour):
    return dt.datetime(2026, 1, 1, hour)


@pytest.fixture(scope="module")
def first_load():
    days = [d for d in range(300) if d % 7 < 5]
    kopa = [bar("KOPA", d, 10 + (d * 37 % 11) / 4, 0) for d in days if d not in (61, 92)]
    return kopa + [bar("LIND", d, 50.0 + (d * 13 % 7), 0) for d in days[::2]]


def test_backdated_bars_redo_their_intervals_only(spark, tmp_path, first_load):
    layers = MonthLayers(spark, str(tmp_path))
    months = layers.load_bars(spark.createDataFrame(first_load, SCHEMA), source_file="a")
    layers.refresh(months, updated_at=stamp(1))
    assert found(layers) == expected(layers)
    files = {m: layers.fact.files(m) for m in months}

    # one bar too late by months, one corrected twenty rows later: one interval
    late = [bar("KOPA", 61, 99.0, 1), bar("KOPA", 88, 3.0, 1)]
    touched = layers.load_bars(spark.createDataFrame(late, SCHEMA), source_file="b")
    assert touched == [202403]
    silver = {m: layers.silver.files(m) for m in months}
    layers.refresh(touched, updated_at=stamp(2))
    assert found(layers) == expected(layers)
    # a load into one month leaves the files of the others
    assert [m for m in months if layers.silver.files(m) != silver[m]] == [202403]

    dates = sorted({r[1] for r in first_load if r[0] == "KOPA"} | {late[0][1]})
    at = [dates.index(b[1]) for b in late]
    redone = {dates[p] for q in at for p in range(q, min(q + LEAD + 1, len(dates)))}
    fact = layers.fact.read().where(F.col("updated_at") == F.lit(stamp(2)))
    assert {(r.symbol, r.trade_date) for r in fact.collect()} == {("KOPA", d) for d in redone}
    reached = {d.year * 100 + d.month for d in redone}
    assert {m for m in months if layers.fact.files(m) != files[m]} == reached < set(months)

    # a newer bad bar changes nothing in staging, so nothing is redone
    bad = spark.createDataFrame([bar("KOPA", 62, -1.0, 2)], SCHEMA)
    layers.refresh(layers.load_bars(bad, source_file="c"), updated_at=stamp(3))
    assert layers.fact.read().where(F.col("updated_at") == F.lit(stamp(3))).count() == 0
    assert found(layers) == expected(layers)
    assert layers.waiting() == []


def test_a_broken_run_is_made_good(spark, tmp_path, first_load, monkeypatch):
    layers = MonthLayers(spark, str(tmp_path))
    layers.refresh(layers.load_bars(spark.createDataFrame(first_load, SCHEMA), source_file="a"))
    late = spark.createDataFrame([bar("KOPA", 92, 42.0, 1)], SCHEMA)  # a week across two months
    months = layers.load_bars(late, source_file="b")
    with monkeypatch.context() as m:
        m.setattr(MonthLayers, "refresh_weekly", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            layers.refresh(months)
    assert len(layers.waiting()) == 1
    layers.refresh(months)
    assert found(layers) == expected(layers)
    assert layers.waiting() == []


def test_intervals_merge_and_count_rows_not_dates(spark):
    bars = [("A", DAY0 + dt.timedelta(days=3 * i)) for i in range(40)] + [("B", DAY0)]
    bars = spark.createDataFrame(bars, "symbol string, trade_date date")
    day = lambda i: DAY0 + dt.timedelta(days=3 * i)
    # changed, changed near it, gone from between two bars, beyond the last bar
    marks = [("A", day(5)), ("A", day(7)), ("A", day(20) + dt.timedelta(days=1)), ("A", day(60))]
    marks = spark.createDataFrame([*marks, ("C", DAY0)], "symbol string, trade_date date")
    got = redo_intervals(bars, marks, lead=4).orderBy("from_date").collect()
    assert [(r.symbol, r.from_date, r.to_date, r.lead_date) for r in got] == [
        ("A", day(5), day(11), day(1)),
        ("A", day(21), day(25), day(17)),
    ]


def test_an_emptied_month_disappears(spark, tmp_path):
    table = MonthTable(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame(
        [("A", dt.date(2024, 1, 5)), ("A", dt.date(2024, 2, 5)), ("A", None)], "symbol string, date date"
    )
    assert months_in(rows) == [202401, 202402, None]
    table.overwrite(rows)
    assert sorted(map(str, (r.date for r in table.read().collect()))) == [
        "2024-01-05", "2024-02-05", "None"]
    table.replace(table.read([202401, None]).where("date is null"), [202401, None])
    assert not (tmp_path / "t" / "month=202401").exists()
    assert sorted(map(str, (r.date for r in table.read().collect()))) == ["2024-02-05", "None"]
    assert table.read([202402]).count() == 1 and table.read([None]).count() == 1


def test_bars_without_a_date_recompute_everything(spark, tmp_path):
    layers = MonthLayers(spark, str(tmp_path))
    for rows in ([bar("A", i, 5.0 + i, 0) for i in range(6)],
                 [("A", None, 9.0, 9.5, 8.0, 9.0, 5, dt.datetime(2025, 1, 2)), bar("A", 2, 1.0, 3)]):
        frame = spark.createDataFrame(rows, SCHEMA)
        layers.refresh(layers.load_bars(frame, source_file="x"))
        assert found(layers)[1] == expected(layers)[1]
