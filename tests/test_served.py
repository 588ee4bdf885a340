"""Lookups on the clustered Silver: the same rows, and how little is read for them."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickhouse.operators.serving import price_history, symbol_detail
from tickhouse.sources.months import MonthTable
from tickhouse.sources.served import ServedBars

DAYS, SYMBOLS = 500, 40


@pytest.fixture(scope="module")
def silver(spark):
    """Forty even-numbered symbols over 500 days in two years; one day has no date."""
    date = F.date_add(F.lit(dt.date(2023, 6, 1)), F.col("d").cast("int"))
    rows = spark.range(SYMBOLS * DAYS).select(
        (F.col("id") % SYMBOLS * 2).alias("s"), F.floor(F.col("id") / SYMBOLS).alias("d")
    )
    prices = [(F.col("s") * 100 + F.col("d") % 50 + i).cast("double").alias(c)
              for i, c in enumerate(["open", "high", "low", "close"])]
    return rows.select(
        F.format_string("S%03d", "s").alias("symbol"),
        F.when(F.col("d") != 7, date).alias("date"),
        *prices,
        F.col("d").alias("volume"),
    )


def rows(df):
    return [tuple(r) for r in df.collect()]


def scanned(df):
    """(result rows, files listed, rows that left the scan) of a query on the served table."""
    got = df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    metric = lambda name: leaf.metrics().apply(name).value()
    return len(got), metric("numFiles"), metric("numOutputRows")


@pytest.fixture(scope="module")
def served(spark, silver, tmp_path_factory):
    table = ServedBars(
        spark, str(tmp_path_factory.mktemp("served") / "t"),
        {"parquet.block.size": "16384", "parquet.page.size": "4096"},
    )
    table.write(silver.repartition(8))
    return table


def test_lookups_equal_those_on_silver(served, silver):
    for symbol in ("s004", "s078", "s005", ""):
        assert rows(served.symbol_detail(symbol)) == rows(symbol_detail(silver, symbol))
        for start, end in ((None, None), (dt.date(2023, 12, 20), dt.date(2024, 1, 9)), (dt.date(2024, 3, 1), None)):
            got = served.price_history(symbol, start, end, 50)
            assert rows(got) == rows(price_history(silver, symbol, start, end, 50))
    assert sorted(map(str, rows(served.read().select(*silver.columns)))) == sorted(map(str, rows(silver)))


def test_one_symbol_reads_few_rows(served):
    total = SYMBOLS * DAYS
    n, _, read = scanned(served.read().where("symbol = 'S036'"))
    assert n == DAYS and read < total / 8
    # between the bounds of row groups, but in none of them
    n, _, read = scanned(served.read().where("symbol = 'S037'"))
    assert n == 0 and read == 0


def test_years_outside_the_range_are_not_listed(served):
    _, every, _ = scanned(served.read())
    _, one, _ = scanned(served.read(dt.date(2024, 2, 1), dt.date(2024, 3, 1)))
    assert one == len(served.files(2024)) < every


def test_a_load_rewrites_its_years_only(spark, silver, tmp_path):
    months = MonthTable(spark, str(tmp_path / "silver"))
    months.overwrite(silver)
    table = ServedBars(spark, str(tmp_path / "served"))
    table.write(months.read())
    old, new = table.files(2023), table.files(2024)
    months.replace(months.read([202402]).where("symbol <> 'S036'"), [202402])
    table.refresh(months, [202402])
    assert table.files(2023) == old and not (table.files(2024) & new)
    assert sorted(map(str, rows(table.read()))) == sorted(map(str, rows(months.read())))
    # a year without rows goes, and so do the bars without a date
    later = [202400 + m for m in range(1, 13)]
    for chosen in ([*later], [None]):
        months.replace(months.read(chosen).where(F.lit(False)), chosen)
        table.refresh(months, chosen)
    assert table.files(2024) == table.files(None) == set() and table.files(2023) == old
    assert table.read().count() == months.read().count()
