"""Lookups: filters, ordering, limits and their plans."""

from __future__ import annotations

import datetime as dt

import pytest

from tickhouse.operators.serving import list_symbols, price_history, silver_table, symbol_detail
from tickhouse.plans.flow import load_bronze, load_gold, load_silver


@pytest.fixture(scope="module")
def lake(spark, sample_bars, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    load_bronze(spark, sample_bars, root, source_file="sample.csv")
    load_silver(spark, root)
    load_gold(spark, root)
    return root


def test_list_symbols(spark, lake):
    assert {r["symbol"] for r in list_symbols(spark, lake).collect()} == {
        "KOPA", "LIND", "MURR"}


def test_missing_layer(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="Gold layer"):
        list_symbols(spark, str(tmp_path / "nothing"))


def test_symbol_detail_upper_cases_argument(spark, lake):
    rows = symbol_detail(silver_table(spark, lake), "kopa", n=3).collect()
    assert [r["date"] for r in rows] == [dt.date(2023, 3, 9), dt.date(2023, 3, 8), dt.date(2023, 3, 7)]
    assert rows[0].asDict().keys() == {"symbol", "date", "open", "high", "low", "close", "volume"}
    assert symbol_detail(silver_table(spark, lake), "nope").count() == 0


def test_price_history_range_inclusive(spark, lake):
    silver = silver_table(spark, lake)
    rows = price_history(silver, "LIND", dt.date(2023, 3, 3), dt.date(2023, 3, 7)).collect()
    assert [r["date"].day for r in rows] == [7, 6, 3]
    assert "_silver_loaded_at" in rows[0].asDict()
    assert price_history(silver, "LIND", limit=2).count() == 2


@pytest.mark.parametrize("bad", [0, 1001, -5])
def test_price_history_limit_validated(spark, lake, bad):
    with pytest.raises(ValueError):
        price_history(silver_table(spark, lake), "LIND", limit=bad)


def test_lookup_plan_pushdown_and_topk(spark, lake):
    q = price_history(silver_table(spark, lake), "LIND", dt.date(2023, 3, 3))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "EqualTo(symbol,LIND)" in plan and "GreaterThanOrEqual(date," in plan
