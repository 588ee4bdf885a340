"""Weekly roll-ups: documented week grain and literal day grain."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from bars import N_BARS, SF_SMALL, rows_by
from tickhouse.operators.indicators import fact_daily_performance, price_indicators
from tickhouse.operators.staging import clean_staging
from tickhouse.operators.weekly import weekly_performance
from tickhouse.sources.adapter import raw_bars

D = dt.date

# (trading_days, open, high, low, close, return_pct, total_volume,
#  avg_daily_return, up_days, down_days)
GOLDEN = {
    ("KOPA", D(2023, 2, 27)): (2, "12.40", "13.60", "12.10", "13.25", 6.8548, 1065, 3.5156, 1, 0),
    ("KOPA", D(2023, 3, 6)): (4, "13.30", "14.10", "11.65", "13.90", 4.5113, 5445, 1.4774, 2, 1),
    ("LIND", D(2023, 2, 27)): (2, "871.00", "880.50", "838.00", "858.50", -1.4351, 164, 1.3877, 1, 0),
    ("LIND", D(2023, 3, 6)): (4, "861.25", "910.00", "860.00", "866.00", 0.5515, 391, 0.2560, 1, 3),
    ("MURR", D(2023, 2, 27)): (2, "3.1416", "3.25", "3.0025", "3.12", -0.6875, 12350000, -2.8794, 0, 1),
    ("MURR", D(2023, 3, 6)): (4, "3.11", "3.4450", "3.0950", "3.33", 7.0740, 34920000, 1.7157, 3, 1),
}


def _fact(df):
    return fact_daily_performance(price_indicators(clean_staging(df)), updated_at=False)


def test_week_grain_goldens(sample_bars):
    wk = weekly_performance(_fact(sample_bars), grain="week")
    got = rows_by(wk, "symbol", "week_start")
    assert len(got) == len(GOLDEN)
    for key, exp in GOLDEN.items():
        r = got[key]
        days, o, h, lo, c, ret, vol, avg_ret, up, down = exp
        assert r["trading_days"] == days
        assert (r["week_open"], r["week_high"], r["week_low"], r["week_close"]) == tuple(
            Decimal(x) for x in (o, h, lo, c)
        )
        assert r["weekly_return_pct"] == ret
        assert r["total_volume"] == vol
        assert r["avg_daily_return"] == avg_ret
        assert (r["up_days"], r["down_days"]) == (up, down)


def test_day_grain_is_one_row_per_day(sample_bars):
    day = weekly_performance(_fact(sample_bars), grain="day")
    assert day.count() == N_BARS
    assert day.where("trading_days != 1").count() == 0
    r = rows_by(day.where("symbol = 'KOPA' and first_trade_date = date'2023-03-07'"), "symbol")
    r = r[("KOPA",)]
    # week's open and close, but that day's high and volume
    assert r["week_open"] == Decimal("13.3000") and r["week_close"] == Decimal("13.9000")
    assert r["week_high"] == Decimal("12.4500") and r["total_volume"] == 720


def test_week_totals_equal_daily_totals(spark):
    fact = _fact(raw_bars(spark, SF_SMALL))
    wk = weekly_performance(fact, grain="week")
    a = fact.agg(F.sum("volume"), F.count(F.lit(1))).first()
    b = wk.agg(F.sum("total_volume"), F.sum("trading_days")).first()
    assert tuple(a) == tuple(b)


def test_weekly_adds_no_exchange(spark):
    fact = _fact(raw_bars(spark, SF_SMALL))
    for grain in ("week", "day"):
        plan = weekly_performance(fact, grain=grain)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2, grain


def test_bad_grain():
    import pytest

    with pytest.raises(ValueError):
        weekly_performance(None, grain="month")
