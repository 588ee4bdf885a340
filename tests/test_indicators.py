"""Staging + indicator goldens (sample bars) and plan shape."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from bars import N_BARS, SF_SMALL, rows_by
from tickhouse.operators.indicators import fact_daily_performance, price_indicators
from tickhouse.operators.staging import clean_staging
from tickhouse.sources.adapter import raw_bars

D = dt.date

# Computed with exact decimals, apart from the library, for each bar:
# (daily_return_pct, daily_price_change, ma_7d, avg_volume_21d, volatility_21d, high volume)
GOLDEN = {
    ("KOPA", D(2023, 3, 2)): (None, None, 12.8, 410, None, False),
    ("KOPA", D(2023, 3, 3)): (3.5156, "0.45", 13.025, 533, None, False),
    ("KOPA", D(2023, 3, 6)): (-9.0566, "-1.20", 12.7, 1015, 8.8899, True),
    ("KOPA", D(2023, 3, 7)): (3.3195, "0.40", 12.6375, 941, 7.2026, False),
    ("KOPA", D(2023, 3, 8)): (0.0, "0.00", 12.6, 814, 5.8926, False),
    ("KOPA", D(2023, 3, 9)): (11.6466, "1.45", 12.8167, 1085, 7.4712, True),
    ("LIND", D(2023, 3, 6)): (5.067, "43.50", 869.0833, 117, 2.6017, True),
    ("LIND", D(2023, 3, 9)): (-0.887, "-7.75", 872.875, 93, 2.8441, False),
    ("MURR", D(2023, 3, 7)): (6.698, "0.2135", 3.2303, 8106250, 4.7909, True),
    ("MURR", D(2023, 3, 8)): (-4.1458, "-0.1410", 3.2362, 8251000, 4.9726, False),
}


def test_indicator_goldens(sample_bars):
    ind = price_indicators(clean_staging(sample_bars))
    got = rows_by(ind, "symbol", "trade_date")
    assert len(got) == N_BARS
    for key, (ret, chg, ma7, avgv, vol, busy) in GOLDEN.items():
        r = got[key]
        assert r["daily_return_pct"] == ret, key
        assert r["daily_price_change"] == (None if chg is None else Decimal(chg))
        # fewer than 7 rows: all frames coincide
        assert r["ma_7d"] == r["ma_21d"] == r["ma_50d"] == ma7
        assert r["avg_volume_21d"] == avgv
        assert r["volatility_21d"] == vol
        assert r["trend_signal"] == "NEUTRAL"
        assert r["high_volume_flag"] is busy, key


def test_staging_types_and_dedup(spark, sample_bars):
    later = sample_bars.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"))
    newer = later.withColumn("close", F.col("close") + 1)
    stg = clean_staging(sample_bars.unionByName(newer))
    assert stg.count() == N_BARS
    types = dict(stg.dtypes)
    assert types["open_price"] == "decimal(18,4)" and types["trade_date"] == "date"
    row = stg.where("symbol = 'KOPA' and trade_date = date'2023-03-06'").first()
    assert row["close_price"] == Decimal("13.0500")  # newest load wins


def test_staging_filters_before_dedup(spark, sample_bars):
    """A bad newest row falls back to the older good one in staging."""
    newer_bad = sample_bars.withColumn(
        "ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR")
    ).withColumn("open", F.lit(-1.0))
    stg = clean_staging(sample_bars.unionByName(newer_bad))
    assert stg.count() == N_BARS
    assert stg.agg(F.min("open_price")).first()[0] > 0


def test_first_rows_neutral_property(spark):
    """With coinciding 7/21 frames the first 7 rows of a symbol are NEUTRAL."""
    ind = price_indicators(clean_staging(raw_bars(spark, SF_SMALL)))
    w = Window.partitionBy("symbol").orderBy("trade_date")
    early = ind.withColumn("pos", F.row_number().over(w)).where("pos <= 7")
    assert early.where("trend_signal != 'NEUTRAL'").count() == 0
    assert early.count() > 0


def test_fact_drops_prev_close_and_stamps(spark, sample_bars):
    ind = price_indicators(clean_staging(sample_bars))
    fact = fact_daily_performance(ind)
    assert "prev_close" not in fact.columns and "updated_at" in fact.columns
    assert "updated_at" not in fact_daily_performance(ind, updated_at=False).columns


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_plan_two_exchanges_and_partial_limit(spark):
    fact = fact_daily_performance(
        price_indicators(clean_staging(raw_bars(spark, SF_SMALL))), updated_at=False
    )
    plan = _plan(fact)
    assert plan.count("Exchange hashpartitioning") == 2
    # top-1 per (symbol, date) is pre-limited before the shuffle
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # predicates reach the scan; only used columns are read
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in plan
    assert "o_orderstatus" not in plan
