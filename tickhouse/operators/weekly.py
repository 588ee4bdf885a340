"""Weekly roll-ups of the daily fact mart.

Two grains exist, and both are built:

* ``grain="week"`` -- the documented meaning: one row per symbol and
  Monday-started week with the week's OHLCV, return, volume and up/down
  day counts;
* ``grain="day"`` -- what the reference SQL literally computes: its
  GROUP BY also holds the open, the close and the trade date, so every
  group is one day; open/close come from windows over the week while
  high, low, volume and the counts are that single day's.

The input arrives hash-partitioned by symbol from the indicator windows,
which already satisfies the (symbol, week) grouping: neither grain adds
a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.functions.columns import exact_mean, ratio_pct

WEEKLY_COLUMNS = [
    "symbol",
    "week_start",
    "first_trade_date",
    "last_trade_date",
    "trading_days",
    "week_open",
    "week_high",
    "week_low",
    "week_close",
    "weekly_return_pct",
    "total_volume",
    "avg_daily_volume",
    "avg_daily_return",
    "avg_volatility",
    "up_days",
    "down_days",
]


def week_start(date_col: str = "trade_date") -> Column:
    """Monday of the date's week."""
    return F.trunc(F.col(date_col), "week")


def weekly_return(close: str = "week_close", open_: str = "week_open") -> Column:
    """``round((close - open) / nullif(open, 0) * 100, 4)``."""
    return F.when(F.col(open_) != 0, ratio_pct(close, open_, 4))


def _common_aggs() -> list[Column]:
    return [
        F.min("trade_date").alias("first_trade_date"),
        F.max("trade_date").alias("last_trade_date"),
        F.count(F.lit(1)).alias("trading_days"),
        F.max("high_price").alias("week_high"),
        F.min("low_price").alias("week_low"),
        F.sum("volume").alias("total_volume"),
        exact_mean("volume", 0, scale=0).alias("avg_daily_volume"),
        exact_mean("daily_return_pct", 4).alias("avg_daily_return"),
        exact_mean("volatility_21d", 4).alias("avg_volatility"),
        # NULL returns count as neither up nor down
        F.count_if(F.col("daily_return_pct") > 0).alias("up_days"),
        F.count_if(F.col("daily_return_pct") < 0).alias("down_days"),
    ]


def weekly_performance(fact: DataFrame, grain: str = "week", updated_at=False) -> DataFrame:
    """Weekly performance per symbol (see module doc for ``grain``).

    ``updated_at``: ``False`` leaves the audit column out, ``None`` stamps
    the current timestamp, anything else is used as the literal value.
    """
    if grain == "week":
        out = (
            fact.groupBy("symbol", week_start().alias("week_start"))
            .agg(
                *_common_aggs(),
                F.min_by("open_price", "trade_date").alias("week_open"),
                F.max_by("close_price", "trade_date").alias("week_close"),
            )
            .withColumn("weekly_return_pct", weekly_return())
            .select(*WEEKLY_COLUMNS)
        )
    elif grain == "day":
        per_day = fact.groupBy(
            "symbol",
            week_start().alias("week_start"),
            "open_price",
            "close_price",
            "trade_date",
        ).agg(*_common_aggs())
        wk = Window.partitionBy("symbol", "week_start").orderBy(
            F.col("trade_date").asc_nulls_last()
        )
        whole_wk = wk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        out = (
            per_day.withColumn("week_open", F.first("open_price").over(wk))
            .withColumn("week_close", F.last("close_price").over(whole_wk))
            .withColumn("weekly_return_pct", weekly_return())
            .select(*WEEKLY_COLUMNS)
            .distinct()
        )
    else:
        raise ValueError(f"grain must be 'week' or 'day', got {grain!r}")
    if updated_at is False:
        return out
    stamp = F.current_timestamp() if updated_at is None else F.lit(updated_at)
    return out.withColumn("updated_at", stamp)
