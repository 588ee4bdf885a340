"""Technical indicators over staged bars, and the daily fact mart.

All windows share one partitioning (symbol) and one order (trade_date),
so Spark sorts each symbol's history once and evaluates the lag and all
five framed aggregates over that sort.  A symbol's staged history holds
at most one bar per calendar day, so a window partition is bounded by the
calendar (about 10**4 rows per 40 years), whatever the raw volume; the
skew of raw input is absorbed by the (symbol, date) dedup before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.functions.columns import exact_mean, ratio_pct

# The moving-average lengths, the volatility length and the
# high-volume multiplier of the indicator model.
MA_SHORT, MA_MEDIUM, MA_LONG = 7, 21, 50
VOLUME_WINDOW = 21
VOLATILITY_WINDOW = 21
HIGH_VOLUME_FACTOR = 1.5

INDICATOR_COLUMNS = [
    "symbol",
    "trade_date",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "volume",
    "prev_close",
    "daily_return_pct",
    "daily_price_change",
    "ma_7d",
    "ma_21d",
    "ma_50d",
    "avg_volume_21d",
    "volatility_21d",
    "trend_signal",
    "high_volume_flag",
    "ingested_at",
]


def _along(by: tuple[str, ...]):
    return Window.partitionBy(*by).orderBy(F.col("trade_date").asc_nulls_last())


def daily_return(close: str = "close_price", prev: str = "prev_close") -> F.Column:
    """Percent change to the previous close, NULL without a positive one."""
    guard = F.col(prev).isNotNull() & (F.col(prev) > 0)
    return F.when(guard, ratio_pct(close, prev, 4))


def trend_signal(short: str = "ma_7d", long: str = "ma_21d") -> F.Column:
    """BULLISH / BEARISH by moving-average cross; NEUTRAL otherwise or NULL."""
    return (
        F.when(F.col(short) > F.col(long), F.lit("BULLISH"))
        .when(F.col(short) < F.col(long), F.lit("BEARISH"))
        .otherwise(F.lit("NEUTRAL"))
    )


def high_volume_flag(
    volume: str = "volume", avg: str = "avg_volume_21d", factor: float = HIGH_VOLUME_FACTOR
) -> F.Column:
    """Volume above ``factor`` x its 21-row mean; a NULL comparison is False."""
    return F.coalesce(F.col(volume) > F.col(avg) * F.lit(factor), F.lit(False))


def price_indicators(
    stg: DataFrame, by: tuple[str, ...] = ("symbol",), keep: tuple[str, ...] = ()
) -> DataFrame:
    """Lag, return, moving averages, volatility, trend and volume flag.

    ``by`` are the columns that tell one history from another; those besides
    the symbol are kept after the indicator columns, as are those of ``keep``.

    The volatility reads the *rounded* daily return, as the model does,
    so the return is materialised before the framed aggregates.
    Averages are exact means over integer ticks, rounded half-up (see
    ``functions.exact_mean``); short frames at the start of a history are
    averaged over the rows they have.
    """
    along = _along(by)

    def _trailing(rows: int):
        return along.rowsBetween(-(rows - 1), Window.currentRow)

    with_lag = stg.withColumn("prev_close", F.lag("close_price").over(along))
    with_ret = with_lag.withColumn("daily_return_pct", daily_return()).withColumn(
        "daily_price_change", F.col("close_price") - F.col("prev_close")
    )
    with_ma = with_ret.select(
        "*",
        exact_mean("close_price", 4, _trailing(MA_SHORT)).alias("ma_7d"),
        exact_mean("close_price", 4, _trailing(MA_MEDIUM)).alias("ma_21d"),
        exact_mean("close_price", 4, _trailing(MA_LONG)).alias("ma_50d"),
        exact_mean("volume", 0, _trailing(VOLUME_WINDOW), scale=0).alias("avg_volume_21d"),
        F.round(
            F.stddev_samp("daily_return_pct").over(_trailing(VOLATILITY_WINDOW)), 4
        ).alias("volatility_21d"),
    )
    return with_ma.select(
        *[
            c
            for c in INDICATOR_COLUMNS
            if c not in ("trend_signal", "high_volume_flag", "ingested_at")
        ],
        trend_signal().alias("trend_signal"),
        high_volume_flag().alias("high_volume_flag"),
        "ingested_at",
        *[c for c in by if c != "symbol"],
        *keep,
    )


def fact_daily_performance(ind: DataFrame, updated_at=None) -> DataFrame:
    """The indicator table without ``prev_close``, stamped with ``updated_at``.

    ``updated_at`` defaults to the query's current timestamp; pass a value
    for reproducible runs, or ``False`` to leave the column out.
    """
    cols = [c for c in INDICATOR_COLUMNS if c != "prev_close"]
    out = ind.select(*cols)
    if updated_at is False:
        return out
    stamp = F.current_timestamp() if updated_at is None else F.lit(updated_at)
    return out.withColumn("updated_at", stamp)
