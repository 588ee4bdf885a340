"""Parse a vendor history frame into raw historical bars.

The vendor frame has capitalised columns (``Date``, ``Open`` ...,
``Volume``, optional ``Dividends`` and ``Stock Splits``).  Prices,
dividends and splits are rounded to four decimals, volume is truncated
to an integer, and an absent dividend or split column reads as 0.
A row-local projection: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.schemas import HISTORY_FIELDS


def _field(frame: DataFrame, key: str, default: float | None = None) -> Column:
    name = HISTORY_FIELDS[key]
    if name in frame.columns:
        return F.col(f"`{name}`")
    if default is None:
        raise ValueError(f"history frame has no column {name!r}")
    return F.lit(default)


def _volume(frame: DataFrame) -> Column:
    """Truncate toward zero; text goes through double first."""
    col = _field(frame, "volume")
    if isinstance(frame.schema[HISTORY_FIELDS["volume"]].dataType, T.StringType):
        col = col.cast("double")
    return col.cast("bigint")


def _trading_date(frame: DataFrame, exchange_tz: str | None) -> Column:
    col = _field(frame, "date")
    name = HISTORY_FIELDS["date"]
    instant = name in frame.columns and isinstance(frame.schema[name].dataType, T.TimestampType)
    if exchange_tz is not None and instant:
        # wall-clock time at the exchange, whatever the session's zone
        col = F.convert_timezone(F.lit("UTC"), F.lit(exchange_tz), _utc_wall_clock(col))
    return F.to_date(col)


def _utc_wall_clock(instant: Column) -> Column:
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), instant.cast(T.TimestampNTZType())
    )


def parse_history_frame(
    frame: DataFrame,
    symbol: Column | str = "symbol",
    ingested_at: Column | str | None = None,
    exchange_tz: str | None = None,
) -> DataFrame:
    """Vendor frame -> raw history bars (see module doc).

    ``exchange_tz`` names the zone in which an instant (TIMESTAMP) is turned
    into the trading date; without it that is UTC.  Dates and wall-clock
    times (DATE, TIMESTAMP_NTZ) are taken as they are.  Prices round half
    up on the decimal value, so a tie such as 2.00005 becomes 2.0001 also
    where its binary value lies below it.
    """
    sym = F.col(symbol) if isinstance(symbol, str) else symbol
    if ingested_at is None:
        stamp = F.current_timestamp()
    elif isinstance(ingested_at, str):
        stamp = F.col(ingested_at)
    else:
        stamp = ingested_at

    def price(key: str, default: float | None = None) -> Column:
        return F.round(_field(frame, key, default).cast("double"), 4)

    return frame.select(
        sym.alias("symbol"),
        _trading_date(frame, exchange_tz).alias("date"),
        price("open").alias("open"),
        price("high").alias("high"),
        price("low").alias("low"),
        price("close").alias("close"),
        _volume(frame).alias("volume"),
        price("dividends", 0.0).alias("dividends"),
        price("stock_splits", 0.0).alias("stock_splits"),
        stamp.alias("ingested_at"),
    )
