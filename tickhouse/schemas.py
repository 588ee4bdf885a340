"""Schemas of the bar tables.

Raw bars are the only fixed schema; every later layer is derived from it
by the operators, so their schemas follow from the code.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE_DECIMAL = T.DecimalType(18, 4)


def raw_daily_schema(timestamp_type: T.DataType | None = None) -> T.StructType:
    """Raw daily bars: one row per symbol and trading date."""
    ts = timestamp_type or T.TimestampType()
    return T.StructType(
        [
            T.StructField("symbol", T.StringType()),
            T.StructField("date", T.DateType()),
            T.StructField("open", T.DoubleType()),
            T.StructField("high", T.DoubleType()),
            T.StructField("low", T.DoubleType()),
            T.StructField("close", T.DoubleType()),
            T.StructField("volume", T.LongType()),
            T.StructField("ingested_at", ts),
        ]
    )


def raw_history_schema(timestamp_type: T.DataType | None = None) -> T.StructType:
    """Raw historical bars: daily bars plus dividends and splits."""
    base = raw_daily_schema(timestamp_type)
    fields = base.fields[:-1] + [
        T.StructField("dividends", T.DoubleType()),
        T.StructField("stock_splits", T.DoubleType()),
        base.fields[-1],
    ]
    return T.StructType(fields)


RAW_DAILY = raw_daily_schema()
RAW_HISTORY = raw_history_schema()

# The shipped sample CSV has no load time.
SAMPLE_CSV = T.StructType(RAW_DAILY.fields[:-1])

# Fixed values of the vendor response format (they must equal what the
# price API sends): the key holding the per-date map and the five field
# names inside each date entry.
RESPONSE_SERIES_KEY = "Time Series (Daily)"
RESPONSE_FIELDS = {
    "open": "1. open",
    "high": "2. high",
    "low": "3. low",
    "close": "4. close",
    "volume": "5. volume",
}

# Fixed column names of the vendor history frame.
HISTORY_FIELDS = {
    "date": "Date",
    "open": "Open",
    "high": "High",
    "low": "Low",
    "close": "Close",
    "volume": "Volume",
    "dividends": "Dividends",
    "stock_splits": "Stock Splits",
}
