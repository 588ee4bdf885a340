"""Staging: validity predicate, typed projection and latest-row dedup.

Two orders of "filter" and "dedup" exist in the reference and they give
different rows, so they are two operators that never share a helper
fixing the order:

* staging (this module) filters first, then keeps the newest surviving
  row per (symbol, date) -- a bad newest row falls back to an older good
  one;
* Silver (``operators.medallion``) keeps the newest row first and then
  filters -- a bad newest row drops the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.schemas import PRICE_DECIMAL, RAW_DAILY


def valid_price_predicate(
    require_high_ge_low: bool,
    open_col: str = "open",
    high_col: str = "high",
    low_col: str = "low",
    close_col: str = "close",
    volume_col: str = "volume",
) -> Column:
    """Positive prices, non-negative volume, optionally ``high >= low``.

    A NULL anywhere makes the predicate NULL, which ``filter`` drops.
    """
    pred = (
        (F.col(open_col) > 0)
        & (F.col(high_col) > 0)
        & (F.col(low_col) > 0)
        & (F.col(close_col) > 0)
        & (F.col(volume_col) >= 0)
    )
    if require_high_ge_low:
        pred = pred & (F.col(high_col) >= F.col(low_col))
    return pred


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Keep a timestamp column as it is; parse it if it arrives as text."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name)
    return F.col(name).cast("timestamp")


def latest_first(*order_cols: str, rest: list[str] | None = None) -> list[Column]:
    """Sort keys newest first, with the remaining columns as tie-breakers.

    The reference orders by load time only; equal load times (one file
    loaded at one instant) would leave the survivor arbitrary, so the
    other columns break the tie deterministically.
    """
    keys = [F.col(c).desc_nulls_last() for c in order_cols]
    keys += [F.col(c).desc_nulls_last() for c in (rest or [])]
    return keys


RAW_BAR_COLUMNS = RAW_DAILY.fieldNames()


def latest_valid_bars(raw: DataFrame) -> DataFrame:
    """Newest valid raw row per (symbol, date), in the raw column types.

    Filter first, then keep the newest row by ``ingested_at``.  The rule
    is a maximum over the valid rows of a key, so it composes:
    ``latest_valid_bars(latest_valid_bars(a) | b) == latest_valid_bars(a | b)``,
    which lets a maintained table absorb new rows without rereading old
    ones.

    Plan: one scan with the predicate pushed into Parquet, a shuffle on
    (symbol, date) and a top-1-per-key window.  Catalyst turns
    ``row_number() ... = 1`` into a partial WindowGroupLimit before the
    exchange, so a key ingested many times (one hot symbol/date) ships at
    most one row per map task.
    """
    order = latest_first("ingested_at", rest=["open", "high", "low", "close", "volume"])
    # cast only where needed: a window over the plain column leaves a partitioning
    # that later steps on (symbol, date) recognise
    if not isinstance(raw.schema["date"].dataType, T.DateType):
        raw = raw.withColumn("date", F.col("date").cast("date"))
    w = Window.partitionBy("symbol", "date").orderBy(*order)
    return (
        raw.where(valid_price_predicate(require_high_ge_low=False))
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .select(*RAW_BAR_COLUMNS)
    )


def stage_types(latest: DataFrame) -> DataFrame:
    """The staging projection: rename and cast (decimal(18,4) prices)."""
    return latest.select(
        F.col("symbol"),
        F.col("date").cast("date").alias("trade_date"),
        F.col("open").cast(PRICE_DECIMAL).alias("open_price"),
        F.col("high").cast(PRICE_DECIMAL).alias("high_price"),
        F.col("low").cast(PRICE_DECIMAL).alias("low_price"),
        F.col("close").cast(PRICE_DECIMAL).alias("close_price"),
        F.col("volume").cast("bigint").alias("volume"),
        as_timestamp(latest, "ingested_at").alias("ingested_at"),
    )


def clean_staging(raw: DataFrame) -> DataFrame:
    """Filter, dedup and cast raw bars into the staging model.

    ``stage_types(latest_valid_bars(raw))``: the decimal casts run after
    the dedup, on surviving rows only.
    """
    return stage_types(latest_valid_bars(raw))
