"""Gold kept up to date: per symbol and month mergeable moments of Silver.

A mean or a deviation cannot be corrected when a bar changes, but counts,
sums and sums of squares can be replaced month by month.  ``month_moments``
reduces a month of Silver to one row per symbol; ``summary_of_moments`` adds
the months up to the rows that ``gold_daily_summary`` gives.

Prices are summed as whole ticks (1e-4) in 38-digit decimals, so the variance
``(n * sum(x^2) - sum(x)^2) / (n * (n - 1))`` is exact before its last
division: a small spread around a large price loses nothing, and the result
does not depend on partitioning.  Closes of more than four decimals are
rounded to ticks.

Scale: the moments hold one row per symbol and month, the longest group of the
merge is a symbol's months.  Both steps are hash aggregations with partial
aggregation; a load costs its months of Silver plus the moments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.functions.columns import as_ticks
from tickhouse.operators.medallion import _stamp

MONTH_START = "month_start"
_WIDE = T.DecimalType(38, 0)
_TICKS = 10_000


def month_moments(silver: DataFrame) -> DataFrame:
    """One row per symbol and month; bars without a date form a month of their own."""
    ticks = as_ticks("close").cast(T.DecimalType(19, 0))
    return silver.groupBy("symbol", F.trunc("date", "month").alias(MONTH_START)).agg(
        F.count(F.lit(1)).alias("records"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.max_by("close", "date").alias("last_close"),
        F.count("close").alias("closes"),
        F.sum(ticks).cast(_WIDE).alias("close_ticks"),
        F.sum((ticks * ticks).cast(_WIDE)).cast(_WIDE).alias("close_squares"),
        F.count("volume").alias("volumes"),
        F.sum("volume").alias("volume"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
    )


def summary_of_moments(moments: DataFrame, loaded_at=False) -> DataFrame:
    """The per-symbol summary; ``loaded_at`` as in ``gold_daily_summary``."""
    merged = moments.groupBy("symbol").agg(
        F.max("last_date").alias("latest_date"),
        F.min("first_date").alias("earliest_date"),
        F.max_by("last_close", "last_date").alias("latest_close"),
        F.sum("closes").alias("n"),
        F.sum("close_ticks").cast(_WIDE).alias("s"),
        F.sum("close_squares").cast(_WIDE).alias("q"),
        F.sum("volumes").alias("volumes"),
        F.sum("volume").alias("total_volume"),
        F.sum("records").alias("total_records"),
        F.max("high").alias("all_time_high"),
        F.min("low").alias("all_time_low"),
    )
    n, s, q = F.col("n").cast(_WIDE), F.col("s"), F.col("q")
    spread = (n * q).cast(_WIDE) - (s * s).cast(_WIDE)
    pairs = (F.col("n") * (F.col("n") - 1)).cast("double")
    deviation = F.sqrt(spread.cast("double") / F.nullif(pairs, F.lit(0.0))) / _TICKS
    out = merged.select(
        "symbol",
        "latest_date",
        "earliest_date",
        "latest_close",
        (s.cast("double") / F.nullif(F.col("n"), F.lit(0)) / _TICKS).alias("avg_close"),
        deviation.alias("std_close"),
        (F.col("total_volume") / F.nullif(F.col("volumes"), F.lit(0))).alias("avg_volume"),
        "total_volume",
        "total_records",
        "all_time_high",
        "all_time_low",
    )
    if loaded_at is False:
        return out
    return out.withColumn("_gold_loaded_at", _stamp(loaded_at))
