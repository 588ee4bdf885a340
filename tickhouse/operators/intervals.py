"""Which indicator rows a changed bar reaches, and their recomputation.

Every indicator looks back at most ``LEAD`` rows, so a bar that appears,
changes or disappears alters the rows from its place up to ``LEAD`` rows
later in its own symbol and no others.  Places are row positions, not dates:
an inserted bar pushes an old one out of a window fifty rows later.

Null symbols form a symbol of their own; rows without a date come last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.operators.indicators import (
    MA_LONG,
    VOLATILITY_WINDOW,
    fact_daily_performance,
    price_indicators,
)

#: Rows before its own that an indicator reads: 49 closes for the 50-row
#: average; 20 returns for the volatility, the first of which needs a close more.
LEAD = max(MA_LONG - 1, VOLATILITY_WINDOW)


def changed_keys(old: DataFrame, new: DataFrame) -> DataFrame:
    """(symbol, trade_date) of bars that differ between two staging tables."""
    keys = ["symbol", "trade_date"]
    columns = sorted(set(new.columns) - set(keys))
    image = F.struct(*columns)
    both = old.select(*keys, image.alias("was"), F.lit(None).cast(new.select(image).schema[0].dataType).alias("now"))
    both = both.unionByName(
        new.select(*keys, F.lit(None).cast(both.schema["was"].dataType).alias("was"), image.alias("now"))
    )
    sides = both.groupBy(*keys).agg(
        F.first("was", ignorenulls=True).alias("was"), F.first("now", ignorenulls=True).alias("now")
    )
    return sides.where(~F.col("was").eqNullSafe(F.col("now"))).select(*keys)


def redo_intervals(bars: DataFrame, changed: DataFrame, lead: int = LEAD) -> DataFrame:
    """(symbol, interval, from_date, to_date, lead_date): merged runs of rows to redo.

    ``bars``: the current staging rows, ``changed``: keys that were added,
    altered or removed.  ``lead_date`` is where the rows begin that the
    interval's first row looks back to.  Reads two columns of the touched
    symbols' bars.
    """
    touched = changed.select("symbol").distinct()
    same = bars["symbol"].eqNullSafe(touched["symbol"])
    rows = bars.join(touched, same, "semi").select("symbol", "trade_date", F.lit(0).alias("mark"))
    marks = changed.select("symbol", "trade_date", F.lit(1).alias("mark")).distinct()
    date = F.col("trade_date").asc_nulls_last()
    # a mark comes before the bar of its date, so it knows that bar's position
    along = Window.partitionBy("symbol").orderBy(date, F.desc("mark")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    placed = (
        rows.unionByName(marks)
        .withColumn("place", F.sum(1 - F.col("mark")).over(along))
        .withColumn("last", F.max(F.when(F.col("mark") == 1, F.col("place") + 1)).over(along))
        .where("mark = 0")
    )
    by_date = Window.partitionBy("symbol").orderBy(date)
    first = F.first("trade_date").over(by_date.rowsBetween(Window.unboundedPreceding, 0))
    placed = placed.select(
        "symbol",
        "trade_date",
        F.coalesce(F.col("place") - F.col("last") <= lead, F.lit(False)).alias("redo"),
        F.coalesce(F.lag("trade_date", lead).over(by_date), first).alias("lead_date"),
    )
    begins = F.col("redo") & ~F.coalesce(F.lag("redo").over(by_date), F.lit(False))
    numbered = placed.withColumn("begins", begins).withColumn(
        "interval",
        F.sum(F.col("begins").cast("int")).over(by_date.rowsBetween(Window.unboundedPreceding, 0)),
    )
    return (
        numbered.where("redo")
        .groupBy("symbol", "interval")
        .agg(
            F.min("trade_date").alias("from_date"),
            F.max("trade_date").alias("to_date"),
            F.min("lead_date").alias("lead_date"),
        )
    )


def redone_rows(bars: DataFrame, intervals: DataFrame, updated_at=False) -> DataFrame:
    """The fact rows of the intervals, computed from them and their lead only."""
    i = intervals.withColumnRenamed("symbol", "of")
    near = (
        bars["symbol"].eqNullSafe(i["of"])
        & (bars["trade_date"] >= i["lead_date"])
        & (bars["trade_date"] <= i["to_date"])
    )
    context = bars.join(i, near).drop("of", "to_date", "lead_date")
    found = price_indicators(context, by=("symbol", "interval", "from_date"))
    return fact_daily_performance(
        found.where(F.col("trade_date") >= F.col("from_date")), updated_at=updated_at
    )
