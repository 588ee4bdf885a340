"""Indicators of very long histories in slices of bounded length.

A window partition of ``price_indicators`` is a whole symbol.  Here a symbol's
rows are numbered and cut into slices of ``rows`` rows; each slice also gets
the ``LEAD`` rows before it, computes its indicators alone, and drops those
rows again.  A task then holds a slice and its lead at a time, whatever the
length of the history, and one symbol's slices are dealt over many tasks.

Places come from counts: rows per block of ``BLOCK_DAYS`` days, summed up over
the blocks before, and the place inside the block.  Only the counts, one row
for each symbol and block, meet in one partition per symbol.

A null symbol is a symbol of its own; the row without a date comes last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.operators.indicators import price_indicators
from tickhouse.operators.intervals import LEAD

#: Rows of a slice: 49 more are read for each.
SLICE_ROWS = 4096
BLOCK_DAYS = 4096


def placed(stg: DataFrame, block_days: int = BLOCK_DAYS) -> DataFrame:
    """The staged bars with ``place``, their number in the symbol's history from 0.

    Rows of one date (staging has none) are numbered in any order.
    """
    day = F.datediff("trade_date", F.lit("1970-01-01").cast("date"))
    blocks = stg.withColumn("block", F.floor(day / F.lit(block_days)).cast("long"))
    counts = blocks.groupBy("symbol", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = (
        Window.partitionBy("symbol")
        .orderBy(F.col("block").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = counts.select(
        F.col("symbol").alias("of"),
        F.col("block").alias("at"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    inside = Window.partitionBy("symbol", "block").orderBy(F.col("trade_date").asc_nulls_last())
    numbered = blocks.withColumn("inside", F.row_number().over(inside) - 1)
    same = numbered["symbol"].eqNullSafe(before["of"]) & numbered["block"].eqNullSafe(before["at"])
    return (
        numbered.join(before, same)
        .withColumn("place", F.col("before") + F.col("inside"))
        .drop("block", "inside", "of", "at", "before")
    )


def sliced(numbered: DataFrame, rows: int = SLICE_ROWS, lead: int = LEAD) -> DataFrame:
    """Each row once for its own slice (``own``) and once for each slice it leads into."""
    if rows < 1:
        raise ValueError("a slice has at least one row")
    slice_of = lambda place: F.floor(place / F.lit(rows)).cast("long")
    place = F.col("place")
    reached = F.sequence(slice_of(place), slice_of(place + lead))
    return numbered.withColumn("slice", F.explode(reached)).withColumn(
        "own", slice_of(place) == F.col("slice")
    )


def sliced_indicators(
    stg: DataFrame, rows: int = SLICE_ROWS, block_days: int = BLOCK_DAYS
) -> DataFrame:
    """``price_indicators(stg)``, computed in slices of ``rows`` rows."""
    parts = sliced(placed(stg, block_days), rows)
    found = price_indicators(parts, by=("symbol", "slice"), keep=("own",))
    return found.where("own").drop("slice", "own")
