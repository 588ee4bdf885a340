"""Staged bars as a bucketed, sorted table: later steps need no shuffle.

Bars are bucketed by symbol and sorted by symbol and date.  Rows that share a
symbol share a bucket, which satisfies the per-key dedup and all indicator
windows, so the fact mart is computed from the table by one stage without an
exchange.  The shuffle is paid once, by ``write``.

A staged symbol has one bar a day at most, so no bucket grows with the number
of loads; ``write`` deduplicates before it buckets, as a raw symbol can hold
any share of all rows.  The number of buckets follows from the rows, unless
given, and is fixed for the life of the table.

The table is one of the session's catalog, its files lie at ``path``.
Null symbols share a bucket; an empty input gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickhouse.operators.indicators import fact_daily_performance, price_indicators
from tickhouse.operators.staging import clean_staging, latest_valid_bars

#: Bars of a bucket, about 60 MB of them decoded.
BUCKET_ROWS = 1_000_000


class BucketedBars:
    def __init__(self, spark: SparkSession, table: str, path: str):
        self.spark, self.table, self.path = spark, table, path.rstrip("/")

    def write(self, raw: DataFrame, buckets: int | None = None) -> int:
        """Replace the table by the newest valid bar of each key; returns its buckets."""
        bars = latest_valid_bars(raw)
        if buckets is None:
            buckets = max(1, -(-bars.count() // BUCKET_ROWS))
        (
            # one task a bucket, so one file a bucket
            bars.repartition(buckets, "symbol")
            .write.mode("overwrite")
            .format("parquet")
            .option("path", self.path)
            .bucketBy(buckets, "symbol")
            .sortBy("symbol", "date")
            .saveAsTable(self.table)
        )
        return buckets

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def staging(self) -> DataFrame:
        """The staging model; its dedup finds the keys of a bucket together."""
        return clean_staging(self.read())

    def fact(self, updated_at=None) -> DataFrame:
        """The fact mart of the table's bars."""
        return fact_daily_performance(price_indicators(self.staging()), updated_at=updated_at)
