"""Derive raw daily bars from the driver's ``orders`` table.

The test tables hold no price bars, so every registered query reads bars
that Spark derives from ``orders`` with this mapping.  It is row-local
(no shuffle) and seeds the defects the pipeline must handle: negative
opens, high below low, negative volumes, NULL closes and many duplicate
(symbol, date) keys.  ``o_orderkey`` is unique, so ``ingested_at`` has
no ties.

``ADAPTER_SQL`` is the same mapping for the DuckDB oracle; both engines
produce row-for-row identical bars (prices are exact multiples of 1e-4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping: 8 symbols, defect moduli 41/43/47/53,
# 200-tick open offset, +-500/900-tick high/low band, load times counted
# in seconds from 2024-01-01.
ADAPTER_SQL = """
select
  'SYM' || cast(o_custkey % 8 as varchar(9)) as symbol,
  cast(o_orderdate as date) as date,
  case when o_orderkey % 41 = 0 then -1 else 1 end * (ticks - o_orderkey % 200) / cast(10000 as double) as open,
  (case when o_orderkey % 43 = 0 then ticks - 900 else ticks + 500 end) / cast(10000 as double) as high,
  (ticks - 500) / cast(10000 as double) as low,
  case when o_orderkey % 53 = 0 then null else ticks / cast(10000 as double) end as close,
  case when o_orderkey % 47 = 0 then -1 else o_custkey * 10 end as volume,
  cast('2024-01-01 00:00:00' as timestamp) + o_orderkey * interval '1' second as ingested_at
from (select *, cast(round(o_totalprice * 100) as bigint) as ticks from orders) t
"""


def read_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")


def bars_from_orders(orders: DataFrame) -> DataFrame:
    """Raw daily bars (raw_daily schema, ``ingested_at`` as TIMESTAMP_NTZ)."""
    key = F.col("o_orderkey")
    ticks = F.round(F.col("o_totalprice") * 100).cast("bigint")
    scale = F.lit(10000.0)
    sign = F.when(key % 41 == 0, F.lit(-1)).otherwise(F.lit(1))
    high_ticks = F.when(key % 43 == 0, ticks - 900).otherwise(ticks + 500)
    return orders.select(
        F.concat(F.lit("SYM"), (F.col("o_custkey") % 8).cast("string")).alias("symbol"),
        F.col("o_orderdate").cast("date").alias("date"),
        ((sign * (ticks - key % 200)).cast("double") / scale).alias("open"),
        (high_ticks.cast("double") / scale).alias("high"),
        ((ticks - 500).cast("double") / scale).alias("low"),
        F.when(key % 53 == 0, F.lit(None).cast("double"))
        .otherwise(ticks.cast("double") / scale)
        .alias("close"),
        F.when(key % 47 == 0, F.lit(-1).cast("bigint"))
        .otherwise(F.col("o_custkey") * 10)
        .alias("volume"),
        F.timestamp_add(
            "SECOND", key, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        ).alias("ingested_at"),
    )


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bars for a test scale directory."""
    return bars_from_orders(read_orders(spark, sf_dir))
