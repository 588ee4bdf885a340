"""Skew behaviour measured from shuffle metrics.

A hot key holds almost every row.  Dedup and the quality pass must
shrink it before the exchange: at most one row per map task and key
crosses the shuffle, whatever the key's size.
"""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickhouse.operators import quality as dq
from tickhouse.operators.medallion import bronze_frame, silver_frame
from tickhouse.operators.staging import clean_staging

ROWS, MAP_TASKS, COLD_EVERY = 200_000, 4, 1000


def _seq(s):
    return [s.apply(i) for i in range(s.size())]


def _exchanges(node, out):
    name = node.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return _exchanges(node.executedPlan(), out)
    if "QueryStage" in name:
        _exchanges(node.plan(), out)
    metrics = node.metrics()
    if metrics.contains("shuffleRecordsWritten"):
        out.append(metrics.get("shuffleRecordsWritten").get().value())
    for child in _seq(node.children()):
        _exchanges(child, out)
    return out


def shuffle_records(df) -> list[int]:
    """Run ``df`` and return the rows written by each shuffle exchange."""
    df.collect()
    return _exchanges(df._jdf.queryExecution().executedPlan(), [])


@pytest.fixture(scope="module")
def hot_bars(spark):
    key = F.col("id")
    return spark.range(0, ROWS, numPartitions=MAP_TASKS).select(
        F.when(key % COLD_EVERY == 0, F.concat(F.lit("C"), key.cast("string")))
        .otherwise(F.lit("HOT"))
        .alias("symbol"),
        F.date_add(F.lit(dt.date(2024, 1, 2)), (key % 1).cast("int")).alias("date"),
        F.lit(1.0).alias("open"),
        F.lit(2.0).alias("high"),
        F.lit(0.5).alias("low"),
        (F.lit(1.0) + key / ROWS).alias("close"),
        key.alias("volume"),
        F.timestamp_seconds(key).alias("ingested_at"),
    )


def test_staging_ships_one_hot_row_per_task(hot_bars):
    stg = clean_staging(hot_bars)
    records = shuffle_records(stg)
    cold = ROWS // COLD_EVERY
    assert records and records[0] <= cold + MAP_TASKS
    newest = stg.where("symbol = 'HOT'").first()
    assert newest["volume"] == ROWS - 1  # the newest load wins


def test_silver_ships_one_hot_row_per_task(hot_bars):
    bronze = bronze_frame(hot_bars, loaded_at=F.col("ingested_at"), source_file="hot")
    records = shuffle_records(silver_frame(bronze))
    assert records and records[0] <= ROWS // COLD_EVERY + MAP_TASKS


def test_quality_pass_combines_before_shuffle(hot_bars):
    rep = dq.dq_report(hot_bars, dq.standard_suite(), "hot", today=dt.date(2024, 1, 3))
    records = shuffle_records(rep)
    assert records[0] <= ROWS // COLD_EVERY + MAP_TASKS
    got = {r["check_name"]: r["records_failed"] for r in rep.collect()}
    assert got["unique_symbol_date"] == ROWS - (ROWS // COLD_EVERY) - 1
