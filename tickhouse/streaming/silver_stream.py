"""Silver kept by a stream: the newest Bronze row per key in Spark's state store.

A file stream over the Bronze folders feeds a grouped maximum per
(symbol, date) in update mode, so each micro-batch yields the keys it changed
with their newest row of all time.  ``foreachBatch`` takes these keys out of
the Silver months they lie in and puts their rows back where valid.

Exactly once without a ledger: the state of a batch is versioned by Spark and a
replayed batch yields the same rows.  The months it rewrites are written beside
the checkpoint before they replace the old ones, so a run that broke off while
replacing them finds them whole and replaces them again.

State is one row per key ever seen, with no watermark: a correction may come
at any time.  A symbol has at most one key a day, so it grows with symbols and
days, not with loads; give ``spark.sql.streaming.stateStore.providerClass``
the RocksDB provider where it outgrows the executors' heap.
A null symbol or date is a key like any other.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.operators.medallion import silver_frame
from tickhouse.sources.months import MONTH, MonthTable, months_in

KEYS = ["symbol", "date"]
_FIRST = ["_bronze_loaded_at", "ingested_at", "open", "high", "low", "close", "volume"]


def newest_of_all(bronze: DataFrame) -> DataFrame:
    """Newest row per key as a streaming aggregation: the order of ``silver_frame``.

    A maximum over structs puts nulls last, as the batch order does.
    """
    order = [c for c in _FIRST if c in bronze.columns]
    order += sorted(c for c in bronze.columns if c not in {*order, *KEYS})
    newest = bronze.groupBy(*KEYS).agg(F.max(F.struct(*order)).alias("bar"))
    return newest.select(*KEYS, "bar.*").select(*bronze.columns)


def _same_key(left: DataFrame, right: DataFrame):
    return functools.reduce(operator.and_, (left[k].eqNullSafe(right[k]) for k in KEYS))


def with_newest(changed: DataFrame, silver: MonthTable, months, loaded_at=None) -> DataFrame:
    """Silver of ``months`` with the newest rows of changed keys in place of the old ones."""
    new = silver_frame(changed, loaded_at=loaded_at)
    if not silver.exists():
        return new
    old = silver.read(months)
    stay = old.join(changed.select(*KEYS), _same_key(old, changed), "anti")
    return stay.unionByName(new, allowMissingColumns=True)


def silver_stream(
    spark: SparkSession,
    bronze: MonthTable,
    silver: MonthTable,
    checkpoint: str,
    schema: T.StructType,
    loaded_at=None,
    max_files_per_trigger: int | None = None,
) -> int:
    """Work off all Bronze files landed since the last run; returns the number of batches.

    ``schema`` is that of Bronze.  ``checkpoint`` is a folder in the shared
    store: the progress, the state and the rewritten months of the latest batch.
    """
    reader = spark.readStream.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.IntegerType())]))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = reader.parquet(bronze.path).select(*schema.fieldNames())
    batches: list[int] = []

    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(checkpoint).getFileSystem(spark._jsc.hadoopConfiguration())

    def _merge(batch: DataFrame, batch_id: int) -> None:
        place = f"{checkpoint.rstrip('/')}/silver/{batch_id}"
        batch.write.mode("overwrite").parquet(f"{place}/changed")
        changed = spark.read.schema(schema).parquet(f"{place}/changed")
        months = months_in(changed)
        if months:
            merged = f"{place}/merged"
            if not system.exists(path(f"{merged}/_SUCCESS")):
                rows = with_newest(changed, silver, months, loaded_at)
                rows.write.mode("overwrite").parquet(merged)
            silver.replace(spark.read.parquet(merged), months)
        system.delete(path(f"{checkpoint.rstrip('/')}/silver/{batch_id - 1}"), True)
        batches.append(batch_id)

    query = (
        newest_of_all(landed)
        .writeStream.outputMode("update")
        .foreachBatch(_merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(batches)
