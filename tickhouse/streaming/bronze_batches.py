"""Exactly-once Bronze loading into one folder per micro-batch.

A file-source stream keeps in its checkpoint which landed files belong to which
micro-batch, and a replayed batch holds the same rows.  So a batch is written
to a folder named after the query and the batch, replacing what an attempt
that broke off has left there: once or many times written, its rows are there
once, without a ledger beside the folders.

A fresh checkpoint is another query and gives other folders.  Columns that
later files bring are null in earlier rows.  A batch without rows leaves an
empty folder; nothing landed leaves none.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickhouse.operators.medallion import bronze_frame

BATCH = "batch"


def read_batches(spark: SparkSession, table_path: str) -> DataFrame:
    """All rows of the batch folders."""
    return spark.read.option("mergeSchema", "true").parquet(table_path).drop(BATCH)


def bronze_batches(
    spark: SparkSession,
    raw_dir: str,
    table_path: str,
    checkpoint: str,
    schema: T.StructType,
    loaded_at=None,
    max_files_per_trigger: int | None = None,
) -> int:
    """Work off all files landed since the last run; returns the number of batches."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    bronze = bronze_frame(reader.parquet(raw_dir), loaded_at=loaded_at)
    done: list[int] = []

    def land(batch: DataFrame, batch_id: int) -> None:
        # the query's own id, which Spark keeps in the checkpoint
        query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        batch.write.mode("overwrite").parquet(f"{table_path}/{BATCH}={query}-{batch_id}")
        done.append(batch_id)

    query = (
        bronze.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(done)
