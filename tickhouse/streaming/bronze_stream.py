"""Exactly-once Bronze loading with Structured Streaming.

The reference appends each newly landed raw file to Bronze in a loop,
and a rerun appends the same file again.  Here a file-source stream
tracks which files it has seen in its checkpoint, and each micro-batch
is appended with a transaction id ``(stream id, batch id)``: when a
batch is replayed after a failure between the table commit and the
checkpoint commit, the table already holds that id and the append is
skipped.  ``trigger(availableNow=True)`` processes everything landed so
far and stops, so the same code serves scheduled batch runs and a
continuously running stream (``trigger(processingTime=...)``).
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickhouse.operators.medallion import bronze_frame
from tickhouse.schemas import RAW_DAILY
from tickhouse.sources.tables import VersionedTable, _Fs


def bronze_stream(
    spark: SparkSession,
    raw_dir: str,
    table_path: str,
    checkpoint: str | None = None,
    schema: T.StructType | None = None,
    loaded_at=None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    columns: list[str] | None = None,
):
    """Start the stream; with ``available_now`` wait for it and return stats.

    ``raw_dir`` holds raw Parquet files with ``schema`` (raw daily by
    default); ``columns`` keeps only those (e.g. drops a partition column
    of the landing layout).  ``checkpoint`` defaults to a folder inside
    the table, so repeated runs for the same table are exactly-once
    without passing it.  Returns ``{"batches": n, "query_id": id}`` for an
    available-now run, or the running ``StreamingQuery`` otherwise.
    """
    # the default checkpoint lives with the table, so every run of the
    # loader for this table resumes from the same progress
    checkpoint = checkpoint or f"{table_path.rstrip('/')}/_checkpoints/bronze_stream"
    reader = spark.readStream.schema(schema or RAW_DAILY)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = reader.parquet(raw_dir)
    if columns:
        landed = landed.select(*columns)
    bronze = bronze_frame(landed, loaded_at=loaded_at)
    table = VersionedTable(spark, table_path)
    progress = _Fs(spark, checkpoint)
    seen: list[int] = []

    def _append(batch: DataFrame, batch_id: int) -> None:
        # the query's own id, kept in its checkpoint: a fresh checkpoint at the same
        # place starts batch numbers anew under another id
        query_id = json.loads(progress.read_text("metadata"))["id"]
        table.append(
            batch,
            merge_schema=True,
            txn=(f"bronze-stream:{query_id}", batch_id),
            time_column="_bronze_loaded_at",
        )
        seen.append(batch_id)

    writer = (
        bronze.writeStream.foreachBatch(_append)
        .option("checkpointLocation", checkpoint)
        .queryName(f"bronze_stream_{zlib.crc32(checkpoint.encode()):08x}")
    )
    if available_now:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return {"batches": len(seen), "query_id": str(query.id)}
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
