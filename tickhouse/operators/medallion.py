"""Bronze, Silver and Gold frames.

These are pure frame-to-frame functions; ``sources.tables`` writes them
as versioned tables and ``plans.flow`` chains the layers.

Scale notes:

* Bronze adds three literal/metadata columns: a projection, no shuffle.
* Silver keeps the newest Bronze row per (symbol, date) and *then*
  filters.  Like staging, the top-1-per-key window is planned as a
  partial WindowGroupLimit before the exchange, so a key loaded many
  times costs one row per map task in the shuffle.
* Gold is one hash aggregation by symbol with map-side partial
  aggregation; only one buffer row per symbol and task is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.operators.staging import latest_first, valid_price_predicate

LOAD_PIPELINE = "raw_ingestion"

def _stamp(value) -> Column:
    return F.current_timestamp() if value is None else F.lit(value)


def _scanned_file(df: DataFrame) -> Column:
    """``_metadata.file_path`` when ``df`` reads files, else NULL."""
    try:
        df.select(F.col("_metadata.file_path")).schema  # noqa: B018 - forces analysis
        return F.col("_metadata.file_path")
    except AnalysisException:
        return F.lit(None).cast("string")


def bronze_frame(
    raw: DataFrame,
    loaded_at=None,
    source_file: Column | str | None = None,
    pipeline: str = LOAD_PIPELINE,
) -> DataFrame:
    """Raw bars plus ``_source_file``, ``_bronze_loaded_at``, ``_load_pipeline``.

    ``source_file`` defaults to the scanned file of each row
    (``_metadata.file_path``), or NULL when ``raw`` does not read files;
    pass a column or a string to set it.  ``loaded_at`` may be
    a value or a Column (defaults to the current timestamp).
    """
    if source_file is None:
        src = _scanned_file(raw)
    elif isinstance(source_file, str):
        src = F.lit(source_file)
    else:
        src = source_file
    loaded = loaded_at if isinstance(loaded_at, Column) else _stamp(loaded_at)
    return raw.select(
        "*",
        src.alias("_source_file"),
        loaded.alias("_bronze_loaded_at"),
        F.lit(pipeline).alias("_load_pipeline"),
    )


def latest_per_key(
    df: DataFrame,
    keys: list[str],
    order_cols: list[str],
    tie_breakers: list[str] | None = None,
) -> DataFrame:
    """Keep the first row per key under a newest-first order.

    Unlike ``dropDuplicates`` the survivor is determined: the given order,
    then ``tie_breakers`` (all descending, NULLs last).
    """
    w = Window.partitionBy(*keys).orderBy(*latest_first(*order_cols, rest=tie_breakers))
    return (
        df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    )


def silver_frame(bronze: DataFrame, loaded_at=None) -> DataFrame:
    """Dedup (newest ``_bronze_loaded_at`` per symbol/date), then validate.

    The validity rule here includes ``high >= low``; a key whose newest
    row is invalid disappears (it does not fall back to an older row).
    Adds ``_silver_loaded_at`` and ``_is_valid`` (always true).
    """
    first = ["ingested_at", "open", "high", "low", "close", "volume"]
    ties = [c for c in first if c in bronze.columns]
    # then every other orderable column (source file, widened columns), so
    # the survivor of identical bars never depends on partitioning
    skip = {"symbol", "date", "_bronze_loaded_at", *ties}
    ties += sorted(
        f.name
        for f in bronze.schema.fields
        if f.name not in skip and not isinstance(f.dataType, T.MapType)
    )
    latest = latest_per_key(bronze, ["symbol", "date"], ["_bronze_loaded_at"], ties)
    loaded = loaded_at if isinstance(loaded_at, Column) else _stamp(loaded_at)
    return latest.where(valid_price_predicate(require_high_ge_low=True)).select(
        "*",
        loaded.alias("_silver_loaded_at"),
        F.lit(True).alias("_is_valid"),
    )


def gold_daily_summary(silver: DataFrame, loaded_at=False) -> DataFrame:
    """Per-symbol summary of Silver.

    ``latest_close`` is the close of the latest date (Silver keys are
    unique, so this is deterministic); means and standard deviation are
    sample statistics over all rows of the symbol.  ``loaded_at``:
    ``False`` omits ``_gold_loaded_at``, ``None`` stamps now.
    """
    out = silver.groupBy("symbol").agg(
        F.max("date").alias("latest_date"),
        F.min("date").alias("earliest_date"),
        F.max_by("close", "date").alias("latest_close"),
        F.avg("close").alias("avg_close"),
        F.stddev_samp("close").alias("std_close"),
        F.avg("volume").alias("avg_volume"),
        F.sum("volume").alias("total_volume"),
        F.count(F.lit(1)).alias("total_records"),
        F.max("high").alias("all_time_high"),
        F.min("low").alias("all_time_low"),
    )
    if loaded_at is False:
        return out
    return out.withColumn("_gold_loaded_at", _stamp(loaded_at))
