"""Raw file layer: daily and historical Parquet, sample CSV.

Layouts (under a root URI):

* ``<root>/daily_prices/symbol=<S>/ingest_date=<D>/`` -- a same-day rerun
  for a symbol replaces that folder only (dynamic partition overwrite);
* ``<root>/historical_prices/symbol=<S>/`` -- a rerun replaces the
  symbol's folder.

Writes use a ``rebalance`` hint on the partition keys: rows of one
folder are gathered into few files, and AQE splits a hot symbol/day
across several tasks instead of sending it to one.  Reads always pass an
explicit schema, so partition values are never type-inferred (a ticker
such as ``"007"`` stays a string).
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.schemas import SAMPLE_CSV, raw_daily_schema, raw_history_schema

DAILY_DIR = "daily_prices"
HISTORY_DIR = "historical_prices"


def _dynamic_overwrite(df: DataFrame, keys: list[str], path: str) -> None:
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_raw_daily(df: DataFrame, root: str, ingest_date: dt.date | None = None) -> str:
    """Land daily bars, one folder per symbol and UTC ingest day.

    The ingest day is the date of ``ingested_at`` (or ``ingest_date`` when
    given, or today when ``ingested_at`` is NULL).  Empty input is an
    error, as in the reference.
    """
    if df.isEmpty():
        raise ValueError("No records to write")
    if ingest_date is not None:
        day = F.lit(ingest_date).cast("date")
    else:
        day = F.coalesce(F.to_date(F.col("ingested_at")), F.current_date())
    path = f"{root.rstrip('/')}/{DAILY_DIR}"
    _dynamic_overwrite(df.withColumn("ingest_date", day), ["symbol", "ingest_date"], path)
    return path


def write_raw_history(df: DataFrame, root: str) -> str:
    """Land historical bars, one folder per symbol (no empty check)."""
    path = f"{root.rstrip('/')}/{HISTORY_DIR}"
    _dynamic_overwrite(df, ["symbol"], path)
    return path


def read_raw(
    spark: SparkSession,
    root: str,
    kind: str = "daily",
    timestamp_type: T.DataType | None = None,
    ingest_date: dt.date | None = None,
) -> DataFrame:
    """Read landed raw bars with an explicit schema.

    ``kind`` is ``daily`` or ``history``.  ``timestamp_type`` is the type
    ``ingested_at`` was written with (TIMESTAMP by default).
    ``ingest_date`` (daily only) keeps one landing day: only that day's
    folders are named, listed and read; a day without folders is empty.
    """
    if kind == "daily":
        schema = raw_daily_schema(timestamp_type)
        full = T.StructType(schema.fields + [T.StructField("ingest_date", T.DateType())])
        path = f"{root.rstrip('/')}/{DAILY_DIR}"
    elif kind == "history":
        schema = raw_history_schema(timestamp_type)
        full = schema
        path = f"{root.rstrip('/')}/{HISTORY_DIR}"
    else:
        raise ValueError(f"kind must be 'daily' or 'history', got {kind!r}")
    if ingest_date is None:
        return spark.read.schema(full).parquet(path).select(*schema.fieldNames())
    if kind != "daily":
        raise ValueError("ingest_date applies to daily raw bars only")
    day = f"{path}/symbol=*/ingest_date={ingest_date.isoformat()}"
    try:
        df = spark.read.schema(full).option("basePath", path).parquet(day)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # nothing landed that day
    return df.select(*schema.fieldNames())


def read_prices_csv(
    spark: SparkSession, path: str, timestamp_type: T.DataType | None = None
) -> DataFrame:
    """Read bars in the sample CSV shape (header, no load time).

    Malformed lines fail the read; ``ingested_at`` is added as NULL of
    ``timestamp_type`` (TIMESTAMP by default).
    """
    df = (
        spark.read.schema(SAMPLE_CSV)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )
    return df.withColumn("ingested_at", F.lit(None).cast(timestamp_type or T.TimestampType()))


def write_prices_csv(df: DataFrame, path: str) -> str:
    """Write bars in the sample CSV shape (header, no load time)."""
    cols = [f.name for f in SAMPLE_CSV.fields]
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)
    return path


BAD_LINE = "_bad_line"
FIELD_COUNT = "field_count"


def read_prices_csv_checked(
    spark: SparkSession,
    path: str,
    timestamp_type: T.DataType | None = None,
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(bars, rejects)`` of CSV files in the sample shape; a bad line ends nothing.

    ``bars`` are those lines whose seven fields all parse; an empty field is
    null, as in ``read_prices_csv``.  ``rejects`` has one row per other line:
    ``line`` (its text), ``reason`` (``field_count``, or ``bad_`` and the first
    field that does not parse) and ``source_file``.  Repeated lines stay
    repeated, empty lines are skipped, a file of a header only gives no rows.

    One scan each, no shuffle: lines are read as text and parsed by
    ``from_csv``, every column whatever is selected, as a pruned one would hide
    its bad values.  ``header`` drops the lines that list the column names.
    """
    names = SAMPLE_CSV.fieldNames()
    schema = T.StructType([*SAMPLE_CSV.fields, T.StructField(BAD_LINE, T.StringType())])
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BAD_LINE,
        "dateFormat": "yyyy-MM-dd",
    }
    lines = spark.read.text(path).where(F.trim("value") != "")
    if header:
        lines = lines.where(F.trim("value") != ",".join(names))
    parsed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.from_csv("value", schema.simpleString(), options).alias("bar"),
    )
    good = F.col("bar")[BAD_LINE].isNull()
    stamp = F.lit(None).cast(timestamp_type or T.TimestampType())
    bar = F.struct(*[F.col("bar")[name].alias(name) for name in names], stamp.alias("ingested_at"))
    # a generator, not a filter: a filter would be pushed below and parse again
    bars = parsed.select(F.inline(F.when(good, F.array(bar))))
    fields = F.split("value", ",", -1)
    unread = [
        F.when(F.col("bar")[name].isNull() & (F.trim(fields[i]) != ""), F.lit(f"bad_{name}"))
        for i, name in enumerate(names)
    ]
    reason = F.when(F.size(fields) != len(names), F.lit(FIELD_COUNT)).otherwise(F.coalesce(*unread))
    reject = F.struct(
        F.col("value").alias("line"),
        F.coalesce(reason, F.lit("unreadable")).alias("reason"),
        "source_file",
    )
    rejects = parsed.select(F.inline(F.when(~good, F.array(reject))))
    return bars, rejects
