"""Parse landed price-API responses (JSON) into raw daily bars.

A response is one JSON document per symbol request:
``{"Meta Data": {...}, "Time Series (Daily)": {"YYYY-MM-DD": {"1. open":
"..", "2. high": "..", "3. low": "..", "4. close": "..", "5. volume":
".."}, ...}}``.

Every step is a row-local expression on the response row -- parse with
``from_json``, convert each map entry with ``transform``, test the whole
response by counting bad entries and only then ``explode`` -- so there is no
shuffle and no per-row Python.  A response without the series key
(rate-limit note, error message) yields no rows and no reject.  A
response with any unparsable entry is rejected *as a whole*, which is
the unit the reference loses when a field is malformed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.schemas import RESPONSE_FIELDS, RESPONSE_SERIES_KEY

_CORRUPT = "_corrupt_record"
_ENTRY_MAP = T.MapType(T.StringType(), T.StringType())
RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField(RESPONSE_SERIES_KEY, T.MapType(T.StringType(), _ENTRY_MAP)),
        T.StructField(_CORRUPT, T.StringType()),
    ]
)



def _entry(e: Column) -> Column:
    fields = e["value"]
    parsed = F.struct(
        F.try_to_timestamp(e["key"], F.lit("yyyy-M-d")).cast("date").alias("date"),
        fields[RESPONSE_FIELDS["open"]].try_cast("double").alias("open"),
        fields[RESPONSE_FIELDS["high"]].try_cast("double").alias("high"),
        fields[RESPONSE_FIELDS["low"]].try_cast("double").alias("low"),
        fields[RESPONSE_FIELDS["close"]].try_cast("double").alias("close"),
        fields[RESPONSE_FIELDS["volume"]].try_cast("bigint").alias("volume"),
    )
    return parsed


# A JSON object that repeats a date key keeps the last value when read by
# a plain JSON parser; Spark's map keeps every copy.  Positions are sorted
# by (key, position descending), the first of each key is kept and its
# entry fetched by position.  Array functions only: no shuffle, and each
# step is its own column so no array is recomputed inside a lambda.


def _key_order(entries: str) -> Column:
    return F.array_sort(
        F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), (-i).alias("pos")))
    )


def _last_per_key(entries: str, order: str) -> Column:
    prev_key = lambda i: F.element_at(F.col(order), i)["key"]  # noqa: E731 - 1-based: i-1
    keep = F.filter(order, lambda x, i: (i == 0) | (prev_key(i) != x["key"]))
    return F.transform(keep, lambda x: F.element_at(F.col(entries), 1 - x["pos"]))


def _entry_bad(x: Column) -> Column:
    return (
        x["date"].isNull()
        | x["open"].isNull()
        | x["high"].isNull()
        | x["low"].isNull()
        | x["close"].isNull()
        | x["volume"].isNull()
    )


def checked_responses(
    responses: DataFrame,
    body: str = "body",
    symbol: str = "symbol",
    ingested_at: Column | str | None = None,
) -> DataFrame:
    """One row per response: its entries, and how many of them cannot be read."""
    if ingested_at is None:
        stamp = F.current_timestamp()
    elif isinstance(ingested_at, str):
        stamp = F.col(ingested_at)
    else:
        stamp = ingested_at
    doc = F.from_json(F.col(body), RESPONSE_SCHEMA, {"columnNameOfCorruptRecord": _CORRUPT})
    return (
        responses.select(
            F.col(symbol).alias("symbol"),
            stamp.alias("ingested_at"),
            doc.alias("_doc"),
        )
        .select(
            "symbol",
            "ingested_at",
            # no document at all (NULL or empty body: a truncated download) is a
            # reject too; only a document without a series may be silent
            (F.col("_doc").isNull() | F.col("_doc")[_CORRUPT].isNotNull()).alias("_malformed"),
            F.map_entries(F.col("_doc")[RESPONSE_SERIES_KEY]).alias("_raw_entries"),
        )
        .withColumn(
            "_repeats",
            F.size(F.array_distinct(F.col("_raw_entries.key"))) < F.size("_raw_entries"),
        )
        # only a response that repeats a key pays for the sort
        .withColumn("_order", F.when(F.col("_repeats"), _key_order("_raw_entries")))
        .select(
            "symbol",
            "ingested_at",
            "_malformed",
            F.transform(
                F.when(F.col("_repeats"), _last_per_key("_raw_entries", "_order")).otherwise(
                    F.col("_raw_entries")
                ),
                _entry,
            ).alias("_entries"),
        )
        .withColumn(
            "_bad_entries",
            # size(NULL) is -1 without ANSI mode: test for the missing series
            F.when(F.col("_entries").isNull(), F.lit(0)).otherwise(
                F.size(F.filter("_entries", _entry_bad))
            ),
        )
    )


def parse_daily_responses(
    responses: DataFrame,
    body: str = "body",
    symbol: str = "symbol",
    ingested_at: Column | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Return ``(prices, rejects)`` for a frame of landed responses.

    ``responses`` has one row per response with its JSON text in ``body``
    and the requested ticker in ``symbol``.  ``ingested_at`` (column name
    or Column) stamps each response; by default every response of the
    query gets the query's current timestamp.

    Rows are kept or dropped by the generator (``explode`` of NULL emits
    nothing) rather than by a filter: the optimizer pushes a filter below
    the projection and would re-run the JSON parse once per predicate.
    """
    return accepted_and_rejected(checked_responses(responses, body, symbol, ingested_at))


def accepted_and_rejected(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(prices, rejects)`` of what ``checked_responses`` returns."""
    ok = ~F.col("_malformed") & (F.col("_bad_entries") == 0)
    prices = staged.select(
        "symbol", "ingested_at", F.explode(F.when(ok, F.col("_entries"))).alias("e")
    ).select(
        "symbol",
        "e.date",
        "e.open",
        "e.high",
        "e.low",
        "e.close",
        "e.volume",
        "ingested_at",
    )
    reject = F.struct(
        F.when(F.col("_malformed"), F.lit("malformed_json"))
        .otherwise(F.lit("bad_field"))
        .alias("reason"),
        F.col("_bad_entries").cast("int").alias("bad_entries"),
    )
    rejects = staged.select(
        "symbol", "ingested_at", F.inline(F.when(~ok, F.array(reject)))
    )
    return prices, rejects


def read_landed_responses(spark: SparkSession, path: str) -> DataFrame:
    """Read landed response files laid out as ``<path>/symbol=<S>/*.json``.

    One row per file: ``symbol``, ``body`` (whole file text), the file
    path and its modification time (used as ``ingested_at``).
    """
    return (
        spark.read.format("text")
        .schema("value string, symbol string")
        .option("wholetext", True)
        .load(path)
        .select(
            "symbol",
            F.col("value").alias("body"),
            F.col("_metadata.file_path").alias("landed_file"),
            F.col("_metadata.file_modification_time").alias("ingested_at"),
        )
    )


def responses_from_bars(bars: DataFrame) -> DataFrame:
    """Encode bars as responses, one response per bar and load time.

    Used to land test responses from existing bars; every value is
    written as text the way the API sends it (NULL stays JSON null).
    """
    fields = F.create_map(
        *[
            part
            for name, key in RESPONSE_FIELDS.items()
            for part in (F.lit(key), F.col(name).cast("string"))
        ]
    )
    series = F.create_map(F.date_format("date", "yyyy-MM-dd"), fields)
    doc = F.struct(
        F.create_map(F.lit("2. Symbol"), F.col("symbol")).alias("Meta Data"),
        series.alias(RESPONSE_SERIES_KEY),
    )
    return bars.select("symbol", "ingested_at", F.to_json(doc).alias("body"))


def response_documents(bars: DataFrame, seconds: int = 300) -> DataFrame:
    """Encode bars as responses of many dates: one per symbol and block of load times.

    A document lists its bars in the order of their load times, so a date that
    is loaded twice stands there twice, and carries its latest load time.  It
    holds what one symbol loads within ``seconds``: the block is the bound of
    the document's size, whatever the length of the history.
    """
    fields = F.create_map(
        *[
            part
            for name, key in RESPONSE_FIELDS.items()
            for part in (F.lit(key), F.col(name).cast("string"))
        ]
    )
    entry = F.concat(
        # a bar without a date gets a key that no parser reads: it rejects the response
        F.lit('"'),
        F.coalesce(F.date_format("date", "yyyy-MM-dd"), F.lit("")),
        F.lit('":'),
        F.to_json(fields),
    )
    loaded = F.unix_micros(F.col("ingested_at").cast("timestamp"))
    block = F.floor(loaded / F.lit(seconds * 1_000_000))
    listed = bars.groupBy("symbol", block.alias("block")).agg(
        F.max("ingested_at").alias("ingested_at"),
        # text objects put together by hand: a map cannot hold a key twice
        F.array_sort(F.collect_list(F.struct("ingested_at", entry.alias("entry")))).alias("bars"),
    )
    head = F.to_json(F.create_map(F.lit("2. Symbol"), F.col("symbol")))
    return listed.select(
        "symbol",
        "ingested_at",
        F.concat(
            F.lit('{"Meta Data":'),
            F.coalesce(head, F.lit("{}")),
            F.lit(f',"{RESPONSE_SERIES_KEY}":{{'),
            F.array_join("bars.entry", ","),
            F.lit("}}"),
        ).alias("body"),
    )
