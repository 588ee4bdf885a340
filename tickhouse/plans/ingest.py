"""From landed responses to the raw layer: parse, store rows and rejects, report.

Responses are parsed once into a table of one row per response, in the shared
scratch folder; bars, rejects and counts are read from it.  Bars go to the raw
daily layout, rejects beside it in the same folders by symbol and ingest day,
so a rerun for a symbol and day replaces both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.session import new_scratch_dir
from tickhouse.sources.files import _dynamic_overwrite, write_raw_daily
from tickhouse.sources.responses import accepted_and_rejected, checked_responses

REJECTS_DIR = "rejected_responses"


def ingest_responses(
    spark: SparkSession,
    responses: DataFrame,
    root: str,
    body: str = "body",
    symbol: str = "symbol",
    ingested_at: Column | str | None = "ingested_at",
) -> dict[str, int | str]:
    """Ingest a frame of responses (see ``read_landed_responses``) under ``root``.

    Returns ``status`` (``completed``, or ``no_data`` when no response holds an
    acceptable bar) and the number of ``responses``, ``accepted``, ``rejected``
    and ``silent`` ones (without a series, or with an empty one) and of ``bars``.
    """
    place = new_scratch_dir(spark, "checked-responses")
    checked_responses(responses, body, symbol, ingested_at).write.parquet(place)
    staged = spark.read.parquet(place)
    bad = F.col("_malformed") | (F.col("_bad_entries") > 0)
    entries = F.coalesce(F.array_size("_entries"), F.lit(0))
    counts = staged.agg(
        F.count(F.lit(1)).alias("responses"),
        F.count_if(~bad & (entries > 0)).alias("accepted"),
        F.count_if(bad).alias("rejected"),
        F.count_if(~bad & (entries == 0)).alias("silent"),
        F.coalesce(F.sum(F.when(~bad, entries)), F.lit(0)).alias("bars"),
    ).first()
    prices, rejects = accepted_and_rejected(staged)
    if counts["bars"]:
        write_raw_daily(prices, root)
    if counts["rejected"]:
        day = F.coalesce(F.to_date("ingested_at"), F.current_date())
        _dynamic_overwrite(
            rejects.withColumn("ingest_date", day),
            ["symbol", "ingest_date"],
            f"{root.rstrip('/')}/{REJECTS_DIR}",
        )
    return {"status": "completed" if counts["bars"] else "no_data", **counts.asDict()}
