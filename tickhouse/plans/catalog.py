"""Registered queries: one Spark callable and one oracle statement each.

Every callable takes ``(spark, sf_dir)``, reads the scale directory's
``orders`` table through the bar adapter and returns a lazy DataFrame
over the whole table.  Audit columns stamped with the wall clock
(``updated_at``, ``*_loaded_at``) are either fixed by argument or left
out so results are reproducible.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.functions.columns import safe_divide
from tickhouse.operators import quality as dq
from tickhouse.operators.indicators import fact_daily_performance, price_indicators
from tickhouse.operators.medallion import bronze_frame, gold_daily_summary, silver_frame
from tickhouse.operators.serving import list_symbols, price_history, symbol_detail
from tickhouse.operators.slices import sliced_indicators
from tickhouse.operators.staging import clean_staging, stage_types, valid_price_predicate
from tickhouse.operators.weekly import weekly_performance
from tickhouse.plans import oracle
from tickhouse.plans.daily import run_daily
from tickhouse.plans.flow import (
    build_marts,
    load_bronze,
    run_medallion,
)
from tickhouse.plans.ingest import ingest_responses
from tickhouse.plans.monthly import MonthLayers
from tickhouse.session import new_scratch_dir
from tickhouse.sources.adapter import raw_bars
from tickhouse.sources.bucketed import BucketedBars
from tickhouse.sources.files import (
    read_prices_csv,
    read_prices_csv_checked,
    read_raw,
    write_prices_csv,
    write_raw_daily,
    write_raw_history,
)
from tickhouse.sources.history import parse_history_frame
from tickhouse.sources.months import MonthTable
from tickhouse.sources.responses import parse_daily_responses, response_documents
from tickhouse.sources.served import ServedBars
from tickhouse.sources.tables import VersionedTable, layer_path
from tickhouse.streaming.bronze_batches import bronze_batches, read_batches
from tickhouse.streaming.silver_stream import silver_stream

Query = Callable[[SparkSession, str], DataFrame]

# Fixed arguments of the registered queries (mirrored in ``oracle``).
NTZ = T.TimestampNTZType()
DQ_TODAY = dt.date.fromisoformat(oracle.DQ_TODAY)
SPLIT_DATE = dt.date.fromisoformat(oracle.SPLIT_DATE)
OVERLAP_DATE = dt.date.fromisoformat(oracle.OVERLAP_DATE)


def fixed_loaded_at() -> F.Column:
    return F.lit(oracle.FIXED_LOADED_AT).cast(NTZ)


def _overlapping_loads(raw: DataFrame) -> list[tuple[DataFrame, F.Column]]:
    """Two Bronze batches sharing one year of keys, the second loaded later."""
    return [
        (raw.where(F.col("date") < F.lit(SPLIT_DATE)), F.lit(oracle.FIRST_LOAD_AT).cast(NTZ)),
        (raw.where(F.col("date") >= F.lit(OVERLAP_DATE)), F.lit(oracle.SECOND_LOAD_AT).cast(NTZ)),
    ]


def _before_and_after(raw: DataFrame) -> list[DataFrame]:
    """The bars before the split date, then the others."""
    late = F.coalesce(F.col("date") >= F.lit(SPLIT_DATE), F.lit(True))
    return [raw.where(~late), raw.where(late)]


def q_stg_daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging model: filter, newest row per (symbol, date), typed columns."""
    return clean_staging(raw_bars(spark, sf_dir))


def q_price_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicator model: lag, returns, moving averages, volatility, signals."""
    return price_indicators(clean_staging(raw_bars(spark, sf_dir)))


def q_fact_daily_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily fact mart: indicators without prev_close (audit stamp left out)."""
    ind = price_indicators(clean_staging(raw_bars(spark, sf_dir)))
    return fact_daily_performance(ind, updated_at=False)


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_fact_daily_performance(spark, sf_dir)


def q_weekly_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly roll-up, one row per symbol and Monday-started week."""
    return weekly_performance(_fact(spark, sf_dir), grain="week")


def q_weekly_performance_day_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly roll-up as the model's SQL literally groups it: one row per day."""
    return weekly_performance(_fact(spark, sf_dir), grain="day")


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_frame(
        raw_bars(spark, sf_dir),
        loaded_at=F.col("ingested_at"),
        source_file=oracle.SOURCE_FILE,
    )
    return silver_frame(bronze, loaded_at=fixed_loaded_at())


def q_silver_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver: newest Bronze row per key, then the validity rule incl. high >= low."""
    return _silver(spark, sf_dir)


def q_silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping Bronze loads; the touched months of Silver follow each."""
    layers = MonthLayers(spark, new_scratch_dir(spark, "lakehouse"))
    for frame, when in _overlapping_loads(raw_bars(spark, sf_dir)):
        months = layers.load_bars(frame, loaded_at=when, source_file=oracle.SOURCE_FILE)
        layers.refresh_silver(months, loaded_at=fixed_loaded_at())
    return layers.silver.read()


def q_medallion_stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping Bronze loads streamed into Silver, the stream started anew after each."""
    layers = MonthLayers(spark, new_scratch_dir(spark, "lakehouse"))
    checkpoint = new_scratch_dir(spark, "checkpoint")
    for frame, when in _overlapping_loads(raw_bars(spark, sf_dir)):
        layers.load_bars(frame, loaded_at=when, source_file=oracle.SOURCE_FILE)
        schema = bronze_frame(frame, when, oracle.SOURCE_FILE).schema
        silver_stream(
            spark, layers.bronze, layers.silver, checkpoint, schema, loaded_at=fixed_loaded_at()
        )
    return layers.silver.read()


def q_gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping Bronze loads; Gold's moments of the touched months follow each."""
    layers = MonthLayers(spark, new_scratch_dir(spark, "lakehouse"))
    for frame, when in _overlapping_loads(raw_bars(spark, sf_dir)):
        months = layers.load_bars(frame, loaded_at=when, source_file=oracle.SOURCE_FILE)
        layers.refresh_silver(months, loaded_at=fixed_loaded_at())
        layers.refresh_moments(months)
    return _round_gold(layers.gold())


def q_stg_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping Bronze loads; the touched months of staging follow each."""
    layers = MonthLayers(spark, new_scratch_dir(spark, "lakehouse"))
    for frame, when in _overlapping_loads(raw_bars(spark, sf_dir)):
        layers.refresh_staged(layers.load_bars(frame, when, oracle.SOURCE_FILE))
    return stage_types(layers.staged.read())


def _backdated(spark: SparkSession, sf_dir: str) -> MonthLayers:
    """All layers after the bars from the split date on, then those before it
    but for the seventh day of each month, then those days."""
    raw = raw_bars(spark, sf_dir)
    layers = MonthLayers(spark, new_scratch_dir(spark, "lakehouse"))
    late, seventh = F.col("date") >= F.lit(SPLIT_DATE), F.dayofmonth("date") == 7
    for frame in (raw.where(late), raw.where(~late & ~seventh), raw.where(~late & seventh)):
        layers.refresh(layers.load_bars(frame, source_file=oracle.SOURCE_FILE))
    return layers


def q_fact_backdated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact mart after backdated bars: only the intervals they reach are redone."""
    return _backdated(spark, sf_dir).fact.read()


def q_weekly_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly mart after backdated bars: only the weeks with redone rows."""
    return _backdated(spark, sf_dir).weekly.read()


def q_fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars before and from the split date loaded in turn; the fact mart is
    built, then extended with the later bars."""
    raw = raw_bars(spark, sf_dir)
    root = new_scratch_dir(spark, "lakehouse")
    batches = [
        (raw.where(F.col("date") < F.lit(SPLIT_DATE)), F.lit(oracle.FIRST_LOAD_AT).cast(NTZ)),
        (raw.where(F.col("date") >= F.lit(SPLIT_DATE)), F.lit(oracle.SECOND_LOAD_AT).cast(NTZ)),
    ]
    for frame, when in batches:
        load_bronze(spark, frame, root, loaded_at=when, source_file=oracle.SOURCE_FILE)
        build_marts(spark, root, updated_at=False)
    return VersionedTable(spark, layer_path(root, "marts", "fact_daily_performance")).read()


def _round_gold(gold: DataFrame) -> DataFrame:
    # double means and deviations depend on summation order in their last
    # bits; compare them at 6 decimals
    return gold.select(
        *[
            F.round(c, 6).alias(c) if c in ("avg_close", "std_close", "avg_volume") else c
            for c in gold.columns
        ]
    )


def q_gold_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold per-symbol summary (means and deviation compared at 6 decimals)."""
    return _round_gold(gold_daily_summary(_silver(spark, sf_dir)))


def q_fact_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact mart computed in slices of 128 rows, each with the rows it looks back to."""
    found = sliced_indicators(clean_staging(raw_bars(spark, sf_dir)), rows=128, block_days=365)
    return fact_daily_performance(found, updated_at=False)


def q_fact_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact mart from bars bucketed by symbol: no exchange in its plan."""
    place = new_scratch_dir(spark, "bucketed")
    bars = BucketedBars(spark, f"tickhouse_{place[-12:]}", place)
    bars.write(raw_bars(spark, sf_dir), buckets=8)
    return bars.fact(updated_at=False)


def q_list_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold written as a versioned table and served back by list_symbols."""
    root = new_scratch_dir(spark, "lakehouse")
    gold = gold_daily_summary(_silver(spark, sf_dir))
    VersionedTable(spark, layer_path(root, "gold")).overwrite(gold)
    return _round_gold(list_symbols(spark, root))


def q_symbol_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 30 Silver bars of one symbol (argument upper-cased)."""
    return symbol_detail(_silver(spark, sf_dir), "sym3")


def q_price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows of one symbol in a closed date range, newest 100."""
    return price_history(
        _silver(spark, sf_dir), "sym5", dt.date(1996, 1, 1), dt.date(1999, 12, 31), limit=100
    )


def _served(spark: SparkSession, sf_dir: str) -> ServedBars:
    served = ServedBars(spark, new_scratch_dir(spark, "served"))
    served.write(_silver(spark, sf_dir))
    return served


def q_symbol_detail_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 30 bars of one symbol from the written, clustered Silver."""
    return _served(spark, sf_dir).symbol_detail("sym3")


def q_price_history_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One symbol in a closed date range from the written, clustered Silver, newest 100."""
    return _served(spark, sf_dir).price_history(
        "sym5", dt.date(1996, 1, 1), dt.date(1999, 12, 31), limit=100
    )


def _raw_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.dq_report(
        raw_bars(spark, sf_dir),
        dq.standard_suite(),
        "daily_prices",
        today=DQ_TODAY,
        executed_at=False,
    )


def q_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standard 11-check quality report on the raw bars (one pass)."""
    return _raw_report(spark, sf_dir)


def q_silver_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow's check suite on Silver: only NULL keys and freshness can fail."""
    silver = _silver(spark, sf_dir)
    return dq.dq_report(
        silver, dq.standard_suite(), "daily_prices", today=DQ_TODAY, executed_at=False
    )


def q_silver_dq_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite on Silver, measured by the job that writes it."""
    checks = dq.WriteChecks(dq.standard_suite(), deduped=("symbol", "date"))
    checks.watch(_silver(spark, sf_dir)).write.parquet(new_scratch_dir(spark, "silver"))
    return checks.report(spark, "daily_prices", today=DQ_TODAY, executed_at=False)


def q_silver_dq_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite on Silver after two loads, from the measures of its months."""
    layers, raw = MonthLayers(spark, new_scratch_dir(spark, "lakehouse")), raw_bars(spark, sf_dir)
    for frame in _before_and_after(raw):
        months = layers.load_bars(frame, source_file=oracle.SOURCE_FILE)
        layers.refresh_silver(months)
        layers.refresh_checks(months)
    return layers.checks_report(today=DQ_TODAY, executed_at=False)


def q_dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over the raw-bar quality report."""
    return dq.dq_summary(_raw_report(spark, sf_dir))


def q_dq_value_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range checks (warnings) on close and open."""
    checks = [dq.value_range("close", 0.0, 4000.0), dq.value_range("open", 0.0, 4000.0)]
    return dq.dq_report(raw_bars(spark, sf_dir), checks, "daily_prices", executed_at=False)


def q_dq_model_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared model tests over raw, staging, fact and weekly models."""
    raw = raw_bars(spark, sf_dir)
    stg = clean_staging(raw)
    fact = fact_daily_performance(price_indicators(stg), updated_at=False)
    weekly = weekly_performance(fact, grain="week")
    return dq.model_tests(
        {
            "raw.daily_prices": raw,
            "stg_daily_prices": stg,
            "fact_daily_performance": fact,
            "agg_weekly_performance": weekly,
        }
    )


def q_safe_divide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """close / (volume + 1), NULL where the denominator is 0 or NULL."""
    raw = raw_bars(spark, sf_dir)
    return raw.select(
        "symbol",
        "date",
        "ingested_at",
        safe_divide(F.col("close"), F.col("volume") + 1).alias("close_per_volume"),
    )


def _parsed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    responses = response_documents(raw_bars(spark, sf_dir), oracle.RESPONSE_SECONDS)
    return parse_daily_responses(responses, ingested_at="ingested_at")


def q_parse_daily_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars encoded as API responses of many dates and parsed back (accepted rows)."""
    return _parsed(spark, sf_dir)[0]


def q_parse_daily_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses rejected whole because a field of one of their dates does not parse."""
    return _parsed(spark, sf_dir)[1]


def q_ingest_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of many dates ingested into the raw layer, read back from there."""
    root = new_scratch_dir(spark, "raw")
    responses = response_documents(raw_bars(spark, sf_dir), oracle.RESPONSE_SECONDS)
    ingest_responses(spark, responses, root)
    return read_raw(spark, root, "daily", timestamp_type=NTZ)


def _vendor_frame(raw: DataFrame) -> DataFrame:
    """Bars in the vendor's history shape, with sub-tick noise to round off."""
    return raw.select(
        "symbol",
        F.col("date").cast(NTZ).alias("Date"),
        (F.col("open") + 0.00003).alias("Open"),
        (F.col("high") + 0.00004).alias("High"),
        (F.col("low") - 0.00004).alias("Low"),
        (F.col("close") + 0.00001).alias("Close"),
        F.col("volume").alias("Volume"),
        ((F.col("volume") % 7).cast("double") / 4).alias("Dividends"),
        "ingested_at",
    )


def q_parse_history_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars in the vendor history shape parsed back (rounding, defaults)."""
    frame = _vendor_frame(raw_bars(spark, sf_dir))
    return parse_history_frame(frame, ingested_at="ingested_at")


def q_raw_daily_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily raw landing (symbol/ingest-day folders) written and read back."""
    root = new_scratch_dir(spark, "raw")
    write_raw_daily(raw_bars(spark, sf_dir), root)
    return read_raw(spark, root, "daily", timestamp_type=NTZ)


def q_raw_history_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical raw landing (symbol folders) written and read back."""
    root = new_scratch_dir(spark, "raw")
    write_raw_history(q_parse_history_frame(spark, sf_dir), root)
    return read_raw(spark, root, "history", timestamp_type=NTZ)


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars in the sample CSV shape written and read back."""
    path = new_scratch_dir(spark, "csv")
    write_prices_csv(raw_bars(spark, sf_dir), path)
    return read_prices_csv(spark, path, timestamp_type=NTZ)


def _checked_csv(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Bars as CSV lines, some of them damaged, read with their rejects."""
    close = F.coalesce(F.col("close").cast("decimal(18,4)").cast("string"), F.lit("n/a"))
    cut = F.col("close").isNotNull() & (F.col("volume") < 0)
    dated = F.col("close").isNotNull() & (F.col("volume") >= 0) & (F.col("open") < 0)
    date = F.concat(F.when(dated, F.lit("D")).otherwise(F.lit("")), F.date_format("date", "yyyy-MM-dd"))
    prices = [F.col(c).cast("decimal(18,4)").cast("string") for c in ("open", "high", "low")]
    # concat_ws leaves nulls out: a cut line ends after its sixth field
    volume = F.when(~cut, F.col("volume").cast("string"))
    line = F.concat_ws(",", "symbol", date, *prices, close, volume)
    path = new_scratch_dir(spark, "csv-lines")
    raw_bars(spark, sf_dir).select(line.alias("value")).write.text(path)
    return read_prices_csv_checked(spark, path, timestamp_type=NTZ, header=False)


def q_csv_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good lines of CSV files that hold bad ones too."""
    return _checked_csv(spark, sf_dir)[0]


def q_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bad lines of CSV files, with their text and what is wrong with them."""
    return _checked_csv(spark, sf_dir)[1].drop("source_file")


def q_bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily raw landing loaded into Bronze by path (file column left out)."""
    raw_root = new_scratch_dir(spark, "raw")
    layers = MonthLayers(spark, new_scratch_dir(spark, "lakehouse"))
    write_raw_daily(raw_bars(spark, sf_dir), raw_root)
    layers.load_raw(raw_root, loaded_at=fixed_loaded_at(), timestamp_type=NTZ)
    return layers.bronze.read().drop("_source_file")


def _history(spark: SparkSession, raw: DataFrame) -> DataFrame:
    return parse_history_frame(_vendor_frame(raw), ingested_at="ingested_at")


def q_bronze_load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily and history raw folders loaded into one Bronze by path; its schema widens."""
    raw_root = new_scratch_dir(spark, "raw")
    layers = MonthLayers(spark, new_scratch_dir(spark, "lakehouse"))
    early, late = _before_and_after(raw_bars(spark, sf_dir))
    write_raw_daily(early, raw_root)
    write_raw_history(_history(spark, late), raw_root)
    for kind in ("daily", "history"):
        layers.load_raw(raw_root, kind, loaded_at=fixed_loaded_at(), timestamp_type=NTZ)
    return layers.bronze.read().drop("_source_file")


def q_bronze_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily then history-shaped appends to month folders; the schema widens."""
    early, late = _before_and_after(raw_bars(spark, sf_dir))
    table = MonthTable(spark, new_scratch_dir(spark, "table"))
    table.append(early)
    table.append(_history(spark, late))
    return table.read()


def _versioned(spark: SparkSession, sf_dir: str) -> VersionedTable:
    raw = raw_bars(spark, sf_dir)
    table = VersionedTable(spark, new_scratch_dir(spark, "table"))
    table.append(raw.where(F.col("date") < F.lit(SPLIT_DATE)))
    table.append(raw.where(F.col("date") >= F.lit(SPLIT_DATE)))
    table.overwrite(table.read(1).where(valid_price_predicate(require_high_ge_low=True)))
    return table


def q_table_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time travel: the table as of version 1 (two appends)."""
    return _versioned(spark, sf_dir).read(version=1)


def q_table_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after an overwrite (latest version)."""
    return _versioned(spark, sf_dir).read()


def q_bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files streamed into Bronze, rerun adds nothing (exactly once)."""
    raw = raw_bars(spark, sf_dir)
    landing = new_scratch_dir(spark, "landing")
    # three landed files, streamed one per micro-batch
    raw.repartitionByRange(3, "ingested_at").write.parquet(landing)
    table_path = new_scratch_dir(spark, "bronze")
    checkpoint = new_scratch_dir(spark, "checkpoint")
    for _ in range(2):  # the rerun finds nothing new and adds nothing
        bronze_batches(
            spark, landing, table_path, checkpoint, schema=raw.schema, max_files_per_trigger=1
        )
    return read_batches(spark, table_path).drop("_source_file", "_bronze_loaded_at")


def q_medallion_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end-to-end run over the raw bars, as a one-row summary."""
    root = new_scratch_dir(spark, "lakehouse")
    summary = run_medallion(
        spark,
        raw_bars(spark, sf_dir),
        root,
        today=DQ_TODAY,
        loaded_at=fixed_loaded_at(),
        source_file=oracle.SOURCE_FILE,
    )
    return _summary_row(spark, summary)


def q_daily_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs on month folders, the bars from the split date on in the second."""
    layers = MonthLayers(spark, new_scratch_dir(spark, "lakehouse"))
    for frame in _before_and_after(raw_bars(spark, sf_dir)):
        summary = run_daily(
            layers,
            frame,
            today=DQ_TODAY,
            loaded_at=fixed_loaded_at(),
            source_file=oracle.SOURCE_FILE,
        )
    return _summary_row(spark, summary)


def _summary_row(spark: SparkSession, summary: dict) -> DataFrame:
    d = summary["dq_summary"]
    row = (
        summary["status"],
        summary["symbols_processed"],
        summary["total_symbols"],
        d["total_checks"],
        d["passed"],
        d["failed"],
        d["warnings"],
        d["all_passed"],
        summary["models_status"],
    )
    return spark.createDataFrame(
        [row],
        "status string, symbols_processed bigint, total_symbols bigint, "
        "dq_total_checks bigint, dq_passed bigint, dq_failed bigint, dq_warnings bigint, "
        "dq_all_passed boolean, models_status string",
    )


QUERIES: dict[str, Query] = {
    "stg_daily_prices": q_stg_daily_prices,
    "stg_incremental": q_stg_incremental,
    "price_indicators": q_price_indicators,
    "fact_daily_performance": q_fact_daily_performance,
    "fact_incremental": q_fact_incremental,
    "fact_backdated": q_fact_backdated,
    "fact_sliced": q_fact_sliced,
    "fact_bucketed": q_fact_bucketed,
    "weekly_incremental": q_weekly_incremental,
    "weekly_performance": q_weekly_performance,
    "weekly_performance_day_grain": q_weekly_performance_day_grain,
    "silver_prices": q_silver_prices,
    "silver_incremental": q_silver_incremental,
    "medallion_stream_silver": q_medallion_stream_silver,
    "gold_incremental": q_gold_incremental,
    "gold_daily_summary": q_gold_daily_summary,
    "list_symbols": q_list_symbols,
    "symbol_detail": q_symbol_detail,
    "price_history": q_price_history,
    "symbol_detail_served": q_symbol_detail_served,
    "price_history_served": q_price_history_served,
    "dq_report": q_dq_report,
    "silver_dq_report": q_silver_dq_report,
    "silver_dq_on_write": q_silver_dq_on_write,
    "silver_dq_incremental": q_silver_dq_incremental,
    "dq_summary": q_dq_summary,
    "dq_value_range": q_dq_value_range,
    "dq_model_tests": q_dq_model_tests,
    "safe_divide": q_safe_divide,
    "parse_daily_responses": q_parse_daily_responses,
    "parse_daily_rejects": q_parse_daily_rejects,
    "ingest_responses": q_ingest_responses,
    "parse_history_frame": q_parse_history_frame,
    "raw_daily_roundtrip": q_raw_daily_roundtrip,
    "raw_history_roundtrip": q_raw_history_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_accepted": q_csv_accepted,
    "csv_rejects": q_csv_rejects,
    "bronze_load": q_bronze_load,
    "bronze_load_history": q_bronze_load_history,
    "bronze_schema_merge": q_bronze_schema_merge,
    "table_snapshot": q_table_snapshot,
    "table_latest": q_table_latest,
    "bronze_stream": q_bronze_stream,
    "medallion_run_summary": q_medallion_run_summary,
    "daily_run_summary": q_daily_run_summary,
}

ORACLE_SQL: dict[str, str] = {
    "stg_daily_prices": oracle.STG_SQL,
    "stg_incremental": oracle.STG_SQL,
    "price_indicators": oracle.IND_SQL,
    "fact_daily_performance": oracle.FACT_SQL,
    "fact_incremental": oracle.FACT_SQL,
    "fact_backdated": oracle.FACT_SQL,
    "fact_sliced": oracle.FACT_SQL,
    "fact_bucketed": oracle.FACT_SQL,
    "weekly_incremental": oracle.WEEKLY_WEEK_SQL,
    "weekly_performance": oracle.WEEKLY_WEEK_SQL,
    "weekly_performance_day_grain": oracle.WEEKLY_DAY_SQL,
    "silver_prices": oracle.SILVER_SQL,
    "silver_incremental": oracle.SILVER_INCREMENTAL_SQL,
    "medallion_stream_silver": oracle.SILVER_INCREMENTAL_SQL,
    "gold_incremental": oracle.GOLD_INCREMENTAL_SQL,
    "gold_daily_summary": oracle.GOLD_SQL,
    "list_symbols": oracle.GOLD_SQL,
    "symbol_detail": oracle.SYMBOL_DETAIL_SQL,
    "price_history": oracle.PRICE_HISTORY_SQL,
    "symbol_detail_served": oracle.SYMBOL_DETAIL_SQL,
    "price_history_served": oracle.PRICE_HISTORY_SQL,
    "dq_report": oracle.DQ_REPORT_SQL,
    "silver_dq_report": oracle.SILVER_DQ_REPORT_SQL,
    "silver_dq_on_write": oracle.SILVER_DQ_REPORT_SQL,
    "silver_dq_incremental": oracle.SILVER_DQ_REPORT_SQL,
    "dq_summary": oracle.DQ_SUMMARY_SQL,
    "dq_value_range": oracle.DQ_RANGE_SQL,
    "dq_model_tests": oracle.DQ_MODEL_TESTS_SQL,
    "safe_divide": oracle.SAFE_DIVIDE_SQL,
    "parse_daily_responses": oracle.PARSED_RESPONSES_SQL,
    "parse_daily_rejects": oracle.RESPONSE_REJECTS_SQL,
    "ingest_responses": oracle.PARSED_RESPONSES_SQL,
    "parse_history_frame": oracle.HISTORY_SQL,
    "raw_daily_roundtrip": oracle.RAW_SQL,
    "raw_history_roundtrip": oracle.HISTORY_SQL,
    "csv_roundtrip": oracle.CSV_SQL,
    "csv_accepted": oracle.CSV_ACCEPTED_SQL,
    "csv_rejects": oracle.CSV_REJECTS_SQL,
    "bronze_load": oracle.BRONZE_LOAD_SQL,
    "bronze_load_history": oracle.BRONZE_HISTORY_SQL,
    "bronze_schema_merge": oracle.SCHEMA_MERGE_SQL,
    "table_snapshot": oracle.RAW_SQL,
    "table_latest": oracle.TABLE_LATEST_SQL,
    "bronze_stream": oracle.BRONZE_STREAM_SQL,
    "medallion_run_summary": oracle.RUN_SUMMARY_SQL,
    "daily_run_summary": oracle.RUN_SUMMARY_SQL,
}
