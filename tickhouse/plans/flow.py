"""The medallion run: raw -> Bronze -> Silver -> checks -> Gold -> marts.

Each layer is one Spark job writing a versioned table; the next layer
reads the written table back, which also cuts the lineage between
layers (an executor lost later never recomputes an earlier layer).
Only small results cross to the driver: the number of symbols and the
one-row check summary.
"""

from __future__ import annotations

import datetime as dt
import logging
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.operators.indicators import (
    MA_LONG,
    VOLATILITY_WINDOW,
    fact_daily_performance,
    price_indicators,
)
from tickhouse.operators.medallion import bronze_frame, gold_daily_summary, silver_frame
from tickhouse.operators.quality import WriteChecks, dq_report, dq_summary_dict, standard_suite
from tickhouse.operators.staging import RAW_BAR_COLUMNS, latest_valid_bars, stage_types
from tickhouse.operators.weekly import weekly_performance
from tickhouse.sources.files import DAILY_DIR, read_raw
from tickhouse.sources.tables import VersionedTable, layer_path

log = logging.getLogger(__name__)

SILVER_SORT = ["symbol", "date"]
MART_TABLES = ("fact_daily_performance", "agg_weekly_performance")


def load_bronze(
    spark: SparkSession,
    raw: DataFrame | str,
    root: str,
    loaded_at=None,
    source_file: Column | str | None = None,
    timestamp_type: T.DataType | None = None,
    ingest_date: dt.date | None = None,
) -> int | None:
    """Append raw bars to Bronze; returns the new version.

    ``raw`` is a landed raw root (read with ``read_raw``, restricted to
    the ``ingest_date`` folders when given; each row keeps its file in
    ``_source_file``) or a DataFrame (then pass ``source_file`` unless it
    is a direct file scan).  Appending the same input twice duplicates
    it, as in the reference; a daily run should pass its ``ingest_date``
    (or use the stream loader, which is exactly-once).
    """
    if isinstance(raw, str):
        raw = read_raw(spark, raw, "daily", timestamp_type, ingest_date)
    bronze = bronze_frame(raw, loaded_at=loaded_at, source_file=source_file)
    return VersionedTable(spark, layer_path(root, "bronze")).append(
        bronze, merge_schema=True, time_column="_bronze_loaded_at"
    )


def load_silver(
    spark: SparkSession,
    root: str,
    loaded_at=None,
    incremental: bool = True,
    checks: WriteChecks | None = None,
) -> int:
    """Bring Silver up to the latest Bronze snapshot (a new overwrite version).

    Full rebuild: dedup and filter all of Bronze.  Incremental refresh
    (used when its preconditions hold, see ``_refresh_silver``): only the
    Bronze versions appended since Silver was built are deduplicated;
    their keys replace the old Silver rows.  Both give the same rows;
    kept rows keep their ``_silver_loaded_at``.  ``checks`` are measured by
    the write; with nothing new nothing is written, and they stay unwatched.
    """
    bronze_t = VersionedTable(spark, layer_path(root, "bronze"))
    silver_t = VersionedTable(spark, layer_path(root, "silver"))
    bronze_version = bronze_t.latest_version()
    if incremental:
        refreshed = _refresh_silver(bronze_t, silver_t, bronze_version, loaded_at, checks)
        if refreshed is not None:
            return refreshed
    silver = silver_frame(bronze_t.read(bronze_version), loaded_at=loaded_at)
    if checks is not None:
        silver = checks.watch(silver)
    return silver_t.overwrite(
        silver, sort_by=SILVER_SORT, meta={"bronze_version": bronze_version}
    )


def _refresh_silver(
    bronze_t: VersionedTable,
    silver_t: VersionedTable,
    bronze_version: int,
    loaded_at,
    checks: WriteChecks | None = None,
) -> int | None:
    """Incremental Silver refresh; None when a full rebuild is required.

    Valid when Silver was built from Bronze version ``b``, Bronze has only
    appended since, and every new row was loaded strictly later than any
    row up to ``b`` (checked from load-time ranges the Bronze commits
    recorded while writing).  Then the newest row of every key in the new
    rows beats all older rows, so the full rebuild's result for that key
    depends on the new rows alone, and every other key keeps its Silver
    row.  Cost: one pass over Silver and the new rows instead of all of
    Bronze.
    """
    silver_rec = silver_t.commit_record()
    base = (silver_rec or {}).get("meta", {}).get("bronze_version")
    if base is None:
        return None
    if base == bronze_version:
        return silver_rec["version"]  # nothing new
    inc = bronze_t.increment(base, upto=bronze_version)
    if inc is None:
        return None
    base_range = (bronze_t.commit_record(base) or {}).get("time_range")
    if not base_range or not base_range["complete"]:
        return None
    new_rows, records = inc
    ranges = [r.get("time_range") for r in records]
    if any(t is None or t["column"] != "_bronze_loaded_at" for t in ranges):
        return None
    mins = [t["min"] for t in ranges if t["min"] is not None]
    if base_range["snapshot_max"] is not None and mins and min(mins) <= base_range["snapshot_max"]:
        return None
    if any(t.get("nulls", 1) for t in ranges):
        return None  # a new row without a load time loses to every old row

    # distinct keys first: the partial aggregate collapses a hot key before
    # the shuffle, so the anti join's build side has one row per key
    keys = new_rows.select("symbol", "date").distinct()
    old = silver_t.read()
    kept = old.join(
        keys,
        (old["symbol"].eqNullSafe(keys["symbol"])) & (old["date"].eqNullSafe(keys["date"])),
        "left_anti",
    )
    fresh = silver_frame(new_rows, loaded_at=loaded_at)
    # no repartition: the scan packs old files into splits of up to
    # maxPartitionBytes, so file counts stay bounded across refreshes
    # columns in the full rebuild's order (new Bronze columns before the
    # Silver audit columns)
    out = kept.unionByName(fresh, allowMissingColumns=True).select(*fresh.columns)
    if checks is not None:
        out = checks.watch(out)
    return silver_t.overwrite(out, sort_by=SILVER_SORT, meta={"bronze_version": bronze_version})


def load_gold(spark: SparkSession, root: str, loaded_at=None) -> int:
    """Rebuild the Gold per-symbol summary from Silver (overwrite)."""
    silver_t = VersionedTable(spark, layer_path(root, "silver"))
    gold = gold_daily_summary(silver_t.read(), loaded_at=loaded_at)
    built_from = (silver_t.commit_record() or {}).get("meta", {}).get("bronze_version")
    return VersionedTable(spark, layer_path(root, "gold")).overwrite(
        gold, meta={"bronze_version": built_from}
    )


def refresh_staging(spark: SparkSession, root: str) -> int:
    """Maintain the newest valid raw row per key over all of Bronze.

    The staging rule is a maximum per key, so the table absorbs the Bronze
    versions appended since it was built (``latest_valid_bars`` over the
    old table plus the new rows) without rereading old Bronze; after an
    overwrite of Bronze, or on first use, it is built from the snapshot.
    """
    bronze_t = VersionedTable(spark, layer_path(root, "bronze"))
    latest_t = VersionedTable(spark, layer_path(root, "staging", "latest_bars"))
    bronze_version = bronze_t.latest_version()
    rec = latest_t.commit_record()
    base = (rec or {}).get("meta", {}).get("bronze_version")
    if base is not None and base == bronze_version:
        return rec["version"]
    inc = bronze_t.increment(base, upto=bronze_version) if base is not None else None
    if inc is not None:
        new_rows, _ = inc
        source = latest_t.read().unionByName(new_rows.select(*RAW_BAR_COLUMNS))
    else:
        source = bronze_t.read(bronze_version)
    return latest_t.overwrite(
        latest_valid_bars(source),
        sort_by=["symbol", "date"],
        meta={"bronze_version": bronze_version},
    )


def build_marts(spark: SparkSession, root: str, updated_at=None, incremental: bool = True) -> None:
    """Staging -> indicators -> fact and weekly marts.

    The fact mart is extended in place when the new bars only continue
    each symbol's history (see ``_extend_fact``); otherwise it is
    recomputed from the whole staging table.  The weekly mart is rebuilt
    from the fact table.
    """
    staging_version = refresh_staging(spark, root)
    latest_t = VersionedTable(spark, layer_path(root, "staging", "latest_bars"))
    fact_table = VersionedTable(spark, layer_path(root, "marts", MART_TABLES[0]))
    staged_from = (latest_t.commit_record(staging_version) or {}).get("meta", {})
    meta = {
        "staging_version": staging_version,
        "bronze_version": staged_from.get("bronze_version"),
    }
    if not (incremental and _extend_fact(spark, root, fact_table, meta, updated_at)):
        latest = latest_t.read(staging_version)
        fact = fact_daily_performance(price_indicators(stage_types(latest)), updated_at=updated_at)
        fact_table.overwrite(fact, sort_by=["symbol", "trade_date"], meta=meta)
    written = fact_table.read()
    weekly = weekly_performance(written, grain="week", updated_at=updated_at)
    VersionedTable(spark, layer_path(root, "marts", MART_TABLES[1])).overwrite(weekly, meta=meta)


# Trailing rows an appended bar needs: 49 closes for the 50-row average,
# and 21 closes (20 returns plus the lag of the first) for the volatility.
CONTEXT_ROWS = max(MA_LONG - 1, VOLATILITY_WINDOW)


def _extend_fact(
    spark: SparkSession, root: str, fact_table: VersionedTable, meta: dict, updated_at
) -> bool:
    """Append fact rows for bars that extend each symbol's history.

    Every indicator is a trailing window, so a bar dated after all earlier
    bars of its symbol changes no earlier fact row, and its own indicators
    need only the ``CONTEXT_ROWS`` bars before it.  Applies when the fact
    was built from an earlier Bronze version, Bronze has only appended
    since, and for every symbol in the new bars the first new date is
    later than the symbol's last staged date (and no key is NULL).  The
    new bars are appended as one fact version; cost: the new bars, a
    per-symbol top-``CONTEXT_ROWS`` of the old staging (pre-limited
    before its shuffle) and one aggregate scan of it.  Returns False when
    the full recompute is needed.
    """
    rec = fact_table.commit_record()
    old_meta = (rec or {}).get("meta", {})
    if old_meta.get("bronze_version") is None or meta["bronze_version"] is None:
        return False
    if old_meta["bronze_version"] == meta["bronze_version"]:
        return old_meta.get("staging_version") == meta["staging_version"]
    bronze_t = VersionedTable(spark, layer_path(root, "bronze"))
    inc = bronze_t.increment(old_meta["bronze_version"], upto=meta["bronze_version"])
    if inc is None:
        return False
    new_rows, _ = inc
    latest_t = VersionedTable(spark, layer_path(root, "staging", "latest_bars"))
    old_stg = stage_types(latest_t.read(old_meta["staging_version"]))
    new_stg = stage_types(latest_valid_bars(new_rows.select(*RAW_BAR_COLUMNS)))

    span = new_stg.groupBy("symbol").agg(
        F.min("trade_date").alias("_first"),
        F.count_if(F.col("trade_date").isNull()).alias("_new_null_dates"),
    )
    last = old_stg.groupBy("symbol").agg(
        F.max("trade_date").alias("_last"),
        F.count_if(F.col("trade_date").isNull()).alias("_old_null_dates"),
    )
    conflicts = span.join(last, "symbol", "left").where(
        F.col("symbol").isNull()
        | (F.col("_new_null_dates") > 0)
        | (F.coalesce(F.col("_old_null_dates"), F.lit(0)) > 0)
        | (F.col("_first") <= F.col("_last"))
    )
    if not conflicts.isEmpty():
        return False

    # the last CONTEXT_ROWS bars of each symbol: the top-k per symbol is
    # planned as a partial WindowGroupLimit before its shuffle, so at most
    # CONTEXT_ROWS rows per symbol and task move, whatever the history; only
    # then is the bounded result matched with the touched symbols
    recent = Window.partitionBy("symbol").orderBy(F.col("trade_date").desc())
    context = (
        old_stg.withColumn("_rn", F.row_number().over(recent))
        .where(F.col("_rn") <= CONTEXT_ROWS)
        .drop("_rn")
        .join(span.select("symbol"), "symbol", "left_semi")
    )
    ind = price_indicators(context.unionByName(new_stg))
    added = ind.join(new_stg.select("symbol", "trade_date"), ["symbol", "trade_date"], "left_semi")
    rows = fact_daily_performance(added, updated_at=updated_at)
    table_schema = T.StructType.fromJson(json.loads(rec["schema"]))
    shape = [(f.name, f.dataType) for f in rows.schema.fields]
    if shape != [(f.name, f.dataType) for f in table_schema.fields]:
        return False  # e.g. updated_at added, dropped or retyped: recompute
    fact_table.append(rows, merge_schema=False, sort_by=["symbol", "trade_date"], meta=meta)
    return True


def _stream_into_bronze(
    spark: SparkSession, raw_root: str, root: str, loaded_at, timestamp_type
) -> None:
    """Stream newly landed daily files into Bronze."""
    from tickhouse.schemas import raw_daily_schema
    from tickhouse.streaming.bronze_stream import bronze_stream

    bronze_t = VersionedTable(spark, layer_path(root, "bronze"))
    schema = raw_daily_schema(timestamp_type)
    landing = T.StructType(schema.fields + [T.StructField("ingest_date", T.DateType())])
    bronze_stream(
        spark,
        f"{raw_root.rstrip('/')}/{DAILY_DIR}",
        bronze_t.path,
        schema=landing,
        columns=schema.fieldNames(),
        loaded_at=loaded_at,
    )


def _pending_rows(spark: SparkSession, root: str, run_models: bool) -> DataFrame | None:
    """Bronze rows that some layer has not absorbed yet; None when there are none.

    Every layer's commit names the Bronze version it was built from, so a run
    that broke off after Bronze, Silver or Gold is taken up by the next one,
    also when nothing new has landed since.
    """
    bronze_t = VersionedTable(spark, layer_path(root, "bronze"))
    latest = bronze_t.latest_version()
    if latest is None:
        return None
    layers = [layer_path(root, "silver"), layer_path(root, "gold")]
    if run_models:
        layers += [layer_path(root, "marts", name) for name in MART_TABLES]
    absorbed = []
    for path in layers:
        record = VersionedTable(spark, path).commit_record() or {}
        absorbed.append(record.get("meta", {}).get("bronze_version"))
    if all(version == latest for version in absorbed):
        return None
    if None in absorbed:
        return bronze_t.read(latest)
    inc = bronze_t.increment(min(absorbed), upto=latest)
    return bronze_t.read(latest) if inc is None else inc[0]


def run_medallion(
    spark: SparkSession,
    raw: DataFrame | str | None,
    root: str,
    symbols: list[str] | None = None,
    run_models: bool = True,
    today: dt.date | None = None,
    loaded_at=None,
    source_file: Column | str | None = None,
    timestamp_type: T.DataType | None = None,
    ingest_date: dt.date | None = None,
    stream: bool = False,
) -> dict:
    """Run every layer and return the run summary.

    ``raw`` is the new input: a DataFrame, or a landed raw root of which
    only the ``ingest_date`` folders are loaded when that is given (a
    daily run); without it every landed day is appended again.  With
    ``stream=True`` (landed raw root only) Bronze is loaded by the
    exactly-once file stream instead: each landed file is appended once,
    whatever the schedule of the runs.

    Without input (None, or no rows for the requested symbols) the layers take
    up what a run that broke off left in Bronze; if there is nothing, the
    result is ``{"status": "no_data", "symbols_processed": 0}``.  Checks only
    report; they never stop Gold.  A failure while building the marts is
    caught and reported as ``models_status = "failed"``.
    """
    rows = processed = 0
    if stream:
        if not isinstance(raw, str) or symbols or ingest_date:
            raise ValueError("stream=True takes a landed raw root, without symbols/ingest_date")
        _stream_into_bronze(spark, raw, root, loaded_at, timestamp_type)
    elif raw is not None:
        if isinstance(raw, str):
            raw = read_raw(spark, raw, "daily", timestamp_type, ingest_date)
        if symbols:
            raw = raw.where(F.col("symbol").isin([s.upper() for s in symbols]))
        # one symbol-only scan of the input answers both "any data?" and the
        # number of symbols processed; one row reaches the driver
        rows, processed = raw.agg(F.count(F.lit(1)), F.count_distinct("symbol")).first()
        if rows:
            load_bronze(spark, raw, root, loaded_at=loaded_at, source_file=source_file)
    if not rows:
        # streamed rows, and what a run that broke off left to the layers
        pending = _pending_rows(spark, root, run_models)
        if pending is not None:
            rows, processed = pending.agg(F.count(F.lit(1)), F.count_distinct("symbol")).first()
        if not rows:
            return {"status": "no_data", "symbols_processed": 0}
    processed = int(processed)

    checks = WriteChecks(standard_suite(), deduped=("symbol", "date"))
    load_silver(spark, root, loaded_at=loaded_at, checks=checks)
    if checks.watched:
        report = checks.report(spark, "daily_prices", today=today)
    else:  # Silver was up to date
        silver = VersionedTable(spark, layer_path(root, "silver")).read()
        report = dq_report(silver, standard_suite(), "daily_prices", today=today)
    dq = dq_summary_dict(report)

    load_gold(spark, root, loaded_at=loaded_at)

    models_status, models_error = "skipped", None
    if run_models:
        try:
            build_marts(spark, root, updated_at=loaded_at)
            models_status = "success"
        except Exception as error:  # noqa: BLE001 - reported in the summary
            log.exception("building the marts failed")
            models_status, models_error = "failed", f"{type(error).__name__}: {error}"

    summary = {
        "status": "completed",
        "symbols_processed": processed,
        "total_symbols": len(symbols) if symbols else processed,
        "dq_summary": dq,
        "models_status": models_status,
    }
    if models_error:
        summary["models_error"] = models_error
    return summary


def main(argv: list[str] | None = None) -> dict:
    """``spark-submit -m``/``python -m tickhouse.plans.flow`` entrypoint."""
    import argparse
    import json

    from tickhouse.session import build_session

    parser = argparse.ArgumentParser(description="raw -> Bronze -> Silver -> Gold -> marts")
    parser.add_argument("--raw", required=True, help="landed raw root (daily_prices/...)")
    parser.add_argument("--root", required=True, help="lakehouse root URI")
    parser.add_argument("--ingest-date", type=dt.date.fromisoformat, default=None,
                        help="load only this landing day (YYYY-MM-DD)")
    parser.add_argument("--symbols", nargs="*", default=None)
    parser.add_argument("--today", type=dt.date.fromisoformat, default=None,
                        help="reference date of the freshness check (default: UTC today)")
    parser.add_argument("--no-models", action="store_true", help="skip the marts")
    parser.add_argument("--stream", action="store_true",
                        help="load Bronze with the exactly-once file stream")
    parser.add_argument("--master", default=None, help="only for local runs")
    args = parser.parse_args(argv)

    # package defaults (UTC, ANSI, AQE); the cluster manager picks the master
    # and the cluster config the shuffle partitions unless --master is given
    spark = build_session(args.master, shuffle_partitions=None)
    summary = run_medallion(
        spark,
        args.raw,
        args.root,
        symbols=args.symbols,
        run_models=not args.no_models,
        today=args.today,
        ingest_date=args.ingest_date,
        stream=args.stream,
    )
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main()
