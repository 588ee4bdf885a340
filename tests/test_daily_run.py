"""The daily run on month folders, checks that ride on writes, batch folders, broken runs."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickhouse.operators import quality as dq
from tickhouse.operators.medallion import bronze_frame, gold_daily_summary, silver_frame
from tickhouse.plans import flow
from tickhouse.plans.daily import run_daily
from tickhouse.plans.monthly import MonthLayers
from tickhouse.sources.tables import VersionedTable, layer_path
from tickhouse.streaming import bronze_batches as batches

SCHEMA = (
    "symbol string, date date, open double, high double, low double, close double, "
    "volume bigint, ingested_at timestamp"
)
DAY = dt.date(2024, 3, 28)
TODAY = dt.date(2024, 4, 4)


def bar(symbol, day, close=5.0, hour=0, high=None):
    date = None if day is None else DAY + dt.timedelta(days=day)
    return (symbol, date, close, close + 1 if high is None else high, close - 0.5, close, 10 + (day or 0),
            dt.datetime(2025, 1, 1, hour))


FIRST = [bar("KOPA", d, 5.0 + d) for d in range(8)] + [bar("LIND", d, 9.0 - d) for d in range(4)]
#: A correction, a bar that goes with its key, a new symbol, a null key part.
SECOND = [bar("KOPA", 1, 7.75, 2), bar("LIND", 2, 8.0, 2, high=1.0), bar("MURR", 5, 3.5, 2),
          bar(None, 6, 2.0, 2)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def records(report):
    return {r.check_name: (r.status, r.records_checked, r.records_failed, r.details) for r in report.collect()}


def content(df):
    columns = sorted(c for c in df.columns if not c.endswith("loaded_at") and c != "updated_at")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def state(layers):
    return [content(t.read()) for t in (layers.silver, layers.fact, layers.weekly)] + [
        content(layers.gold()), records(layers.checks_report(TODAY, False))]


def loaded(hour):
    return F.lit(dt.datetime(2025, 2, 1, hour)).cast("timestamp")


# --- checks while writing ------------------------------------------------------------


@pytest.mark.parametrize("rows", [FIRST + SECOND, [], [bar("A", None)]])
def test_checks_of_the_write_equal_those_of_a_scan(spark, tmp_path, rows):
    silver = silver_frame(bronze_frame(frame(spark, rows), F.col("ingested_at"), "f"))
    checks = dq.WriteChecks([*dq.standard_suite(), dq.value_range("close", 0, 8)], ("symbol", "date"))
    assert not checks.watched
    checks.watch(silver).write.parquet(str(tmp_path / "s"))
    assert checks.watched
    scan = dq.dq_report(spark.read.parquet(str(tmp_path / "s")), checks.checks, "t", TODAY, False)
    assert records(checks.report(spark, "t", TODAY, False)) == records(scan)


def test_an_unsure_key_is_refused():
    with pytest.raises(ValueError, match="unique_symbol_date"):
        dq.WriteChecks(dq.standard_suite())
    with pytest.raises(ValueError, match="unique_symbol_date"):
        dq.WriteChecks(dq.standard_suite(), ("symbol",))


def test_the_run_checks_silver_without_a_scan_of_its_own(spark, tmp_path, monkeypatch):
    def scanned(*args, **kwargs):
        raise AssertionError("Silver was scanned")

    monkeypatch.setattr(flow, "dq_report", scanned)
    root = str(tmp_path)
    got = flow.run_medallion(spark, frame(spark, FIRST), root, today=TODAY, loaded_at=loaded(1), source_file="a")
    more = flow.run_medallion(spark, frame(spark, SECOND), root, today=TODAY, loaded_at=loaded(2), source_file="b")
    silver = VersionedTable(spark, layer_path(root, "silver")).read()
    want = dq.dq_summary_dict(dq.dq_report(silver, dq.standard_suite(), "daily_prices", TODAY))
    assert more["dq_summary"] == want and want["failed"] == 1
    assert got["dq_summary"]["failed"] == 0


def test_measures_of_parts_add_up(spark):
    bars = frame(spark, FIRST + SECOND + [bar("A", None), bar("A", None)])
    month = F.trunc("date", "month").alias("m")
    suite = dq.standard_suite()
    parts = dq.part_measures(bars, suite, month)
    assert parts.count() == 3
    assert records(dq.report_of_parts(parts, suite, "t", TODAY, False)) == records(
        dq.dq_report(bars, suite, "t", TODAY, False)
    )
    rowwise = dq.not_null("symbol")
    parts = dq.part_measures(bars, rowwise, month)
    assert records(dq.report_of_parts(parts, rowwise, "t")) == records(dq.dq_report(bars, rowwise, "t"))
    with pytest.raises(ValueError, match="one unique key"):
        dq.part_measures(bars, [dq.unique("symbol"), dq.unique("date")], month)


# --- batch folders -------------------------------------------------------------------


def test_a_replayed_batch_lands_once(spark, tmp_path, monkeypatch):
    landing, table, place = (str(tmp_path / n) for n in ("raw", "bronze", "ckpt"))
    raw = frame(spark, FIRST)
    raw.repartition(2).write.parquet(landing)

    def run(**how):
        return batches.bronze_batches(spark, landing, table, place, raw.schema, loaded(1), **how)

    with monkeypatch.context() as m:
        real = batches.bronze_frame
        m.setattr(batches, "bronze_frame", lambda *a, **k: real(*a, **k).withColumn(
            "volume", F.when(F.col("date") > F.lit(DAY), F.raise_error(F.lit("lost")).cast("bigint"))))
        with pytest.raises(Exception, match="lost"):
            run()
    assert run() == 1
    assert content(batches.read_batches(spark, table).select(*raw.columns)) == content(raw)
    assert run() == 0
    # the run broke off after its folder was written, before Spark noted the batch
    last = max((tmp_path / "ckpt" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    frame(spark, SECOND).write.mode("append").parquet(landing)
    run(max_files_per_trigger=1)
    assert content(batches.read_batches(spark, table).select(*raw.columns)) == content(
        frame(spark, FIRST + SECOND)
    )


# --- runs ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    layers = MonthLayers(spark, str(tmp_path_factory.mktemp("whole")))
    assert run_daily(layers, None)["status"] == "no_data"
    got = run_daily(layers, frame(spark, FIRST), today=TODAY, loaded_at=loaded(1), source_file="a")
    assert got["symbols_processed"] == 2 and got["models_status"] == "success"
    got = run_daily(layers, frame(spark, SECOND), today=TODAY, loaded_at=loaded(2), source_file="b")
    assert got["symbols_processed"] == 3 and got["dq_summary"]["failed"] == 1
    assert run_daily(layers, frame(spark, SECOND), symbols=["nope"])["status"] == "no_data"
    return layers


def test_a_run_equals_the_batch_rules(whole):
    silver = silver_frame(whole.bronze.read())
    assert content(whole.silver.read()) == content(silver)
    scan = dq.dq_report(silver, dq.standard_suite(), "daily_prices", TODAY, False)
    assert records(whole.checks_report(TODAY, False)) == records(scan)
    rounded = [F.round(c, 9).alias(c) if "_c" in c or "avg" in c else F.col(c) for c in whole.gold().columns]
    assert content(whole.gold().select(*rounded)) == content(gold_daily_summary(silver).select(*rounded))


@pytest.mark.parametrize("step", ["load_bars", "refresh_moments", "refresh_staged", "refresh_weekly"])
def test_a_broken_run_is_taken_up_without_new_bars(spark, tmp_path, monkeypatch, whole, step):
    layers = MonthLayers(spark, str(tmp_path))
    run_daily(layers, frame(spark, FIRST), today=TODAY, loaded_at=loaded(1), source_file="a")
    with monkeypatch.context() as m:
        def lost(*args, **kwargs):
            raise RuntimeError("lost")

        m.setattr(MonthLayers, step, lost)
        if step == "refresh_weekly":
            got = run_daily(layers, frame(spark, SECOND), today=TODAY, loaded_at=loaded(2), source_file="b")
            assert got["models_status"] == "failed" and "lost" in got["models_error"]
        else:
            with pytest.raises(RuntimeError):
                run_daily(layers, frame(spark, SECOND), today=TODAY, loaded_at=loaded(2), source_file="b")
    if step == "load_bars":  # nothing reached Bronze; the bars come again
        again = run_daily(layers, frame(spark, SECOND), today=TODAY, loaded_at=loaded(2), source_file="b")
    else:
        again = run_daily(layers, None, today=TODAY, loaded_at=loaded(2))
    assert again["status"] == "completed" and again["models_status"] == "success"
    assert state(layers) == state(whole)
    assert run_daily(layers, None)["status"] == "no_data"


def test_bars_that_are_all_invalid(spark, tmp_path):
    layers = MonthLayers(spark, str(tmp_path))
    got = run_daily(layers, frame(spark, [bar("A", 0, -1.0)]), today=TODAY, source_file="a")
    assert got["status"] == "completed" and got["dq_summary"]["total_checks"] == 11
    got = run_daily(layers, frame(spark, [bar("A", 0, 2.0, 1)]), today=TODAY, source_file="b")
    assert got["models_status"] == "success" and layers.fact.read().count() == 1


@pytest.mark.parametrize("step", ["load_silver", "load_gold", "build_marts"])
def test_a_batch_run_on_versions_is_taken_up_too(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)

    def run(raw):
        return flow.run_medallion(spark, raw, root, today=TODAY, loaded_at=loaded(1), source_file="a")

    with monkeypatch.context() as m:
        m.setattr(flow, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        if step == "build_marts":
            assert run(frame(spark, FIRST))["models_status"] == "failed"
        else:
            with pytest.raises(RuntimeError):
                run(frame(spark, FIRST))
    for raw in (frame(spark, []), None):
        got = run(raw)
        if raw is not None:
            assert got["status"] == "completed" and got["symbols_processed"] == 2
            assert got["models_status"] == "success"
    assert got["status"] == "no_data"
    assert VersionedTable(spark, layer_path(root, "bronze")).read().count() == len(FIRST)
