"""Runs that break off, competing writers, bad landings, odd names."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bars import SF_SMALL
from tickhouse.operators import quality as dq
from tickhouse.plans import flow
from tickhouse.sources.adapter import raw_bars
from tickhouse.sources.files import read_raw, write_raw_daily
from tickhouse.sources.history import parse_history_frame
from tickhouse.sources.responses import RESPONSE_SERIES_KEY, parse_daily_responses
from tickhouse.sources.tables import VersionedTable, layer_path
from tickhouse.streaming.bronze_stream import bronze_stream

NTZ = T.TimestampNTZType()


def layers(spark, root):
    names = [("silver", None), ("gold", None), *[("marts", n) for n in flow.MART_TABLES]]
    return {
        n: sorted(
            str(r)
            for r in VersionedTable(spark, layer_path(root, *[x for x in n if x])).read()
            .drop("_silver_loaded_at", "_gold_loaded_at", "updated_at", "_bronze_loaded_at")
            .collect()
        )
        for n in names
    }


@pytest.mark.parametrize("step", ["load_silver", "load_gold", "build_marts"])
def test_a_streamed_run_takes_up_what_a_broken_one_left(spark, tmp_path, monkeypatch, step):
    landing = str(tmp_path / "raw")
    write_raw_daily(raw_bars(spark, SF_SMALL).limit(300), landing, dt.date(2025, 1, 2))
    stamp = F.lit("2025-01-03 00:00:00").cast(NTZ)

    def run(root):
        return flow.run_medallion(spark, landing, root, stream=True, loaded_at=stamp, timestamp_type=NTZ)

    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    assert run(whole)["models_status"] == "success"
    with monkeypatch.context() as m:
        m.setattr(flow, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        if step == "build_marts":
            got = run(broken)
            assert got["models_status"] == "failed" and "lost" in got["models_error"]
        else:
            with pytest.raises(RuntimeError):
                run(broken)
    assert run(broken)["status"] == "completed"
    assert layers(spark, broken) == layers(spark, whole)
    assert run(broken)["status"] == "no_data"


def test_a_fresh_checkpoint_loses_no_rows(spark, tmp_path):
    raw = raw_bars(spark, SF_SMALL)
    table, place = str(tmp_path / "t"), tmp_path / "ckpt"
    for name in ("one", "two"):
        landing = str(tmp_path / name)
        raw.write.parquet(landing)
        checkpoint = f"{place}-{name}"
        bronze_stream(spark, landing, table, checkpoint, schema=raw.schema)
    ids = [json.loads((tmp_path / f"ckpt-{n}" / "metadata").read_text())["id"] for n in ("one", "two")]
    txns = VersionedTable(spark, table).commit_record()["txns"]
    assert set(txns) == {f"bronze-stream:{i}" for i in ids}
    assert VersionedTable(spark, table).read().count() == 2 * raw.count()


def test_a_beaten_writer_leaves_committed_rows(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.append(spark.range(3))
    late = VersionedTable(spark, str(tmp_path / "t"))
    stale = table._versions()
    table.append(spark.range(1000))
    monkeypatch.setattr(late, "_versions", lambda: stale)
    with pytest.raises(RuntimeError, match="concurrent commit"):
        late.append(spark.range(5))
    assert table.read().count() == 1003


def test_folders_of_the_other_kind_are_refused(spark, tmp_path):
    (tmp_path / "d" / "_delta_log").mkdir(parents=True)
    with pytest.raises(ValueError, match="not a parquet table"):
        VersionedTable(spark, str(tmp_path / "d"))


def test_unreadable_responses_are_rejected_and_a_missing_series_is_not(spark):
    good = {"1. open": "2.5", "2. high": "3", "3. low": "2", "4. close": "2.75", "5. volume": "10"}
    bodies = {
        "OK": json.dumps({RESPONSE_SERIES_KEY: {"2025-02-03": good, "2025-02-04": good}}),
        "EMPTY": "",
        "BLANK": "  ",
        "NONE": None,
        "CUT": '{"Time',
        "FIELD": json.dumps({RESPONSE_SERIES_KEY: {"2025-02-03": {**good, "4. close": "x"}}}),
        "SILENT": "{}",
        "NULL": json.dumps({RESPONSE_SERIES_KEY: None}),
    }
    frame = spark.createDataFrame(list(bodies.items()), "symbol string, body string")
    prices, rejects = parse_daily_responses(frame)
    assert sorted(r.symbol for r in prices.collect()) == ["OK", "OK"]
    assert sorted(r.symbol for r in rejects.collect()) == ["BLANK", "CUT", "EMPTY", "FIELD", "NONE"]


def test_history_dates_are_the_exchange_s(spark):
    frame = spark.sql(
        "select 'X' symbol, timestamp'2025-01-06 00:00:00+09:00' Date, 2.00005D Open, 1D High,"
        " 1D Low, 1D Close, 5L Volume"
    )
    assert parse_history_frame(frame).first().date == dt.date(2025, 1, 5)
    row = parse_history_frame(frame, exchange_tz="Asia/Tokyo").first()
    assert row.date == dt.date(2025, 1, 6)
    assert row.open == 2.0001  # ties round half up on the decimal value


def test_a_day_without_landings_is_empty(spark, tmp_path):
    root = str(tmp_path)
    bars = raw_bars(spark, SF_SMALL).limit(50)
    for day in (dt.date(2025, 1, 2), dt.date(2025, 1, 3)):
        write_raw_daily(bars, root, day)
    one = read_raw(spark, root, timestamp_type=NTZ, ingest_date=dt.date(2025, 1, 3))
    assert one.count() == 50
    assert all("ingest_date=2025-01-03" in f for f in one.inputFiles())
    assert read_raw(spark, root, timestamp_type=NTZ, ingest_date=dt.date(2025, 1, 9)).count() == 0


def test_quality_texts_with_odd_names_and_text_dates(spark):
    frame = spark.createDataFrame([(1.0, "2025-01-01")], "`50%d` double, day string")
    report = dq.dq_report(
        frame, [*dq.not_null("50%d"), dq.freshness("day", 9_999_999)], "t",
        today=dt.date(2025, 1, 2), executed_at=False,
    )
    texts = [r.details for r in report.collect()]
    assert texts[0] == "Column '50%d': 0 nulls found"
    assert texts[1].startswith("Most recent date: None")


def test_model_tests_add_no_shuffle_after_the_dedup(spark):
    from tickhouse.operators.staging import clean_staging

    plan = dq._model_tests(
        clean_staging(raw_bars(spark, SF_SMALL)), "stg", ("symbol",), ("symbol", "trade_date")
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
