"""Bronze stream (exactly once) and the end-to-end run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bars import SF_SMALL
from tickhouse.plans.flow import run_medallion
from tickhouse.sources.adapter import raw_bars
from tickhouse.sources.tables import VersionedTable, layer_path, layer_status
from tickhouse.streaming.bronze_stream import bronze_stream


def test_stream_is_exactly_once(spark, tmp_path):
    raw = raw_bars(spark, SF_SMALL)
    landing = str(tmp_path / "landing")
    raw.repartitionByRange(3, "ingested_at").write.parquet(landing)
    table, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    first = bronze_stream(spark, landing, table, ckpt, schema=raw.schema, max_files_per_trigger=1)
    assert first["batches"] == 3
    again = bronze_stream(spark, landing, table, ckpt, schema=raw.schema)
    assert again["batches"] == 0
    t = VersionedTable(spark, table)
    assert t.read().count() == raw.count()
    assert t.read().where(F.col("_source_file").contains("part-")).count() == raw.count()
    # a new landed file is picked up on the next run, and only it
    raw.limit(5).write.mode("append").parquet(landing)
    assert bronze_stream(spark, landing, table, ckpt, schema=raw.schema)["batches"] == 1
    assert t.read().count() == raw.count() + 5


def test_run_no_data(spark, tmp_path):
    assert run_medallion(spark, None, str(tmp_path)) == {"status": "no_data", "symbols_processed": 0}
    raw = raw_bars(spark, SF_SMALL)
    got = run_medallion(spark, raw, str(tmp_path), symbols=["NOPE"], source_file="o")
    assert got["status"] == "no_data"


def test_run_end_to_end(spark, tmp_path):
    root = str(tmp_path / "lake")
    raw = raw_bars(spark, SF_SMALL)
    got = run_medallion(spark, raw, root, today=dt.date(2001, 8, 3), source_file="orders")
    assert got["status"] == "completed" and got["symbols_processed"] == 8
    assert got["models_status"] == "success"
    assert got["dq_summary"]["total_checks"] == 11 and got["dq_summary"]["failed"] == 0
    status = {r["layer"]: r["table_exists"] for r in layer_status(spark, root).collect()}
    assert status == {"bronze": True, "silver": True, "gold": True}
    fact = VersionedTable(spark, layer_path(root, "marts", "fact_daily_performance")).read()
    assert fact.count() == 1352  # staged rows at sf0.001
    weekly = VersionedTable(spark, layer_path(root, "marts", "agg_weekly_performance")).read()
    assert weekly.count() == 1104
    # a rerun appends Bronze again; Silver's dedup hides the copy
    run_medallion(spark, raw, root, today=dt.date(2001, 8, 3), source_file="orders")
    assert VersionedTable(spark, layer_path(root, "bronze")).read().count() == 3000
    assert VersionedTable(spark, layer_path(root, "silver")).read().count() == 1316


def test_flow_entrypoint(spark, tmp_path):
    from tickhouse.plans.flow import main
    from tickhouse.sources.files import write_raw_daily

    raw = raw_bars(spark, SF_SMALL)
    write_raw_daily(raw, str(tmp_path / "landing"))
    day = raw.select(F.to_date("ingested_at").alias("d")).first()["d"]
    got = main(["--raw", str(tmp_path / "landing"), "--root", str(tmp_path / "lake"),
                "--ingest-date", day.isoformat(), "--today", "2001-08-03"])
    assert got["status"] == "completed" and got["models_status"] == "success"
    loaded = VersionedTable(spark, layer_path(str(tmp_path / "lake"), "bronze")).read()
    assert loaded.count() == raw.where(F.to_date("ingested_at") == F.lit(day)).count()
    assert loaded.where(F.col("_source_file").contains(f"ingest_date={day}")).count() == loaded.count()


def test_stream_default_checkpoint_is_stable(spark, tmp_path):
    raw = raw_bars(spark, SF_SMALL)
    landing = str(tmp_path / "landing")
    raw.write.parquet(landing)
    table = str(tmp_path / "bronze")
    assert bronze_stream(spark, landing, table, schema=raw.schema)["batches"] == 1
    assert bronze_stream(spark, landing, table, schema=raw.schema)["batches"] == 0
    assert VersionedTable(spark, table).read().count() == raw.count()


def test_run_with_stream_loads_each_file_once(spark, tmp_path):
    from tickhouse.sources.files import write_raw_daily

    raw = raw_bars(spark, SF_SMALL)
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    write_raw_daily(raw.where("date < date'1998-01-01'"), landing)
    first = run_medallion(spark, landing, root, today=dt.date(2001, 8, 3), stream=True)
    assert first["status"] == "completed" and first["symbols_processed"] == 8
    bronze = VersionedTable(spark, layer_path(root, "bronze"))
    n1 = bronze.read().count()
    assert n1 == raw.where("date < date'1998-01-01'").count()
    # a rerun with nothing newly landed appends nothing
    assert run_medallion(spark, landing, root, stream=True)["status"] == "no_data"
    # newly landed files are picked up once
    write_raw_daily(raw.where("date >= date'1998-01-01'"), landing)
    again = run_medallion(spark, landing, root, today=dt.date(2001, 8, 3), stream=True)
    assert again["status"] == "completed"
    assert bronze.read().count() == raw.count()
    assert "ingest_date" not in bronze.read().columns
    silver = VersionedTable(spark, layer_path(root, "silver")).read()
    assert silver.count() == 1316
