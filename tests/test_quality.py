"""Data-quality checks on the valid and dirty frames."""

from __future__ import annotations

import datetime as dt

import pytest

from tickhouse.operators import quality as dq

SCHEMA = "symbol string, date date, open double, high double, low double, close double, volume bigint"
TODAY = dt.date(2023, 3, 10)


@pytest.fixture(scope="module")
def valid_df(sample_bars):
    return sample_bars.drop("ingested_at")


@pytest.fixture(scope="module")
def dirty_df(spark):
    """Five bars: a symbol and a close missing, two openings not above zero,
    two bars whose high lies under their low, one key three times."""
    day = dt.date(2023, 3, 9)
    return spark.createDataFrame(
        [
            ("KOPA", day, 0.0, 13.0, 12.0, 12.5, 40),
            ("KOPA", day, 12.5, 11.0, 12.0, 12.5, 40),
            ("KOPA", day, 12.5, 13.0, 12.0, None, 45),
            ("LIND", dt.date(2023, 2, 28), -3.0, 900.0, 880.0, 890.0, 7),
            (None, dt.date(2023, 3, 1), 870.0, 869.5, 871.0, 870.0, 9),
        ],
        SCHEMA,
    )


def _by_name(report):
    return {r["check_name"]: r.asDict() for r in report.collect()}


def test_valid_frame_all_pass(valid_df):
    rep = dq.dq_report(valid_df, dq.standard_suite(), "daily_prices", today=TODAY)
    got = _by_name(rep)
    assert len(got) == 11
    assert {r["status"] for r in got.values()} == {"PASSED"}
    assert all(r["pass_rate"] == 1.0 for r in got.values())
    s = dq.dq_summary_dict(rep)
    assert s == {"table": "daily_prices", "total_checks": 11, "passed": 11, "failed": 0,
                 "warnings": 0, "all_passed": True}


def test_dirty_frame_failures(dirty_df):
    checks = [*dq.not_null("symbol", "close"), *dq.positive("open"), dq.unique("symbol", "date"),
              dq.high_gte_low(), dq.freshness("date", max_age_days=5)]
    got = _by_name(dq.dq_report(dirty_df, checks, "t", today=dt.date(2023, 3, 15)))
    failed = {n: r["records_failed"] for n, r in got.items() if r["status"] == "FAILED"}
    assert failed == {"not_null_symbol": 1, "not_null_close": 1, "positive_open": 2,
                      "unique_symbol_date": 2, "high_gte_low": 2}
    assert got["freshness_date"]["status"] == "WARNING"
    assert got["not_null_symbol"]["details"] == "Column 'symbol': 1 nulls found"
    assert got["unique_symbol_date"]["details"] == "Composite key ['symbol', 'date']: 2 duplicate rows"
    assert got["freshness_date"]["details"] == "Most recent date: 2023-03-09, age: 6 days (max 5)"
    assert got["positive_open"]["pass_rate"] == 0.6


def test_value_range_warns_and_summary_ignores_warnings(dirty_df):
    rep = dq.dq_report(dirty_df, [dq.value_range("open", 0.0, 20.0)], "t")
    r = _by_name(rep)["range_open"]
    assert r["status"] == "WARNING" and r["records_failed"] == 2
    assert r["details"] == "Column 'open': 2 values outside [0.0, 20.0]"
    assert dq.dq_summary_dict(rep)["all_passed"] is True


def test_empty_frame(spark):
    empty = spark.createDataFrame([], SCHEMA)
    got = _by_name(dq.dq_report(empty, dq.standard_suite(), "t", today=TODAY))
    assert got["not_null_symbol"]["pass_rate"] == 0.0
    assert got["freshness_date"]["status"] == "WARNING"
    assert got["freshness_date"]["details"] == "Most recent date: None, age: 4 days (max 3)"


def test_nulls_count_equal_in_unique(spark):
    df = spark.createDataFrame([(None, None, 1.0, 1.0, 1.0, 1.0, 1)] * 2, SCHEMA)
    assert _by_name(dq.dq_report(df, [dq.unique("symbol", "date")], "t"))[
        "unique_symbol_date"]["records_failed"] == 1


def test_two_unique_keys_union(dirty_df):
    got = _by_name(dq.dq_report(dirty_df, [dq.unique("symbol", "date"), dq.unique("symbol")], "t",
                                executed_at=False))
    assert got["unique_symbol"]["records_failed"] == 2  # one symbol three times
    assert got["unique_symbol_date"]["records_failed"] == 2


def test_single_scan(spark, tmp_path, dirty_df):
    path = str(tmp_path / "dirty")
    dirty_df.write.parquet(path)
    df = spark.read.parquet(path)
    rep = dq.dq_report(df, dq.standard_suite(), "t", today=TODAY)
    rep.collect()
    plan = rep._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1
    assert final.count("Exchange") == 2  # key shuffle + final single partition


def test_model_tests(spark, dirty_df):
    from pyspark.sql import functions as F

    stg_like = dirty_df.select("symbol", F.col("date").alias("trade_date"),
                               F.col("close").alias("close_price"))
    got = {(r["test"], r["column_name"]): r for r in
           dq.model_tests({"stg_daily_prices": stg_like}).collect()}
    assert got[("not_null", "symbol")]["failures"] == 1
    assert got[("unique", "symbol || '-' || cast(trade_date as varchar)")]["failures"] == 1  # one key, however often
    assert got[("unique", "symbol || '-' || cast(trade_date as varchar)")]["status"] == "fail"


def test_model_tests_single_column_key(spark):
    from pyspark.sql import functions as F

    weekly_like = spark.createDataFrame(
        [("A", None), ("A", None), (None, None)], "symbol string, week_start date"
    ).withColumn("week_start", F.coalesce("week_start", F.current_date()))
    got = {(r["test"], r["column_name"]): r["failures"]
           for r in dq.model_tests({"agg_weekly_performance": weekly_like}).collect()}
    assert got == {("not_null", "symbol"): 1, ("not_null", "week_start"): 0}
    # a one-column unique key works too
    one = dq._model_tests(weekly_like, "m", ("symbol",), ("symbol",))
    assert {r["test"]: r["failures"] for r in one.collect()} == {"not_null": 1, "unique": 1}
