"""tickhouse: a Spark-native medallion engine for daily OHLCV price bars.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column``)
function built from Spark's own expressions, so Catalyst sees the whole
plan: filters reach the Parquet scan, windows share one sort, and
aggregations combine map-side before they shuffle.
"""

from tickhouse.functions.columns import exact_mean, safe_divide
from tickhouse.operators.indicators import fact_daily_performance, price_indicators
from tickhouse.operators.medallion import bronze_frame, gold_daily_summary, silver_frame
from tickhouse.operators.quality import dq_report, dq_summary, model_tests, standard_suite
from tickhouse.operators.serving import list_symbols, price_history, symbol_detail
from tickhouse.operators.staging import clean_staging, latest_valid_bars, valid_price_predicate
from tickhouse.operators.weekly import weekly_performance
from tickhouse.plans.flow import (
    build_marts,
    load_bronze,
    load_gold,
    load_silver,
    refresh_staging,
    run_medallion,
)
from tickhouse.session import build_session, new_scratch_dir, scratch_root
from tickhouse.sources.files import (
    read_prices_csv,
    read_raw,
    write_raw_daily,
    write_raw_history,
)
from tickhouse.sources.history import parse_history_frame
from tickhouse.sources.responses import parse_daily_responses, read_landed_responses
from tickhouse.sources.tables import VersionedTable, layer_status, read_table
from tickhouse.streaming.bronze_stream import bronze_stream

__all__ = [
    "VersionedTable",
    "bronze_frame",
    "bronze_stream",
    "build_marts",
    "build_session",
    "clean_staging",
    "dq_report",
    "dq_summary",
    "exact_mean",
    "fact_daily_performance",
    "gold_daily_summary",
    "latest_valid_bars",
    "layer_status",
    "list_symbols",
    "load_bronze",
    "load_gold",
    "load_silver",
    "model_tests",
    "new_scratch_dir",
    "parse_daily_responses",
    "parse_history_frame",
    "price_history",
    "price_indicators",
    "read_landed_responses",
    "read_prices_csv",
    "read_raw",
    "read_table",
    "refresh_staging",
    "run_medallion",
    "safe_divide",
    "scratch_root",
    "silver_frame",
    "standard_suite",
    "symbol_detail",
    "valid_price_predicate",
    "weekly_performance",
    "write_raw_daily",
    "write_raw_history",
]
