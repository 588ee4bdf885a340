"""Lookups served from the layer tables, as functions returning DataFrames.

Plans: the symbol and date predicates are pushed into the Parquet scan
(Silver is written sorted by symbol and date, so row-group statistics
skip most of the table), and ``ORDER BY date DESC LIMIT n`` runs as
TakeOrderedAndProject: a per-task top-n, never a global sort.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.sources.tables import VersionedTable, layer_path

DETAIL_COLUMNS = ["symbol", "date", "open", "high", "low", "close", "volume"]
# Fixed values of the lookups: recent rows shown per symbol, default and
# allowed range of the history row limit.
DETAIL_ROWS = 30
DEFAULT_LIMIT = 100
MIN_LIMIT, MAX_LIMIT = 1, 1000


def _layer(spark: SparkSession, root: str, layer: str) -> DataFrame:
    table = VersionedTable(spark, layer_path(root, layer))
    if not table.exists():
        raise FileNotFoundError(f"{layer.capitalize()} layer not yet populated")
    return table.read()


def silver_table(spark: SparkSession, root: str) -> DataFrame:
    return _layer(spark, root, "silver")


def list_symbols(spark: SparkSession, root: str) -> DataFrame:
    """All Gold summary rows (unordered); error when Gold is missing."""
    return _layer(spark, root, "gold")


def _for_symbol(silver: DataFrame, symbol: str) -> DataFrame:
    # Only the argument is upper-cased; stored symbols are compared as is.
    return silver.where(F.col("symbol") == F.lit(symbol.upper()))


def symbol_detail(silver: DataFrame, symbol: str, n: int = DETAIL_ROWS) -> DataFrame:
    """Newest ``n`` bars of a symbol (7 columns); empty means not found."""
    return (
        _for_symbol(silver, symbol)
        .select(*DETAIL_COLUMNS)
        .orderBy(F.col("date").desc_nulls_last())
        .limit(n)
    )


def price_history(
    silver: DataFrame,
    symbol: str,
    start_date: dt.date | None = None,
    end_date: dt.date | None = None,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """All Silver columns of a symbol, newest first, both date ends inclusive."""
    if not isinstance(limit, int) or not MIN_LIMIT <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be an integer in [{MIN_LIMIT}, {MAX_LIMIT}], got {limit!r}")
    rows = _for_symbol(silver, symbol)
    if start_date is not None:
        rows = rows.where(F.col("date") >= F.lit(start_date))
    if end_date is not None:
        rows = rows.where(F.col("date") <= F.lit(end_date))
    return rows.orderBy(F.col("date").desc_nulls_last()).limit(limit)
