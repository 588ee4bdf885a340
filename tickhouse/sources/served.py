"""Silver laid out for lookups: years, and in each year ranges of (symbol, date).

Silver's month folders suit loads, not the question for one symbol.  The
served copy is clustered: within a year, files are ranges of symbol and date,
sorted inside, so the footer's minima and maxima name the one or two files
that can hold a symbol.  A symbol that lies between a row group's bounds
without being in it is excluded by the group's dictionary or, where a group
holds too many symbols for one, by its Bloom filter.

A load rewrites the years it touches, from Silver; other years' files stay.
A symbol with more bars than fit a file spans several, as dates are part of
the range.  Rows without a date lie in a folder of their own, a year that ends
up empty is removed.  A broken run is repeated.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.operators.serving import DEFAULT_LIMIT, DETAIL_ROWS, price_history, symbol_detail
from tickhouse.sources.months import NO_DATE, MonthTable

YEAR = "year"


class ServedBars:
    def __init__(self, spark: SparkSession, path: str, options: dict[str, str] | None = None):
        """``options`` go to the Parquet writer, such as another ``parquet.block.size``."""
        self.spark, self.path = spark, path.rstrip("/")
        self.options = {"parquet.bloom.filter.enabled#symbol": "true"} | (options or {})

    def write(self, silver: DataFrame) -> None:
        """Replace the years of ``silver`` by its rows."""
        dealt = silver.withColumn(YEAR, F.year("date")).repartitionByRange(YEAR, "symbol", "date")
        (
            dealt.sortWithinPartitions(YEAR, "symbol", "date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(**self.options)
            .partitionBy(YEAR)
            .parquet(self.path)
        )

    def files(self, year: int | None) -> set[str]:
        """Names of a year's data files."""
        system, folder = self._folder(year)
        if not system.exists(folder):
            return set()
        names = {s.getPath().getName() for s in system.listStatus(folder)}
        return {n for n in names if not n.startswith(("_", "."))}

    def _folder(self, year: int | None):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        folder = path(f"{self.path}/{YEAR}={NO_DATE if year is None else year}")
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def refresh(self, silver: MonthTable, months: Iterable[int | None]) -> None:
        """Rewrite the years that ``months`` lie in after Silver has them."""
        years = sorted({None if m is None else m // 100 for m in months}, key=lambda y: (y is None, y))
        read = [None if y is None else y * 100 + m for y in years for m in range(1, 13)]
        before = {y: self.files(y) for y in years}
        self.write(silver.read(list(dict.fromkeys(read))))
        for year, old in before.items():
            if old and self.files(year) == old:  # no row is left in it
                system, folder = self._folder(year)
                system.delete(folder, True)

    def read(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """All rows, or only the folders of the years from ``start`` to ``end``."""
        rows = self.spark.read.parquet(self.path)
        if start is not None:
            rows = rows.where(F.col(YEAR) >= start.year)
        if end is not None:
            rows = rows.where(F.col(YEAR) <= end.year)
        return rows.drop(YEAR)

    def symbol_detail(self, symbol: str, n: int = DETAIL_ROWS) -> DataFrame:
        return symbol_detail(self.read(), symbol, n)

    def price_history(
        self,
        symbol: str,
        start_date: dt.date | None = None,
        end_date: dt.date | None = None,
        limit: int = DEFAULT_LIMIT,
    ) -> DataFrame:
        return price_history(self.read(start_date, end_date), symbol, start_date, end_date, limit)
