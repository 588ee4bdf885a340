"""Layer tables as plain Parquet in one folder per calendar month.

A bar belongs to one month, and so does every rule that looks at one key
(symbol, date) only: a load that touches a few months needs those folders,
whatever the length of the history.  ``replace`` rewrites the touched months
by Spark's dynamic partition overwrite and removes the folder of a month that
ends up empty; a run that breaks off is repeated with the same rows and gives
the same folders.  The folders are the table: no log beside them.

Rows without a date are kept in a folder of their own.  One job writes a
table at a time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "month"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def month_of(date: Column | str) -> Column:
    """Year and month as one number, such as 202501."""
    date = F.col(date) if isinstance(date, str) else date
    return (F.year(date) * 100 + F.month(date)).alias(MONTH)


def months_in(df: DataFrame, date: str = "date") -> list[int | None]:
    """The months of a frame's rows: at most a few thousand, whatever its size."""
    found = [r[0] for r in df.select(month_of(date)).distinct().collect()]
    return sorted(found, key=lambda m: (m is None, m))


class MonthTable:
    def __init__(self, spark: SparkSession, path: str, date: str = "date", order: Iterable[str] = ()):
        self.spark, self.path, self.date = spark, path.rstrip("/"), date
        self.order = list(order) or ["symbol", date]

    def _files(self):
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(self.path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _folder(self, month: int | None) -> str:
        return f"{self.path}/{MONTH}={NO_DATE if month is None else month}"

    def files(self, month: int | None) -> set[str]:
        """Names of a month's data files."""
        system, path = self._files()
        folder = path(self._folder(month))
        if not system.exists(folder):
            return set()
        names = {s.getPath().getName() for s in system.listStatus(folder)}
        return {n for n in names if not n.startswith(("_", "."))}

    def exists(self) -> bool:
        system, path = self._files()
        folder = path(self.path)
        return system.exists(folder) and any(
            s.getPath().getName().startswith(f"{MONTH}=") for s in system.listStatus(folder)
        )

    def read(
        self,
        months: Iterable[int | None] | None = None,
        since: int | None = None,
        until: int | None = None,
    ) -> DataFrame:
        """All rows, or those of the given months: only their folders are read."""
        rows = self.spark.read.option("mergeSchema", "true").parquet(self.path)
        if months is not None:
            named = [m for m in months if m is not None]
            chosen = F.col(MONTH).isin(named) if named else F.lit(False)
            if None in months:
                chosen = chosen | F.col(MONTH).isNull()
            rows = rows.where(chosen)
        if since is not None:
            rows = rows.where(F.col(MONTH) >= since)
        if until is not None:
            rows = rows.where(F.col(MONTH) <= until)
        return rows.drop(MONTH)

    def _writer(self, rows: DataFrame):
        dealt = rows.withColumn(MONTH, month_of(self.date)).hint("rebalance", MONTH)
        return dealt.sortWithinPartitions(MONTH, *self.order).write.partitionBy(MONTH)

    def append(self, rows: DataFrame) -> None:
        self._writer(rows).mode("append").parquet(self.path)

    def overwrite(self, rows: DataFrame) -> None:
        """The table holds ``rows`` and nothing else; they must not come from it."""
        self._writer(rows).mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path)

    def replace(self, rows: DataFrame, months: Iterable[int | None]) -> None:
        """``rows`` become the whole content of ``months``; they may be read from the table.

        Other months' files stay as they are.
        """
        before = {m: self.files(m) for m in months}
        self._writer(rows).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
        system, path = self._files()
        for month, old in before.items():
            if old and self.files(month) == old:  # nothing was written in its place
                system.delete(path(self._folder(month)), True)
