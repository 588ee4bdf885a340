"""The medallion layers on month folders: a load costs the months it touches.

``load_bars`` appends to Bronze; ``refresh`` brings staging, Silver, the fact
and the weekly mart up to date.  Staging and Silver rules look at one key, so
a month of either follows from that month of Bronze.  Fact rows are redone in
the intervals that changed bars reach, weeks where a redone row lies in them;
both are written back by month.

What changed in staging is kept in a folder of its own until the marts have it,
so a run that broke off anywhere is made good by the next ``refresh`` of the
same months.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.operators.indicators import fact_daily_performance, price_indicators
from tickhouse.operators.intervals import changed_keys, redo_intervals, redone_rows
from tickhouse.operators.medallion import bronze_frame, silver_frame
from tickhouse.operators.moments import MONTH_START, month_moments, summary_of_moments
from tickhouse.operators.quality import dq_report, part_measures, report_of_parts, standard_suite
from tickhouse.operators.staging import RAW_BAR_COLUMNS, latest_valid_bars, stage_types
from tickhouse.operators.weekly import weekly_performance
from tickhouse.session import new_scratch_dir
from tickhouse.sources.files import read_raw
from tickhouse.sources.months import MONTH, MonthTable, month_of, months_in

Months = Iterable[int | None]


class MonthLayers:
    """The tables of one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        def table(name: str, date: str) -> MonthTable:
            return MonthTable(spark, f"{root.rstrip('/')}/{name}", date)

        self.spark = spark
        self.pending = f"{root.rstrip('/')}/staging/changed_bars"
        self.due = f"{root.rstrip('/')}/staging/due_months"
        self.bronze = table("bronze/daily_prices", "date")
        self.silver = table("silver/daily_prices", "date")
        self.moments = table("gold/month_moments", MONTH_START)
        self.measures = MonthTable(
            spark, f"{root.rstrip('/')}/quality/month_measures", MONTH_START, [MONTH_START]
        )
        self.staged = table("staging/latest_bars", "date")
        self.fact = table("marts/fact_daily_performance", "trade_date")
        self.weekly = table("marts/agg_weekly_performance", "week_start")

    # --- layers that follow from one month of Bronze ---------------------------

    def load_bars(self, raw: DataFrame, loaded_at=None, source_file=None) -> list[int | None]:
        """Append bars to Bronze; returns the months they touch."""
        months = months_in(raw)
        if months:
            self.bronze.append(bronze_frame(raw, loaded_at=loaded_at, source_file=source_file))
        return months

    def refresh_silver(self, months: Months, loaded_at=None) -> None:
        self.silver.replace(silver_frame(self.bronze.read(months), loaded_at=loaded_at), months)

    def _silver(self, months: Months | None = None) -> DataFrame:
        """Silver, also where no bar of Bronze is valid so far and nothing was written."""
        if self.silver.exists():
            return self.silver.read(months)
        return silver_frame(self.bronze.read(months))

    def refresh_moments(self, months: Months) -> None:
        """Replace Gold's moments of these months by those of Silver as it is now."""
        self.moments.replace(month_moments(self._silver(months)), months)

    def gold(self, loaded_at=False) -> DataFrame:
        """The per-symbol summary, from one row per symbol and month."""
        return summary_of_moments(self.moments.read(), loaded_at)

    def load_raw(
        self,
        raw_root: str,
        kind: str = "daily",
        loaded_at=None,
        timestamp_type: T.DataType | None = None,
        ingest_date: dt.date | None = None,
    ) -> list[int | None]:
        """Append landed ``daily`` or ``history`` folders; each row keeps the file it came from."""
        return self.load_bars(read_raw(self.spark, raw_root, kind, timestamp_type, ingest_date), loaded_at)

    def refresh_checks(self, months: Months) -> None:
        """Measure the standard checks in these months of Silver."""
        part = F.trunc("date", "month").alias(MONTH_START)
        self.measures.replace(part_measures(self._silver(months), standard_suite(), part), months)

    def checks_report(self, today: dt.date | None = None, executed_at=None) -> DataFrame:
        """The standard checks on all of Silver, from one row per month."""
        if not self.measures.exists():  # Silver has no rows
            return dq_report(self._silver(), standard_suite(), "daily_prices", today, executed_at)
        parts = self.measures.read()
        return report_of_parts(parts, standard_suite(), "daily_prices", today, executed_at)

    def refresh_layers(self, months: Months, loaded_at=None) -> None:
        """Silver, Gold's moments, the checks and staging of these months."""
        self.refresh_silver(months, loaded_at)
        self.refresh_moments(months)
        self.refresh_checks(months)
        self.refresh_staged(months)

    def note(self, months: Months) -> None:
        """Months whose layers are due, kept until they are struck out."""
        rows = self.spark.createDataFrame([(m,) for m in months], f"{MONTH} int")
        rows.coalesce(1).write.parquet(f"{self.due}/{uuid.uuid4().hex}")

    def noted(self) -> tuple[list[int | None], list[str]]:
        """The months that are due, and the folders that say so."""
        notes = self._complete(self.due)
        if not notes:
            return [], []
        found = self.spark.read.schema(f"{MONTH} int").parquet(*notes).distinct().collect()
        return sorted((r[0] for r in found), key=lambda m: (m is None, m)), notes

    def strike(self, notes: list[str]) -> None:
        self._taken_up(notes)

    def refresh_staged(self, months: Months) -> None:
        """Rewrite the months of staging; the keys of changed bars wait in a folder for the marts."""
        new = latest_valid_bars(self.bronze.read(months).select(*RAW_BAR_COLUMNS))
        if self.staged.exists():
            old = self.staged.read(months)
        else:
            old = self.spark.createDataFrame([], new.schema)
        # written before the months are, and compared with what they held
        keys = changed_keys(stage_types(old), stage_types(new))
        keys.write.parquet(f"{self.pending}/{uuid.uuid4().hex}")
        self.staged.replace(new, months)

    def _complete(self, place: str) -> list[str]:
        """The folders below ``place`` whose writing was completed."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        system = path(place).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(path(place)):
            return []
        found = [f.getPath().toString() for f in system.listStatus(path(place))]
        return sorted(f for f in found if system.exists(path(f"{f}/_SUCCESS")))

    def waiting(self) -> list[str]:
        """Folders of changed keys that the marts have not taken up yet.

        One without the mark broke off before staging was touched.
        """
        return self._complete(self.pending)

    def _taken_up(self, folders: list[str]) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for folder in folders:
            path(folder).getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path(folder), True)

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        place = new_scratch_dir(self.spark, name)
        rows.write.parquet(place)
        return self.spark.read.parquet(place)

    # --- marts -------------------------------------------------------------------

    def refresh_fact(self, changed: DataFrame, updated_at=False) -> DataFrame:
        """Redo what the changed bars reach; returns (symbol, trade_date) of those fact rows."""
        bars = stage_types(self.staged.read())
        keys = ["symbol", "trade_date"]
        if (
            not self.fact.exists()
            or self.staged.files(None)
            or not bars.where(F.col("symbol").isNull()).isEmpty()
        ):
            # first use, or bars that no symbol and date can name
            self.fact.overwrite(
                fact_daily_performance(price_indicators(bars), updated_at=updated_at)
            )
            return self.fact.read().select(*keys).unionByName(changed.select(*keys))
        intervals = self._kept(redo_intervals(bars, changed), "intervals")
        reach = intervals.agg(
            F.min(month_of("lead_date")).alias("first"), F.max(month_of("to_date")).alias("last")
        ).first()
        near = stage_types(self.staged.read(since=reach["first"], until=reach["last"]))
        redone = self._kept(redone_rows(near, intervals, updated_at), "redone-facts")
        # bars that disappeared leave no row, but their old row goes too
        reached = redone.select(*keys).unionByName(changed.select(*keys)).distinct()
        months = months_in(reached, "trade_date")
        stay = self.fact.read(months).join(reached, keys, "anti")
        self.fact.replace(stay.unionByName(redone), months)
        return reached

    def refresh_weekly(self, reached: DataFrame, updated_at=False) -> None:
        """Redo the weeks of the given fact rows, across month borders."""
        week = F.trunc("trade_date", "week").alias("week_start")
        weeks = reached.select("symbol", week).distinct()
        # the week's first day names the folder of the week; its other days may lie in the next month
        months = months_in(weeks, "week_start")
        days = weeks.select(
            F.explode(F.array("week_start", F.date_add("week_start", 6))).alias("date")
        )
        read = months_in(days, "date")
        rows = self.fact.read(read).withColumn("week_start", week).join(
            weeks, ["symbol", "week_start"], "semi"
        )
        new = weekly_performance(rows.drop("week_start"), grain="week", updated_at=updated_at)
        if not self.weekly.exists():
            self.weekly.overwrite(new)
            return
        stay = self.weekly.read(months).join(weeks, ["symbol", "week_start"], "anti")
        self.weekly.replace(stay.unionByName(new), months)

    def refresh_marts(self, updated_at=False) -> None:
        """Both marts take up the changed keys that wait for them."""
        folders = self.waiting()
        if folders and self.staged.exists():  # otherwise no bar is valid so far
            changed = self.spark.read.parquet(*folders).distinct()
            self.refresh_weekly(self.refresh_fact(changed, updated_at), updated_at)
        self._taken_up(folders)

    def refresh(self, months: Months, loaded_at=None, updated_at=False) -> None:
        """Silver, Gold, staging and both marts after bars of ``months`` were loaded."""
        if months:
            self.refresh_layers(months, loaded_at)
        self.refresh_marts(updated_at)
