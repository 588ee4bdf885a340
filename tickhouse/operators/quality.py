"""Data-quality checks evaluated in one aggregation pass.

A check is a declarative description; ``dq_report`` turns a list of them
into a single aggregation over the input and unpivots the one-row result
into one record per check (name, status, table, rows checked, rows
failed, details, pass rate, time).  With a uniqueness check the pass
first groups by the key -- a hash aggregation whose partial step runs
map-side, so a hot key shrinks to one row per task before the shuffle --
and carries every per-row failure count through that grouping; the
final step is a global sum over the (much smaller) grouped rows.

Statuses: a failing ``not_null``, ``positive``, ``unique`` or
``high_gte_low`` is FAILED; a failing ``freshness`` or ``value_range``
is only a WARNING, and the summary's ``all_passed`` ignores warnings.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PASSED, FAILED, WARNING = "PASSED", "FAILED", "WARNING"

@dataclass(frozen=True)
class Check:
    name: str
    kind: str
    columns: tuple[str, ...]
    fail_status: str = FAILED
    params: tuple = ()


def not_null(*cols: str) -> list[Check]:
    return [Check(f"not_null_{c}", "not_null", (c,)) for c in cols]


def positive(*cols: str) -> list[Check]:
    """Value <= 0 fails; NULL passes."""
    return [Check(f"positive_{c}", "positive", (c,)) for c in cols]


def unique(*cols: str) -> Check:
    """Rows minus distinct rows over the key (NULLs compare equal)."""
    return Check(f"unique_{'_'.join(cols)}", "unique", tuple(cols))


def freshness(col: str, max_age_days: int = 3) -> Check:
    """Newest date older than ``max_age_days`` (or none at all) warns."""
    return Check(f"freshness_{col}", "freshness", (col,), WARNING, (max_age_days,))


def value_range(col: str, min_val: float, max_val: float) -> Check:
    """Values outside ``[min_val, max_val]`` warn; NULL passes."""
    return Check(f"range_{col}", "range", (col,), WARNING, (min_val, max_val))


def high_gte_low(high: str = "high", low: str = "low") -> Check:
    """``high < low`` fails; NULL passes."""
    return Check("high_gte_low", "high_gte_low", (high, low))


def standard_suite() -> list[Check]:
    """The suite the flow runs on Silver: 11 checks."""
    return [
        *not_null("symbol", "date", "close", "volume"),
        *positive("open", "high", "low", "close"),
        unique("symbol", "date"),
        freshness("date", max_age_days=3),
        high_gte_low(),
    ]


def _row_failure(check: Check) -> Column | None:
    c = [F.col(x) for x in check.columns]
    if check.kind == "not_null":
        return c[0].isNull()
    if check.kind == "positive":
        return c[0] <= 0
    if check.kind == "range":
        lo, hi = check.params
        return (c[0] < F.lit(lo)) | (c[0] > F.lit(hi))
    if check.kind == "high_gte_low":
        return c[0] < c[1]
    return None


def _py_list(cols: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{c}'" for c in cols) + "]"


def _record(
    check: Check, checked: Column, failed: Column, details: Column, table: str
) -> Column:
    status = F.when(failed == 0, F.lit(PASSED)).otherwise(F.lit(check.fail_status))
    rate = F.when(checked == 0, F.lit(0.0)).otherwise(
        (checked - failed).cast("double") / checked.cast("double")
    )
    return F.struct(
        F.lit(check.name).alias("check_name"),
        status.alias("status"),
        F.lit(table).alias("table_name"),
        checked.cast("bigint").alias("records_checked"),
        failed.cast("bigint").alias("records_failed"),
        details.alias("details"),
        rate.alias("pass_rate"),
    )


def dq_report(
    df: DataFrame,
    checks: list[Check],
    table_name: str,
    today: dt.date | None = None,
    executed_at=None,
) -> DataFrame:
    """One record per check, all computed by a single aggregation pass.

    ``today`` is the reference date of freshness checks (UTC today when
    None).  ``executed_at``: None stamps the current time, ``False``
    leaves the column out, anything else is used as the value.
    """
    keysets = list(dict.fromkeys(ck.columns for ck in checks if ck.kind == "unique"))
    if len(keysets) > 1:
        # one pass per distinct key; the row checks ride along the first
        first = [ck for ck in checks if ck.kind != "unique" or ck.columns == keysets[0]]
        out = dq_report(df, first, table_name, today, executed_at)
        for key in keysets[1:]:
            same = [ck for ck in checks if ck.kind == "unique" and ck.columns == key]
            out = out.unionByName(dq_report(df, same, table_name, today, executed_at))
        return out
    unique_keys = keysets

    row_aggs = _row_measures(checks, df.schema)
    if unique_keys:
        totals = _summed(_per_key(df, checks, unique_keys[0], row_aggs), checks)
    else:
        totals = df.agg(F.count(F.lit(1)).alias("_rows"), *row_aggs)

    return _report(totals, checks, table_name, today, executed_at)


def _per_key(
    df: DataFrame, checks: list[Check], key: tuple[str, ...], row_aggs: list[Column], *also: Column
) -> DataFrame:
    """Measures of each key value: rows, repeats and what the row checks found."""
    grouped = df.groupBy(*key, *also).agg(F.count(F.lit(1)).alias("_rows"), *row_aggs)
    return grouped.withColumn("_dup", F.col("_rows") - 1)


def _merges(checks: list[Check]) -> list[Column]:
    """How measures of parts make those of the whole."""
    merged = [F.sum("_rows").alias("_rows"), F.sum("_dup").alias("_dup")]
    for i, ck in enumerate(checks):
        if ck.kind != "unique":
            merge = F.max if ck.kind == "freshness" else F.sum
            merged.append(merge(f"_f{i}").alias(f"_f{i}"))
    return merged


def _summed(parts: DataFrame, checks: list[Check]) -> DataFrame:
    return parts.agg(*_merges(checks))


def part_measures(df: DataFrame, checks: list[Check], part: Column) -> DataFrame:
    """Measures of the checks, one row for each value of ``part`` (an aliased column).

    Rows of equal unique keys must lie in one part, so that a part's repeats
    can be counted in it alone; with several unique keys there is no such
    part in general, and the checks are refused.  A part that changes is
    measured anew and replaces its row; ``report_of_parts`` adds up the rest.
    """
    keys = list(dict.fromkeys(ck.columns for ck in checks if ck.kind == "unique"))
    if len(keys) > 1:
        raise ValueError("one unique key at most can be measured by parts")
    name = df.select(part).columns[0]
    aggs = _row_measures(checks, df.schema)
    if not keys:
        return df.groupBy(part).agg(
            F.count(F.lit(1)).alias("_rows"), F.lit(0).cast("bigint").alias("_dup"), *aggs
        )
    by_key = _per_key(df, checks, keys[0], aggs, part)
    return by_key.groupBy(name).agg(*_merges(checks))


def report_of_parts(
    parts: DataFrame,
    checks: list[Check],
    table_name: str,
    today: dt.date | None = None,
    executed_at=None,
) -> DataFrame:
    """``dq_report`` of the whole table from the measures of its parts."""
    return _report(_summed(parts, checks), checks, table_name, today, executed_at)


def _row_measures(checks: list[Check], schema: T.StructType) -> list[Column]:
    """One aggregate for each check that looks at rows: failures, or the newest date."""
    found: list[Column] = []
    for i, ck in enumerate(checks):
        fail = _row_failure(ck)
        if fail is not None:
            found.append(F.count_if(fail).alias(f"_f{i}"))
        elif ck.kind == "freshness":
            # a column that holds no dates has no newest date: the check warns
            dated = isinstance(
                schema[ck.columns[0]].dataType,
                (T.DateType, T.TimestampType, T.TimestampNTZType),
            )
            day = F.col(ck.columns[0]).cast("date") if dated else F.lit(None).cast("date")
            found.append(F.max(day).alias(f"_f{i}"))
    return found


def _report(
    totals: DataFrame,
    checks: list[Check],
    table_name: str,
    today: dt.date | None,
    executed_at,
) -> DataFrame:
    """One record per check from the one row of measures."""
    rows = F.coalesce(F.col("_rows"), F.lit(0)).cast("bigint")
    ref_day = F.lit(today) if today is not None else F.current_date()
    records = []
    for i, ck in enumerate(checks):
        col = ck.columns[0]
        if ck.kind == "unique":
            failed = F.coalesce(F.col("_dup"), F.lit(0))
            before, after = f"Composite key {_py_list(ck.columns)}: ", " duplicate rows"
            details = _around(before, failed, after)
        elif ck.kind == "freshness":
            limit = ck.params[0]
            newest = F.col(f"_f{i}")
            age = F.coalesce(F.datediff(ref_day, newest), F.lit(limit + 1))
            failed = F.when(age <= limit, F.lit(0)).otherwise(F.lit(1))
            details = F.concat(
                F.lit("Most recent date: "),
                F.coalesce(newest.cast("string"), F.lit("None")),
                _around(", age: ", age, f" days (max {limit})"),
            )
        else:
            failed = F.coalesce(F.col(f"_f{i}"), F.lit(0))
            if ck.kind == "not_null":
                before, after = f"Column '{col}': ", " nulls found"
            elif ck.kind == "positive":
                before, after = f"Column '{col}': ", " non-positive values"
            elif ck.kind == "range":
                lo, hi = ck.params
                before, after = f"Column '{col}': ", f" values outside [{lo}, {hi}]"
            else:
                before, after = "", " records where high < low"
            details = _around(before, failed, after)
        records.append(_record(ck, rows, failed, details, table_name))

    report = totals.select(F.inline(F.array(*records)))
    if executed_at is False:
        return report
    stamp = F.current_timestamp() if executed_at is None else F.lit(executed_at)
    return report.withColumn("executed_at", stamp)


class WriteChecks:
    """Checks measured by the job that writes a frame, without a scan of their own.

    ``watch`` puts the measures on the frame that is written; do so after its
    last shuffle, where each written row is counted once even if tasks or
    executors are lost.  Once the write has run, ``report`` gives what
    ``dq_report`` would find in the written rows.

    Counting distinct keys needs a shuffle, so a uniqueness check is only
    taken where its key is named in ``deduped``: the writer has just kept one
    row of each.
    """

    def __init__(self, checks: list[Check], deduped: tuple[str, ...] = ()):
        for ck in checks:
            if ck.kind == "unique" and set(ck.columns) != set(deduped):
                raise ValueError(f"{ck.name} needs rows deduplicated by {list(ck.columns)}")
        self.checks = checks
        self._observation = Observation()
        self._schema: T.StructType | None = None

    def watch(self, df: DataFrame) -> DataFrame:
        measures = [F.count(F.lit(1)).alias("_rows"), *_row_measures(self.checks, df.schema)]
        self._schema = df.select(*measures).schema
        return df.observe(self._observation, *measures)

    @property
    def watched(self) -> bool:
        """Whether a frame carries the measures."""
        return self._schema is not None

    def report(
        self,
        spark: SparkSession,
        table_name: str,
        today: dt.date | None = None,
        executed_at=None,
    ) -> DataFrame:
        """The report of the written rows; waits for the write."""
        if self._schema is None:
            raise ValueError("no frame is watched")
        found = self._observation.get
        row = tuple(found.get(name) for name in self._schema.names)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in self._schema.fields])
        totals = spark.createDataFrame([row], schema).withColumn("_dup", F.lit(0))
        return _report(totals, self.checks, table_name, today, executed_at)


def _around(before: str, number: Column, after: str) -> Column:
    """A fixed text around a number; names in it may hold any character."""
    return F.concat(F.lit(before), number.cast("string"), F.lit(after))


def dq_summary(report: DataFrame) -> DataFrame:
    """Totals over a report: passed, failed, warnings; warnings still pass."""
    return report.agg(
        F.max("table_name").alias("table_name"),
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == PASSED).alias("passed"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.count_if(F.col("status") == WARNING).alias("warnings"),
    ).withColumn("all_passed", F.col("failed") == 0)


def dq_summary_dict(report: DataFrame) -> dict:
    """The summary as a plain dict (one tiny row through the driver)."""
    row = dq_summary(report).first()
    return {
        "table": row["table_name"],
        "total_checks": int(row["total_checks"]),
        "passed": int(row["passed"]),
        "failed": int(row["failed"]),
        "warnings": int(row["warnings"]),
        "all_passed": bool(row["all_passed"]),
    }


# ------------------------------------------------------------------ model tests
# The declared tests of each model (not-null columns and the
# unique key expression parts).
MODEL_TESTS = {
    "raw.daily_prices": (("symbol", "date", "close", "volume"), None),
    "stg_daily_prices": (("symbol", "trade_date", "close_price"), ("symbol", "trade_date")),
    "fact_daily_performance": (("symbol", "trade_date", "close_price"), ("symbol", "trade_date")),
    "agg_weekly_performance": (("symbol", "week_start"), None),
}


def _model_tests(df: DataFrame, model: str, not_null_cols, key_cols) -> DataFrame:
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_nn_{c}") for c in not_null_cols]
    if key_cols:
        # the tested key is symbol || '-' || date, NULL when a part is; a date's text
        # has a fixed width, so the key columns themselves group the same rows and
        # keep the partitioning they already have
        whole = F.lit(True)
        for c in key_cols:
            whole = whole & F.col(c).isNotNull()
        grouped = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n"), *nulls)
        totals = grouped.agg(
            *[F.sum(f"_nn_{c}").alias(f"_nn_{c}") for c in not_null_cols],
            F.count_if((F.col("_n") > 1) & whole).alias("_dups"),
        )
    else:
        totals = df.agg(*nulls)
    recs = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit("not_null").alias("test"),
            F.lit(c).alias("column_name"),
            F.coalesce(F.col(f"_nn_{c}"), F.lit(0)).cast("bigint").alias("failures"),
        )
        for c in not_null_cols
    ]
    if key_cols:
        expr = " || '-' || ".join(
            c if i == 0 else f"cast({c} as varchar)" for i, c in enumerate(key_cols)
        )
        recs.append(
            F.struct(
                F.lit(model).alias("model"),
                F.lit("unique").alias("test"),
                F.lit(expr).alias("column_name"),
                F.col("_dups").cast("bigint").alias("failures"),
            )
        )
    return totals.select(F.inline(F.array(*recs))).withColumn(
        "status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail"))
    )


def model_tests(models: dict[str, DataFrame]) -> DataFrame:
    """Declared model tests: NULL counts and duplicated key values.

    A ``unique`` failure counts key *values* seen more than once (NULL keys
    excluded); ``not_null`` counts NULL rows.  One pass per model.
    """
    out = None
    for model, df in models.items():
        nn, key = MODEL_TESTS[model]
        part = _model_tests(df, model, nn, key)
        out = part if out is None else out.unionByName(part)
    return out
