"""Incremental Silver refresh equals the full rebuild."""

from __future__ import annotations

import datetime as dt
import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bars import SF_SMALL
from tickhouse.operators.medallion import silver_frame
from tickhouse.plans import flow
from tickhouse.sources.adapter import raw_bars
from tickhouse.sources.tables import VersionedTable, layer_path

SCHEMA = (
    "symbol string, date date, open double, high double, low double, close double, "
    "volume bigint, ingested_at timestamp"
)
_n = itertools.count()


def _content(df):
    cols = ["symbol", "date", "open", "high", "low", "close", "volume", "ingested_at",
            "_bronze_loaded_at"]
    rows = [tuple(r) for r in df.select(*cols).collect()]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def _full(spark, root):
    bronze = VersionedTable(spark, layer_path(root, "bronze")).read()
    return silver_frame(bronze)


def _load(spark, root, frame, when):
    flow.load_bronze(spark, frame, root, loaded_at=F.lit(when), source_file="t")
    return flow.load_silver(spark, root)


def test_incremental_matches_full_on_adapter_batches(spark, tmp_path, monkeypatch):
    taken = []
    real = flow._refresh_silver

    def spy(*args, **kwargs):
        out = real(*args, **kwargs)
        taken.append(out is not None)
        return out

    monkeypatch.setattr(flow, "_refresh_silver", spy)
    raw = raw_bars(spark, SF_SMALL)
    root = str(tmp_path / "lake")
    t0 = dt.datetime(2025, 1, 1)
    # overlapping batches: the later ones rewrite keys of the earlier ones
    batches = [
        raw.where("date < date'1998-01-01'"),
        raw.where("date >= date'1997-01-01'"),
        raw.where("volume < 0 or close is null or date >= date'2000-01-01'"),
    ]
    silver_t = VersionedTable(spark, layer_path(root, "silver"))
    for i, b in enumerate(batches):
        _load(spark, root, b, t0 + dt.timedelta(days=i))
        assert silver_t.commit_record()["meta"]["bronze_version"] == i
        assert _content(silver_t.read()) == _content(_full(spark, root))
    # the first load builds Silver, the later ones refresh it incrementally
    assert taken == [False, True, True]


def test_refresh_refuses_out_of_order_loads(spark, tmp_path):
    raw = raw_bars(spark, SF_SMALL)
    root = str(tmp_path / "lake")
    _load(spark, root, raw, dt.datetime(2025, 1, 2))
    flow.load_bronze(spark, raw.limit(50), root, loaded_at=F.lit(dt.datetime(2025, 1, 1)),
                     source_file="t")
    b = VersionedTable(spark, layer_path(root, "bronze"))
    s = VersionedTable(spark, layer_path(root, "silver"))
    assert flow._refresh_silver(b, s, b.latest_version(), None) is None
    flow.load_silver(spark, root)  # falls back to the full rebuild
    assert _content(s.read()) == _content(_full(spark, root))


bar = st.tuples(
    st.sampled_from(["A", "B", None]),
    st.integers(0, 3),
    st.sampled_from([-1.0, 1.0, 2.0, None]),
    st.sampled_from([0.5, 3.0]),
    st.sampled_from([1.0, 2.5]),
    st.integers(0, 1000),
)


@settings(max_examples=int(__import__('os').environ.get('INC_EXAMPLES', '5')), deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(bar, min_size=0, max_size=8), min_size=1, max_size=3))
def test_incremental_matches_full_property(spark, tmp_path_factory, batches):
    root = str(tmp_path_factory.mktemp(f"inc{next(_n)}"))
    t0 = dt.datetime(2025, 1, 1)
    silver_t = VersionedTable(spark, layer_path(root, "silver"))
    for i, rows in enumerate(batches):
        data = [
            (sym, dt.date(2024, 1, 1) + dt.timedelta(days=d), o, h, lo, 1.5, v,
             t0 + dt.timedelta(seconds=k))
            for k, (sym, d, o, h, lo, v) in enumerate(rows)
        ]
        frame = spark.createDataFrame(data, SCHEMA)
        _load(spark, root, frame, t0 + dt.timedelta(days=i))
        assert _content(silver_t.read()) == _content(_full(spark, root))


def test_staging_refresh_matches_full(spark, tmp_path, monkeypatch):
    from tickhouse.operators.staging import clean_staging

    used = []
    real_increment = VersionedTable.increment

    def spy(self, after, upto=None):
        out = real_increment(self, after, upto)
        if self.path.endswith("bronze/daily_prices"):
            used.append(out is not None)
        return out

    monkeypatch.setattr(VersionedTable, "increment", spy)

    raw = raw_bars(spark, SF_SMALL)
    root = str(tmp_path / "lake")
    t0 = dt.datetime(2025, 1, 1)
    latest_t = VersionedTable(spark, layer_path(root, "staging", "latest_bars"))
    batches = [raw.where("date < date'1998-01-01'"), raw.where("date >= date'1997-01-01'"), raw]
    for i, b in enumerate(batches):
        flow.load_bronze(spark, b, root, loaded_at=F.lit(t0 + dt.timedelta(days=i)),
                         source_file="t")
        # fact extension off: only the staging refresh reads increments
        flow.build_marts(spark, root, updated_at=False, incremental=False)
        assert latest_t.commit_record()["meta"]["bronze_version"] == i
        full = clean_staging(VersionedTable(spark, layer_path(root, "bronze")).read())
        got = VersionedTable(spark, layer_path(root, "marts", "fact_daily_performance")).read()
        cols = ["symbol", "trade_date", "close_price", "ingested_at"]
        assert sorted(got.select(*cols).collect()) == sorted(full.select(*cols).collect())
    assert got.count() == 1352
    # each refresh after the first read only the new Bronze version
    assert used == [True, True]


def test_refresh_refuses_new_rows_without_load_time(spark, tmp_path):
    root = str(tmp_path / "lake")
    one = [("A", dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 1, dt.datetime(2024, 1, 1))]
    first = spark.createDataFrame(one, SCHEMA)
    flow.load_bronze(spark, first, root, loaded_at=F.col("ingested_at"), source_file="t")
    flow.load_silver(spark, root)
    two = [
        ("A", dt.date(2024, 1, 2), 9.0, 9.5, 8.0, 9.0, 1, None),
        ("B", dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 1, dt.datetime(2024, 1, 5)),
    ]
    second = spark.createDataFrame(two, SCHEMA)
    flow.load_bronze(spark, second, root, loaded_at=F.col("ingested_at"), source_file="t")
    b = VersionedTable(spark, layer_path(root, "bronze"))
    s = VersionedTable(spark, layer_path(root, "silver"))
    assert flow._refresh_silver(b, s, b.latest_version(), None) is None
    flow.load_silver(spark, root)
    assert _content(s.read()) == _content(_full(spark, root))
    assert s.read().where("symbol = 'A'").first()["open"] == 1.0


def test_missing_base_version_falls_back(spark, tmp_path):
    raw = raw_bars(spark, SF_SMALL)
    root = str(tmp_path / "lake")
    _load(spark, root, raw, dt.datetime(2025, 1, 1))
    silver_t = VersionedTable(spark, layer_path(root, "silver"))
    # Silver claims a Bronze version that does not exist (Bronze was reloaded)
    silver_t.overwrite(silver_t.read(), meta={"bronze_version": 10})
    flow.load_silver(spark, root)
    assert silver_t.commit_record()["meta"]["bronze_version"] == 0
    assert _content(silver_t.read()) == _content(_full(spark, root))


def test_widened_bronze_keeps_full_rebuild_column_order(spark, tmp_path):
    raw = raw_bars(spark, SF_SMALL)
    root = str(tmp_path / "lake")
    _load(spark, root, raw.where("date < date'1998-01-01'"), dt.datetime(2025, 1, 1))
    wider = raw.where("date >= date'1997-01-01'").withColumn("dividends", F.lit(0.25))
    _load(spark, root, wider, dt.datetime(2025, 1, 2))
    silver_t = VersionedTable(spark, layer_path(root, "silver"))
    assert silver_t.read().columns == _full(spark, root).columns
    assert silver_t.read().columns[-2:] == ["_silver_loaded_at", "_is_valid"]


def _fact_content(df):
    cols = [c for c in df.columns if c != "updated_at"]
    rows = [tuple(r) for r in df.select(*sorted(cols)).collect()]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def _full_fact(spark, root):
    from tickhouse.operators.indicators import fact_daily_performance, price_indicators
    from tickhouse.operators.staging import clean_staging

    bronze = VersionedTable(spark, layer_path(root, "bronze")).read()
    return fact_daily_performance(price_indicators(clean_staging(bronze)), updated_at=False)


def test_fact_extension_matches_full_recompute(spark, tmp_path, monkeypatch):
    taken = []
    real = flow._extend_fact

    def spy(*args, **kwargs):
        out = real(*args, **kwargs)
        taken.append(out)
        return out

    monkeypatch.setattr(flow, "_extend_fact", spy)
    raw = raw_bars(spark, SF_SMALL)
    root = str(tmp_path / "lake")
    t0 = dt.datetime(2025, 1, 1)
    fact_t = VersionedTable(spark, layer_path(root, "marts", "fact_daily_performance"))
    # yearly batches extend every symbol's history; the last one goes back
    batches = [raw.where(F.year("date") <= 1996)] + [
        raw.where(F.year("date") == y) for y in (1997, 1998, 1999)
    ] + [raw.where(F.year("date") == 1996)]
    for i, b in enumerate(batches):
        flow.load_bronze(spark, b, root, loaded_at=F.lit(t0 + dt.timedelta(days=i)),
                         source_file="t")
        flow.build_marts(spark, root, updated_at=False)
        assert _fact_content(fact_t.read()) == _fact_content(_full_fact(spark, root)), i
    # first build and the backdated batch recompute; the yearly ones extend
    assert taken == [False, True, True, True, False]
    assert [r["mode"] for r in fact_t.history().orderBy("version").collect()] == [
        "Overwrite", "Append", "Append", "Append", "Overwrite"]


def test_fact_extension_ignores_bronze_appended_meanwhile(spark, tmp_path, monkeypatch):
    raw = raw_bars(spark, SF_SMALL)
    root = str(tmp_path / "lake")
    t0 = dt.datetime(2025, 1, 1)
    fact_t = VersionedTable(spark, layer_path(root, "marts", "fact_daily_performance"))
    flow.load_bronze(spark, raw.where(F.year("date") <= 1996), root, loaded_at=F.lit(t0),
                     source_file="t")
    flow.build_marts(spark, root, updated_at=False)
    flow.load_bronze(spark, raw.where(F.year("date") == 1997), root,
                     loaded_at=F.lit(t0 + dt.timedelta(days=1)), source_file="t")
    real_refresh = flow.refresh_staging

    def refresh_then_concurrent_append(spark_, root_):
        version = real_refresh(spark_, root_)
        # another writer commits a Bronze version right after staging ran
        flow.load_bronze(spark_, raw.where(F.year("date") == 1998), root_,
                         loaded_at=F.lit(t0 + dt.timedelta(days=2)), source_file="t")
        return version

    monkeypatch.setattr(flow, "refresh_staging", refresh_then_concurrent_append)
    flow.build_marts(spark, root, updated_at=False)
    staged = VersionedTable(spark, layer_path(root, "staging", "latest_bars")).read()
    assert fact_t.read().count() == staged.count()  # nothing beyond what was staged
    monkeypatch.setattr(flow, "refresh_staging", real_refresh)
    flow.build_marts(spark, root, updated_at=False)
    got = fact_t.read()
    assert got.count() == got.select("symbol", "trade_date").distinct().count()
    assert _fact_content(got) == _fact_content(_full_fact(spark, root))


def test_fact_extension_recomputes_when_columns_change(spark, tmp_path):
    raw = raw_bars(spark, SF_SMALL)
    root = str(tmp_path / "lake")
    t0 = dt.datetime(2025, 1, 1)
    fact_t = VersionedTable(spark, layer_path(root, "marts", "fact_daily_performance"))
    flow.load_bronze(spark, raw.where(F.year("date") <= 1996), root, loaded_at=F.lit(t0),
                     source_file="t")
    flow.build_marts(spark, root, updated_at=False)
    flow.load_bronze(spark, raw.where(F.year("date") == 1997), root,
                     loaded_at=F.lit(t0 + dt.timedelta(days=1)), source_file="t")
    flow.build_marts(spark, root, updated_at=None)  # now stamped: new column
    got = fact_t.read()
    assert fact_t.commit_record()["mode"] == "Overwrite"
    assert got.where(F.col("updated_at").isNull()).count() == 0
    assert _fact_content(got) == _fact_content(_full_fact(spark, root))


def test_fact_extension_context_is_prelimited(spark, tmp_path, monkeypatch):
    """The context (last bars per symbol) is a top-k limited before its shuffle."""
    raw = raw_bars(spark, SF_SMALL)
    root = str(tmp_path / "lake")
    t0 = dt.datetime(2025, 1, 1)
    flow.load_bronze(spark, raw.where(F.year("date") <= 1997), root, loaded_at=F.lit(t0),
                     source_file="t")
    flow.build_marts(spark, root, updated_at=False)
    flow.load_bronze(spark, raw.where(F.year("date") > 1997), root,
                     loaded_at=F.lit(t0 + dt.timedelta(days=1)), source_file="t")
    plans = []
    real_append = VersionedTable.append

    def spy(self, df, **kwargs):
        if self.path.endswith("fact_daily_performance"):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real_append(self, df, **kwargs)

    monkeypatch.setattr(VersionedTable, "append", spy)
    flow.build_marts(spark, root, updated_at=False)
    assert len(plans) == 1
    assert "WindowGroupLimit" in plans[0] and "Partial" in plans[0]
