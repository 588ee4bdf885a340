"""Responses of many dates and CSV files with bad lines, against plain Python."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from bars import BARS_CSV, N_BARS, SF_SMALL
from tickhouse.schemas import RESPONSE_SERIES_KEY
from tickhouse.sources.adapter import raw_bars
from tickhouse.sources.files import read_prices_csv_checked
from tickhouse.sources.responses import parse_daily_responses, response_documents

SCHEMA = (
    "symbol string, date date, open double, high double, low double, close double, "
    "volume bigint, ingested_at timestamp"
)
T0 = dt.datetime(2025, 1, 1)


def bar(symbol, day, close, second):
    date = None if day is None else dt.date(2024, 3, 1) + dt.timedelta(days=day)
    return (symbol, date, 1.5, 9.0, 0.5, close, 7, T0 + dt.timedelta(seconds=second))


def parsed(frame, seconds):
    bars, rejects = parse_daily_responses(response_documents(frame, seconds), ingested_at="ingested_at")
    return bars, rejects


def test_one_bad_date_rejects_its_response_only(spark):
    frame = spark.createDataFrame(
        [bar("A", 0, 3.0, 0), bar("A", 1, None, 1), bar("A", 2, 3.5, 2),  # bad: none is kept
         bar("A", 0, 4.0, 60), bar("A", 3, 4.5, 61),                       # the next block is good
         bar("B", 0, None, 5), bar("B", 0, 5.0, 6),   # the bad entry is replaced: good
         bar("C", 0, 6.0, 5), bar("C", 0, None, 6),   # the good entry is replaced: bad
         bar("D", None, 7.0, 0)],
        SCHEMA,
    )
    bars, rejects = parsed(frame, 60)
    got = sorted((r.symbol, r.date.day, r.close, r.ingested_at.second) for r in bars.collect())
    assert got == [("A", 1, 4.0, 1), ("A", 4, 4.5, 1), ("B", 1, 5.0, 6)]
    bad = sorted((r.symbol, r.reason, r.bad_entries, r.ingested_at.second) for r in rejects.collect())
    assert bad == [("A", "bad_field", 1, 2), ("C", "bad_field", 1, 6), ("D", "bad_field", 1, 0)]


def test_documents_are_what_a_json_reader_reads(spark):
    """Every document parsed with the json module gives the rows and rejects."""
    seconds = 250
    documents = response_documents(raw_bars(spark, SF_SMALL), seconds).collect()
    assert max(len(json.loads(d.body)[RESPONSE_SERIES_KEY]) for d in documents) > 20
    rows, rejects = set(), set()
    for d in documents:
        series = json.loads(d.body)[RESPONSE_SERIES_KEY]
        bad = sum(None in (e.get(k) for k in ("1. open", "4. close", "5. volume")) for e in series.values())
        if bad:
            rejects.add((d.symbol, d.ingested_at, bad))
        else:
            rows |= {(d.symbol, date, float(e["4. close"]), d.ingested_at) for date, e in series.items()}
    got, refused = parsed(raw_bars(spark, SF_SMALL), seconds)
    assert {(r.symbol, str(r.date), r.close, r.ingested_at) for r in got.collect()} == rows
    assert {(r.symbol, r.ingested_at, r.bad_entries) for r in refused.collect()} == rejects
    assert rows and rejects


def test_no_bars_no_documents(spark):
    bars, rejects = parsed(spark.createDataFrame([], SCHEMA), 60)
    assert bars.count() == 0 and rejects.count() == 0


BAD_LINES = [
    ("KOPA,2023-03-10,1.0,2.0,0.5", "field_count"),
    ("KOPA,2023-03-10,1.0,2.0,0.5,1.5,10,more", "field_count"),
    ("KOPA,yesterday,1.0,2.0,0.5,1.5,10", "bad_date"),
    ("KOPA,2023-03-10,1.0,high,0.5,1.5,10", "bad_high"),
    ("KOPA,2023-03-10,1.0,2.0,0.5,1.5,1e3x", "bad_volume"),
    ("KOPA,2023-03-10,one,2.0,low,1.5,10", "bad_open"),
]


def test_bad_lines_are_kept_apart(spark, tmp_path):
    head, *good = BARS_CSV.splitlines()
    lines = [head, *good[:4], *(line for line, _ in BAD_LINES), "", *good[4:], BAD_LINES[0][0],
             "EMPT,2023-03-10,,,,,"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text(head + "\n")
    bars, rejects = read_prices_csv_checked(spark, str(tmp_path))
    rows = bars.collect()
    assert len(rows) == N_BARS + 1
    assert [tuple(r)[2:] for r in rows if r.symbol == "EMPT"] == [(None,) * 6]
    assert sorted((r.line, r.reason) for r in rejects.collect()) == sorted([*BAD_LINES, BAD_LINES[0]])
    assert {r.source_file.rsplit("/", 1)[1] for r in rejects.collect()} == {"a.csv"}


def test_a_pruned_column_still_rejects_its_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text(BARS_CSV + BAD_LINES[3][0] + "\n")
    bars, rejects = read_prices_csv_checked(spark, str(tmp_path))
    assert bars.count() == N_BARS
    assert bars.select("symbol").where(F.col("symbol") == "KOPA").count() == 6
    assert [r.reason for r in rejects.select("reason").collect()] == ["bad_high"]
