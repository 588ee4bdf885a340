"""The ingest job: landed response files to raw bars, rejects and a report."""

from __future__ import annotations

import json

from tickhouse.plans.ingest import REJECTS_DIR, ingest_responses
from tickhouse.schemas import RESPONSE_FIELDS, RESPONSE_SERIES_KEY
from tickhouse.sources.files import read_raw
from tickhouse.sources.responses import read_landed_responses


def document(closes):
    names = list(RESPONSE_FIELDS.values())
    series = {d: dict(zip(names, ("2.5", "4", "1.25", c, "70"), strict=True)) for d, c in closes.items()}
    return json.dumps({RESPONSE_SERIES_KEY: series})


def land(root, symbol, *bodies):
    folder = root / f"symbol={symbol}"
    folder.mkdir(parents=True)
    for i, body in enumerate(bodies):
        (folder / f"{i}.json").write_text(body)


def test_files_to_raw_layer(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "raw")
    land(landing, "KOPA", document({"2024-05-01": "3.5", "2024-05-02": "3.75"}))
    land(landing, "007", document({"2024-05-01": "1.5"}), document({"2024-05-02": "1.5", "2024-05-03": "x"}))
    land(landing, "MURR", '{"Note": "too many requests"}', document({}))
    land(landing, "LIND", '{"cut off')
    responses = read_landed_responses(spark, str(landing))
    report = ingest_responses(spark, responses, root)
    assert report == {
        "status": "completed", "responses": 6, "accepted": 2, "rejected": 2, "silent": 2, "bars": 3,
    }
    bars = {(r.symbol, str(r.date), r.close) for r in read_raw(spark, root).collect()}
    assert bars == {("KOPA", "2024-05-01", 3.5), ("KOPA", "2024-05-02", 3.75), ("007", "2024-05-01", 1.5)}

    def kept():
        rows = spark.read.schema("symbol string, reason string, bad_entries int").parquet(
            f"{root}/{REJECTS_DIR}"
        )
        return [tuple(r) for r in rows.select("symbol", "reason", "bad_entries").collect()]

    assert set(kept()) == {("007", "bad_field", 1), ("LIND", "malformed_json", 0)}
    # a rerun replaces the day's folders and adds nothing
    assert ingest_responses(spark, responses, root) == report
    assert read_raw(spark, root).count() == 3 and len(kept()) == 2


def test_nothing_acceptable(spark, tmp_path):
    empty = spark.createDataFrame([], "symbol string, body string, ingested_at timestamp")
    report = ingest_responses(spark, empty, str(tmp_path / "raw"))
    assert report == {"status": "no_data", "responses": 0, "accepted": 0, "rejected": 0, "silent": 0, "bars": 0}
    assert not (tmp_path / "raw").exists()
