"""The daily run on month folders: a load costs the months it touches.

Bronze, Silver, Gold, the checks and the marts are brought up to date after new
bars.  Which months are due is noted in a folder before Bronze is written and
struck out once Silver, Gold, checks and staging have them, and changed staging
keys wait for the marts in the same way.  So a run that broke off anywhere is
taken up by the next one, also when nothing new has landed.

Checks and Gold are kept as one row of measures per month (and symbol): their
reports read these rows, not Silver.  Checks only report; they never stop Gold.
A failure of the marts is reported in the summary and made good by the next
run.  One run at a time works on a root folder.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.operators.quality import dq_summary_dict
from tickhouse.plans.monthly import MonthLayers
from tickhouse.sources.months import months_in

log = logging.getLogger(__name__)

NO_DATA = {"status": "no_data", "symbols_processed": 0}


def _size(rows: DataFrame) -> tuple[int, int]:
    """Rows and symbols, by one aggregation."""
    n, symbols = rows.agg(F.count(F.lit(1)), F.count_distinct("symbol")).first()
    return n, symbols


def run_daily(
    layers: MonthLayers,
    raw: DataFrame | None,
    symbols: list[str] | None = None,
    run_models: bool = True,
    today: dt.date | None = None,
    loaded_at=None,
    source_file=None,
) -> dict:
    """Load ``raw`` (None: nothing new), refresh what is due, return the run summary.

    ``symbols`` keeps those of the input (upper-cased).  With neither new rows
    nor anything left over from earlier runs the status is ``no_data``.
    """
    rows = processed = 0
    if raw is not None:
        if symbols:
            raw = raw.where(F.col("symbol").isin([s.upper() for s in symbols]))
        rows, processed = _size(raw)
    if rows:
        layers.note(months_in(raw))
        layers.load_bars(raw, loaded_at=loaded_at, source_file=source_file)
    months, notes = layers.noted()
    if not months and not (run_models and layers.waiting()):
        return dict(NO_DATA)
    if not rows and layers.bronze.exists():
        rows, processed = _size(layers.bronze.read(months or None))
    if not rows:  # a note whose load never came about
        layers.strike(notes)
        return dict(NO_DATA)

    if months:
        layers.refresh_layers(months, loaded_at)
        layers.strike(notes)
    checks = dq_summary_dict(layers.checks_report(today))

    models_status, models_error = "skipped", None
    if run_models:
        try:
            layers.refresh_marts(updated_at=False if loaded_at is None else loaded_at)
            models_status = "success"
        except Exception as error:  # noqa: BLE001 - reported in the summary
            log.exception("refreshing the marts failed")
            models_status, models_error = "failed", f"{type(error).__name__}: {error}"

    summary = {
        "status": "completed",
        "symbols_processed": int(processed),
        "total_symbols": len(symbols) if symbols else int(processed),
        "dq_summary": checks,
        "models_status": models_status,
    }
    return summary | ({"models_error": models_error} if models_error else {})
