"""Every registered query equals its DuckDB oracle (sf0.001, strict).

Same comparison as ``tools/check_oracle.py``: row multisets after
normalising each value to text, and column types mapped to DuckDB's.
"""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

from bars import SF_SMALL
from tickhouse.plans.catalog import ORACLE_SQL, QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from check_oracle import TABLES, rows_of, spark_type  # noqa: E402

SQL = ORACLE_SQL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = Path(SF_SMALL) / f"{t}.parquet"
        if p.exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    d_names = [d[0] for d in cur.description]
    d_types = {d[0]: str(d[1]).replace(" ", "") for d in cur.description}
    d_rows = cur.fetchall()
    s_types = {f.name: spark_type(f.dataType.simpleString()).replace(" ", "")
               for f in df.schema.fields}
    assert s_types == d_types
    s_c, s_cols = rows_of(df.columns, s_rows)
    d_c, d_cols = rows_of(d_names, d_rows)
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_c == d_c


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)
