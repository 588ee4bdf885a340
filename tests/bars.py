"""Bars and helpers that several test modules share."""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

#: Three invented symbols over six trading days; the days lie in two weeks.
BARS_CSV = """symbol,date,open,high,low,close,volume
KOPA,2023-03-02,12.40,12.95,12.10,12.80,410
KOPA,2023-03-03,12.75,13.60,12.75,13.25,655
KOPA,2023-03-06,13.30,13.30,11.90,12.05,1980
KOPA,2023-03-07,12.00,12.45,11.65,12.45,720
KOPA,2023-03-08,12.60,12.60,12.05,12.45,305
KOPA,2023-03-09,12.20,14.10,12.20,13.90,2440
LIND,2023-03-02,871.00,880.50,842.25,846.75,93
LIND,2023-03-03,846.75,859.00,838.00,858.50,71
LIND,2023-03-06,861.25,903.75,860.00,902.00,188
LIND,2023-03-07,899.50,910.00,887.75,890.25,64
LIND,2023-03-08,888.00,894.50,871.00,873.75,80
LIND,2023-03-09,874.00,874.00,861.50,866.00,59
MURR,2023-03-02,3.1416,3.2500,3.0025,3.2125,7200000
MURR,2023-03-03,3.2125,3.2125,3.1040,3.1200,5150000
MURR,2023-03-06,3.1100,3.1875,3.0950,3.1875,4875000
MURR,2023-03-07,3.1900,3.4450,3.1900,3.4010,15200000
MURR,2023-03-08,3.4000,3.4000,3.2275,3.2600,8830000
MURR,2023-03-09,3.2600,3.3315,3.2500,3.3300,6015000
"""
SYMBOLS = {"KOPA", "LIND", "MURR"}
N_BARS = 18


def rows_by(df, *keys):
    """Collect a small result as dicts keyed by ``keys``."""
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}
