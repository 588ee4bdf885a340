"""Scalar and aggregate Column builders.

All of these are ordinary Spark expressions, so they stay inside
whole-stage code generation; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator``, or NULL when the denominator is NULL or 0.

    CASE evaluates only the chosen branch, so the division never sees a
    zero even with ANSI mode on.
    """
    n, d = _col(numerator), _col(denominator)
    return F.when(d.isNull() | (d == 0), F.lit(None)).otherwise(n / d)


def ratio_pct(new: Column | str, base: Column | str, digits: int = 4) -> Column:
    """``round((new - base) / base * 100, digits)`` as a double.

    The difference is taken exactly in the operands' (decimal) type and
    only then converted to double, which is the order a SQL engine
    applies to ``decimal - decimal`` followed by ``/``.
    """
    n, b = _col(new), _col(base)
    return F.round((n - b).cast("double") / b.cast("double") * 100, digits)


def as_ticks(c: Column | str, scale: int = 4) -> Column:
    """Exact integer count of ``10**-scale`` units in a value with at most
    ``scale`` decimals (a price of 154.3 is 1543000 ticks at scale 4).

    The value goes through ``decimal(20, scale)`` so a double is read by
    its shortest decimal form; ANSI mode raises on overflow (values from
    about 9.2e14 at scale 4) instead of wrapping.
    """
    exact = _col(c).cast(T.DecimalType(20, scale))
    return (exact * F.lit(10**scale)).cast("bigint")


def exact_mean(
    c: Column | str,
    digits: int,
    window: WindowSpec | None = None,
    scale: int = 4,
) -> Column:
    """Mean rounded half-up to ``digits``, computed without binary error.

    Values are summed as integer ticks (prices carry four decimals,
    volumes none), so frame and group sums stay on 64-bit integer
    arithmetic; the tick sum is divided by the non-null count as an exact
    decimal, rounded half-up, and scaled back to a double.  A double mean
    would make the last digit depend on summation order, i.e. on the
    partitioning.  NULLs are ignored; an all-NULL input gives NULL.
    """
    ticks = as_ticks(c, scale)
    total = F.sum(ticks)
    count = F.count(ticks)
    if window is not None:
        total, count = total.over(window), count.over(window)
    # decimal(20,0) / bigint keeps 18 decimals: no false half-way ties
    mean_ticks = F.round(total.cast(T.DecimalType(20, 0)) / F.nullif(count, F.lit(0)),
                         digits - scale)
    return mean_ticks.cast("double") / F.lit(float(10**scale))
