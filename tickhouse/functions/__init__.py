"""Column-level helpers shared by the operators."""

from tickhouse.functions.columns import (
    as_ticks,
    exact_mean,
    ratio_pct,
    safe_divide,
)

__all__ = ["as_ticks", "exact_mean", "ratio_pct", "safe_divide"]
