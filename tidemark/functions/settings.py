"""Settings of rolling cutoffs, checked on the driver before anything runs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bars as B
from ..operators.predicates import CUTOFFS

#: The keys of a settings file, the two modes, and the window that holds where none is set (30 days of 5 seconds).
MODE, BARS, LEVELS = "REGIME_ATOM_MODE", "REGIME_ATOM_QUANTILE_WINDOW_BARS", "REGIME_ATOM_QUANTILE_LEVELS"
FIXED, ROLLING, DEFAULT_BARS = "fixed", "rolling_quantile", 518_400


@dataclass(frozen=True)
class RollingCutoffs:
    window_bars: int
    levels: dict[str, tuple[float, ...]]


def rolling_cutoffs(settings: Mapping, family: str = "tick") -> RollingCutoffs | None:
    """None for fixed cutoffs. Unknown modes, columns and levels raise, and so do keys that the mode would leave unused."""
    mode = settings.get(MODE, FIXED)
    if mode == FIXED:
        unused = [k for k in (BARS, LEVELS) if k in settings]
        if unused:
            raise ValueError(f"{', '.join(unused)} without {MODE}={ROLLING!r}")
        return None
    if mode != ROLLING:
        raise ValueError(f"{MODE} is {FIXED!r} or {ROLLING!r}, not {mode!r}")
    n = settings.get(BARS, DEFAULT_BARS)
    if isinstance(n, bool) or not isinstance(n, int) or n <= 0:
        raise ValueError(f"{BARS} is a whole number above 0, not {n!r}")
    levels, own = dict(CUTOFFS[family]), settings.get(LEVELS, {})
    if not isinstance(own, Mapping):
        raise ValueError(f"{LEVELS} maps columns to levels")
    for column, level in own.items():
        if column not in levels:
            raise ValueError(f"{LEVELS}: {column!r} has no cutoff; those that have: {sorted(levels)}")
        if isinstance(level, bool) or not isinstance(level, (int, float)) or not 0 < level < 1:
            raise ValueError(f"{LEVELS}[{column!r}] lies between 0 and 1, not {level!r}")
        levels[column] = (float(level),)
    return RollingCutoffs(n, levels)


def window_days(bars: DataFrame, window_bars: int) -> dict[str, int]:
    """For each series (a row each on the driver) the whole days that so many bars span, by their median distance.

    Series of one time, times that are missing, and windows that round to less than a day raise: cutoffs hold for whole days.
    """
    if not bars.where(F.col("t").isNull()).isEmpty():
        raise ValueError("bars without a time")
    found = {r["symbol"]: r["spacing"] for r in bars.select("symbol").distinct().join(B.spacing(bars), "symbol", "left").collect()}
    lone = sorted(s for s, v in found.items() if v is None)
    if not found or lone:
        raise ValueError(f"the distance of bars needs two different times: {lone or 'no bars'}")
    days = {s: round(window_bars * v / B.DAY) for s, v in found.items()}
    short = sorted(s for s, d in days.items() if d < 1)
    if short:
        raise ValueError(f"{window_bars} bars are less than a day of {short}")
    return days
