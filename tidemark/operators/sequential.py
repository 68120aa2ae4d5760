"""Recurrences that no window expresses: one sorted pandas group for each series, dealt by Spark.

A group is one series (a symbol, or a symbol within one walk-forward window), whose rows depend on all rows before.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import windows as W


def _per_series(rows: DataFrame, added: list[str], run, by: tuple[str, ...] = ("symbol",), order: str = "t") -> DataFrame:
    schema = T.StructType([*rows.schema.fields, *[T.StructField(a, T.DoubleType()) for a in added]])
    return rows.groupBy(*by).applyInPandas(lambda g: run(g.sort_values(order, kind="stable").reset_index(drop=True)), schema)


def smoothed(x: np.ndarray, n: int, share: float) -> np.ndarray:
    """Seeded with the mean of the first n known values, then s += share (x - s)."""
    out, known = np.full(len(x), np.nan), np.flatnonzero(~np.isnan(x))
    if len(known) < n:
        return out
    s = x[known[:n]].mean()
    out[known[n - 1]] = s
    for i in known[n:]:
        s += share * (x[i] - s)
        out[i] = s
    return out


def ema(x: np.ndarray, n: int) -> np.ndarray:
    return smoothed(x, n, 2 / (n + 1))


def wilder(x: np.ndarray, n: int) -> np.ndarray:
    return smoothed(x, n, 1 / n)


def recursive_indicators(bars: DataFrame) -> DataFrame:
    """exponential averages, MACD, relative strength, average true range and directional movement."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        high, low, close = (g[c].to_numpy(float) for c in ("high", "low", "close"))
        step = np.diff(close, prepend=np.nan)
        with np.errstate(divide="ignore", invalid="ignore"):
            up, down = wilder(np.where(np.isnan(step), np.nan, np.maximum(step, 0)), 14), wilder(np.where(np.isnan(step), np.nan, np.maximum(-step, 0)), 14)
            before = np.concatenate(([np.nan], close[:-1]))
            true = np.where(np.isnan(before), np.nan, np.maximum(high, before) - np.minimum(low, before))
            atr = wilder(true, 14)
            rise, fall = np.diff(high, prepend=np.nan), -np.diff(low, prepend=np.nan)
            plus = wilder(np.where(np.isnan(rise), np.nan, np.where((rise > fall) & (rise > 0), rise, 0.0)), 14)
            minus = wilder(np.where(np.isnan(fall), np.nan, np.where((fall > rise) & (fall > 0), fall, 0.0)), 14)
            macd = ema(close, 12) - ema(close, 26)
            signal = ema(macd, 9)
            dx = 100 * np.abs(plus - minus) / (plus + minus)
        found = {"ema_12": ema(close, 12), "macd": macd, "macd_signal": signal, "rsi": 100 * up / (up + down), "atr": atr, "adx": wilder(dx, 14)}
        return g.assign(**{k: np.where(np.isfinite(v), v, np.nan) for k, v in found.items()})

    return _per_series(bars, ["ema_12", "macd", "macd_signal", "rsi", "atr", "adx"], run)


def parabolic_stop(bars: DataFrame, step: float = 0.02, most: float = 0.2) -> DataFrame:
    """A stop that trails the extreme of the trend and speeds up with it; it turns when touched."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        high, low = g["high"].to_numpy(float), g["low"].to_numpy(float)
        out = np.full(len(g), np.nan)
        if len(g) > 1:
            rising = high[1] + low[1] >= high[0] + low[0]
            stop, far, speed = (low[0], high[1], step) if rising else (high[0], low[1], step)
            for i in range(1, len(g)):
                out[i] = stop
                if (low[i] <= stop) if rising else (high[i] >= stop):
                    rising, stop, far, speed = not rising, far, (low[i] if rising else high[i]), step
                    continue
                if (high[i] > far) if rising else (low[i] < far):
                    far, speed = (high[i] if rising else low[i]), min(most, speed + step)
                stop += speed * (far - stop)
                stop = min(stop, low[i], low[i - 1]) if rising else max(stop, high[i], high[i - 1])
        return g.assign(stop=out)

    return _per_series(bars, ["stop"], run)


def exponential(rows: DataFrame, column: str, spans: tuple[int, ...], by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """<column>_ewm<span>: s += 2 / (span + 1) (x - s), from the first value on; null values are passed over."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        x = g[column].to_numpy(float)
        return g.assign(**{f"{column}_ewm{n}": smoothed(x, 1, 2 / (n + 1)) for n in spans})

    return _per_series(rows, [f"{column}_ewm{n}" for n in spans], run, by)


def more_recursive(bars: DataFrame) -> DataFrame:
    """Relative strength of 7 and 28 rows, chande momentum, true ranges of 10, 14 and 60 rows, directional indices, triple exponential change, stochastic strength."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        high, low, close = (g[c].to_numpy(float) for c in ("high", "low", "close"))
        step = np.diff(close, prepend=np.nan)
        gains, losses = np.maximum(step, 0), np.maximum(-step, 0)
        before = np.concatenate(([np.nan], close[:-1]))
        true = np.maximum(high, before) - np.minimum(low, before)
        rise, fall = np.diff(high, prepend=np.nan), -np.diff(low, prepend=np.nan)
        up = np.where(np.isnan(rise), np.nan, np.where((rise > fall) & (rise > 0), rise, 0.0))
        down = np.where(np.isnan(fall), np.nan, np.where((fall > rise) & (fall > 0), fall, 0.0))
        triple = ema(ema(ema(close, 30), 30), 30)
        with np.errstate(divide="ignore", invalid="ignore"):
            strength = {n: 100 * wilder(gains, n) / (wilder(gains, n) + wilder(losses, n)) for n in (7, 14, 28)}
            atr = {n: wilder(true, n) for n in (10, 14, 60)}
            plus, minus = 100 * wilder(up, 14) / atr[14], 100 * wilder(down, 14) / atr[14]
            series = pd.Series(strength[14])
            least, most = series.rolling(5).min(), series.rolling(5).max()
            found = {
                "rsi_7": strength[7], "rsi_28": strength[28], "cmo": 2 * strength[14] - 100, "atr_10": atr[10], "atr_60": atr[60], "natr": 100 * atr[14] / close, "plus_di": plus, "minus_di": minus,
                "dx": 100 * np.abs(plus - minus) / (plus + minus), "trix": 100 * (triple / np.concatenate(([np.nan], triple[:-1])) - 1), "stochrsi_k": (100 * (series - least) / (most - least)).to_numpy(),
            }
        found["stochrsi_d"] = pd.Series(found["stochrsi_k"]).rolling(3).mean().to_numpy()
        return g.assign(**{k: np.where(np.isfinite(v), v, np.nan) for k, v in found.items()})

    return _per_series(bars, ["rsi_7", "rsi_28", "cmo", "atr_10", "atr_60", "natr", "plus_di", "minus_di", "dx", "trix", "stochrsi_k", "stochrsi_d"], run)


def rolling_quantile(rows: DataFrame, column: str, quantiles: tuple[float, ...], n: int, least: int, block: int = 20_000) -> DataFrame:
    """Interpolated quantiles of long frames; a sliding window expression sorts each frame anew.

    A series is dealt in blocks of rows, each with the n - 1 rows before it, so that a long one is no single task.
    """
    numbered = W.numbered(rows)
    own = F.floor(F.col("__n") / block)
    reach = F.floor((F.col("__n") + n - 1) / block)
    dealt = numbered.withColumn("__block", F.explode(F.sequence(own, reach)))
    names = [f"{column}_q{round(q * 100)}" for q in quantiles]

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("__n", kind="stable").reset_index(drop=True)
        over = g[column].astype(float).rolling(n, min_periods=least)
        found = g.assign(**{name: over.quantile(q) for name, q in zip(names, quantiles, strict=True)})
        return found[g["__n"] // block == g["__block"]].drop(columns=["__n", "__block"])

    schema = T.StructType([*rows.schema.fields, *[T.StructField(a, T.DoubleType()) for a in names]])
    return dealt.groupBy("symbol", "__block").applyInPandas(run, schema)


def positions_by_score(rows: DataFrame, score: str = "z", enter: float = 2.0, leave: float = 0.5, stop: float = 0.0, longest: int = 0, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """-1, 0 or 1: against a score beyond enter, until it is within leave, beyond stop, or held for more than `longest` rows.

    A position opens only from 0 and is never turned at once. The row that opens counts as held, and so do rows without
    a score, on which nothing changes. stop or longest of 0: no such rule.
    """

    def run(g: pd.DataFrame) -> pd.DataFrame:
        held, age, out = 0, 0, []
        for z in g[score].to_numpy(float):
            if held:
                age += 1
                if abs(z) < leave or (stop and abs(z) > stop) or (longest and age > longest and not np.isnan(z)):
                    held = 0
            elif abs(z) > enter:
                held, age = (-1 if z > 0 else 1), 1
            out.append(float(held))
        return g.assign(position=out)

    return _per_series(rows, ["position"], run, by)


def laddered_positions(rows: DataFrame, score: str = "z", enter: float = 2.0, leave: float = 0.5, stop: float = 0.0, longest: int = 0, rungs: int = 5, step: float = 0.5, steep: bool = False, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Positions of -1 to 1 that grow by a rung with every step of the score beyond enter; steep: rung k adds k units.

    Leaves as `positions_by_score` does; the row that opens counts as two rows held, as it is both opened and held.
    Rows without a score keep the position.
    """

    def run(g: pd.DataFrame) -> pd.DataFrame:
        side, age, now, out = 0, 0, 0.0, []
        for z in g[score].to_numpy(float):
            if np.isnan(z):
                age += side != 0
                out.append(now)
                continue
            if not side and abs(z) > enter:
                side, age = (-1 if z > 0 else 1), 1
            if side:
                age += 1
                if abs(z) < leave or (stop and abs(z) > stop) or (longest and age > longest):
                    side, age = 0, 0
            filled = int(sum(abs(z) > enter + k * step for k in range(rungs)))
            now = side * (filled * (filled + 1) / (rungs * (rungs + 1)) if steep else filled / rungs)
            out.append(now)
        return g.assign(position=np.array(out, float))

    return _per_series(rows, ["position"], run, by)


def positions_by_break(rows: DataFrame, threshold: float = 0.2, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """From correlation, baseline and z: in against z when the correlation falls below its baseline by the threshold, out when it is back."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        held, out = 0, []
        for c, b, z in zip(*(g[x].to_numpy(float) for x in ("correlation", "baseline", "z")), strict=True):
            if not (np.isnan(c) or np.isnan(b) or np.isnan(z)):
                if held and c >= b:
                    held = 0
                elif not held and c < b - threshold:
                    held = -int(np.sign(z))
            out.append(float(held))
        return g.assign(position=out)

    return _per_series(rows, ["position"], run, by)


def kalman_hedge(rows: DataFrame, drift: float = 1e-4, noise: float = 1e-3, by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """The slope of y on x as a random walk; each row's estimate uses rows before it only."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        slope, var, out = 0.0, 1.0, []
        for x, y in zip(g["x"].to_numpy(float), g["y"].to_numpy(float), strict=True):
            out.append(slope)
            if np.isnan(x) or np.isnan(y):
                continue
            var += drift
            gain = var * x / (x * x * var + noise)
            slope, var = slope + gain * (y - slope * x), var * (1 - gain * x)
        return g.assign(hedge=out)

    return _per_series(rows, ["hedge"], run, by)
