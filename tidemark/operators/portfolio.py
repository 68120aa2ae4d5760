"""Portfolios that revert fast for how much they move: prescreened, seeded, optimised and validated window by window.

Each step is a table keyed by the window. A basket's price rows are summed up once, to cross moments; seeds, the optimiser
and the checks work on these small matrices, so their cost does not hang on the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import cointegration, pairs
from . import windows as W

WORST = 1e6


@dataclass(frozen=True)
class Reversion:
    """Quadratic forms of a basket's detrended spread: its level before, the change, and both together; and the drift of each series."""

    rows: int
    level: np.ndarray
    change: np.ndarray
    both: np.ndarray
    drift: np.ndarray
    base: np.ndarray

    @staticmethod
    def of(parts: dict[int, np.ndarray]) -> Reversion:
        """From the moments of cointegration.stepped."""
        width = next(iter(parts.values())).shape[0]
        k, every, later = (width - 2) // 3, sum(parts.values()), sum((m for have, m in parts.items() if have >= 1), np.zeros((width, width)))
        n, mean_n = every[-1, -1], every[-2, -1] / every[-1, -1]
        variance = every[-2, -2] / n - mean_n**2
        mean_x = every[:k, -1] / n
        drift = (every[:k, -2] / n - mean_x * mean_n) / variance if variance > 0 else np.zeros(k)
        base = mean_x - drift * mean_n
        # Level before and change of each detrended series, as linear maps of v.
        lag, step = np.zeros((k, width)), np.zeros((k, width))
        lag[:, k : 2 * k], lag[:, -2], lag[:, -1] = np.eye(k), -drift, drift - base
        step[:, :k], step[:, k : 2 * k], step[:, -1] = np.eye(k), -np.eye(k), -drift
        count = max(later[-1, -1], 1.0)
        one = np.zeros(width)
        one[-1] = 1
        centred = lambda a, b: a @ later @ b.T / count - np.outer(a @ later @ one, b @ later @ one) / count**2
        return Reversion(int(n), centred(lag, lag), centred(step, step), centred(lag, step), drift, base)

    def fit(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Speed and deviation of the residuals of each row of weights, and the drift of its spread."""
        level = np.einsum("ni,ij,nj->n", w, self.level, w)
        both = np.einsum("ni,ij,nj->n", w, self.both, w)
        slope = both / np.where(level > 0, level, np.inf)
        residual = np.einsum("ni,ij,nj->n", w, self.change, w) - slope * both
        return -slope, np.sqrt(np.maximum(residual, 0)), w @ self.drift


def normalised(w: np.ndarray) -> np.ndarray:
    total = np.abs(w).sum(axis=-1, keepdims=True)
    return w / np.where(total > 0, total, 1)


def cost(own: Reversion, raw: np.ndarray, penalty: float) -> np.ndarray:
    """What the optimiser makes small: -speed / deviation, a charge for a falling spread and one on squared weights; WORST where nothing reverts."""
    w = normalised(raw)
    speed, deviation, drift = own.fit(w)
    sound = (speed > 0) & (deviation > 0) & (own.rows >= 50)
    return np.where(sound, -speed / np.where(sound, deviation, 1) + np.where(drift <= 0, 100 * np.abs(drift), 0) + penalty * (w**2).sum(axis=1), WORST)


def evolved(own: Reversion, seed: np.ndarray, most: float, penalty: float, rounds: int = 300, crowd: int = 25, tolerance: float = 1e-6, draw: int = 42) -> np.ndarray:
    """Weights by differential evolution within +-most, from a population that holds the seed; repeatable."""
    rng, k = np.random.default_rng(draw), len(seed)
    people = rng.uniform(-most, most, (crowd * k, k))
    people[0] = np.clip(normalised(np.clip(normalised(seed), -most, most)), -most, most)
    costs = cost(own, people, penalty)
    for _ in range(rounds):
        best = people[costs.argmin()]
        others = rng.integers(0, len(people), (2, len(people)))
        mutant = best + rng.uniform(0.5, 1.0) * (people[others[0]] - people[others[1]])
        crossed = rng.random(people.shape) < 0.7
        crossed[np.arange(len(people)), rng.integers(0, k, len(people))] = True
        trial = np.where(crossed, mutant, people)
        outside = np.abs(trial) > most
        trial[outside] = rng.uniform(-most, most, outside.sum())
        tried = cost(own, trial, penalty)
        better = tried <= costs
        people[better], costs[better] = trial[better], tried[better]
        if costs.std() <= tolerance * abs(costs.mean()):
            break
    return normalised(people[costs.argmin()])


def prescreened(prices: DataFrame, assets: int, lags: int = 1, least: int = 100) -> DataFrame:
    """window, symbols: the `assets` symbols whose pairs are cointegrated best on average (mean of -log p over pairs with `least` common rows).

    prices: window, t, symbol, close. Equal scores go by name.
    """
    own = prices.where("close > 0").select("window", "t", "symbol", F.log("close").alias("y"))
    other = own.select("window", "t", F.col("symbol").alias("other"), F.col("y").alias("x"))
    met = own.join(other, ["window", "t"]).where("symbol < other").select("window", F.concat_ws("\x1f", F.col("window").cast("string"), "symbol", "other").alias("pair"), "symbol", "other", "t", "x", "y")
    keys = met.groupBy("pair", "window", "symbol", "other").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= least)
    tests = cointegration.engle_granger(pairs.hedged(met.select("pair", "t", "x", "y")), ["pair"], lags, choose=False)
    scored = keys.join(tests.select("pair", (-F.log(F.greatest("p", F.lit(1e-10)))).alias("score")), "pair")
    sides = scored.select("window", "symbol", "score").union(scored.select("window", "other", "score"))
    means = own.select("window", "symbol").distinct().join(sides.groupBy("window", "symbol").agg(F.avg("score").alias("score")), ["window", "symbol"], "left")
    order = Window.partitionBy("window").orderBy(F.desc(F.coalesce("score", F.lit(0.0))), "symbol")
    best = means.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= assets)
    return best.groupBy("window").agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", "symbol"))), lambda s: s["symbol"]).alias("symbols"))


def built(prices: DataFrame, assets: int = 8, most: float = 0.25, penalty: float = 0.1, optimise: bool = True, longest: float = 500.0, seeds: int = 3, rounds: int = 300) -> DataFrame:
    """window, symbols, weights, speed, deviation, half_life, drift, base, score, n: the best valid portfolio of each window.

    prices: window, t, symbol, close. For each of the first cointegrating vectors, weights are optimised (or taken as they are); valid
    ones revert, within `longest` rows to a half. The best has the greatest speed / deviation, half as much again with a rising spread.
    """
    baskets = prescreened(prices, assets)

    def solve(parts: dict[int, np.ndarray]) -> tuple | None:
        every = sum(parts.values())
        found = cointegration.johansen(parts)
        if found is None or every[-1, -1] < 100:
            return None
        own, best = Reversion.of(parts), None
        for seed in found[2].T[:seeds]:
            w = evolved(own, seed, most, penalty, rounds) if optimise else seed
            speed, deviation, drift = (float(x[0]) for x in own.fit(w[None]))
            if speed <= 0 or np.log(2) / speed > longest:
                continue
            score = (speed / deviation if deviation > 0 else 0.0) * (1.5 if drift > 0 else 1.0)
            if best is None or score > best[0]:
                best = (score, w, speed, deviation, drift)
        if best is None:
            return None
        score, w, speed, deviation, drift = best
        return w.tolist(), speed, deviation, float(np.log(2) / speed), drift, float(w @ own.base), score, own.rows

    rows = cointegration.stepped(cointegration.basket_rows(prices, baskets, ["window"]), ["window"])
    fits = cointegration.solved(cointegration.moments(rows, ["window"]), ["window"], "weights array<double>, speed double, deviation double, half_life double, drift double, base double, score double, n long", solve)
    return fits.join(baskets, "window").select("window", "symbols", *fits.columns[1:])


def scorecard(days: DataFrame, by: str = "pair", most: float = 3.0, least_good: int = 0, of_last: int = 0) -> DataFrame:
    """by, window, sharpe, good, weight, trades from daily gains (by, window, day, gain).

    sharpe is the window's own, not scaled to a year (the sum, if it has one day). weight and trades hold for the window but come from the
    windows before it alone: the Sharpe ratio of the last one between 0 and `most` (1 in the first window), and whether
    `least_good` of the `of_last` before were good (always, if switched off or in the first window).
    """
    one = F.count("gain") > 1
    sharpe = F.when(one, F.coalesce(W.ratio(F.avg("gain"), F.stddev_samp("gain")), F.lit(0.0))).otherwise(F.coalesce(F.sum("gain"), F.lit(0.0)))
    scores = days.groupBy(by, "window").agg(sharpe.alias("sharpe")).withColumn("good", F.col("sharpe") > 0)
    w = W.series(by, order="window")
    before = F.lag("sharpe").over(w)
    weight = F.when(before.isNull(), 1.0).otherwise(F.least(F.greatest(before, F.lit(0.0)), F.lit(most)))
    if least_good <= 0 or of_last <= 0:
        trades = F.lit(True)
    else:
        trades = before.isNull() | (F.sum(F.col("good").cast("int")).over(w.rowsBetween(-of_last, -1)) >= least_good)
    return scores.select("*", weight.alias("weight"), trades.alias("trades"))
