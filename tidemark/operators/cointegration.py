"""Tests for unit roots and cointegration, from grouped cross moments.

A regression needs no rows in one place, only the sums of products of its columns. Rows become short vectors, Spark adds
up their products by group (a pair, a basket, a window), and what meets in a task is one small matrix a group. The first rows
of a series lack some lags; they are added up apart by the number of lags they have, so that one pass serves each lag
order on just the rows that have it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import windows as W

# MacKinnon's (1994) response surfaces for the Dickey-Fuller t value with a constant, by number of series: the
# value below which the first polynomial holds and above which the second one does, the least and greatest value of all,
# and the polynomials in tau whose normal probability is p.
TAU_STAR = [-1.61, -2.62, -3.13, -3.47, -3.78, -3.93]
TAU_MIN = [-18.83, -18.86, -23.48, -28.07, -25.96, -23.27]
TAU_MAX = [2.74, 0.92, 0.55, 0.61, 0.79, 1.0]
TAU_SMALL = [
    [2.1659, 1.4412, 0.038269], [2.92, 1.5012, 0.039796], [3.4699, 1.4856, 0.03164],
    [3.9673, 1.4777, 0.026315], [4.5509, 1.5338, 0.029545], [5.1399, 1.6036, 0.034445],
]
TAU_LARGE = [
    [1.7339, 0.93202, -0.12745, -0.010368], [2.1945, 0.64695, -0.29198, -0.042377], [2.5893, 0.45168, -0.36529, -0.050074],
    [3.0387, 0.45452, -0.33666, -0.041921], [3.5049, 0.52098, -0.29158, -0.033468], [3.9489, 0.58933, -0.25359, -0.02721],
]
# 95 % points of Johansen's trace statistic with a constant, by number of series less rank.
TRACE_95 = [3.8415, 15.4943, 29.7961, 47.8545, 69.8189, 95.7542, 125.6185, 159.5290]


def p_value(tau: float, series: int = 1) -> float:
    if tau > TAU_MAX[series - 1]:
        return 1.0
    if tau < TAU_MIN[series - 1]:
        return 0.0
    of = TAU_SMALL if tau <= TAU_STAR[series - 1] else TAU_LARGE
    z = sum(c * tau**i for i, c in enumerate(of[series - 1]))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def moments(rows: DataFrame, by: list[str], vector: str = "v", part: str = "available") -> DataFrame:
    """by, cells (part, i, j, s): the sums of products of the vector's entries i <= j, for each part of the group's rows."""
    cells = rows.select(*by, part, vector, F.posexplode(vector).alias("i", "x"))
    cells = cells.select(*by, part, "i", F.posexplode(F.expr(f"slice({vector}, i + 1, size({vector}) - i)")).alias("k", "y"), "x")
    sums = cells.groupBy(*by, part, "i", "k").agg(F.sum(F.col("x") * F.col("y")).alias("s"))
    return sums.groupBy(*by).agg(F.collect_list(F.struct(F.col(part).alias("part"), "i", (F.col("i") + F.col("k")).alias("j"), "s")).alias("cells"))


def matrices(cells: list) -> dict[int, np.ndarray]:
    """The symmetric matrix of each part."""
    width, out = max(c["j"] for c in cells) + 1, {}
    for c in cells:
        m = out.setdefault(c["part"], np.zeros((width, width)))
        m[c["i"], c["j"]] = m[c["j"], c["i"]] = c["s"]
    return out


def solved(packed: DataFrame, by: list[str], result: str, solve: Callable[[dict[int, np.ndarray]], tuple | None]) -> DataFrame:
    """by and what solve gives for each group's matrices; groups for which it gives None are left out. result: the DDL of its columns."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, cells in zip(frame[by].itertuples(index=False, name=None), frame["cells"], strict=True):
                found = solve(matrices(cells))
                if found is not None:
                    out.append((*key, *found))
            yield pd.DataFrame(out, columns=[*by, *(c.split()[0] for c in result.split(", "))])

    keys = ", ".join(f"`{c}` {packed.schema[c].dataType.simpleString()}" for c in by)
    return packed.select(*by, "cells").mapInPandas(run, f"{keys}, {result}")


def lagged(series: DataFrame, by: list[str], value: str, lags: int, order: str = "t") -> DataFrame:
    """by, v = (change, level before, the `lags` changes before, 1) and available, the number of these changes there are."""
    w = W.series(*by, order=order)
    steps = series.where(F.col(value).isNotNull()).select(*by, order, F.lag(value).over(w).alias("__s"), (F.col(value) - F.lag(value).over(w)).alias("__d"))
    before = [F.lag("__d", i).over(w) for i in range(1, lags + 1)]
    there = steps.select(*by, "__d", "__s", *[b.alias(f"__l{i}") for i, b in enumerate(before)])
    names = [f"__l{i}" for i in range(lags)]
    have = sum((F.col(n).isNotNull().cast("int") for n in names), F.lit(0))
    return there.where("__s is not null").select(*by, have.alias("available"), F.array("__d", "__s", *[F.coalesce(n, F.lit(0.0)) for n in names], F.lit(1.0)).alias("v"))


def dickey_fuller(parts: dict[int, np.ndarray], constant: bool = True, series: int = 1, choose: bool = True, least: int = 20) -> tuple[int, int, float | None, float]:
    """Lag order, rows, t value of the level and its p value from the moments of `lagged`.

    The order has the least Akaike criterion over the rows that have all lags (choose), the regression is then made over all
    rows that have the chosen ones. Short or degenerate series have no t value and p = 1.
    """
    lags = next(iter(parts.values())).shape[0] - 3
    rows = lambda k: sum((m for have, m in parts.items() if have >= k), np.zeros((lags + 3, lags + 3)))

    def regression(m: np.ndarray, k: int) -> tuple[float, np.ndarray, np.ndarray] | None:
        at = [1, *range(2, 2 + k), *([lags + 2] if constant else [])]
        a, b = m[np.ix_(at, at)], m[at, 0]
        scale = np.sqrt(np.maximum(np.diag(a), 0))
        if (scale == 0).any():
            return None
        inverse = np.linalg.pinv(a / np.outer(scale, scale), hermitian=True) / np.outer(scale, scale)
        weights = inverse @ b
        return max(float(m[0, 0] - weights @ b), 0.0), weights, inverse

    everything = rows(0)
    if everything[-1, -1] + 1 < least:
        return 0, int(everything[-1, -1]), None, 1.0
    order = lags
    if choose:
        m, scores = rows(lags), []
        n = m[-1, -1]
        for k in range(lags + 1):
            found = regression(m, k)
            if found is not None and n > k + 2:
                scores.append((n * math.log(max(found[0], 1e-300) / n) + 2 * (k + 1 + constant), k))
        order = min(scores)[1] if scores else 0
    m = rows(order)
    n, found = int(m[-1, -1]), regression(m, order)
    free = n - 1 - order - constant
    if found is None or free <= 0 or found[0] <= 1e-14 * m[0, 0]:
        return order, n, None, 1.0
    tau = float(found[1][0] / math.sqrt(found[0] / free * found[2][0, 0]))
    return order, n, tau, p_value(tau, series)


_TEST = "lags int, n long, statistic double, p double"


def unit_root_test(series: DataFrame, by: list[str], value: str = "spread", lags: int = 4, choose: bool = True) -> DataFrame:
    """by, lags, n, statistic, p: augmented Dickey-Fuller test with a constant."""
    return solved(moments(lagged(series, by, value, lags), by), by, _TEST, lambda parts: dickey_fuller(parts, choose=choose))


def engle_granger(hedged: DataFrame, by: list[str], lags: int = 4, choose: bool = True) -> DataFrame:
    """by, lags, n, statistic, p for the residuals (spread) of pairs regressed on each other."""
    return solved(moments(lagged(hedged, by, "spread", lags), by), by, _TEST, lambda parts: dickey_fuller(parts, constant=False, series=2, choose=choose))


def basket_rows(prices: DataFrame, baskets: DataFrame, by: list[str]) -> DataFrame:
    """by, t, x: the log prices of a basket's symbols in their order, at times that have all of them.

    baskets: by, symbols (an array). A basket is a handful of symbols; the table of baskets is broadcast by Spark where small.
    """
    members = baskets.select(*by, F.size("symbols").alias("__k"), F.posexplode("symbols").alias("__at", "symbol"))
    keys = [c for c in by if c in prices.columns]
    met = prices.where("close > 0").join(members, [*keys, "symbol"])
    rows = met.groupBy(*by, "t").agg(F.array_sort(F.collect_list(F.struct("__at", F.log("close").alias("x")))).alias("__x"), F.max("__k").alias("__k"))
    return rows.where(F.size("__x") == F.col("__k")).select(*by, "t", F.transform("__x", lambda s: s["x"]).alias("x"))


def stepped(rows: DataFrame, by: list[str]) -> DataFrame:
    """by, v = (x, x before, change before, row number, 1) and available: 0 for the first row, 1 for the second, 2 for the others."""
    w = W.series(*by)
    before = rows.select(*by, "x", F.lag("x").over(w).alias("__b"), F.lag("x", 2).over(w).alias("__c"), (F.row_number().over(w) - 1).cast("double").alias("__n"))
    zeros = F.transform("x", lambda _: F.lit(0.0))
    change = F.coalesce(F.zip_with("__b", "__c", lambda a, b: a - b), zeros)
    have = F.col("__b").isNotNull().cast("int") + F.col("__c").isNotNull().cast("int")
    return before.select(*by, have.alias("available"), F.concat("x", F.coalesce("__b", zeros), change, F.array("__n", F.lit(1.0))).alias("v"))


def johansen(parts: dict[int, np.ndarray], least: int = 30) -> tuple[int, np.ndarray, np.ndarray, np.ndarray] | None:
    """Rows, eigenvalues (falling), vectors (as columns, absolute weights adding up to 1) and trace statistics, with a constant and one lag, from the moments of `stepped`."""
    width = next(iter(parts.values())).shape[0]
    k, m = (width - 2) // 3, parts.get(2, np.zeros((width, width)))
    n = int(m[-1, -1])
    if n + 2 < least or k < 2:
        return None
    # Products of the changes (x less x before), the levels before, the changes before and the constant.
    turn = np.zeros((3 * k + 1, width))
    turn[:k, :k], turn[:k, k : 2 * k] = np.eye(k), -np.eye(k)
    turn[k : 2 * k, k : 2 * k] = turn[2 * k : 3 * k, 2 * k : 3 * k] = np.eye(k)
    turn[3 * k, -1] = 1
    m = turn @ m @ turn.T
    mean = m[:, -1] / n
    m = (m - n * np.outer(mean, mean))[:-1, :-1] / n
    z = slice(2 * k, 3 * k)
    rest = m[: 2 * k, : 2 * k] - m[: 2 * k, z] @ np.linalg.pinv(m[z, z], hermitian=True) @ m[z, : 2 * k]
    s00, s0k, skk = rest[:k, :k], rest[:k, k:], rest[k:, k:]
    try:
        low = np.linalg.inv(np.linalg.cholesky(skk))
        values, vectors = np.linalg.eigh(low @ s0k.T @ np.linalg.solve(s00, s0k) @ low.T)
    except np.linalg.LinAlgError:  # series that are multiples of each other
        return None
    values, vectors = np.clip(values[::-1], 0, 1 - 1e-15), (low.T @ vectors)[:, ::-1]
    vectors = vectors / np.abs(vectors).sum(axis=0)
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)] < 0, -1, 1)  # the largest weight is positive
    return n, values, vectors, -n * np.cumsum(np.log1p(-values)[::-1])[::-1]


def cointegrating_vectors(prices: DataFrame, baskets: DataFrame, by: list[str]) -> DataFrame:
    """by, n, rank, place, eigenvalue, trace, weights: a row for each vector of each basket. rank: vectors found at 95 %, one after the other."""

    def solve(parts: dict[int, np.ndarray]) -> tuple | None:
        found = johansen(parts)
        if found is None:
            return None
        n, values, vectors, trace = found
        k = len(values)
        rank = next((r for r in range(k) if k - r > len(TRACE_95) or trace[r] <= TRACE_95[k - r - 1]), k)
        return n, rank, values.tolist(), trace.tolist(), [v.tolist() for v in vectors.T]

    packed = moments(stepped(basket_rows(prices, baskets, by), by), by)
    found = solved(packed, by, "n long, rank int, eigenvalues array<double>, trace array<double>, weights array<array<double>>", solve)
    every = F.posexplode(F.arrays_zip("eigenvalues", "trace", "weights")).alias("place", "__v")
    return found.select(*by, "n", "rank", every).select(*by, "n", "rank", (F.col("place") + 1).alias("place"), F.col("__v.eigenvalues").alias("eigenvalue"), F.col("__v.trace").alias("trace"), F.col("__v.weights").alias("weights"))
