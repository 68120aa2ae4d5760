"""Cointegration and portfolio building against the direct computation from rows."""

import math

import numpy as np
import pytest

from tidemark.operators import cointegration, pairs, portfolio


def design(s, k, start, constant):
    """Change, and [level before, k changes before, constant], for the rows from `start` on."""
    d = np.diff(s)
    rows = range(start, len(d))
    x = [[s[i], *[d[i - j] for j in range(1, k + 1)], *([1.0] if constant else [])] for i in rows]
    return np.array([d[i] for i in rows]), np.array(x).reshape(len(rows), -1)


def by_rows(s, most, constant, choose=True):
    s = np.array([v for v in s if v is not None])
    scores = []
    for k in range(most + 1):
        y, x = design(s, k, most, constant)
        residual = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
        scores.append((len(y) * math.log(residual @ residual / len(y)) + 2 * x.shape[1], k))
    k = min(scores)[1] if choose else most
    y, x = design(s, k, k, constant)
    w = np.linalg.lstsq(x, y, rcond=None)[0]
    residual = y - x @ w
    error = math.sqrt(residual @ residual / (len(y) - x.shape[1]) * np.linalg.inv(x.T @ x)[0, 0])
    return k, len(y), w[0] / error


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(2)
    out = {}
    for i in range(8):
        n, s, e = 60 + 40 * i, [0.0], 0.0
        for _ in range(n):
            e = 0.6 * (i % 3) / 2 * e + rng.normal()
            s.append((0.3 + 0.09 * i) * s[-1] + e)
        out[f"s{i}"] = [None if i == 3 and j % 11 == 5 else 3.0 + v for j, v in enumerate(s)]
    out["short"], out["flat"] = [1.0, 2.0, 1.5], [2.0] * 50
    return out


@pytest.mark.parametrize("constant", [True, False])
def test_unit_root_tests_equal_regressions_on_rows(spark, series, constant):
    rows = spark.createDataFrame([(k, i, v) for k, s in series.items() for i, v in enumerate(s)], "pair string, t long, spread double").repartition(7)
    run = cointegration.unit_root_test if constant else cointegration.engle_granger
    got = {r["pair"]: r for r in run(rows, ["pair"], lags=4).collect()}
    assert set(got) == set(series)
    for name, s in series.items():
        if name in ("short", "flat"):
            assert got[name]["statistic"] is None and got[name]["p"] == 1.0
            continue
        k, n, tau = by_rows(s, 4, constant)
        assert (got[name]["lags"], got[name]["n"]) == (k, n) and abs(got[name]["statistic"] - tau) < 1e-7
        assert got[name]["p"] == pytest.approx(cointegration.p_value(tau, 1 if constant else 2), abs=1e-9)


def test_p_values_of_published_critical_values():
    """Asymptotic points of MacKinnon's tables: 1, 5 and 10 %."""
    for tau, p, n in ((-3.43, 0.01, 1), (-2.86, 0.05, 1), (-2.57, 0.10, 1), (-3.90, 0.01, 2), (-3.34, 0.05, 2), (-3.05, 0.10, 2), (-3.74, 0.05, 3)):
        assert abs(cointegration.p_value(tau, n) - p) < 0.003
    assert cointegration.p_value(5) == 1.0 and cointegration.p_value(-30) == 0.0
    taus = np.linspace(-6, 2, 200)
    assert all(a <= b + 1e-3 for a, b in zip([cointegration.p_value(t) for t in taus], [cointegration.p_value(t) for t in taus[1:]]))


def johansen_by_rows(x):
    dx = np.diff(x, axis=0)
    demean = lambda a: a - a.mean(axis=0)
    z, y, lx = demean(dx[:-1]), demean(dx[1:]), demean(x[1:-1])
    out = lambda a: a - z @ np.linalg.lstsq(z, a, rcond=None)[0]
    r0, rk = out(y), out(lx)
    n = len(y)
    skk, sk0, s00 = rk.T @ rk / n, rk.T @ r0 / n, r0.T @ r0 / n
    values, vectors = np.linalg.eig(np.linalg.inv(skk) @ sk0 @ np.linalg.inv(s00) @ sk0.T)
    order = np.argsort(-values.real)
    return n, values.real[order], vectors.real[:, order]


def basket_prices(seed, n=400, k=4):
    rng = np.random.default_rng(seed)
    walk = np.cumsum(rng.normal(0, 0.02, (n, k - 1)), axis=0)
    tied = walk @ rng.normal(1, 0.3, k - 1) + rng.normal(0, 0.02, n)
    return np.column_stack([walk, tied]) + 4


@pytest.fixture(scope="module")
def windows(spark):
    data = {w: basket_prices(w) for w in (1, 2)}
    rows = [(w, t, f"c{i}", float(math.exp(v))) for w, x in data.items() for t, r in enumerate(x) for i, v in enumerate(r)]
    rows += [(1, 1000, "c0", 5.0), (1, 1001, "c1", -1.0)]  # times that lack a symbol or its price
    return data, spark.createDataFrame(rows, "window long, t long, symbol string, close double").repartition(6)


def test_cointegrating_vectors_equal_the_direct_computation(spark, windows):
    data, prices = windows
    baskets = spark.createDataFrame([(w, ["c0", "c1", "c2", "c3"]) for w in data], "window long, symbols array<string>")
    got = cointegration.cointegrating_vectors(prices, baskets, ["window"]).collect()
    for w, x in data.items():
        own = sorted((r for r in got if r["window"] == w), key=lambda r: r["place"])
        n, values, vectors = johansen_by_rows(x)
        assert own[0]["n"] == n and np.allclose([r["eigenvalue"] for r in own], values, atol=1e-9)
        assert np.allclose([r["trace"] for r in own], [-n * np.log(1 - values[i:]).sum() for i in range(4)], atol=1e-6)
        assert own[0]["rank"] >= 1  # the tied series is found
        v = np.array(own[0]["weights"])
        first = vectors[:, 0] / np.abs(vectors[:, 0]).sum()
        assert min(np.abs(v - first).max(), np.abs(v + first).max()) < 1e-7 and abs(np.abs(v).sum() - 1) < 1e-12


def reversion_by_rows(x, w):
    s, t = x @ w, np.arange(len(x), dtype=float)
    line = np.polyfit(t, s, 1)
    s = s - np.polyval(line, t)
    a = np.column_stack([np.ones(len(s) - 1), s[:-1]])
    b = np.linalg.lstsq(a, np.diff(s), rcond=None)[0]
    return -b[1], np.std(np.diff(s) - a @ b), line[0], line[1]


def test_forms_of_a_basket_equal_regressions_on_rows(spark, windows):
    data, prices = windows
    baskets = spark.createDataFrame([(w, ["c0", "c1", "c2", "c3"]) for w in data], "window long, symbols array<string>")
    packed = cointegration.moments(cointegration.stepped(cointegration.basket_rows(prices, baskets, ["window"]), ["window"]), ["window"]).collect()
    rng = np.random.default_rng(1)
    for r in packed:
        own = portfolio.Reversion.of(cointegration.matrices(r["cells"]))
        for _ in range(5):
            w = portfolio.normalised(rng.normal(size=4))
            speed, deviation, drift = (float(v[0]) for v in own.fit(w[None]))
            want = reversion_by_rows(data[r["window"]], w)
            assert np.allclose([speed, deviation, drift, w @ own.base], want, rtol=1e-6, atol=1e-9)


def test_optimiser_is_repeatable_bounded_and_finds_the_best_of_a_grid():
    rng = np.random.default_rng(3)
    x = basket_prices(7, k=3)
    n = np.arange(len(x), dtype=float)
    lag, change = np.vstack([np.zeros((1, 3)), x[:-1]]), np.vstack([np.zeros((2, 3)), x[1:-1] - x[:-2]])
    v = np.column_stack([x, lag, change, n, np.ones(len(x))])
    own = portfolio.Reversion.of({0: np.outer(v[0], v[0]), 1: np.outer(v[1], v[1]), 2: v[2:].T @ v[2:]})
    seed = rng.normal(size=3)
    w = portfolio.evolved(own, seed, 0.6, 0.1)
    assert (w == portfolio.evolved(own, seed, 0.6, 0.1)).all() and abs(np.abs(w).sum() - 1) < 1e-12
    grid = np.array([(a, b, c) for a in np.linspace(-0.6, 0.6, 41) for b in np.linspace(-0.6, 0.6, 41) for c in np.linspace(-0.6, 0.6, 41) if abs(a) + abs(b) + abs(c) > 0])
    best = portfolio.cost(own, grid, 0.1).min()
    assert portfolio.cost(own, w[None], 0.1)[0] <= best + 1e-3 * abs(best) and portfolio.cost(own, w[None], 0.1)[0] <= portfolio.cost(own, seed[None], 0.1)[0]


def test_built_portfolios_are_valid_and_take_the_best_pairs(spark, windows):
    data, prices = windows
    noise = np.random.default_rng(9)
    walk = np.cumsum(noise.normal(0, 0.02, 400))
    extra = spark.createDataFrame([(w, t, "zz", float(math.exp(4 + walk[t]))) for w in data for t in range(400)] + [(3, t, "c0", 1.0 + t % 3) for t in range(50)], "window long, t long, symbol string, close double")
    got = {r["window"]: r for r in portfolio.built(prices.union(extra), assets=4, most=0.6, rounds=60).collect()}
    assert set(got) == {1, 2}
    for w, r in got.items():
        x = np.column_stack([data[w][:, int(s[1])] if s != "zz" else 4 + walk for s in r["symbols"]])
        speed, deviation, drift, base = reversion_by_rows(x, np.array(r["weights"]))
        assert np.allclose([r["speed"], r["deviation"], r["drift"], r["base"]], [speed, deviation, drift, base], rtol=1e-5, atol=1e-8)
        assert r["speed"] > 0 and r["half_life"] <= 500 and r["score"] == pytest.approx(speed / deviation * (1.5 if drift > 0 else 1), rel=1e-5)
    # On the same basket the optimiser finds no slower reversion than the seeds, but for what it pays to avoid a falling spread.
    plain, free = ({r["window"]: r for r in portfolio.built(prices, assets=4, **how).collect()} for how in ({"optimise": False}, {"most": 1.0, "penalty": 0.0}))
    for w, r in plain.items():
        assert free[w]["speed"] / free[w]["deviation"] >= r["speed"] / r["deviation"] - 100 * max(0.0, -r["drift"]) - 1e-3


def test_scorecards_only_know_windows_before(spark):
    days = [("a", 90 * w, 90 * w + d, g) for w, gains in enumerate([[1, 2, 3], [-1, -2], [5], [0, 0], [1, -9, 2]]) for d, g in enumerate(gains)]
    frame = lambda rows: spark.createDataFrame([(p, w, d, float(g)) for p, w, d, g in rows], "pair string, window long, day long, gain double")
    got = portfolio.scorecard(frame(days), most=1.5, least_good=1, of_last=2).orderBy("window").collect()
    assert [r["good"] for r in got] == [True, False, True, False, False]
    assert [round(r["weight"], 6) for r in got] == [1.0, 1.5, 0.0, 1.5, 0.0] and [r["trades"] for r in got] == [True, True, True, True, True]
    other = portfolio.scorecard(frame([*days[:-1], ("a", 360, 362, 99.0)]), most=1.5, least_good=1, of_last=2).orderBy("window").collect()
    assert [(r["weight"], r["trades"]) for r in other] == [(r["weight"], r["trades"]) for r in got]


def test_states_of_two_frames(spark):
    rows = lambda ps: pairs.break_states(spark.createDataFrame([("a", i, p) for i, p in enumerate(ps)], "pair string, t long, p double"))
    got = pairs.both_recovered(rows([0.9, 0.01, 0.2, 0.01, 0.01, 0.5]), rows([0.01, 0.3, 0.01, 0.01, 0.4])).orderBy("t").collect()
    assert [r["state"] for r in got] == ["inactive", "cointegrated", "broken", "recovered", "recovered", "broken"]
    assert [r["tradeable"] for r in got] == [False, False, False, True, False, False]
