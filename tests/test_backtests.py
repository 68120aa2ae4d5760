"""Walk-forward trades against a plain loop, and the rules that choose pairs."""

import math

import numpy as np
import pytest

from tidemark.operators import backtests

LOOK, STEP = 40, 10


def series(seed, n=120):
    rng = np.random.default_rng(seed)
    x = np.cumsum(rng.normal(0, 0.02, n)) + 3
    e = [0.0]
    for _ in range(n - 1):
        e.append(0.6 * e[-1] + rng.normal(0, 0.05))
    return x, 0.8 * x + np.array(e)


def by_loop(x, y, enter, leave, stop, longest, cap, fee):
    """t to (z, position, gain) for windows whose past reverts."""
    out, n = {}, len(x)
    for start in range(0, n, STEP):
        past = range(max(0, start - LOOK), start)
        if len(past) < 3:
            continue
        px, py = x[list(past)], y[list(past)]
        hedge = np.polyfit(px, py, 1)[0] if len(past) >= 10 else 1.0
        base = py.mean() - hedge * px.mean()
        s = py - hedge * px - base
        slope, _ = np.polyfit(s[:-1], np.diff(s), 1)
        if -slope <= 0:
            continue
        rows = range(start, min(start + STEP, n))
        z = [(y[t] - hedge * x[t] - base) / s.std(ddof=1) for t in rows]
        held, age, before, last = 0, 0, 0.0, None
        for t, score in zip(rows, z):
            if held:
                age += 1
                if abs(score) < leave or (stop and abs(score) > stop) or (longest and age > longest):
                    held = 0
            elif abs(score) > enter:
                held, age = (-1 if score > 0 else 1), 1
            now = 0.0 if math.log(2) / -slope > cap else float(held)
            spread = y[t] - hedge * x[t] - base
            out[t] = (score, now, before * (spread - last if last is not None else 0.0) - abs(now - before) * 2 * fee)
            before, last = now, spread
    return out


@pytest.mark.parametrize("cap, stop, longest", [(500.0, 0.0, 0), (500.0, 2.5, 4), (1.2, 0.0, 0)])
def test_trades_equal_a_loop(spark, cap, stop, longest):
    data = {p: series(i) for i, p in enumerate(("a/b", "c/d"))}
    rows = [(p, t, float(x[t]), float(y[t])) for p, (x, y) in data.items() for t in range(len(x))]
    aligned = spark.createDataFrame(rows, "pair string, t long, x double, y double").repartition(5)
    _, fits = backtests.fitted_windows(aligned, LOOK, STEP)
    got = backtests.traded(aligned, fits, STEP, enter=1.0, leave=0.3, stop=stop, longest=longest, most_half_life=cap, fee=0.001)
    found = {(r["pair"], r["t"]): (r["z"], r["position"], r["gain"]) for r in got.collect()}
    want = {(p, t): v for p, (x, y) in data.items() for t, v in by_loop(x, y, 1.0, 0.3, stop, longest, cap, 0.001).items()}
    assert set(found) == set(want) and all(np.allclose(found[k], want[k], atol=1e-9) for k in want)
    assert any(v[1] for v in want.values())
    result = {r["pair"]: r for r in backtests.outcome(got.withColumn("t", got["t"] * 86_400), fits).collect()}
    for p in data:
        gains = [v[2] for (q, _), v in want.items() if q == p]
        assert result[p]["days"] == len(gains) and result[p]["total"] == pytest.approx(sum(gains))


def test_no_later_row_changes_a_fit(spark):
    x, y = series(5)
    frame = lambda y: spark.createDataFrame([("a/b", t, float(x[t]), float(y[t])) for t in range(len(x))], "pair string, t long, x double, y double")
    later = y.copy()
    later[80:] += 5
    fits = [{r["window"]: (r["hedge"], r["base"], r["width"], r["speed"]) for r in backtests.fitted_windows(frame(v), LOOK, STEP)[1].collect() if r["window"] <= 80} for v in (y, later)]
    assert fits[0] == fits[1] and len(fits[0]) == 8


def test_ladders_and_their_names(spark):
    x, y = series(1)
    aligned = spark.createDataFrame([("a/b", t, float(x[t]), float(y[t])) for t in range(len(x))], "pair string, t long, x double, y double")
    _, fits = backtests.fitted_windows(aligned, LOOK, STEP)
    sizes = {kind: {abs(r["position"]) for r in backtests.traded(aligned, fits, STEP, enter=0.5, rungs=3, ladder=kind).collect()} for kind in backtests.LADDERS}
    assert sizes["none"] <= {0.0, 1.0} and len(sizes["linear"]) > 2 and sizes["linear"] <= {0.0, 1 / 3, 2 / 3, 1.0} and sizes["steep"] <= {0.0, 1 / 6, 0.5, 1.0}
    with pytest.raises(ValueError):
        backtests.traded(aligned, fits, STEP, ladder="other")


HISTORY = "pair string, window long, p double, speed double, deviation double, hedge double, sharpe double"


@pytest.mark.parametrize("change, kept", [
    ({}, True), ({(1, "p"): 0.05}, False), ({(2, "p"): None}, False), ({(2, "speed"): 0.49}, False), ({(0, "speed"): 0.1}, True), ({(2, "deviation"): 0.0}, False), ({(1, "hedge"): 1.3}, False), ({(1, "hedge"): 1.2}, True),
    ({(0, "hedge"): 0.0}, False), ({(2, "sharpe"): -0.1}, False), ({(1, "sharpe"): -5.0}, True), ({(-1, "p"): 0.9}, True), ({(-1, "hedge"): 9.0}, True),
])
def test_stable_pairs_only(spark, change, kept):
    names = ("p", "speed", "deviation", "hedge", "sharpe")
    rows = []
    for w in (-1, 0, 1, 2):
        own = dict(zip(names, (0.01, 1.0, 1.0, 1.0, 0.5))) | {c: v for (at, c), v in change.items() if at == w}
        rows.append(("a/b", w, *[own[c] for c in names]))
    rows += [("c/d", w, 0.01, 3.0, 1.0, 1.0, 1.0) for w in (0, 1, 2)] + [("few", 2, 0.01, 9.0, 1.0, 1.0, 1.0)]
    got = {r["pair"]: r["place"] for r in backtests.tradeable_pairs(spark.createDataFrame(rows, HISTORY)).collect()}
    assert got == ({"c/d": 1, "a/b": 2} if kept else {"c/d": 1})
    assert [r["pair"] for r in backtests.tradeable_pairs(spark.createDataFrame(rows, HISTORY), top=1).collect()] == ["c/d"]
