"""Windowed models: no look-ahead, exact ranks and fits; tree ensembles against a plain walk."""

import math
import random

import numpy as np
import pytest

from tidemark.operators import rolling_models, trees

DAY = 86_400
ROWS = "symbol string, t long, a double, b double, c double, d double, y double"


def panel(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.gauss(0, 1), rng.choice([0.0, 0.0, 1.0, 2.0])
        c = None if i % 9 == 0 else float("inf") if i % 50 == 0 else rng.gauss(0, 3)
        rows.append((f"s{i % 3}", (i // 3) * DAY, a, b, c, None, 0.5 * a - 0.2 * b + rng.gauss(0, 0.3) if i % 17 else None))
    return rows


def by_window(rows, size):
    """Test month to (training rows, test rows), from months that have rows with a target."""
    rows = [r for r in rows if r[-1] is not None]
    month = lambda r: (np.datetime64(0, "s") + np.timedelta64(r[1], "s")).astype("datetime64[M]").astype(int) + 1970 * 12
    months = sorted({month(r) for r in rows})
    return {months[i]: ([r for r in rows if month(r) in months[i - size + 1 : i]], [r for r in rows if month(r) == months[i]]) for i in range(size - 1, len(months))}


def ranks(v):
    order = sorted(v)
    return [order.index(x) + (order.count(x) + 1) / 2 for x in v]


def clean(x):
    return x if x is not None and math.isfinite(x) else None


def test_rank_correlations_equal_counting(spark, monkeypatch):
    monkeypatch.setattr(rolling_models, "BLOCKS", 7)
    rows = panel(300)
    dealt = rolling_models.monthly_windows(spark.createDataFrame(rows, ROWS).where("y is not null"), 3).where("not test")
    got = {(r["window"], r["feature"]): r for r in rolling_models.rank_correlations(rolling_models.long_features(dealt, ["a", "b", "c", "d"], "y", [])).collect()}
    want = by_window(rows, 3)
    assert {w for w, _ in got} == set(want) and not any(f == "d" for _, f in got)
    for w, (train, _) in want.items():
        for i, f in ((2, "a"), (3, "b"), (4, "c")):
            both = [(clean(r[i]), r[-1]) for r in train if clean(r[i]) is not None]
            rx, ry = ranks([x for x, _ in both]), ranks([y for _, y in both])
            assert got[w, f]["n"] == len(both) and got[w, f]["ic"] == pytest.approx(np.corrcoef(rx, ry)[0, 1])


@pytest.mark.parametrize("top", [None, 2])
def test_pooled_models_equal_numpy(spark, top):
    rows = panel()
    predictions, scores = rolling_models.pooled(spark.createDataFrame(rows, ROWS).repartition(5), ["a", "b", "c", "d"], "y", ["symbol", "t"], 3, top, (1.0, 100.0))
    got = {(r["symbol"], r["t"]): r for r in predictions.collect()}
    best = {r["window"]: r for r in scores.collect() if r["best"]}
    want = by_window(rows, 3)
    assert set(best) == set(want) and len(got) == sum(len(t) for _, t in want.values())
    for w, (train, test) in want.items():
        columns = []
        for i in (2, 3, 4):
            x = [clean(r[i]) for r in train]
            there = [v for v in x if v is not None]
            q = np.quantile(there, [0.25, 0.5, 0.75])
            scaled = lambda rs, i=i, q=q: np.array([((clean(r[i]) if clean(r[i]) is not None else q[1]) - q[1]) / ((q[2] - q[0]) or 1) for r in rs])
            ic = np.corrcoef(ranks(there), ranks([r[-1] for r, v in zip(train, x) if v is not None]))[0, 1]
            columns.append((-abs(ic), "abc"[i - 2], scaled(train), scaled(test)))
        columns = sorted(columns, key=lambda c: c[:2])[:top]
        z, zt = np.column_stack([c[2] for c in columns]), np.column_stack([c[3] for c in columns])
        y, yt = np.array([r[-1] for r in train]), np.array([r[-1] for r in test])
        found = []
        for penalty in (1.0, 100.0):
            zc = z - z.mean(axis=0)
            weights = np.linalg.solve(zc.T @ zc + penalty * np.eye(z.shape[1]), zc.T @ (y - y.mean()))
            said = y.mean() + (zt - z.mean(axis=0)) @ weights
            found.append((1 - ((yt - said) ** 2).sum() / ((yt - yt.mean()) ** 2).sum(), f"ridge_{penalty:g}", said))
        r2, name, said = max(found, key=lambda f: f[0])
        assert best[w]["model"] == name and best[w]["r2"] == pytest.approx(r2)
        for r, p in zip(test, said):
            assert got[r[0], r[1]]["y_pred"] == pytest.approx(p) and got[r[0], r[1]]["window"] == w


def test_no_test_row_takes_part_in_training(spark):
    """Whatever stands in a test month, predictions of that month's other rows stay what they were."""
    rows = panel()
    last = max(by_window(rows, 3))
    test = by_window(rows, 3)[last][1]
    changed = [(*r[:2], 99.0, 99.0, -99.0, 5.0, 50.0) if r[:2] == test[0][:2] else r for r in rows]
    runs = []
    for data in (rows, changed):
        dealt = rolling_models.monthly_windows(spark.createDataFrame(data, ROWS).where("y is not null"), 3)
        learned = dealt.where(f"not test and window = {last}")
        assert learned.where(f"t >= {min(r[1] for r in test)}").count() == 0
        chosen = rolling_models.chosen_features(rolling_models.long_features(learned, ["a", "b", "c", "d"], "y", []), 2)
        ready = rolling_models.scaled_rows(dealt.where(f"window = {last}"), chosen, ["a", "b", "c", "d"])
        fits = rolling_models.ridge_fits(ready.where("not test"), [1.0, 100.0]).collect()
        runs.append(sorted((r["model"], round(r["intercept"], 12), tuple(round(v, 12) for v in r["weights"])) for r in fits))
    assert runs[0] == runs[1]


def test_windows_skip_months_without_rows(spark):
    rows = [("s", t * DAY, 1.0, 1.0, 1.0, 1.0, 1.0) for t in (0, 40, 100, 130)]  # January, February, April, May
    got = rolling_models.monthly_windows(spark.createDataFrame(rows, ROWS), 3).collect()
    assert sorted((r["window"] - 1970 * 12, r["t"] // DAY, r["test"]) for r in got) == [(3, 0, False), (3, 40, False), (3, 100, True), (4, 40, False), (4, 100, False), (4, 130, True)]
    assert rolling_models.monthly_windows(spark.createDataFrame(rows, ROWS), 5).count() == 0


def walk(tree, x):
    node = 0 if tree.feature else -1
    while node >= 0:
        node = tree.left[node] if x[tree.feature[node]] <= tree.threshold[node] else tree.right[node]
    return tree.leaf[-node - 1]


def grown(rng, depth):
    """A random tree, by splitting leaves."""
    tree = trees.Tree([], [], [], [], [])

    def grow(level):
        if level == 0 or rng.random() < 0.2:
            tree.leaf.append(rng.gauss(0, 1))
            return -len(tree.leaf)
        node = len(tree.feature)
        tree.feature.append(rng.randrange(3))
        tree.threshold.append(rng.choice([0.0, rng.gauss(0, 1), float("inf")]))
        tree.left.append(0)
        tree.right.append(0)
        tree.left[node], tree.right[node] = grow(level - 1), grow(level - 1)
        return node

    grow(depth)
    return tree


def test_trees_equal_a_plain_walk_on_every_row(spark):
    rng = random.Random(7)
    own = trees.Ensemble(["a", "b", "c"], [grown(rng, d) for d in (0, 1, 2, 5, 8, 5)], [1.0, 0.5, -2.0, 1.0, 0.1, 3.0], 0.25, [0.1, 0.0, -1.0], [2.0, 0.0, 0.5])
    odd = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0]
    rows = [(i, *[rng.choice(odd) if rng.random() < 0.2 else rng.gauss(0, 2) for _ in range(3)]) for i in range(400)]
    got = {r["i"]: r["score"] for r in trees.score(spark.createDataFrame(rows, "i long, a double, b double, c double"), own).collect()}
    for i, *values in rows:
        x = [((v if v is not None and math.isfinite(v) else 0.0) - c) / (s or 1.0) for v, c, s in zip(values, own.center, own.scale)]
        assert got[i] == pytest.approx(own.base + sum(w * walk(t, x) for w, t in zip(own.weights, own.trees)), abs=1e-12)


def test_scores_of_fitted_ensembles(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor

    rng = random.Random(2)
    rows = [(x := rng.gauss(0, 1), z := rng.gauss(0, 1), x * (1 if z > 0 else -1)) for _ in range(300)]
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "a double, b double, label double"))
    for kind in (GBTRegressor(maxIter=4, maxDepth=3), RandomForestRegressor(numTrees=4, maxDepth=4, seed=1), DecisionTreeRegressor(maxDepth=3)):
        model = kind.fit(data)
        both = trees.score(model.transform(data), trees.of_fitted(model, ["a", "b"])).select("prediction", "score").collect()
        assert all(abs(r["prediction"] - r["score"]) < 1e-9 for r in both)


def test_text_models_are_checked():
    text = "max_feature_idx=1\n\nTree=0\nsplit_feature=0\nthreshold=0.5\ndecision_type={}\nleft_child=-1\nright_child=-2\nleaf_value=1 2\n\nend of trees\n"
    assert trees.read_text(text.format(2), ["a", "b"]).trees[0].leaf == [1.0, 2.0]
    for kind in (1, 6):
        with pytest.raises(ValueError):
            trees.read_text(text.format(kind), ["a", "b"])
    with pytest.raises(ValueError, match="2 features"):
        trees.read_text(text.format(2), ["a"])
    with pytest.raises(ValueError, match="scale"):
        trees.read_text(text.format(2), ["a", "b"], [(0.0, 1.0)])


def test_missing_columns_are_refused(spark):
    with pytest.raises(ValueError, match="no b"):
        trees.score(spark.createDataFrame([(1.0,)], "a double"), trees.Ensemble(["a", "b"], []))
