"""Three-class windows: labels, groups, clusters of groups, and no look-ahead."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rolling_models, window_classes
from tidemark.operators.window_classes import Clusters, Settings

ROWS = "symbol string, t long, a double, b double, c double, y double, label int, group int"
FEATURES = ["a", "b", "c"]
FEW = Settings(rounds=3, depth=2, clusters=[Clusters(3, 2)])


def panel(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        y = 0.8 * a + rng.gauss(0, 0.2)
        rows.append((f"s{i % 2}", (i // 2) * 86_400 * 8, a, b if i % 7 else None, None, y, 2 if y > 0.4 else 0 if y < -0.4 else 1, int(b > 0.5)))
    return rows


def dealt(spark, rows):
    frame = spark.createDataFrame(rows, ROWS)
    return rolling_models.period_windows(frame, 3, F.year(F.date_from_unix_date((F.col("t") / 86_400).cast("int"))))


def test_labels_and_groups(spark):
    rows = [(0.2, 0.0), (0.0, -0.3), (0.2, -0.3), (0.3, -0.2), (0.0, 0.0), (None, None), (0.1, -0.1)]
    got = spark.createDataFrame(rows, "u double, d double").select(window_classes.label(F.col("u"), F.col("d"), 0.1).alias("x")).collect()
    assert [r["x"] for r in got] == [2, 0, 0, 2, 1, 1, 1]
    names = [("high_volume_and_up",), ("low_volume",), ("baseline",), ("other",), (None,)]
    got = spark.createDataFrame(names, "n string").select(window_classes.group_of(F.col("n"), ["baseline", "high_volume", "low_volume"]).alias("g")).collect()
    assert [r["g"] for r in got] == [1, 2, 0, 0, 0]


@pytest.mark.parametrize("settings", [FEW, Settings(rounds=2, depth=2, clusters=[Clusters(3, 2), Clusters(2, 2)], least_rows=20)])
def test_predictions_of_a_window_do_not_hang_on_its_test_rows(spark, settings):
    rows = panel()
    windows = dealt(spark, rows)
    assert windows.groupBy("window", "symbol", "t").count().where("count > 1").count() == 0
    last = windows.agg(F.max("window")).first()[0]
    test = sorted((r["symbol"], r["t"]) for r in windows.where(f"window = {last} and test").collect())
    changed = [(*r[:2], 9.0, -9.0, 5.0, 7.0, 1, 1) if r[:2] == test[0] else r for r in rows]
    runs = []
    for data in (rows, changed):
        own = dealt(spark, data).where(f"window = {last}")
        found = window_classes.window_predictions(own.where("not test"), own.where("test"), FEATURES, ["symbol", "t"], settings).collect()
        assert sorted((r["symbol"], r["t"]) for r in found) == test
        runs.append({(r["symbol"], r["t"]): (r["regime"], r["predicted"], round(r["p_up"], 9), round(r["p_down"], 9)) for r in found if (r["symbol"], r["t"]) != test[0]})
    assert runs[0] == runs[1]


def test_windows_learn_and_are_summed_up(spark):
    found = window_classes.walk(dealt(spark, panel()), FEATURES, ["symbol", "t", "y"], FEW)
    rows = found.collect()
    assert all(abs(r["p_down"] + r["p_neutral"] + r["p_up"] - 1) < 1e-9 and 0 <= r["cluster"] < 3 and r["regime"] == r["group"] * 1000 + r["cluster"] for r in rows)
    assert sum(r["predicted"] == r["label"] for r in rows) > 0.7 * len(rows)
    sums = {r["window"]: r for r in window_classes.summary(found, "y", "y", 1.0).collect()}
    for w, s in sums.items():
        own = [r for r in rows if r["window"] == w]
        longs = [r["y"] for r in own if r["predicted"] == 2]
        mean = sum(longs) / len(longs)
        assert s["n"] == len(own) and s["n_down"] + s["n_neutral"] + s["n_up"] == s["n"] and s["sharpe_long"] == pytest.approx(mean / (sum((v - mean) ** 2 for v in longs) / len(longs)) ** 0.5)
        assert s["sharpe_all_long"] == pytest.approx(-s["sharpe_all_short"])


def test_small_groups_and_missing_classes(spark):
    rows = panel(120)
    few = [(*r[:7], 1 if i < 5 else 0) for i, r in enumerate(rows)]
    frame = spark.createDataFrame(few, ROWS)
    found = window_classes.window_predictions(frame, frame, FEATURES, ["t"], Settings(rounds=1, depth=1, clusters=[Clusters(3, 2), Clusters(3, 2)], least_rows=20)).collect()
    assert {r["cluster"] for r in found if r["group"] == 1} == {0} and len({r["cluster"] for r in found if r["group"] == 0}) > 1
    two = frame.where("label <> 1")
    got = window_classes.window_predictions(two, frame, FEATURES, ["t"], FEW).collect()
    assert len(got) == 120 and all((r["predicted"], r["p_neutral"]) == (1, 1.0) for r in got)
    with pytest.raises(ValueError):
        window_classes.walk(dealt(spark, rows).where("false"), FEATURES, ["t"], FEW)


def test_runs_are_saved_and_models_read_again(spark, tmp_path):
    rows = dealt(spark, panel())
    folder = f"file://{tmp_path}/run"
    settings = Settings(rounds=2, depth=2, clusters=[Clusters(3, 2), Clusters(2, 2), Clusters(2, 2)], least_rows=20)  # no row is of group 2
    found = window_classes.walk(rows, FEATURES, ["symbol", "t", "y"], settings, models=f"{folder}/models")
    window_classes.save_run(found, window_classes.summary(found, "y", "y", 1.0), folder)
    kept = spark.read.parquet(f"{folder}/predictions")
    assert kept.count() == found.count() and spark.read.option("header", True).csv(f"{folder}/summary").count() == kept.select("window").distinct().count()
    last = kept.agg(F.max("window")).first()[0]
    model = window_classes.WindowModel.load(spark, f"{folder}/models/window={last}")
    assert model.features == ["a", "b"] and model.clusters[2] is None
    again = {(r["symbol"], r["t"]): r for r in model.predict(rows.where(f"window = {last} and test"), ["symbol", "t"]).collect()}
    for r in kept.where(f"window = {last}").collect():
        other = again[r["symbol"], r["t"]]
        assert (other["regime"], other["predicted"]) == (r["regime"], r["predicted"]) and abs(other["p_up"] - r["p_up"]) < 1e-12
    assert window_classes.numeric_features(rows, ("t", "label", "group", "window", "y")) == FEATURES


def test_rows_are_made_once_for_all_fits(spark):
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x

    rows = dealt(spark, panel(240))
    n = rows.count()
    counted = rows.withColumn("a", F.udf(seen, "double").asNondeterministic()("a"))
    window_classes.walk(counted, FEATURES, ["symbol", "t", "y"], Settings(rounds=1, depth=1, clusters=[Clusters(2, 2)]))
    assert made.value == n


def test_grouped_query_learns_with_all_rounds_and_clusters(spark, monkeypatch):
    """200 rounds of depth 5 at 0.05, six, six and four clusters: nothing is cut to save time."""
    from tidemark.plans import models

    class Seen(Exception):
        pass

    def walk(dealt, features, keep, settings, **_):
        raise Seen(settings)

    monkeypatch.setattr(window_classes, "walk", walk)
    monkeypatch.setattr(models, "_classed", lambda *_: None)
    with pytest.raises(Seen) as seen:
        models.grouped_class_windows(spark, "")
    settings = seen.value.args[0]
    assert (settings.rounds, settings.depth, settings.rate, [c.k for c in settings.clusters], [c.components for c in settings.clusters]) == (200, 5, 0.05, [6, 6, 4], [10, 10, 8])
    assert Settings() == Settings(rounds=200, depth=5, rate=0.05, clusters=[Clusters(8, 10)])


def test_windows_fitted_together_answer_as_alone(spark):
    windows = dealt(spark, panel())
    names = [r["window"] for r in windows.where("test").select("window").distinct().orderBy("window").collect()]
    of = lambda rows: sorted((r["window"], r["symbol"], r["t"], r["regime"], r["predicted"], round(r["p_up"], 9)) for r in window_classes.walk(rows, FEATURES, ["symbol", "t"], FEW).collect())
    assert len(names) > 1 and of(windows) == [r for w in names for r in of(windows.where(f"window = {w}"))]
