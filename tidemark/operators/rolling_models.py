"""Regressors fitted anew for each walk-forward window of months, over the pooled rows of all series.

A window is `size` consecutive months that have rows: all but the last train, the last tests. Everything a model takes
from data (which features exist, their rank correlations, medians, quartiles, cross moments) is an aggregate over a window's
training rows; test rows only meet finished coefficients. All windows are fitted in the same few jobs: a row is dealt to its
windows once, features are aggregated by (window, feature, value), and what is solved is one small matrix a window.

Missing features count as the training median. A row without target takes no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settled
from . import windows as W

#: Blocks of values that ranks are counted in, so that no task sorts all values of a feature.
BLOCKS = 64


def month_of(t: Column) -> Column:
    """Months since year 0 of a time in seconds."""
    day = F.date_from_unix_date(F.floor(t / 86_400).cast("int"))
    return F.year(day) * 12 + F.month(day) - 1


def period_windows(rows: DataFrame, size: int, period: Column) -> DataFrame:
    """Each row once for every window it belongs to: window (the test period) and test. Periods without rows are no part of a window."""
    known = rows.withColumn("__period", period)
    # A row for each calendar period: one small window over them.
    periods = known.select("__period").distinct().withColumn("__k", F.row_number().over(Window.orderBy("__period")))
    later = periods.select(F.col("__k").alias("__last"), F.col("__period").alias("window"))
    windows = periods.join(later, (F.col("__k") <= F.col("__last")) & (F.col("__k") > F.col("__last") - size) & (F.col("__last") >= size))
    return known.join(F.broadcast(windows), "__period").select(*rows.columns, "window", (F.col("__period") == F.col("window")).alias("test"))


def monthly_windows(rows: DataFrame, size: int, at: str = "t") -> DataFrame:
    return period_windows(rows, size, month_of(F.col(at)))


def long_features(dealt: DataFrame, features: list[str], target: str, keep: list[str]) -> DataFrame:
    """keep, window, feature, x (null in place of NaN and infinities) and y."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), W.finite(F.col(c).cast("double")).alias("x")) for c in features])
    return dealt.select(*keep, "window", F.col(target).alias("y"), F.explode(pairs).alias("__f")).select(*keep, "window", "__f.feature", "__f.x", "y")


def distributions(values: DataFrame, by: list[str], x: str) -> DataFrame:
    """by, x, n (rows with that value), before (rows below it) and total, for each distinct value.

    Values are counted first, so a value that many rows share is one row; counts are summed up within blocks of values,
    and the blocks' totals are added in front.
    """
    there = values.where(F.col(x).isNotNull())
    edges = there.groupBy(*by[1:]).agg(F.percentile_approx(x, [i / BLOCKS for i in range(1, BLOCKS)], 1000).alias("__edges"))
    counted = there.groupBy(*by, x).agg(F.count(F.lit(1)).alias("n"))
    counted = counted.join(F.broadcast(edges), by[1:]) if by[1:] else counted.crossJoin(F.broadcast(edges))
    blocked = counted.withColumn("__block", F.size(F.filter("__edges", lambda e: e < F.col(x)))).drop("__edges")
    inside = F.sum("n").over(Window.partitionBy(*by, "__block").orderBy(x).rowsBetween(Window.unboundedPreceding, -1))
    rows = blocked.withColumn("__inside", F.coalesce(inside, F.lit(0)))
    over = Window.partitionBy(*by)
    sums = blocked.groupBy(*by, "__block").agg(F.sum("n").alias("__n"))
    offsets = sums.select(*by, "__block", F.coalesce(F.sum("__n").over(over.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__front"), F.sum("__n").over(over).alias("total"))
    return rows.join(offsets, [*by, "__block"]).select(*by, x, "n", (F.col("__inside") + F.col("__front")).alias("before"), "total")


def quantiles(spread: DataFrame, by: list[str], x: str, wanted: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles from `distributions`."""

    def at(index: Column) -> Column:
        return F.max(F.when((F.col("before") <= index) & (index < F.col("before") + F.col("n")), F.col(x)))

    out = []
    for name, q in wanted.items():
        place = (F.col("total") - 1) * q
        low, high = at(F.floor(place)), at(F.ceil(place))
        out.append((low + (high - low) * F.max(place - F.floor(place))).alias(name))
    return spread.groupBy(*by).agg(*out)


def rank_correlations(train: DataFrame, least: int = 3) -> DataFrame:
    """window, feature, n, ic: Spearman's correlation of x and y over a window's rows that have both, ties at their mean rank.

    train: window, feature, x, y. Null where x or y is constant or rows are too few.
    """
    both = train.where("x is not null and y is not null").select("window", "feature", "x", "y")
    ranks = lambda c: distributions(both, ["window", "feature"], c).select("window", "feature", c, (F.col("before") + (F.col("n") + 1) / 2).alias(f"r{c}"))
    ranked = both.join(ranks("x"), ["window", "feature", "x"]).join(ranks("y"), ["window", "feature", "y"])
    spread = F.stddev_pop("rx") * F.stddev_pop("ry")
    return ranked.groupBy("window", "feature").agg(F.count(F.lit(1)).alias("n"), W.ratio(F.covar_pop("rx", "ry"), spread).alias("ic")).select("window", "feature", "n", F.when(F.col("n") >= least, F.col("ic")).alias("ic"))


def chosen_features(train: DataFrame, top: int | None) -> DataFrame:
    """window, place, feature, median, scale of the features with the largest absolute rank correlation in training; features that are never there are left out.

    scale: the distance between the quartiles, 1 where it is zero. Equal correlations go by name, missing ones come last.
    """
    spread = distributions(train.select("window", "feature", "x"), ["window", "feature"], "x")
    scales = quantiles(spread, ["window", "feature"], "x", {"median": 0.5, "__low": 0.25, "__high": 0.75})
    scale = F.col("__high") - F.col("__low")
    scales = scales.select("window", "feature", "median", F.when(scale > 0, scale).otherwise(1.0).alias("scale"))
    order = Window.partitionBy("window").orderBy(F.desc_nulls_last(F.abs("ic")), "feature")
    placed = scales.join(rank_correlations(train), ["window", "feature"], "left").withColumn("place", F.row_number().over(order))
    return (placed if top is None else placed.where(F.col("place") <= top)).select("window", "place", "feature", "median", "scale", "ic")


def scaled_rows(dealt: DataFrame, chosen: DataFrame, features: list[str]) -> DataFrame:
    """dealt with z: the window's chosen features in their order, imputed and scaled. chosen is a few rows a window and broadcast."""
    plan = chosen.groupBy("window").agg(F.array_sort(F.collect_list(F.struct("place", "feature", "median", "scale"))).alias("__plan"))
    values = F.create_map(*[v for c in features for v in (F.lit(c), W.finite(F.col(c).cast("double")))])
    z = F.transform("__plan", lambda p: (F.coalesce(F.col("__values")[p["feature"]], p["median"]) - p["median"]) / p["scale"])
    return dealt.withColumn("__values", values).join(F.broadcast(plan), "window").withColumn("z", z).drop("__plan", "__values")


def ridge_fits(train: DataFrame, penalties: list[float]) -> DataFrame:
    """window, model, penalty, intercept, weights: least squares with a penalty on the squared weights (not on the intercept), from cross moments.

    train: window, z, y. A window's moments are one row; they are solved where that row lies.
    """
    named = train.select("window", F.concat(F.col("z"), F.array(F.col("y").cast("double"), F.lit(1.0))).alias("v"))
    # Scaled features lie about zero, so plain moments lose nothing. Row i of the matrix: value i times itself and all behind it.
    cells = named.select("window", "v", F.posexplode("v").alias("i", "x")).select("window", "i", F.posexplode(F.transform(F.expr("slice(v, i + 1, size(v) - i)"), lambda y: y * F.col("x"))).alias("j", "p"))
    moments = cells.groupBy("window", "i", "j").agg(F.sum("p").alias("s"))
    packed = moments.groupBy("window").agg(F.collect_list(F.struct("i", "j", "s")).alias("cells"))

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples():
                k = max(cell["i"] for cell in r.cells) - 1
                m = np.zeros((k + 2, k + 2))
                for cell in r.cells:
                    at, to = cell["i"], cell["i"] + cell["j"]
                    m[at, to] = m[to, at] = cell["s"]
                means = m[-1, :-1] / m[-1, -1]
                m = m[:-1, :-1] - m[-1, -1] * np.outer(means, means)
                for penalty in penalties:
                    weights = np.linalg.lstsq(m[:k, :k] + penalty * np.eye(k), m[:k, k], rcond=None)[0]
                    out.append((r.window, f"ridge_{penalty:g}", penalty, float(means[k] - weights @ means[:k]), weights.tolist()))
            yield pd.DataFrame(out, columns=["window", "model", "penalty", "intercept", "weights"])

    kind = train.schema["window"].dataType.simpleString()
    return packed.mapInPandas(solve, f"window {kind}, model string, penalty double, intercept double, weights array<double>")


def pooled(rows: DataFrame, features: list[str], target: str, keep: list[str], size: int = 12, top: int | None = None, penalties: tuple[float, ...] = (1.0, 100.0)) -> tuple[DataFrame, DataFrame]:
    """Predictions of the test months (keep, window, model, y, y_pred) by each window's best model, and its scores (window, model, n_test, r2, best).

    The best model has the largest share of the test month's variance explained; of equal ones the first by name.
    """
    dealt = monthly_windows(rows.where(F.col(target).isNotNull()), size)
    learned = dealt.where("not test")
    chosen = settled(chosen_features(long_features(learned, features, target, []), top), "chosen-features")
    ready = scaled_rows(dealt, chosen, features).withColumn("y", F.col(target).cast("double"))
    fits = settled(ridge_fits(ready.where("not test"), list(penalties)), "ridge-fits")
    scored = ready.where("test").join(F.broadcast(fits), "window")
    said = F.col("intercept") + F.aggregate(F.zip_with("z", "weights", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    tested = scored.select(*keep, "window", "model", "y", said.alias("y_pred"))
    apart = F.col("y") - F.col("y_pred")
    scores = tested.groupBy("window", "model").agg(F.count(F.lit(1)).alias("n_test"), (1 - W.ratio(F.avg(apart * apart), F.var_pop("y"))).alias("r2"))
    first = F.row_number().over(Window.partitionBy("window").orderBy(F.desc_nulls_last("r2"), "model"))
    scores = settled(scores.withColumn("best", (first == 1) & F.col("r2").isNotNull()), "model-scores")
    return tested.join(F.broadcast(scores.where("best").select("window", "model")), ["window", "model"]).select(*keep, "window", "model", "y", "y_pred"), scores
