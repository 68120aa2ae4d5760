"""Statistics of pairs of price series and of their trading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import windows as W

DAY = 86_400


def aligned(prices: DataFrame) -> DataFrame:
    """pair, t, x, y (log prices): all pairs of symbols a < b, joined by time."""
    a = prices.select("t", F.col("symbol").alias("a"), F.log("close").alias("x"))
    b = prices.select("t", F.col("symbol").alias("b"), F.log("close").alias("y"))
    return a.join(b, "t").where("a < b").select(F.concat_ws("/", "a", "b").alias("pair"), "t", "x", "y")


def hedged(pairs: DataFrame) -> DataFrame:
    """pairs with the least-squares hedge of each pair (1 with fewer than 10 rows) and the spread y - hedge x - base."""
    fits = pairs.groupBy("pair").agg(F.count("x").alias("n"), F.regr_slope("y", "x").alias("s"), F.avg("x").alias("mx"), F.avg("y").alias("my"))
    hedge = F.when(F.col("n") >= 10, F.coalesce("s", F.lit(1.0))).otherwise(1.0)
    fits = fits.select("pair", hedge.alias("hedge"), (F.col("my") - hedge * F.col("mx")).alias("base"))
    return pairs.join(fits, "pair").select("pair", "t", "x", "y", "hedge", (F.col("y") - F.col("hedge") * F.col("x") - F.col("base")).alias("spread"))


def reversion(spreads: DataFrame) -> DataFrame:
    """Mean-reverting fit of each spread from the regression of its change on its level: speed, level, deviation, half-life."""
    w = W.series("pair")
    steps = spreads.select("pair", F.lag("spread").over(w).alias("s"), (F.col("spread") - F.lag("spread").over(w)).alias("d")).where("s is not null and d is not null")
    fit = steps.groupBy("pair").agg(F.count("s").alias("n"), F.regr_slope("d", "s").alias("b"), F.avg("s").alias("ms"), F.avg("d").alias("md"), F.var_pop("d").alias("vd"), F.var_pop("s").alias("vs"))
    residual = F.col("vd") - F.col("b") * F.col("b") * F.col("vs")
    speed = -F.col("b")
    return fit.select("pair", "n", speed.alias("speed"), W.ratio(F.col("md") - F.col("b") * F.col("ms"), speed).alias("level"), F.sqrt(F.greatest(residual, F.lit(0.0))).alias("deviation"), F.when(speed > 0, 0.6931471805599453 / speed).alias("half_life"))


def scored(spreads: DataFrame, n: int = 96) -> DataFrame:
    w = W.series("pair")
    return spreads.select("*", W.ratio(F.col("spread") - W.mean(F.col("spread"), n, w), W.std(F.col("spread"), n, w)).alias("z"))


def gains(rows: DataFrame, fee: float, by: str = "pair") -> DataFrame:
    """What the position of the row before earns on the spread's change, less the fee for each unit of change in position."""
    w = W.series(by)
    before = F.coalesce(F.lag("position").over(w), F.lit(0.0))
    moved = F.coalesce(F.col("spread") - F.lag("spread").over(w), F.lit(0.0))
    return rows.select("*", (before * moved - F.abs(F.col("position") - before) * fee).alias("gain"))


def daily(rows: DataFrame, by: str = "pair") -> DataFrame:
    return rows.groupBy(by, (F.col("t") - F.pmod("t", F.lit(DAY))).alias("day")).agg(F.sum("gain").alias("gain"))


def performance(days: DataFrame, by: str = "pair", per_year: float = 365.0) -> DataFrame:
    """Total gain, Sharpe ratio and deepest drawdown of each series of daily gains."""
    w = W.series(by, order="day")
    equity = days.select(by, "day", "gain", F.sum("gain").over(W.so_far(w)).alias("e"))
    under = equity.withColumn("u", F.col("e") - F.max("e").over(W.so_far(w)))
    return under.groupBy(by).agg(F.count("gain").alias("days"), F.sum("gain").alias("total"), (W.ratio(F.avg("gain"), F.stddev_samp("gain")) * per_year**0.5).alias("sharpe"), F.min("u").alias("drawdown"))


def walk_forward(rows: DataFrame, lookback: int, step: int, at: str = "t") -> DataFrame:
    """Each row once for every window (start, and whether the row is in its past `lookback` or its next `step`) it belongs to.

    Windows start every `step` after 1970, so the assignment needs no pass over the data; a row meets lookback / step + 1 windows.
    """
    past = -(-lookback // step)
    first = F.col(at) - F.pmod(F.col(at), F.lit(step))
    spread = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(past))).alias("__k")).select(*rows.columns, (first + F.col("__k") * step).alias("window"))
    return spread.where(F.col(at) >= F.col("window") - lookback).select("*", (F.col(at) >= F.col("window")).alias("test"))


def stable(history: DataFrame, last: int, least_ratio: float) -> DataFrame:
    """Pairs whose last windows all reach a ratio of speed to deviation."""
    w = W.series("pair", order="window").orderBy(F.desc("window"))
    recent = history.select("*", F.row_number().over(w).alias("__n")).where(F.col("__n") <= last)
    return recent.groupBy("pair").agg(F.count(F.lit(1)).alias("windows"), F.min(W.ratio(F.col("speed"), F.col("deviation"))).alias("worst")).where((F.col("windows") == last) & (F.col("worst") >= least_ratio))


def sweep(scored_rows: DataFrame, enters: list[float], fees: list[float]) -> DataFrame:
    """Every row for every setting (enter, fee); a fixed, small grid."""
    grid = F.array(*[F.struct(F.lit(e).alias("enter"), F.lit(f).alias("fee")) for e in enters for f in fees])
    return scored_rows.select("*", F.explode(grid).alias("s")).select(*scored_rows.columns, "s.enter", "s.fee")


def threshold_position(z: Column, enter: Column) -> Column:
    return F.when(z > enter, -1.0).when(z < -enter, 1.0).otherwise(0.0)


def detrended(spreads: DataFrame, least: int = 20, by: str = "pair") -> DataFrame:
    """spreads with trend, drift (for each row) and base of a straight line in the row number; unchanged with fewer than `least` values."""
    rows = spreads.withColumn("__n", (F.row_number().over(W.series(by)) - 1).cast("double"))
    fit = rows.groupBy(by).agg(F.count("spread").alias("k"), F.regr_slope("spread", "__n").alias("s"), F.regr_intercept("spread", "__n").alias("i"))
    enough = F.col("k") >= least
    fit = fit.select(by, F.when(enough, F.col("s")).otherwise(0.0).alias("drift"), F.when(enough, F.col("i")).otherwise(0.0).alias("base"))
    return rows.join(fit, by).select(*spreads.columns, "drift", "base", (F.col("spread") - F.col("base") - F.col("drift") * F.col("__n")).alias("trendless"))


def basket(prices: DataFrame, weights: DataFrame) -> DataFrame:
    """basket, t, spread: weighted log prices; the weights of what has a price at that time are scaled to an absolute sum of 1."""
    met = prices.where("close > 0").join(F.broadcast(weights), "symbol")  # a weight for each symbol of a basket
    sums = met.groupBy("basket", "t").agg(F.sum(F.col("weight") * F.log("close")).alias("s"), F.sum(F.abs("weight")).alias("w"))
    return sums.select("basket", "t", W.ratio(F.col("s"), F.col("w")).alias("spread"))


def whole_sample_score(spreads: DataFrame, by: str = "pair") -> DataFrame:
    """z against mean and deviation of the whole series: it looks ahead, and only serves to rank."""
    fit = spreads.groupBy(by).agg(F.avg("spread").alias("__m"), F.stddev_pop("spread").alias("__d"))
    return spreads.join(fit, by).select(*spreads.columns, W.ratio(F.col("spread") - F.col("__m"), F.col("__d")).alias("z"))


def confirmed_entries(rows: DataFrame, n: int = 2, by: str = "pair") -> DataFrame:
    """position 0 at entries before which the score z did not come back for n rows on end."""
    w = W.series(by)
    before = F.coalesce(F.lag("position").over(w), F.lit(0.0))
    back = F.lit(True)
    for i in range(n):
        late, early = F.lag("z", i).over(w), F.lag("z", i + 1).over(w)
        back = back & F.when(F.col("position") > 0, late > early).otherwise(late < early)
    entry = (before == 0) & (F.col("position") != 0) & F.lag("z", n).over(w).isNotNull() & F.lag(F.lit(1), n).over(w).isNotNull()
    return rows.withColumn("position", F.when(entry & ~F.coalesce(back, F.lit(False)), 0.0).otherwise(F.col("position")))


def by_year(days: DataFrame, by: str = "pair", per_year: float = 365.0) -> DataFrame:
    """Gain, Sharpe ratio and drawdown of each calendar year."""
    dated = days.withColumn("year", F.year(F.date_from_unix_date(F.floor(F.col("day") / DAY).cast("int"))))
    w = W.series(by, "year", order="day")
    equity = dated.select(by, "year", "day", "gain", F.sum("gain").over(W.so_far(w)).alias("e"))
    under = equity.withColumn("u", F.col("e") - F.max("e").over(W.so_far(w)))
    return under.groupBy(by, "year").agg(F.count("gain").alias("days"), F.sum("gain").alias("total"), (W.ratio(F.avg("gain"), F.stddev_samp("gain")) * per_year**0.5).alias("sharpe"), F.min("u").alias("drawdown"))


def best_settings(results: DataFrame, by: str = "pair", score: str = "sharpe") -> DataFrame:
    """The setting of each pair with the best score; ties go to the smaller setting."""
    others = [c for c in results.columns if c not in (by, score)]
    order = Window.partitionBy(by).orderBy(F.desc_nulls_last(score), *others)
    return results.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def holding(rows: DataFrame, by: str = "pair") -> DataFrame:
    """How often the position changes, and for how many rows on average one is held."""
    before = F.coalesce(F.lag("position").over(W.series(by)), F.lit(0.0))
    flagged = rows.select(by, (F.col("position") != before).cast("int").alias("c"), ((before == 0) & (F.col("position") != 0)).cast("int").alias("o"), (F.col("position") != 0).cast("int").alias("h"))
    return flagged.groupBy(by).agg(F.sum("c").alias("changes"), W.ratio(F.sum("h"), F.sum("o")).alias("mean_rows_held"))


def unit_root_statistic(spreads: DataFrame, by: str = "pair") -> DataFrame:
    """The t value of the level in the regression of a spread's change on its level before and its change before (one lag), from grouped sums."""
    w = W.series(by)
    d = F.col("spread") - F.lag("spread").over(w)
    rows = spreads.select(by, "t", F.lag("spread").over(w).alias("s"), d.alias("d")).select(by, "s", "d", F.lag("d").over(w).alias("l")).where("s is not null and d is not null and l is not null")
    cov = lambda a, b: F.covar_pop(a, b)
    m = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[cov(a, b).alias(a + b) for a, b in ("ss", "ll", "dd", "sl", "sd", "ld")])
    det = F.col("ss") * F.col("ll") - F.col("sl") * F.col("sl")
    b = (F.col("sd") * F.col("ll") - F.col("ld") * F.col("sl")) / F.when(det > 0, det)
    c = (F.col("ld") * F.col("ss") - F.col("sd") * F.col("sl")) / F.when(det > 0, det)
    residual = F.greatest(F.col("dd") - b * F.col("sd") - c * F.col("ld"), F.lit(0.0)) * F.col("n") / (F.col("n") - 3)
    error = F.sqrt(residual * F.col("ll") / F.when(det > 0, det) / F.col("n"))
    return m.where("n > 4").select(by, "n", b.alias("level"), W.ratio(b, error).alias("statistic"))


def break_states(rows: DataFrame, p: str = "p", threshold: float = 0.05, by: str = "pair") -> DataFrame:
    """state of each row: inactive until p first passes, cointegrated until it first fails, then recovered while it passes and broken while it fails."""
    w = W.series(by)
    passes = F.coalesce(F.col(p) < threshold, F.lit(False))
    flagged = rows.withColumn("__p", passes)
    ever = flagged.withColumn("__e", F.max(F.col("__p").cast("int")).over(W.so_far(w)))
    failed = ever.withColumn("__f", F.max(((F.col("__e") == 1) & ~F.col("__p")).cast("int")).over(W.so_far(w)))
    state = F.when(F.col("__e") == 0, "inactive").when(F.col("__f") == 0, "cointegrated").when(F.col("__p"), "recovered").otherwise("broken")
    return failed.select(*rows.columns, state.alias("state"))


def both_recovered(quick: DataFrame, slow: DataFrame, by: str = "pair", order: str = "t") -> DataFrame:
    """quick with slow_state, the state of the slower frame at the same time, and tradeable, true where both have recovered."""
    other = slow.select(by, order, F.col("state").alias("slow_state"))
    both = (F.col("state") == "recovered") & F.coalesce(F.col("slow_state") == "recovered", F.lit(False))
    return quick.join(other, [by, order], "left").withColumn("tradeable", both)
