"""Walk-forward trading of pairs: a window's past fits the hedge and the rules, the rows after it are traded by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import pairs, sequential
from . import windows as W

LADDERS = ("none", "linear", "steep")


def fitted_windows(aligned: DataFrame, lookback: int, step: int) -> tuple[DataFrame, DataFrame]:
    """The past rows of each window with their spread (pair, window, t, spread), and its fit: hedge, base, n, speed, deviation, half_life, width.

    width is the sample deviation of the past spread, whose mean is zero. Windows without a past have no fit.
    """
    past = pairs.walk_forward(aligned, lookback, step).where("not test")
    own = ["pair", "window"]
    keyed = past.select(F.concat_ws("|", "pair", F.col("window").cast("string")).alias("pair"), "t", "x", "y")
    spreads = pairs.hedged(keyed)
    base = (F.first("y") - F.first("hedge") * F.first("x") - F.first("spread")).alias("base")
    widths = spreads.groupBy("pair").agg(F.first("hedge").alias("hedge"), base, F.stddev_samp("spread").alias("width"))
    split = lambda df: df.withColumns({"window": F.substring_index("pair", "|", -1).cast("long"), "pair": F.substring_index("pair", "|", 1)})
    fits = split(widths.join(pairs.reversion(spreads), "pair", "left"))
    return split(spreads.select("pair", "t", "spread")), fits.select(*own, "hedge", "base", "n", "speed", "deviation", "half_life", "width")


def traded(aligned: DataFrame, fits: DataFrame, step: int, enter: float = 2.0, leave: float = 0.5, stop: float = 0.0, longest: int = 0, rungs: int = 1, rung_step: float = 0.5, ladder: str = "none", most_half_life: float = 500.0, fee: float = 0.0005) -> DataFrame:
    """pair, window, t, spread, z, position, gain of each row under the fit of its own window.

    Windows whose past does not revert are left out; where it reverts too slowly nothing is held. A position starts from nothing in each window,
    earns on the next row's move and pays the fee for both legs.
    """
    if ladder not in LADDERS:
        raise ValueError(f"a ladder is one of {LADDERS}, not {ladder!r}")
    window = F.col("t") - F.pmod(F.col("t"), F.lit(step))
    live = fits.where("speed > 0").select("pair", "window", "hedge", "base", "width", "half_life")
    rows = aligned.withColumn("window", window).join(live, ["pair", "window"])
    spread = F.col("y") - F.col("hedge") * F.col("x") - F.col("base")
    slow = F.col("half_life") > most_half_life
    rows = rows.select("pair", "window", "t", spread.alias("spread"), W.ratio(spread, F.col("width")).alias("z"), slow.alias("__slow"))
    by = ("pair", "window")
    if ladder == "none" or rungs <= 1:
        held = sequential.positions_by_score(rows, enter=enter, leave=leave, stop=stop, longest=longest, by=by)
    else:
        held = sequential.laddered_positions(rows, enter=enter, leave=leave, stop=stop, longest=longest, rungs=rungs, step=rung_step, steep=ladder == "steep", by=by)
    held = held.withColumn("position", F.when(F.col("__slow"), 0.0).otherwise(F.col("position"))).drop("__slow")
    w = W.series(*by)
    before = F.coalesce(F.lag("position").over(w), F.lit(0.0))
    moved = F.coalesce(F.col("spread") - F.lag("spread").over(w), F.lit(0.0))
    return held.select("*", (before * moved - F.abs(F.col("position") - before) * 2 * fee).alias("gain"))


def outcome(rows: DataFrame, fits: DataFrame, per_year: float = 365.0) -> DataFrame:
    """pair, days, total, sharpe, drawdown, trades, windows, mean_half_life of traded rows. Days without rows do not count."""
    w = W.series("pair", "window")
    changes = rows.select("pair", (F.col("position") != F.coalesce(F.lag("position").over(w), F.lit(0.0))).cast("int").alias("c"))
    trades = changes.groupBy("pair").agg(F.sum("c").alias("trades"))
    known = rows.select("pair", "window").distinct().join(fits.select("pair", "window", "half_life"), ["pair", "window"]).groupBy("pair").agg(F.count(F.lit(1)).alias("windows"), F.avg("half_life").alias("mean_half_life"))
    return pairs.performance(pairs.daily(rows), per_year=per_year).join(trades, "pair").join(known, "pair")


def window_history(fits: DataFrame, tests: DataFrame, rows: DataFrame) -> DataFrame:
    """pair, window, p, speed, deviation, hedge, sharpe of each window that has been traded: tests have p (1 where it is missing), rows are the traded ones."""
    days = pairs.daily(rows.withColumn("pair", F.concat_ws("|", "pair", F.col("window").cast("string"))))
    ratio = F.coalesce(W.ratio(F.avg("gain"), F.stddev_samp("gain")), F.lit(0.0))
    sharpes = days.groupBy("pair").agg(ratio.alias("sharpe")).select(F.substring_index("pair", "|", 1).alias("pair"), F.substring_index("pair", "|", -1).cast("long").alias("window"), "sharpe")
    met = fits.join(tests, ["pair", "window"], "left").join(sharpes, ["pair", "window"])
    return met.select("pair", "window", F.coalesce("p", F.lit(1.0)).alias("p"), "speed", "deviation", "hedge", "sharpe")


def tradeable_pairs(history: DataFrame, last: int = 3, most_p: float = 0.05, least_ratio: float = 0.5, most_drift: float = 0.2, least_sharpe: float = 0.0, top: int = 0) -> DataFrame:
    """pair, ratio, place: pairs that are stable over their `last` windows, the fastest against their deviation first (at most top, if not 0).

    All p below most_p, no hedge moved by more than most_drift of the one before (or from 0), and in the last window speed / deviation and Sharpe
    ratio at their floors or above. Equal ratios go by name.
    """
    w = W.series("pair", order="window")
    drift = W.ratio(F.abs(F.col("hedge") - F.lag("hedge").over(w)), F.abs(F.lag("hedge").over(w)))
    back = F.row_number().over(Window.partitionBy("pair").orderBy(F.desc("window")))
    rows = history.select("*", F.coalesce(W.ratio(F.col("speed"), F.col("deviation")), F.lit(0.0)).alias("__ratio"), drift.alias("__drift"), back.alias("__n")).where(F.col("__n") <= last)
    steady = F.col("__n") == last  # the first of them has no predecessor among them
    at_end = lambda c: F.max(F.when(F.col("__n") == 1, F.col(c)))
    judged = rows.groupBy("pair").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(F.col("p") < most_p, F.lit(False))).alias("tested"), F.bool_and(steady | F.coalesce(F.col("__drift") <= most_drift, F.lit(False))).alias("steady"), at_end("__ratio").alias("ratio"), at_end("sharpe").alias("sharpe"),
    )
    good = judged.where((F.col("n") == last) & F.col("tested") & F.col("steady") & (F.col("ratio") >= least_ratio) & (F.col("sharpe") >= least_sharpe))
    placed = good.select("pair", "ratio", F.row_number().over(Window.orderBy(F.desc("ratio"), "pair")).alias("place"))  # a row for each pair
    return placed.where(F.col("place") <= top) if top else placed
