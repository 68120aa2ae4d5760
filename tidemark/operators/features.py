"""Features of bars: prices, quotes, flows, and finite-window indicators. All windows of one call share one sort by series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..sources.driver_tables import DAY
from . import windows as W

EPS = 1e-10


def price_features(bars: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """Range, place within the range, lagged returns and volume changes."""
    w = w or W.series()
    span = F.col("high") - F.col("low")
    rows = {
        "range_pct": W.ratio(span, F.col("close")), "open_close_pct": W.ratio(F.col("close"), F.col("open")) - 1, "close_in_range": (F.col("close") - F.col("low")) / (span + EPS),
        **{f"return_{n}": W.change(F.col("close"), n, w) for n in (1, 2, 3)},
        "volume_change": W.change(F.col("volume"), 1, w), "volume_ratio": W.ratio(F.col("volume"), W.mean(F.col("volume"), 7, w, 1)),
    }
    return bars.select("*", *[x.alias(name) for name, x in rows.items()])


def quote_features(bars: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """Spread, mid, microprice, size imbalance and order flow imbalance, then shown one bar later, as they are known."""
    w = w or W.series()
    bid, ask = F.col("bid"), F.col("ask")
    bid_size, ask_size = (F.when(F.col(c) < 0, 0.0).otherwise(F.col(c)) for c in ("bid_size", "ask_size"))
    mid = (bid + ask) / 2
    micro = (bid * ask_size + ask * bid_size) / (bid_size + ask_size + EPS)
    raw = bars.select("*", mid.alias("mid"), (ask - bid).alias("__spread"), micro.alias("__micro"), ((bid_size - ask_size) / (bid_size + ask_size + EPS)).alias("__book"), ((F.col("bid_size") - F.lag("bid_size").over(w)) - (F.col("ask_size") - F.lag("ask_size").over(w))).alias("__ofi"))
    known = lambda c: F.lag(c).over(w)
    return raw.select(*bars.columns, "mid", known("__spread").alias("spread"), known(F.col("__spread") / F.col("mid")).alias("relative_spread"), known(F.col("__micro") - F.col("mid")).alias("micro_gap"), known("__book").alias("book_imbalance"), known("__ofi").alias("order_flow"))


def flow_features(bars: DataFrame, n: int = 60, w: WindowSpec | None = None) -> DataFrame:
    """Trade intensity, price impact, and rolling mean and deviation of the imbalance."""
    w = w or W.series()
    signed = F.col("buy_volume") - F.col("sell_volume")
    move = F.abs(F.col("close") - F.lag("close").over(w))
    return bars.select(
        "*", (F.col("trades") / (W.mean(F.col("trades").cast("double"), n, w, 1) + EPS)).alias("intensity"), (move / (F.abs(signed) + EPS)).alias("impact"),
        W.mean(F.col("imbalance"), n, w, max(1, n // 4)).alias("imbalance_mean"), W.std(F.col("imbalance"), n, w, max(2, n // 4)).alias("imbalance_std"),
    )


def clock_features(t: Column, bar: int, period: int) -> dict[str, Column]:
    """Place of a bar's end within the period, and whether 8-hourly funding is at most two hours away."""
    into = F.pmod(t + bar, F.lit(period))
    hour = F.floor(F.pmod(t, F.lit(DAY)) / 3600)
    return {"cycle_progress": into / period, "secs_to_boundary": F.pmod(F.lit(period) - into, F.lit(period)), "before_funding": F.pmod(F.lit(8) - F.pmod(hour, F.lit(8)), F.lit(8)).between(1, 2)}


def indicators(bars: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """Indicators with a finite window, in window SQL alone."""
    w = w or W.series()
    o, h, low, c, v = (F.col(x) for x in ("open", "high", "low", "close", "volume"))
    typical = (h + low + c) / 3
    hi = lambda n: W.enough(F.max(h).over(W.last_rows(n, w)), h, W.last_rows(n, w), n)
    lo = lambda n: W.enough(F.min(low).over(W.last_rows(n, w)), low, W.last_rows(n, w), n)
    base = bars.select(
        "*", typical.alias("__tp"), F.lag(c).over(w).alias("__pc"), (typical * v).alias("__flow"), F.lag(typical).over(w).alias("__ptp"),
        W.ratio(100 * (c - lo(5)), hi(5) - lo(5)).alias("__k"), W.mean(typical, 14, w).alias("__tpm"), F.collect_list(typical).over(W.last_rows(14, w)).alias("__tps"), (c - F.lag(c).over(w)).alias("__d"),
    )
    up = F.sum(F.when(F.col("__tp") > F.col("__ptp"), F.col("__flow")).otherwise(0.0)).over(W.last_rows(14, w))
    down = F.sum(F.when(F.col("__tp") < F.col("__ptp"), F.col("__flow")).otherwise(0.0)).over(W.last_rows(14, w))
    apart = F.aggregate("__tps", F.lit(0.0), lambda a, x: a + F.abs(x - F.col("__tpm"))) / 14
    true_low, true_high = F.least("low", "__pc"), F.greatest("high", "__pc")
    buying = lambda n: W.ratio(F.sum(F.when(F.col("__pc").isNotNull(), c - true_low)).over(W.last_rows(n, w)), F.sum(F.when(F.col("__pc").isNotNull(), true_high - true_low)).over(W.last_rows(n, w)))
    whole = lambda x, n: W.enough(x, F.col("__pc"), W.last_rows(n, w), n)
    sma20, dev20 = W.mean(c, 20, w), W.enough(F.stddev_pop(c).over(W.last_rows(20, w)), c, W.last_rows(20, w), 20)
    gain, loss = F.sum(F.greatest("__d", F.lit(0.0))).over(W.last_rows(14, w)), F.sum(F.greatest(-F.col("__d"), F.lit(0.0))).over(W.last_rows(14, w))
    return base.select(
        *bars.columns, *[W.mean(c, n, w).alias(f"sma_{n}") for n in (7, 25)], (c - F.lag(c, 10).over(w)).alias("momentum"), (100 * W.change(c, 10, w)).alias("rate_of_change"),
        W.ratio(-100 * (hi(14) - c), hi(14) - lo(14)).alias("williams_r"), W.ratio(F.col("__tp") - F.col("__tpm"), 0.015 * apart).alias("cci"),
        (sma20 + 2 * dev20).alias("band_upper"), (sma20 - 2 * dev20).alias("band_lower"), W.mean(F.col("__k"), 3, w).alias("stochastic_k"),
        whole(W.ratio(100 * up, up + down), 14).alias("money_flow"), W.ratio(c - o, h - low).alias("balance_of_power"),
        whole(100 * (4 * buying(7) + 2 * buying(14) + buying(28)) / 7, 28).alias("ultimate"), whole(W.ratio(100 * gain, gain + loss), 14).alias("simple_rsi"),
        F.sum(F.sign("__d") * v).over(W.so_far(w)).alias("on_balance_volume"),
        F.sqrt(W.mean(F.pow(F.log(F.when((low > 0) & (h > 0), h / F.when(low > 0, low))), F.lit(2.0)), 14, w) / (4 * 0.6931471805599453)).alias("parkinson"),
    )


def against_anchor(bars: DataFrame, anchor: DataFrame, n: int, w: WindowSpec | None = None) -> DataFrame:
    """Rolling beta, correlation and relative strength to an anchor series (t, close), joined by time."""
    w = w or W.series()
    met = bars.join(anchor.select("t", F.col("close").alias("__a")), "t", "left")
    returns = met.select("*", W.change(F.col("close"), 1, w).alias("__r"), W.change(F.col("__a"), 1, w).alias("__ar"))
    return returns.select(*bars.columns, W.beta(F.col("__r"), F.col("__ar"), n, w).alias("beta"), W.correlation(F.col("__r"), F.col("__ar"), n, w).alias("correlation"), (F.log("close") - F.log("__a")).alias("log_spread"), (F.col("__r") - F.col("__ar")).alias("relative_strength"))


def lagged_features(bars: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """Past returns of close and volume (1 to 3 rows ago; none over a bar without volume), and ratios to the last 7 rows.

    Buy pressure, quote volume ratio and trade intensity only where bars have the columns they read.
    """
    w, there = w or W.series(), set(bars.columns)
    known = bars.select("*", W.change(F.col("close"), 1, w).alias("__r"), W.change(F.col("volume"), 1, w).alias("__v"))
    against = lambda c: F.col(c) / (W.mean(F.col(c).cast("double"), 7, w, 1) + 1e-8)
    made = {f"ret_lag{n}": F.lag("__r", n).over(w) for n in (1, 2, 3)} | {f"vol_ret_lag{n}": F.lag("__v", n).over(w) for n in (1, 2, 3)} | {"vol_ratio": against("volume")}
    if "quote_volume" in there:
        made["quote_vol_ratio"] = against("quote_volume")
        if "taker_buy_quote_volume" in there:
            made["buy_pressure"] = F.col("taker_buy_quote_volume") / (F.col("quote_volume") + 1e-8)
        if "number_of_trades" in there:
            made["trade_intensity"] = against("number_of_trades")
    return known.select(*bars.columns, *[x.alias(name) for name, x in made.items()])


def anchor_lags(bars: DataFrame, anchor: DataFrame, windows: tuple[int, ...], prefix: str, w: WindowSpec | None = None) -> DataFrame:
    """bars with past returns, range ratio and distance from its mean of an anchor series (t, close, atr, mean_close), and what
    a series does against it: correlation of returns over each window, distance from its hedge, and strength over the shortest window.

    All returns are those up to the row itself; the hedge is the rolling slope of close on the anchor's close over the longest window.
    """
    w, long, short = w or W.series(), max(windows), min(windows)
    alone = W.Window.orderBy("t")  # one series: the anchor's
    c = F.col("close")
    shown = anchor.select("t", F.col("close").alias("__a"), W.change(c, 1, alone).alias("__ar"), W.ratio(F.col("atr"), W.mean(F.col("atr"), long, alone, 1)).alias(f"{prefix}_atr_ratio"), (c - F.col("mean_close")).alias(f"{prefix}_close_vs_ma"))
    shown = shown.select("*", *[F.lag("__ar", n).over(alone).alias(f"{prefix}_ret_lag{n}") for n in (1, 2, 3)])
    met = bars.join(shown, "t", "left").withColumn("__r", W.change(c, 1, w))
    total = lambda x: W.enough(F.sum(x).over(W.last_rows(short, w)), F.col(x), W.last_rows(short, w), short)
    return met.select(
        *bars.columns, *[f"{prefix}_{x}" for x in ("ret_lag1", "ret_lag2", "ret_lag3", "atr_ratio", "close_vs_ma")], *[W.correlation(F.col("__r"), F.col("__ar"), n, w).alias(f"{prefix}_corr_{n}") for n in windows],
        (c - W.beta(c, F.col("__a"), long, w) * F.col("__a")).alias(f"{prefix}_spread"), (total("__r") - total("__ar")).alias(f"{prefix}_rel_strength"),
    )
