"""Order book, derivative ticker and liquidation columns of bars, and the features made of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..sources.driver_tables import DAY
from . import windows as W
from .bars import EPS, bar_of

DEPTHS = (1, 3, 5)
TICKER = ("mark_price", "index_price", "open_interest", "funding_rate")
LIQUIDATIONS = ("liq_total_count", "liq_long_count", "liq_short_count", "liq_long_notional", "liq_short_notional")
#: Columns that are known one bar later only.
LATE = ("spread", "relative_spread", "microprice", "microprice_vs_mid", *(f"depth_imbalance_L{n}" for n in DEPTHS), *(f"ofi_L{n}" for n in DEPTHS), "ofi_agg", "basis_pct", "funding_rate")
KEY_SIGNALS = ("trade_imbalance", "ofi_agg", "depth_imbalance_L5", "relative_spread", "dollar_tsi", "kyle_lambda")


def present_sum(values: list[Column]) -> Column:
    """Sum of what is there; 0 of nothing."""
    return reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in values])


def present_mean(values: list[Column]) -> Column:
    """Mean of what is there; null of nothing."""
    known = reduce(lambda a, b: a + b, [v.isNotNull().cast("int") for v in values])
    return W.ratio(present_sum(values), known)


def not_below_zero(x: Column) -> Column:
    """greatest() would pass over nulls."""
    return F.when(x < 0, 0.0).otherwise(x)


def level_columns(levels: int) -> list[str]:
    return [f"{side}_{i}_qty" for side in ("bids", "asks") for i in range(levels)]


def with_streams(bars: DataFrame, books: DataFrame, tickers: DataFrame, liquidations: DataFrame, seconds: int, levels: int = 5) -> DataFrame:
    """bars (on a full grid, with day) with the last book sizes and ticker of each bar, carried on within the day, and the liquidations in it.

    The three streams are aggregated as one union, so that there is one shuffle of events and one join with the bars.
    Counts and notionals of a bar without liquidations are 0. A liquidation with side buy counts as long.
    """
    sizes = level_columns(levels)
    flows = liquidations.select("symbol", "us", "seq", F.lower("side").isin("buy", "b").alias("is_long"), F.col("amount").alias("liq_amount"), (F.col("price") * F.col("amount")).alias("notional"))
    events = books.select("symbol", "us", "seq", *sizes).unionByName(tickers.select("symbol", "us", "seq", *TICKER), allowMissingColumns=True).unionByName(flows, allowMissingColumns=True)
    when = F.struct("us", "seq")
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), when)).alias(c) for c in (*sizes, *TICKER)]
    count = lambda which: F.count(F.when(which, F.col("liq_amount"))).cast("double")
    known = F.col("is_long").isNotNull()
    made = [count(known), count(F.col("is_long")), count(~F.col("is_long")), F.sum(F.when(F.col("is_long"), F.col("notional"))), F.sum(F.when(~F.col("is_long"), F.col("notional")))]
    by_bar = events.groupBy("symbol", bar_of(F.col("us"), seconds).alias("t")).agg(*last, *[x.alias(c) for c, x in zip(LIQUIDATIONS, made, strict=True)])
    met, w = bars.join(by_bar, ["symbol", "t"], "left"), W.series("symbol", "day")
    carried = met.select(*bars.columns, *[W.fill_forward(F.col(c), w).alias(c) for c in (*sizes, *TICKER)], *[F.coalesce(c, F.lit(0.0)).alias(c) for c in LIQUIDATIONS])
    depth = [present_sum([F.col(f"{side}_{i}_qty") for i in range(min(n, levels))]).alias(f"depth_{side[:3]}_L{n}") for side in ("bids", "asks") for n in DEPTHS]
    return carried.select("*", *depth)


def book_features(bars: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """Spread, mid, microprice, imbalance and order flow imbalance of three depths, and their sum."""
    w = w or W.series()
    bid, ask = F.col("bid"), F.col("ask")
    bid_size, ask_size = (not_below_zero(F.col(c)) for c in ("bid_size", "ask_size"))
    mid = (bid + ask) / 2
    micro = (bid * ask_size + ask * bid_size) / (bid_size + ask_size + EPS)
    quoted = bars.withColumns({"spread": ask - bid, "mid_price": mid, "relative_spread": (ask - bid) / (mid + EPS), "microprice": micro, "microprice_vs_mid": micro - mid})
    of = lambda side, n: F.col(f"depth_{side}_L{n}")
    step = lambda c: c - F.lag(c).over(w)
    deep = quoted.select(
        "*", *[((of("bid", n) - of("ask", n)) / (of("bid", n) + of("ask", n) + EPS)).alias(f"depth_imbalance_L{n}") for n in DEPTHS],
        *[(step(of("bid", n)) - step(of("ask", n))).alias(f"ofi_L{n}") for n in DEPTHS],
    )
    return deep.withColumn("ofi_agg", present_sum([F.col(f"ofi_L{n}") for n in DEPTHS]))


def before_funding(t: Column, hours: int = 2) -> Column:
    """1 in the hours before a settlement at 00, 08 and 16 UTC, else 0."""
    return (F.pmod(t, F.lit(8 * 3600)) >= (8 - hours) * 3600).cast("double")


def derivative_features(bars: DataFrame) -> DataFrame:
    return bars.withColumns({"basis_pct": (F.col("mark_price") - F.col("index_price")) / (F.col("index_price") + EPS) * 100, "pre_funding": before_funding(F.col("t"))})


def liquidation_features(bars: DataFrame, n: int = 60, w: WindowSpec | None = None) -> DataFrame:
    w = w or W.series()
    long, short = F.coalesce("liq_long_notional", F.lit(0.0)), F.coalesce("liq_short_notional", F.lit(0.0))
    total = bars.withColumn("liq_total_notional", long + short)
    return total.withColumns({
        "liq_burst_ratio": F.col("liq_total_notional") / (W.mean(F.col("liq_total_notional"), n, w, 1) + EPS),
        "liq_directional_imbalance": (long - short) / (F.col("liq_total_notional") + EPS),
    })


def flow_features(bars: DataFrame, n: int = 60, w: WindowSpec | None = None) -> DataFrame:
    """Signed dollars, trade intensity, price move for each unit of volume, and volume against its mean of seven bars."""
    w = w or W.series()
    return bars.withColumns({
        "trade_imbalance": F.col("imbalance"), "dollar_tsi": F.col("imbalance") * F.col("volume") * F.col("close"),
        "trade_intensity": F.col("trades") / (W.mean(F.col("trades").cast("double"), n, w, 1) + EPS),
        "kyle_lambda": F.abs(F.col("close") - F.col("open")) / (F.col("volume") + EPS), "vol_ratio": F.col("volume") / (W.mean(F.col("volume"), 7, w, 1) + EPS),
    })


def point_in_time(bars: DataFrame, columns: tuple[str, ...] = LATE, w: WindowSpec | None = None) -> DataFrame:
    """Columns that stem from the end of a bar, shown one bar later; others as they are."""
    w = w or W.series()
    return bars.withColumns({c: F.lag(c).over(w) for c in columns if c in bars.columns})


def rolling_signals(bars: DataFrame, columns: tuple[str, ...], sizes: tuple[int, ...], w: WindowSpec | None = None) -> DataFrame:
    """<column>_roll<n>_mean and _std; a quarter of the rows must be there."""
    w = w or W.series()
    made = {}
    for c in columns:
        for n in sizes:
            made[f"{c}_roll{n}_mean"] = W.mean(F.col(c), n, w, max(1, n // 4))
            made[f"{c}_roll{n}_std"] = W.std(F.col(c), n, w, max(1, n // 4))
    return bars.select("*", *[x.alias(name) for name, x in made.items()])


def anchor_features(bars: DataFrame, anchor: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """bars with returns, imbalances and spread ratio of an anchor series (t, mid_price, ...), joined by time."""
    w = w or W.series()
    read = ("mid_price", "bid_size", "ask_size", "trade_imbalance", "volume", "ofi_L1", "relative_spread", "liq_directional_imbalance")
    met = bars.join(anchor.select("t", *[F.col(c).alias(f"__{c}") for c in read]), "t", "left")
    returns = met.select("*", W.change(F.col("__mid_price"), 1, w).alias("__r1"), W.change(F.col("__mid_price"), 4, w).alias("__r4"))
    bid, ask = (not_below_zero(F.col(c)) for c in ("__bid_size", "__ask_size"))
    bought = F.least(F.greatest((F.col("__trade_imbalance") + 1) / 2 * F.col("__volume"), F.lit(0.0)), F.col("__volume"))
    clip = lambda x: F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)))
    return returns.select(
        *bars.columns, F.lag("__r1").over(w).alias("btc_mid_return_lag1"), F.lag("__r4").over(w).alias("btc_mid_return_lag4"), ((bid - ask) / (bid + ask + EPS)).alias("btc_book_imbalance_L1"),
        clip(bought / (F.col("__volume") + EPS)).alias("btc_trade_imbalance"), F.col("__ofi_L1").alias("btc_ofi_L1"),
        (F.col("__relative_spread") / (F.col("relative_spread") + EPS)).alias("btc_spread_ratio"), F.col("__liq_directional_imbalance").alias("btc_liq_directional"),
    )


def calendar(t: Column, seconds: int) -> dict[str, Column]:
    """Year and month of a bar, its end, and the hour, ISO week and weekday (Monday is 0)."""
    day = F.date_from_unix_date(F.floor(t / DAY).cast("int"))
    return {"year": F.year(day), "month": F.month(day), "close_timestamp": t + seconds, "hour": F.floor(F.pmod(t, F.lit(DAY)) / 3600).cast("int"), "iso_week": F.weekofyear(day), "weekday": F.weekday(day)}
