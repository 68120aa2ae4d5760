"""Ticks, quotes and liquidations to uniform bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.driver_tables import DAY, floor_to
from . import windows as W
from .asof import as_of

EPS = 1e-10


def bar_of(us: Column, seconds: int) -> Column:
    return floor_to(F.floor(us / 1_000_000).cast("long"), seconds)


def trade_bars(ticks: DataFrame, seconds: int) -> DataFrame:
    """symbol, t and OHLCV with volume by side; map-side partial aggregation, ties broken by (us, seq)."""
    when = F.struct("us", "seq")
    buys = F.lower("side").isin("buy", "b")
    bars = ticks.groupBy("symbol", bar_of(F.col("us"), seconds).alias("t")).agg(
        F.min_by("price", when).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", when).alias("close"),
        F.sum("amount").alias("volume"), F.count("price").alias("trades"), F.sum(F.when(buys, F.col("amount")).otherwise(0.0)).alias("buy_volume"),
        F.sum(F.col("price") * F.col("amount")).alias("__pv"),
    )
    sells = F.col("volume") - F.col("buy_volume")
    return bars.select(
        "symbol", "t", "open", "high", "low", "close", "volume", "trades", "buy_volume", sells.alias("sell_volume"),
        (F.col("__pv") / (F.col("volume") + EPS)).alias("vwap"), ((F.col("buy_volume") - sells) / (F.col("volume") + EPS)).alias("imbalance"),
    )


def sided(ticks: DataFrame, quotes: DataFrame, positive: bool = True) -> DataFrame:
    """ticks with taker ('buy', 'sell' or null) and by ('flag', 'quote' or null): what the feed says, else the quote rule.

    A tick without a side is a buy at or above the last ask and a sale at or below the last bid before or at its time; within
    the spread, or before any quote, it stays unsided rather than be guessed. Missing quotes side nothing, and neither do
    those that are not above zero, unless positive is false.
    """
    flag = F.lower("side")
    said = F.when(flag.isin("buy", "b"), "buy").when(flag.isin("sell", "s"), "sell")
    met = as_of(ticks, quotes.select("symbol", "us", "seq", "bid", "ask"), "symbol", "us", "us", "__q_", block=DAY * 1_000_000)
    counts = lambda c: F.col(c) > 0 if positive else F.lit(True)
    rule = F.when(counts("__q_ask") & (F.col("price") >= F.col("__q_ask")), "buy").when(counts("__q_bid") & (F.col("price") <= F.col("__q_bid")), "sell")
    by = F.when(said.isNotNull(), "flag").when(rule.isNotNull(), "quote")
    return met.select(*ticks.columns, F.coalesce(said, rule).alias("taker"), by.alias("by"))


def taker_bars(sided_ticks: DataFrame, seconds: int) -> DataFrame:
    """symbol, t, OHLC, volume and quote_volume with what takers bought, trades, unsided trades, and which rules sided the bar."""
    when = F.struct("us", "seq")
    worth, bought = F.col("price") * F.col("amount"), F.col("taker") == "buy"
    return sided_ticks.groupBy("symbol", bar_of(F.col("us"), seconds).alias("t")).agg(
        F.min_by("price", when).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", when).alias("close"), F.sum("amount").alias("volume"), F.sum(worth).alias("quote_volume"), F.count("price").alias("trades"),
        F.sum(F.when(bought, F.col("amount")).otherwise(0.0)).alias("taker_buy_base"), F.sum(F.when(bought, worth).otherwise(0.0)).alias("taker_buy_quote"), F.count(F.when(F.col("taker").isNull(), 1)).alias("unsided"),
        F.coalesce(F.bool_or(F.col("by") == "flag"), F.lit(False)).alias("any_flag"), F.coalesce(F.bool_or(F.col("by") == "quote"), F.lit(False)).alias("any_quote_rule"),
    )


def spacing(bars: DataFrame, by: str = "symbol") -> DataFrame:
    """by, spacing: the median distance in seconds between a series' different times."""
    w = W.series(by)
    steps = bars.select(by, (F.col("t") - F.lag("t").over(w)).alias("step")).where("step > 0")
    return steps.groupBy(by).agg(F.percentile("step", F.lit(0.5)).alias("spacing"))


def state_bars(quotes: DataFrame, seconds: int, columns: tuple[str, ...]) -> DataFrame:
    """The last known value of each column within each bar."""
    when = F.struct("us", "seq")
    return quotes.groupBy("symbol", bar_of(F.col("us"), seconds).alias("t")).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), when)).alias(c) for c in columns])


def grid(ticks: DataFrame, seconds: int) -> DataFrame:
    """Every bar of every UTC day on which the symbol has a tick."""
    days = ticks.select("symbol", bar_of(F.col("us"), DAY).alias("day")).distinct()
    return days.select("symbol", "day", F.explode(F.sequence(F.col("day"), F.col("day") + DAY - seconds, F.lit(seconds).cast("long"))).alias("t"))


FLOWS = ("volume", "trades", "buy_volume", "sell_volume", "imbalance")


def uniform_bars(ticks: DataFrame, quotes: DataFrame, seconds: int, states: tuple[str, ...] = ("bid", "ask", "bid_size", "ask_size")) -> DataFrame:
    """Bars on the full grid: flows are 0 and prices null in empty bars, close and quotes are carried on within a day."""
    joined = grid(ticks, seconds).join(trade_bars(ticks, seconds), ["symbol", "t"], "left").join(state_bars(quotes, seconds, states), ["symbol", "t"], "left")
    w = W.series("symbol", "day")
    return joined.select(
        "symbol", "t", "day", F.col("trades").isNotNull().alias("has_trade"), "open", "high", "low", W.fill_forward(F.col("close"), w).alias("close"), "vwap",
        *[F.coalesce(c, F.lit(0).cast(joined.schema[c].dataType)).alias(c) for c in FLOWS], *[W.fill_forward(F.col(c), w).alias(c) for c in states],
    )


def flat_where_empty(bars: DataFrame) -> DataFrame:
    """Empty bars take open, high, low and vwap from the carried close."""
    return bars.withColumns({c: F.coalesce(c, "close") for c in ("open", "high", "low", "vwap")})


def coarser(bars: DataFrame, seconds: int) -> DataFrame:
    """Bars of a longer period out of bars."""
    return bars.groupBy("symbol", floor_to(F.col("t"), seconds).alias("t")).agg(
        F.min_by("open", F.when(F.col("open").isNotNull(), F.col("t"))).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", F.when(F.col("close").isNotNull(), F.col("t"))).alias("close"), F.sum("volume").alias("volume"),
    )


def corrected(bars: DataFrame, truth: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Take columns of known bars from truth and mark them; bars that only truth has are not added."""
    known = truth.select("symbol", "t", *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__known"))
    met = bars.join(known, ["symbol", "t"], "left")
    return met.select(*[F.when(F.col("__known"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in bars.columns], F.coalesce("__known", F.lit(False)).alias("reconciled"))


def gaps(rows: DataFrame, step: int, key: str = "symbol", at: str = "t") -> DataFrame:
    """Maximal runs without a gap: key, island, first, last, n."""
    w = W.series(key, order=at)
    new = F.coalesce(F.col(at) - F.lag(at).over(w) != step, F.lit(True)).cast("int")
    marked = rows.select(key, at, new.alias("__new")).select(key, at, F.sum("__new").over(W.so_far(w)).alias("island"))
    return marked.groupBy(key, "island").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n"))
