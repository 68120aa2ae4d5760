"""Further indicators: the set that needs no recurrence but two exponential means, the scale-free seven, and compression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from . import windows as W
from .bars import EPS
from .sequential import exponential

SOURCES = ("close", "book_mid")
FALLBACK = ("rsi", "rsi_7", "rsi_28", "macd", "macdhist", "atr", "natr", "std", "bb_upper", "bb_lower", "mom", "roc")


def priced(bars: DataFrame, source: str, mid: str = "mid_price") -> DataFrame:
    """bars with the prices that indicators read: their own, or the book's mid for high, low and close."""
    if source not in SOURCES:
        raise ValueError(f"the price source is one of {SOURCES}, not {source!r}")
    return bars if source == "close" else bars.withColumns({c: F.col(mid) for c in ("high", "low", "close")})


def simple_rsi(close: Column, n: int, w: WindowSpec) -> Column:
    """From plain means of gains and losses over what there is of n rows; step is the change of close, made before."""
    over = W.last_rows(n, w)
    gain, loss = F.avg(F.greatest("step", F.lit(0.0))).over(over), F.avg(F.greatest(-F.col("step"), F.lit(0.0))).over(over)
    return F.when(F.col("step").isNotNull() | (F.count("step").over(over) > 0), 100 - 100 / (1 + gain / (loss + EPS)))


def plain_indicators(bars: DataFrame) -> DataFrame:
    """The indicators in FALLBACK, on rows with a close; other rows get nulls."""
    w, c = W.series(), F.col("close")
    known = exponential(bars.where("close is not null").select("symbol", "t", "high", "low", "close"), "close", (12, 26))
    stepped = known.withColumns({"step": c - F.lag(c).over(w), "macd": F.col("close_ewm12") - F.col("close_ewm26"), "atr": W.mean(F.col("high") - F.col("low"), 14, w, 1)})
    smooth = exponential(stepped, "macd", (9,))
    middle, wide = W.mean(c, 20, w, 1), W.std(c, 20, w, 1)
    made = smooth.select(
        "symbol", "t", *[simple_rsi(c, n, w).alias(name) for name, n in (("rsi", 14), ("rsi_7", 7), ("rsi_28", 28))], "macd", (F.col("macd") - F.col("macd_ewm9")).alias("macdhist"), "atr",
        (F.col("atr") / (c + EPS) * 100).alias("natr"), W.std(c, 14, w, 1).alias("std"), (middle + 2 * wide).alias("bb_upper"), (middle - 2 * wide).alias("bb_lower"),
        (c - F.lag(c, 10).over(w)).alias("mom"), (W.change(c, 10, w) * 100).alias("roc"),
    )
    return bars.join(made, ["symbol", "t"], "left")


def accumulation(bars: DataFrame, n: int = 14, w: WindowSpec | None = None) -> DataFrame:
    """obv and ad as running totals, and their changes over n rows (0 at the start)."""
    w = w or W.series()
    h, low, c, v = (F.col(x) for x in ("high", "low", "close", "volume"))
    place = F.coalesce(W.ratio((c - low) - (h - c), h - low), F.lit(0.0)) * v
    signed = F.coalesce(F.sign(c - F.lag(c).over(w)), F.lit(0.0)) * v
    flows = bars.withColumns({"__s": signed, "__p": place})
    totals = flows.withColumns({"obv": F.sum("__s").over(W.so_far(w)), "ad": F.sum("__p").over(W.so_far(w))}).drop("__s", "__p")
    return totals.withColumns({f"{x}_change": F.coalesce(F.col(x) - F.lag(x, n).over(w), F.lit(0.0)) for x in ("obv", "ad")})


def scale_free(bars: DataFrame, n: int = 20, cumulative: bool = True, prefix: str = "", w: WindowSpec | None = None) -> DataFrame:
    """Seven columns without a price scale. cumulative: obv and ad are running totals (else their changes already)."""
    w = w or W.series()
    needed = ("close", "sar", "bb_upper", "bb_lower", "macd", "macdhist", "obv", "ad", "volume")
    missing = [prefix + x for x in needed if prefix + x not in bars.columns]
    if missing:
        raise ValueError(f"scale-free indicators need the columns {missing}")
    close, sar, upper, lower, macd, hist, obv, ad, volume = (F.col(prefix + x) for x in needed)
    traded = W.enough(F.sum(volume).over(W.last_rows(n, w)), volume, W.last_rows(n, w), n)
    flow = (lambda x: x - F.lag(x, n).over(w)) if cumulative else (lambda x: W.enough(F.sum(x).over(W.last_rows(n, w)), x, W.last_rows(n, w), n))
    made = {
        "sar_dist": W.ratio(close - sar, close), "bb_pctb": W.ratio(close - lower, upper - lower), "bb_width": W.ratio(upper - lower, close), "macd_norm": W.ratio(macd, close),
        "macdhist_norm": W.ratio(hist, close), "obv_slope": W.ratio(flow(obv), traded), "ad_slope": W.ratio(flow(ad), traded),
    }
    return bars.select("*", *[x.alias(prefix + name) for name, x in made.items()])


def more_windows(bars: DataFrame, w: WindowSpec | None = None) -> DataFrame:
    """Indicators of finite windows that `features.indicators` lacks: long mean, slow stochastic, population deviation, tick bands."""
    w = w or W.series()
    h, low, c = F.col("high"), F.col("low"), F.col("close")
    over = W.last_rows(5, w)
    low5, high5 = W.enough(F.min(low).over(over), low, over, 5), W.enough(F.max(h).over(over), h, over, 5)
    fast = bars.withColumn("__fast", W.ratio(100 * (c - low5), high5 - low5))
    slow = fast.withColumn("stoch_k", W.mean(F.col("__fast"), 3, w))
    dev = lambda n: W.enough(F.stddev_pop(c).over(W.last_rows(n, w)), c, W.last_rows(n, w), n)
    return slow.select(
        *bars.columns, W.mean(c, 99, w).alias("sma_99"), "stoch_k", W.mean(F.col("stoch_k"), 3, w).alias("stoch_d"), dev(14).alias("stddev_14"),
        (W.mean(c, 5, w) + 2 * dev(5)).alias("tick_band_upper"), (W.mean(c, 5, w) - 2 * dev(5)).alias("tick_band_lower"),
    )


def convergence_tight(bars: DataFrame, short: str = "atr_10", long: str = "atr_60", w: WindowSpec | None = None) -> DataFrame:
    """True where the range is compressed against its own 60 rows, the close lies just below the high of 20 rows, for three
    rows on end, and two means have come together. Needs two average true ranges."""
    w = w or W.series()
    c = F.col("close")
    ratio = bars.withColumn("__ratio", W.ratio(F.col(short), F.col(long)))
    level = W.enough(F.max("high").over(W.last_rows(20, w)), F.col("high"), W.last_rows(20, w), 20)
    levelled = ratio.withColumns({"__q": W.quantile(F.col("__ratio"), 0.4, 60, w), "__level": level, "__gap": W.mean(c, 9, w) - W.mean(c, 21, w)})
    near = W.ratio(c - F.lag("__level").over(w), F.lag("__level").over(w))
    flagged = levelled.withColumns({"__tight": F.coalesce((F.col("__ratio") <= F.col("__q")) & near.between(-0.045, 0.0), F.lit(False)), "__apart": W.ratio(W.std(F.col("__gap"), 10, w), c)})
    return flagged.select(*bars.columns, (F.col("__tight") & W.streak(F.col("__tight"), 3, w) & F.coalesce(F.col("__apart") < 0.008, F.lit(False))).alias("convergence_tight"))
