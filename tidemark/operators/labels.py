"""Forward-looking labels. Rows too near the end of their series have none (null)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from . import windows as W


def forward_return(close: Column, n: int, w: WindowSpec, fee: float = 0.0, short: bool = False) -> Column:
    """The signed gain of a position held for n rows, less the fee."""
    gain = W.change(close, -n, w)
    return (-gain if short else gain) - fee


def rungs(close: Column, extreme: Column, step: float, most: int) -> Column:
    """How many rungs a ladder of entries fills when the price moves against it to `extreme`; the first always fills."""
    against = F.greatest((close - extreme) / close, F.lit(0.0))
    return F.coalesce(1 + F.least(F.floor(against / step + 1e-9), F.lit(most - 1)), F.lit(1)).cast("int")


def short_rungs(close: Column, highest: Column, step: float, most: int) -> Column:
    return rungs(close, 2 * close - highest, step, most)


def ladder_return(gain: Column, filled: Column, step: float, most: int, short: bool = False) -> Column:
    """Sum over filled rungs of the gain from each rung's own entry price."""
    sign = 1 if short else -1
    parts = [F.when(filled >= j, (1 + gain) / (1 + sign * (j - 1) * step) - 1).otherwise(0.0) for j in range(1, most + 1)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return -total if short else total


def ladder_target(bars: DataFrame, horizon: int, step: float, most: int, fee: float, w: WindowSpec | None = None) -> DataFrame:
    """Rungs filled within the horizon and the ladder's return at the horizon, with both fees for each rung."""
    w = w or W.series()
    ahead = W.next_rows(horizon, w)
    low, high, gain = F.min("low").over(ahead), F.max("high").over(ahead), W.change(F.col("close"), -horizon, w)
    filled = bars.select("*", rungs(F.col("close"), low, step, most).alias("rungs_long"), short_rungs(F.col("close"), high, step, most).alias("rungs_short"), gain.alias("__gain"))
    return filled.select(
        *bars.columns, "rungs_long", "rungs_short",
        (ladder_return(F.col("__gain"), F.col("rungs_long"), step, most) - 2 * fee * F.col("rungs_long")).alias("target_long"),
        (ladder_return(F.col("__gain"), F.col("rungs_short"), step, most, short=True) - 2 * fee * F.col("rungs_short")).alias("target_short"),
    )


def three_way(gain: Column, threshold: float) -> Column:
    return F.when(gain > threshold, 1).when(gain < -threshold, -1).when(gain.isNotNull(), 0)


def within_bar(bars: DataFrame, fine: DataFrame, bar: int, step: int, minutes: int, take: float, fee: float) -> DataFrame:
    """A target resolved on finer bars behind each bar: out at the first one whose high reaches take, else at the last close.

    Bars that miss any of the `minutes` finer bars have no target. An equi join on (symbol, time), no range join.
    """
    wanted = bars.select("symbol", "t", "close", F.posexplode(F.sequence(F.col("t") + bar, F.col("t") + bar + (minutes - 1) * step, F.lit(step).cast("long"))).alias("at", "fine_t"))
    met = wanted.join(fine.select("symbol", F.col("t").alias("fine_t"), F.col("high").alias("fh"), F.col("close").alias("fc")), ["symbol", "fine_t"])
    hit = F.col("fh") >= F.col("close") * (1 + take)
    found = met.groupBy("symbol", "t").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(hit, F.col("at"))).alias("hit_at"), (F.max_by("fc", "at") / F.first("close") - 1).alias("drift"))
    return bars.join(found, ["symbol", "t"], "left").select(*bars.columns, F.when(F.col("n") == minutes, F.col("hit_at")).alias("hit_at"), F.when(F.col("n") == minutes, F.when(F.col("hit_at").isNotNull(), F.lit(take)).otherwise(F.col("drift")) - fee).alias("target"))


FILLS = ("ladder", "flat", "limit_then_taker")
MODES = ("close_to_close", "typical_over_open", "typical_over_close")


def checked_ladder(step: float, most: int, fee: float, horizon: int = 1) -> None:
    """Raise on settings that no ladder can have."""
    if int(most) != most or most < 1 or not 0 < step < 1 or not 0 <= fee < 1 or int(horizon) != horizon or horizon < 1 or (most - 1) * step >= 1:
        raise ValueError(f"no such ladder: {most} rungs of {step}, fee {fee}, horizon {horizon}")


def filled_target(bars: DataFrame, horizon: int, step: float, most: int, fee: float, fill: str = "ladder", w: WindowSpec | None = None) -> DataFrame:
    """target_long and target_short under a way of filling.

    ladder: as many rungs as the price reaches. flat: one rung. limit_then_taker: out at the close of the horizon if the
    price comes back to it within another horizon, else at that one's close; rows without both have no target.
    """
    checked_ladder(step, most, fee, horizon)
    if fill not in FILLS:
        raise ValueError(f"a way of filling is one of {FILLS}, not {fill!r}")
    w = w or W.series()
    close = F.when(F.col("close") != 0, F.col("close"))
    near, far = W.next_rows(horizon, w), w.rowsBetween(horizon + 1, 2 * horizon)
    ends = bars.select("*", close.alias("__c"), F.lead(close, horizon).over(w).alias("__h"), F.lead(close, 2 * horizon).over(w).alias("__hh"), F.min("low").over(near).alias("__low"), F.max("high").over(near).alias("__high"), F.min("low").over(far).alias("__low2"), F.max("high").over(far).alias("__high2"))
    c, h, hh = F.col("__c"), F.col("__h"), F.col("__hh")
    if fill == "limit_then_taker":
        out = [F.when(F.col("__high2") >= h, h).otherwise(hh), F.when(F.col("__low2") <= h, h).otherwise(hh)]
        gains = [F.when(hh.isNotNull(), W.ratio(x, c) - 1) for x in out]
    else:
        gains = [W.ratio(h, c) - 1] * 2
    filled = [F.lit(1), F.lit(1)] if fill == "flat" else [rungs(c, F.col("__low"), step, most), short_rungs(c, F.col("__high"), step, most)]
    targets = [ladder_return(g, n, step, most, short=bool(i)) - 2 * fee * n for i, (g, n) in enumerate(zip(gains, filled, strict=True))]
    return ends.select(*bars.columns, targets[0].alias("target_long"), targets[1].alias("target_short"))


def dip_and_rip(w: WindowSpec) -> tuple[Column, Column]:
    """How far the next row goes below and above the close."""
    return W.ratio(F.lead("low").over(w), F.col("close")) - 1, W.ratio(F.lead("high").over(w), F.col("close")) - 1


def mode_return(bars: DataFrame, mode: str, w: WindowSpec | None = None) -> Column:
    """The next row's close, or its typical price, over this close or over the next open."""
    if mode not in MODES:
        raise ValueError(f"a mode of return is one of {MODES}, not {mode!r}")
    needed = {"close_to_close": (), "typical_over_open": ("open", "high", "low"), "typical_over_close": ("high", "low")}[mode]
    if missing := [c for c in needed if c not in bars.columns]:
        raise ValueError(f"the mode {mode!r} needs the columns {missing}")
    w = w or W.series()
    typical = F.lead((F.col("high") + F.col("low") + F.col("close")) / 3).over(w) if needed else F.lead("close").over(w)
    return W.ratio(typical, F.lead("open").over(w) if mode == "typical_over_open" else F.col("close")) - 1


def minute_fills(bars: DataFrame, fine: DataFrame, bar: int, step_seconds: int, minutes: int, rung: float, most: int, aim: float, fee: float, short: bool = False) -> DataFrame:
    """symbol, t, size, avg_cost, is_maker, pnl of a ladder that is followed on finer bars behind each bar.

    Rungs fill as the running extreme reaches them. The exit stands at the average cost plus the aim and is tested on the
    next finer bar, with the rungs filled before it; without a hit the position is crossed at the last close, less the
    fee. Bars that lack any of the finer bars have nulls.
    """
    if minutes < 2 or most < 1:
        raise ValueError("an exit needs a bar to be placed on and one to be tested on, and a ladder a rung")
    sign = -1 if short else 1
    close = F.when(F.col("close") != 0, F.col("close"))
    wanted = bars.select("symbol", "t", close.alias("c"), F.posexplode(F.sequence(F.col("t") + bar, F.col("t") + bar + (minutes - 1) * step_seconds, F.lit(step_seconds).cast("long"))).alias("at", "fine_t"))
    met = wanted.join(fine.select("symbol", F.col("t").alias("fine_t"), F.col("high").alias("fh"), F.col("low").alias("fl"), F.col("close").alias("fc")), ["symbol", "fine_t"]).where("c is not null and fh is not null and fl is not null and fc is not null")
    w = Window.partitionBy("symbol", "t").orderBy("at")
    extreme = F.max("fh").over(W.so_far(w)) if short else F.min("fl").over(W.so_far(w))
    reached = [(extreme >= F.col("c") * (1 + j * rung)) if short else (extreme <= F.col("c") * (1 - j * rung)) for j in range(1, most)]
    size = F.lit(1.0)
    for r in reached:
        size = size + r.cast("double")
    sized = met.select("*", size.alias("size"))
    cost = F.col("c") * (1 - sign * (F.col("size") - 1) / 2 * rung)
    costed = sized.select("*", cost.alias("cost"), F.lag(cost * (1 + sign * aim)).over(w).alias("exit"), F.lag("size").over(w).alias("size0"), F.lag(cost).over(w).alias("cost0"))
    hit = F.coalesce((F.col("fl") <= F.col("exit")) if short else (F.col("fh") >= F.col("exit")), F.lit(False))
    row = F.struct("at", "size", "cost", "fc", "size0", "cost0")
    ends = costed.groupBy("symbol", "t").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(hit, row)).alias("made"), F.max(row).alias("last")).where(F.col("n") == minutes)
    maker = F.col("made").isNotNull()
    crossed = F.col("last.size") * (sign * (F.col("last.fc") - F.col("last.cost")) / F.col("last.cost") - fee)
    found = ends.select("symbol", "t", F.when(maker, F.col("made.size0")).otherwise(F.col("last.size")).alias("size"), F.when(maker, F.col("made.cost0")).otherwise(F.col("last.cost")).alias("avg_cost"), maker.alias("is_maker"), F.when(maker, F.col("made.size0") * aim).otherwise(crossed).alias("pnl"))
    return bars.select("symbol", "t").join(found, ["symbol", "t"], "left")


def further_return(bars: DataFrame, extra: DataFrame, bar: int, extra_bar: int, w: WindowSpec | None = None) -> DataFrame:
    """extra_return: from the next bar's close on to the close of the finer series at t + bar + extra_bar."""
    w = w or W.series()
    ends = bars.select("*", F.lead("close").over(w).alias("__next"), (F.col("t") + bar + extra_bar).alias("__at"))
    met = ends.join(extra.select("symbol", F.col("t").alias("__at"), F.col("close").alias("__extra")), ["symbol", "__at"], "left")
    return met.select(*bars.columns, (W.ratio(F.col("__extra"), F.col("__next")) - 1).alias("extra_return"))


def boundary_return(bars: DataFrame, price: str, bar: int, period: int) -> DataFrame:
    """boundary_return: from each row on to the next multiple of the period (one whole period from a multiple itself). An equi join."""
    ahead = bars.withColumn("__at", F.col("t") + period - F.pmod("t", F.lit(period)))
    met = ahead.join(bars.select("symbol", F.col("t").alias("__at"), F.col(price).alias("__then")), ["symbol", "__at"], "left")
    return met.select(*bars.columns, (W.ratio(F.col("__then"), F.col(price)) - 1).alias("boundary_return"))


def cross_frame_target(base: DataFrame, target: DataFrame, seconds: int, step: float, most: int, fee: float) -> DataFrame:
    """The ladder target of each base row on the target frame's bar that opened last: its close, low and high, from the base close on."""
    from .asof import BLOCK, as_of

    met = as_of(base, target.select("symbol", F.col("t").alias("opened"), F.col("close").alias("exit_close"), F.col("low").alias("exit_low"), F.col("high").alias("exit_high")), "symbol", "t", "opened", "", seconds, BLOCK)
    gain, n, m = W.ratio(F.col("exit_close"), F.col("close")) - 1, rungs(F.col("close"), F.col("exit_low"), step, most), short_rungs(F.col("close"), F.col("exit_high"), step, most)
    return met.select(*base.columns, "exit_close", (ladder_return(gain, n, step, most) - 2 * fee * n).alias("target_long"), (ladder_return(gain, m, step, most, short=True) - 2 * fee * m).alias("target_short"))


def ternary(long: Column, short: Column, threshold: float) -> Column:
    """1 where the long target passes the threshold, -1 where the short one does; if both do, the larger; else 0."""
    up, down = F.coalesce(long > threshold, F.lit(False)), F.coalesce(short > threshold, F.lit(False))
    return F.when(up & down, F.when(long >= short, 1).otherwise(-1)).when(up, 1).when(down, -1).otherwise(0)


def with_targets(rows: DataFrame, mode: str = "long_short") -> DataFrame:
    """Rows that have the targets their mode needs."""
    needed = {"long_short": ("target_long", "target_short"), "signed": ("target",)}[mode]
    return rows.dropna(subset=list(needed))
