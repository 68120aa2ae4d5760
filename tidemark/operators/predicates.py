"""Named predicates over feature rows, and the algebra that joins them.

A name is an atom, or atoms joined by `_and_` and `_or_` (or binds tighter), or a list such as ["a", "&", "b", "|", "c"]
that is folded from left to right. A leading time frame such as `4h_` reads the columns under that prefix, a trailing
`_long` or `_short` fixes the side. Names become Columns on the driver: missing columns and unknown atoms raise, null is
false, and an atom that belongs to the other side is false everywhere.

Atoms come in families: "kline" (candles), "tick" (bars with a book, funding and liquidations), "flow" (order flow, no
side) and "options". The conditions below are constants of this module; a name only chooses among them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FRAME = re.compile(r"^(\d+[smhd])_(?!and_|or_)(.+)$")
COLUMN = re.compile(r"[a-z][A-Za-z0-9_]*")
SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400}
BANNED = ("baseline",)

UP, DOWN = "close > mvg1 AND mvg1 > mvg2", "close < mvg1 AND mvg1 < mvg2"
ABOVE, BELOW = "close > mvg1 AND close > mvg2", "close < mvg1 AND close < mvg2"
CALM, SURGE = f"({DOWN} AND price_range_pct < price_range_pct_q50)", f"({DOWN} AND quote_vol_ratio > 2)"
UNDER_ALL = [f"({BELOW} AND close < mvg3)", f"({BELOW})"]

# The vocabulary of the atoms, and the conditions that each stands for, for long and for short. One text
# holds for both sides, None for a side that the atom does not have. Of a list the first whose columns are all there counts.
ATOMS: dict[str, dict[str, tuple]] = {
    "kline": {
        "low_vol": ("price_range_pct < price_range_pct_q50",),
        "high_vol": ("price_range_pct > price_range_pct_q50",),
        "high_vol_q80": ("price_range_pct > price_range_pct_q80",),
        "high_vol_q90": ("price_range_pct > price_range_pct_q90",),
        "high_vol_q95": ("price_range_pct > price_range_pct_q95",),
        "convergence_tight": ("convergence_tight",),
        "strong_candle": ("open_close_pct > 0.005", "open_close_pct < -0.005"),
        "rsi_oversold": ("rsi < 30", None),
        "rsi_overbought": (None, "rsi > 70"),
        "macd_bullish": ("macdhist > 0", None),
        "macd_bearish": (None, "macdhist < 0"),
        "stoch_bullish": ("stoch_k > stoch_d", None),
        "cci_reversal": ("cci > 100", "cci < -100"),
        "adx_trend": ("adx > 25",),
        "mom_positive": ("mom > 0", "mom < 0"),
        "low_volume": (["quote_vol_ratio < 1", "vol_ratio < 1"],),
        "high_volume": (["quote_vol_ratio > 1", "vol_ratio > 1"],),
        "vol_breakout": (["quote_vol_ratio > 2", "vol_ratio > 2"],),
        "buy_pressure": ("buy_pressure > 0.55", "buy_pressure < 0.45"),
        "mfi_oversold": ("mfi < 30", None),
        "mfi_overbought": (None, "mfi > 70"),
        "bop_bullish": ("bop > 0.1", None),
        "bop_bearish": (None, "bop < -0.1"),
        "roc_positive": ("roc > 0", None),
        "roc_negative": (None, "roc < 0"),
        "trend_aligned": (UP, DOWN),
        "strong_trend": ([f"{UP} AND mvg2 > mvg3", UP], [f"{DOWN} AND mvg2 < mvg3", DOWN]),
        "ma_momentum": (["mvg1 > mvg2 AND mvg1 > mvg3", "mvg1 > mvg2"], ["mvg1 < mvg2 AND mvg1 < mvg3", "mvg1 < mvg2"]),
        "above_all_mas": ([f"{ABOVE} AND close > mvg3", ABOVE], UNDER_ALL),
        "near_ma": ("(close - mvg1) / nullif(mvg1, 0) < 0.02", "(mvg1 - close) / nullif(mvg1, 0) < 0.02"),
        "bb_rebound": ("close < bb_lower", "close > bb_upper"),
        "sar_aligned": ("close > sar", "close < sar"),
        "combined_union": (None, f"{CALM} OR {SURGE}"),
        "combined_intersection": (None, f"{CALM} AND {SURGE}"),
        "combined_union_plus": (None, [f"{CALM} OR {SURGE} OR {x}" for x in UNDER_ALL]),
        "combined_union_alt": (None, [f"{CALM} OR {x}" for x in UNDER_ALL]),
    },
    "tick": {
        "high_liquidation_pressure": ("liq_burst_ratio > liq_burst_ratio_q75",),
        "low_liquidation_pressure": ("liq_burst_ratio < liq_burst_ratio_q25",),
        "funding_positive": ("funding_rate > 0",),
        "funding_negative": ("funding_rate < 0",),
        "deep_book": ("depth_imbalance_L5 > depth_imbalance_L5_q60", "depth_imbalance_L5 < depth_imbalance_L5_q40"),
        "trade_imbalance": ("trade_imbalance > 0", "trade_imbalance < 0"),
        "basis_premium": ("basis_pct > 0",),
        "basis_discount": ("basis_pct < 0",),
        "pre_funding_settlement": ("pre_funding > 0",),
        "ofi_positive": ("ofi_agg > 0", "ofi_agg < 0"),
        "tight_spread": ("relative_spread < relative_spread_q50",),
        "wide_spread": ("relative_spread > relative_spread_q50",),
        "rsi_oversold": ("rsi < 30",),
        "rsi_overbought": ("rsi > 70",),
        "macd_bullish": ("macdhist > 0", "macdhist < 0"),
        "macd_bearish": ("macdhist < 0", "macdhist > 0"),
        "adx_trend": ("adx > 25",),
        "low_volume": ("vol_ratio < 1",),
        "high_volume": ("vol_ratio > 1",),
        "vol_breakout": ("vol_ratio > 2",),
        "high_vol": ("price_range_pct > price_range_pct_q50",),
        "low_vol": ("price_range_pct < price_range_pct_q50",),
        "mom_positive": ("mom > 0", "mom < 0"),
    },
    "flow": {
        "buy_flow": ("trade_imbalance > 0.2",),
        "sell_flow": ("trade_imbalance < -0.2",),
        "bid_heavy": ([f"depth_imbalance_{x} > 0.2" for x in ("L5", "L3", "L1")],),
        "ask_heavy": ([f"depth_imbalance_{x} < -0.2" for x in ("L5", "L3", "L1")],),
        "ofi_positive": ("ofi_agg > 0",),
        "ofi_negative": ("ofi_agg < 0",),
        "short_liq_spike": ("liq_burst_ratio > 2 AND liq_directional_imbalance > 0",),
        "long_liq_spike": ("liq_burst_ratio > 2 AND liq_directional_imbalance < 0",),
        "liq_spike": ("liq_burst_ratio > 2",),
        "high_spread": ("relative_spread > 1.5 * relative_spread_median",),
        "low_spread": ("relative_spread < 0.7 * relative_spread_median",),
    },
    "options": {
        "high_iv_rank": ("iv_rank > 70",),
        "low_iv_rank": ("iv_rank < 30",),
        "backwardation": ("term_structure_ratio < 1",),
        "contango": ("term_structure_ratio > 1",),
        "positive_skew": ("skew_25d_rr > 0",),
        "negative_skew": ("skew_25d_rr < 0",),
        "oi_expansion": ("oi_1d_change > 0",),
        "high_hv": ("hv_20d > hv_20d_q66",),
        "low_hv": ("hv_20d < hv_20d_q33",),
        "rsi_oversold": ("rsi_7 < 30",),
        "rsi_overbought": ("rsi_7 > 70",),
        "above_ma20": ("spot_vs_ma20 > 0",),
        "below_ma20": ("spot_vs_ma20 < 0",),
        "momentum_up": ("spot_return_20d > 0.03",),
        "momentum_down": ("spot_return_20d < -0.03",),
        "iv_premium": ("iv_vs_hv20 > 1.2",),
        "iv_discount": ("iv_vs_hv20 < 0.8",),
        "vol_compression": ("hv_10d < hv_20d",),
        "vol_expansion": ("hv_10d > hv_20d",),
    },
}
# Quantile levels of the cutoffs that atoms compare with.
CUTOFFS = {"kline": {"price_range_pct": (0.5, 0.8, 0.9, 0.95)}, "tick": {"liq_burst_ratio": (0.75, 0.25), "depth_imbalance_L5": (0.6, 0.4), "relative_spread": (0.5,), "price_range_pct": (0.5,)}, "flow": {}, "options": {"hv_20d": (0.66, 0.33)}}

Name = str | list


def _columns(text: str) -> list[str]:
    return [c for c in COLUMN.findall(text) if c != "nullif"]


def _sides(family: str, atom: str) -> tuple:
    """Conditions for long and for short."""
    entry = ATOMS[family][atom]
    return entry if len(entry) == 2 else (entry[0], entry[0])


def _parts(name: Name, family: str) -> list[str]:
    """Atoms of a name, with their time frames."""
    if isinstance(name, list):
        return [a for x in name[::2] for a in _parts(x, family)]
    return [a for part in name.split("_and_") for a in part.split("_or_")]


def _framed(text: str) -> tuple[str, str]:
    found = FRAME.match(text)
    return (f"{found[1]}_", found[2]) if found else ("", text)


def with_side(name: str, family: str = "kline") -> tuple[str, str | None]:
    """A name without a trailing _long or _short, and that side. Atoms that end so by themselves stay whole."""
    if _framed(name)[1] in ATOMS[family]:
        return name, None
    for side in ("long", "short"):
        if name.endswith(f"_{side}"):
            return name[: -len(side) - 1], side
    return name, None


def allowed_sides(name: Name, family: str = "kline") -> list[str]:
    """The sides that every atom of the name has; none if two atoms exclude each other."""
    atoms = [_framed(a)[1] for a in _parts(name, family)]
    return [side for i, side in enumerate(("long", "short")) if all(a not in ATOMS[family] or _sides(family, a)[i] is not None for a in atoms)]


def atom_column(atom: str, side: str, columns: Iterable[str], family: str, prefix: str = "") -> Column:
    if atom in BANNED:
        raise ValueError(f"{atom!r} holds on every row and is no predicate")
    if atom not in ATOMS[family]:
        raise ValueError(f"unknown predicate {atom!r} of the family {family!r}")
    made, there = _sides(family, atom)[side == "short"], set(columns)
    if made is None:
        return F.lit(False)
    choices = made if isinstance(made, list) else [made]
    lacking = [sorted({prefix + c for c in _columns(text)} - there) for text in choices]
    for text, lacks in zip(choices, lacking, strict=True):
        if not lacks:
            return F.coalesce(F.expr(COLUMN.sub(lambda m: m[0] if m[0] == "nullif" else f"`{prefix}{m[0]}`", text)), F.lit(False))
    raise ValueError(f"predicate {prefix + atom!r} needs the columns {lacking[-1]}")


def predicate(name: Name, side: str, columns: Iterable[str], family: str = "kline", codes: Mapping[str, str] | None = None) -> Column:
    """The condition of a name for "long" or "short". codes: names by short codes."""
    columns = list(columns)
    if isinstance(name, list):
        result = predicate(name[0], side, columns, family, codes)
        for sign, other in zip(name[1::2], name[2::2], strict=True):
            more = predicate(other, side, columns, family, codes)
            if sign not in ("&", "|"):
                raise ValueError(f"{sign!r} joins no predicates")
            result = result & more if sign == "&" else result | more
        return result
    name = (codes or {}).get(name, name)
    if name.startswith("__"):
        return F.lit(True)
    name, fixed = with_side(name, family)
    if (fixed or side) != side:
        return F.lit(False)
    result = F.lit(True)
    for part in name.split("_and_"):
        any_of = F.lit(False)
        for text in part.split("_or_"):
            prefix, atom = _framed(text)
            any_of = any_of | atom_column(atom, side, columns, family, prefix)
        result = result & any_of
    return result if side in allowed_sides(name, family) else F.lit(False)


def sliced(rows: DataFrame, stack: list[tuple[Name, str]], family: str = "kline") -> DataFrame:
    """Each row once for every (name, side) of the stack that holds: one scan and one projection for all of them."""
    held = F.array_compact(F.array(*[F.when(predicate(n, s, rows.columns, family), F.struct(F.lit(str(n)).alias("name"), F.lit(s).alias("side"))) for n, s in stack]))
    return rows.select("*", F.explode(held).alias("__h")).select(*rows.columns, F.col("__h.name").alias("predicate"), F.col("__h.side").alias("side"))


def stack_of(names: Iterable[str], family: str = "kline") -> list[tuple[str, str]]:
    """Rows (name, side) for all sides that a name allows; internal names (`__...`) are left out."""
    return [(n, s) for n in names if not n.startswith("__") for s in allowed_sides(n, family)]


def crossed(atoms: list[str], frames: list[str], family: str = "kline") -> list[tuple[str, str]]:
    """Pairs of atoms on two different frames, the finer first, for the sides they allow."""
    order = sorted(frames, key=lambda f: int(f[:-1]) * SECONDS[f[-1]])
    pairs = [(a, b) for i, a in enumerate(order) for b in order[i + 1 :]]
    return stack_of([f"{a}_{x}_and_{b}_{y}" for (a, b), x, y in product(pairs, atoms, atoms)], family)


# The default rules of a stack over a ladder of frames. Rank 0 is the coarsest frame, which gives the context; a
# signal comes from a finer one. SINGLE holds on every frame, SAME on one frame at a time, CROSSED are (rank, contexts, rank, signals).
SINGLE = """strong_trend ma_momentum above_all_mas low_vol high_vol strong_candle near_ma rsi_oversold rsi_overbought macd_bullish macd_bearish
stoch_bullish cci_reversal adx_trend bb_rebound mom_positive low_volume high_volume vol_breakout buy_pressure sar_aligned mfi_oversold mfi_overbought
bop_bullish bop_bearish roc_positive roc_negative""".split()
SAME = [("vol_breakout", "mfi_oversold mfi_overbought"), ("high_volume", "bop_bullish bop_bearish"), ("low_volume", "roc_positive roc_negative")]
_MACD, _RSI, _BOP, _MFI = "macd_bullish macd_bearish", "rsi_oversold rsi_overbought", "bop_bullish bop_bearish", "mfi_oversold mfi_overbought"
_TWO, _THREE, _FOUR = f"{_MACD} {_RSI}", f"{_MACD} {_RSI} {_BOP}", f"{_MACD} {_RSI} {_BOP} {_MFI}"
TREND = [
    (0, "strong_trend ma_momentum above_all_mas", 2, _TWO), (1, "strong_trend adx_trend", 2, _TWO), (1, "macd_bullish", 2, _RSI), (0, "strong_trend", 1, _TWO), (0, "ma_momentum", 1, _MACD),
    (0, "vol_breakout", 1, _TWO), (0, "vol_breakout", 2, _TWO), (1, "vol_breakout", 2, _TWO), (0, "strong_trend vol_breakout", 1, "vol_breakout", 2, _MACD),
]
VOLUME = [
    (0, "low_volume", 1, _THREE), (0, "low_volume", 2, _FOUR), (0, "high_volume", 1, _THREE), (0, "high_volume", 2, _FOUR), (1, "low_volume", 2, f"{_FOUR} stoch_bullish"), (1, "high_volume", 2, _FOUR),
    (0, "low_vol", 1, _THREE), (0, "low_vol", 2, f"{_FOUR} stoch_bullish"), (0, "high_vol", 1, _TWO), (0, "high_vol", 2, _THREE), (1, "low_vol", 2, f"{_FOUR} stoch_bullish"), (1, "high_vol", 2, _THREE),
]
FLOW = [(0, "strong_trend", 2, _BOP), (0, "vol_breakout", 2, _MFI), (1, "vol_breakout", 2, _BOP), (1, "vol_breakout", 2, _MFI)]


def ranked(rules: list[tuple], ladder: list[str]) -> list[str]:
    """The names that rules (rank, atoms, rank, atoms, ...) stand for on a ladder of frames, coarsest first.

    Ranks must rise from leg to leg, so that the context is the coarser frame; a ladder without a rank raises.
    """
    names = []
    for rule in rules:
        ranks, atoms = rule[::2], [a.split() for a in rule[1::2]]
        if list(ranks) != sorted(set(ranks)) or ranks[-1] >= len(ladder):
            raise ValueError(f"ranks {ranks} do not go from coarse to fine on {ladder}")
        names += ["_and_".join(f"{ladder[r]}_{a}" for r, a in zip(ranks, legs, strict=True)) for legs in product(*atoms)]
    return names


def ladder_stack(frames: list[str], family: str = "kline") -> list[tuple[str, str]]:
    """The default stack on these frames: single atoms, crossed ones, pairs on one frame; each name and side once, none of them banned."""
    fine = sorted(frames, key=lambda f: int(f[:-1]) * SECONDS[f[-1]])
    ladder = fine[::-1]
    names = [f"{f}_{a}" for f in fine for a in SINGLE] + ranked(TREND, ladder) + [f"{f}_{a}_and_{f}_{b}" for f in fine for a, other in SAME for b in other.split()] + ranked(VOLUME, ladder) + ranked(FLOW, ladder)
    return list(dict.fromkeys((n, s) for n, s in stack_of(names, family) if not any(_framed(a)[1] in BANNED for a in _parts(n, family))))


def swept(gates: list[str], techniques: list[str]) -> list[str]:
    """All gates, all techniques, and each gate with each technique."""
    return [*gates, *techniques, *(f"{g}_and_{t}" for g, t in product(gates, techniques))]


def without_anchors(stack: list[tuple[str, str]], anchors: Iterable[str]) -> list[tuple[str, str]]:
    """Rows of a stack that name no anchor state (`<first three letters>_...`)."""
    starts = tuple(f"{a[:3].lower()}_" for a in anchors)
    return [(n, s) for n, s in stack if not any(p.startswith(starts) for p in _parts(n, "kline"))]


def anchor_state(rules: list[Mapping], columns: Iterable[str]) -> Column:
    """All of several comparisons {col, op, val} with constants; null is false."""
    compare = {">": lambda c, v: c > v, "<": lambda c, v: c < v, ">=": lambda c, v: c >= v, "<=": lambda c, v: c <= v, "==": lambda c, v: c == v}
    result, there = F.lit(True), set(columns)
    for rule in rules:
        if rule["op"] not in compare or rule["col"] not in there:
            raise ValueError(f"no such comparison or column: {rule}")
        result = result & F.coalesce(compare[rule["op"]](F.col(rule["col"]), F.lit(rule["val"])), F.lit(False))
    return result


def cut_name(column: str, q: float) -> str:
    return f"{column}_q{round(q * 100)}"


def with_cutoffs(rows: DataFrame, levels: Mapping[str, tuple[float, ...]], by: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """rows with the quantiles of columns over all rows of their series, as <column>_q<percent>."""
    cuts = rows.groupBy(*by).agg(*[F.percentile(c, F.lit(q)).alias(cut_name(c, q)) for c, qs in levels.items() for q in qs])
    return rows.join(cuts, list(by))


def with_daily_cutoffs(rows: DataFrame, levels: Mapping[str, tuple[float, ...]], days: int, symbol: str = "symbol", t: str = "t") -> DataFrame:
    """rows with cutoffs that were known before their day: the mean of the daily quantiles of the `days` days before it.

    The grid of days has no gaps: a day without rows has no quantile, and no cutoff stands where one of the days lacks it.
    """
    from ..sources.driver_tables import DAY, floor_to
    from . import windows as W

    day = floor_to(F.col(t), DAY)
    daily = rows.groupBy(symbol, day.alias("__day")).agg(*[F.percentile(c, F.lit(q)).alias(cut_name(c, q)) for c, qs in levels.items() for q in qs])
    ends = daily.groupBy(symbol).agg(F.min("__day").alias("a"), F.max("__day").alias("b"))
    grid = ends.select(symbol, F.explode(F.sequence("a", "b", F.lit(DAY).cast("long"))).alias("__day"))
    names = [cut_name(c, q) for c, qs in levels.items() for q in qs]
    before = W.series(symbol, order="__day").rowsBetween(-days, -1)
    known = grid.join(daily, [symbol, "__day"], "left").select(symbol, "__day", *[F.when(F.count(n).over(before) >= days, F.avg(n).over(before)).alias(n) for n in names])
    return rows.withColumn("__day", day).join(known, [symbol, "__day"], "left").drop("__day")
