"""Queries on books, tickers, liquidations, cutoffs, predicates and further indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bars as B
from ..operators import book, features, indicators, predicates, sequential
from ..operators import windows as W
from ..sources import driver_tables as tables
from . import oracles as sql
from .catalog import hourly
from .registry import HOUR, query, rounded

ANCHOR = "click"
LEVELS = 5
_SIZES = [f"b{i}" for i in range(LEVELS)] + [f"a{i}" for i in range(LEVELS)]
_BOOKS = ", ".join([f"CASE WHEN user_id % {4 + i} <> 0 THEN CAST(user_id % {7 + i} AS DOUBLE) + 1 END AS b{i}" for i in range(LEVELS)] + [f"CAST(user_id % {5 + i} AS DOUBLE) + {i} AS a{i}" for i in range(LEVELS)])
_STATES = [*_SIZES, "mark_price", "index_price", "open_interest", "funding_rate"]
_LAST = ", ".join(f"last({c} ORDER BY us, seq) FILTER ({c} IS NOT NULL) AS {c}" for c in _STATES)
_DEPTH = ", ".join(f"{' + '.join(f'coalesce({s}{i}, 0)' for i in range(n))} AS depth_{'bid' if s == 'b' else 'ask'}_L{n}" for s in "ba" for n in (1, 3, 5))
_K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"
STREAMS = f"""{sql.uniform(HOUR)}, {sql.FLAT}, wide0 AS (SELECT event_type AS symbol, epoch_us(ts) AS us, event_id AS seq, {_BOOKS}, value * (1 + ({_K} - 50) / 10000) AS mark_price, value AS index_price, CAST(user_id AS DOUBLE) AS open_interest, ({_K} - 50) / 10000 AS funding_rate FROM events),
  wide AS (SELECT symbol, (us // 1000000) // {HOUR} * {HOUR} AS t, {_LAST} FROM wide0 GROUP BY 1, 2),
  liqs AS (SELECT symbol, (us // 1000000) // {HOUR} * {HOUR} AS t, count(*) AS n, count(*) FILTER (side = 'buy') AS nl, count(*) FILTER (side = 'sell') AS ns, sum(price * amount) FILTER (side = 'buy') AS vl, sum(price * amount) FILTER (side = 'sell') AS vs FROM ticks WHERE amount >= 80 GROUP BY 1, 2),
  met AS (SELECT f.*, w.* EXCLUDE (symbol, t), CAST(coalesce(n, 0) AS DOUBLE) AS liq_total_count, CAST(coalesce(nl, 0) AS DOUBLE) AS liq_long_count, CAST(coalesce(ns, 0) AS DOUBLE) AS liq_short_count, coalesce(vl, 0) AS liq_long_notional, coalesce(vs, 0) AS liq_short_notional
    FROM flat f LEFT JOIN wide w ON w.symbol = f.symbol AND w.t = f.t LEFT JOIN liqs l ON l.symbol = f.symbol AND l.t = f.t),
  filled AS (SELECT * REPLACE ({", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in _STATES)}) FROM met WINDOW w AS (PARTITION BY symbol, day ORDER BY t ROWS UNBOUNDED PRECEDING)),
  streams AS (SELECT *, {_DEPTH} FROM filled)"""
_DIFF = "({0} - lag({0}) OVER w)"
_W = "WINDOW w AS (PARTITION BY symbol ORDER BY t)"
BOOKED = f"""{STREAMS}, q1 AS (SELECT *, ask - bid AS spread, (bid + ask) / 2 AS mid_price, (bid * greatest(ask_size, 0) + ask * greatest(bid_size, 0)) / (bid_size + ask_size + 1e-10) AS microprice,
    {", ".join(f"(depth_bid_L{n} - depth_ask_L{n}) / (depth_bid_L{n} + depth_ask_L{n} + 1e-10) AS depth_imbalance_L{n}, {_DIFF.format(f'depth_bid_L{n}')} - {_DIFF.format(f'depth_ask_L{n}')} AS ofi_L{n}" for n in (1, 3, 5))},
    (mark_price - index_price) / (index_price + 1e-10) * 100 AS basis_pct, CAST(t % 28800 >= 21600 AS DOUBLE) AS pre_funding, liq_long_notional + liq_short_notional AS liq_total_notional,
    imbalance AS trade_imbalance, imbalance * volume * close AS dollar_tsi, trades / ({sql.mean("CAST(trades AS DOUBLE)", 60, 1)} + 1e-10) AS trade_intensity, abs(close - open) / (volume + 1e-10) AS kyle_lambda, volume / ({sql.mean("volume", 7, 1)} + 1e-10) AS vol_ratio FROM streams {_W}),
  booked AS (SELECT *, spread / (mid_price + 1e-10) AS relative_spread, microprice - mid_price AS microprice_vs_mid, coalesce(ofi_L1, 0) + coalesce(ofi_L3, 0) + coalesce(ofi_L5, 0) AS ofi_agg, liq_total_notional / ({sql.mean("liq_total_notional", 60, 1)} + 1e-10) AS liq_burst_ratio,
    (liq_long_notional - liq_short_notional) / (liq_total_notional + 1e-10) AS liq_directional_imbalance FROM q1)"""


def streams(spark, sf_dir):
    base = B.flat_where_empty(hourly(spark, sf_dir))
    return book.with_streams(base, tables.books(spark, sf_dir), tables.tickers(spark, sf_dir), tables.liquidations(spark, sf_dir), HOUR, LEVELS)


def booked(spark, sf_dir):
    return book.flow_features(book.liquidation_features(book.derivative_features(book.book_features(streams(spark, sf_dir)))))


SHOWN = "depth_bid_L1 depth_ask_L1 depth_bid_L3 depth_ask_L3 depth_bid_L5 depth_ask_L5 mark_price index_price open_interest funding_rate liq_total_count liq_long_count liq_short_count liq_long_notional liq_short_notional"


@query("book_and_ticker_bars", f"WITH {STREAMS} SELECT symbol, t, {sql.rounded(SHOWN)} FROM streams")
def book_and_ticker_bars(spark, sf_dir):
    df = streams(spark, sf_dir)
    return df.select("symbol", "t", *rounded(df, SHOWN))


FEATURES = "mid_price relative_spread microprice_vs_mid depth_imbalance_L1 depth_imbalance_L3 depth_imbalance_L5 ofi_L1 ofi_L3 ofi_L5 ofi_agg basis_pct pre_funding liq_burst_ratio liq_directional_imbalance trade_intensity kyle_lambda vol_ratio"


@query("book_features", f"WITH {BOOKED} SELECT symbol, t, {sql.rounded(FEATURES, 5)}, {sql.rounded('dollar_tsi', 2)} FROM booked")
def book_features(spark, sf_dir):
    df = booked(spark, sf_dir)
    return df.select("symbol", "t", *rounded(df, FEATURES, 5), *rounded(df, "dollar_tsi", 2))


LATE = "relative_spread depth_imbalance_L5 ofi_agg basis_pct"


SIGNALS, SIZES = ("trade_imbalance", "ofi_agg", "depth_imbalance_L5", "relative_spread", "dollar_tsi", "kyle_lambda"), (30, 60, 300, 900)
_ROLLED = [(f"{c}_roll{n}_{s}", 2 if c == "dollar_tsi" else 5) for c in SIGNALS for n in SIZES for s in ("mean", "std")]


@query("point_in_time_signals", f"""WITH {BOOKED}, late AS (SELECT * REPLACE ({", ".join(f"lag({c}) OVER w AS {c}" for c in LATE.split())}) FROM booked {_W}),
  r AS (SELECT symbol, t, {LATE.replace(' ', ', ')}, {", ".join(f"{sql.mean(c, n, max(1, n // 4))} AS {c}_roll{n}_mean, {sql.rolled(f'stddev_samp({c})', c, n, max(2, n // 4))} AS {c}_roll{n}_std" for c in SIGNALS for n in SIZES)} FROM late)
  SELECT symbol, t, {sql.rounded(LATE, 5)}, {", ".join(f"round({c}, {d}) + 0.0 AS {c}" for c, d in _ROLLED)} FROM r""")
def point_in_time_signals(spark, sf_dir):
    df = W.in_blocks(booked(spark, sf_dir), 1 + max(SIZES), lambda rows, w: book.rolling_signals(book.point_in_time(rows, w=w), SIGNALS, SIZES, w))
    return df.select("symbol", "t", *rounded(df, LATE, 5), *[(F.round(c, d) + 0.0).alias(c) for c, d in _ROLLED])


@query("anchor_features", f"""WITH {BOOKED}, anchor AS (SELECT * FROM booked WHERE symbol = '{ANCHOR}'), j AS (SELECT b.symbol, b.t, b.relative_spread, a.mid_price AS m, a.bid_size AS bs, a.ask_size AS sz, a.trade_imbalance AS ti, a.volume AS v, a.ofi_L1 AS o, a.relative_spread AS rs, a.liq_directional_imbalance AS d FROM booked b LEFT JOIN anchor a ON a.t = b.t),
  r AS (SELECT *, m / nullif(lag(m) OVER w, 0) - 1 AS r1, m / nullif(lag(m, 4) OVER w, 0) - 1 AS r4 FROM j {_W})
  SELECT symbol, t, round(lag(r1) OVER w, 6) + 0.0 AS btc_mid_return_lag1, round(lag(r4) OVER w, 6) + 0.0 AS btc_mid_return_lag4, round((bs - sz) / (bs + sz + 1e-10), 6) + 0.0 AS btc_book_imbalance_L1, round(CASE WHEN v IS NOT NULL THEN least(greatest(least(greatest((ti + 1) / 2 * v, 0), v) / (v + 1e-10), 0), 1) END, 6) + 0.0 AS btc_trade_imbalance,
  round(o, 6) + 0.0 AS btc_ofi_L1, round(rs / (relative_spread + 1e-10), 6) + 0.0 AS btc_spread_ratio, round(d, 6) + 0.0 AS btc_liq_directional FROM r {_W}""")
def anchor_features(spark, sf_dir):
    rows = booked(spark, sf_dir)
    df = book.anchor_features(rows, rows.where(F.col("symbol") == ANCHOR))
    return df.select("symbol", "t", *rounded(df, "btc_mid_return_lag1 btc_mid_return_lag4 btc_book_imbalance_L1 btc_trade_imbalance btc_ofi_L1 btc_spread_ratio btc_liq_directional"))


@query("calendar_columns", f"WITH {sql.uniform(HOUR)} SELECT symbol, t, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, t + {HOUR} AS close_timestamp, CAST(hour(d) AS INTEGER) AS hour, CAST(week(d) AS INTEGER) AS iso_week, CAST(isodow(d) - 1 AS INTEGER) AS weekday FROM (SELECT symbol, t, make_timestamp(t * 1000000) AS d FROM bars)")
def calendar_columns(spark, sf_dir):
    return hourly(spark, sf_dir).select("symbol", "t", *[c.alias(name) for name, c in book.calendar(F.col("t"), HOUR).items()])


_CUT = {"liq_burst_ratio": (0.75, 0.25), "depth_imbalance_L5": (0.6, 0.4), "relative_spread": (0.5,)}
_CUT_SQL = ", ".join(f"quantile_cont({c}, {q}) AS {c}_q{round(q * 100)}" for c, qs in _CUT.items() for q in qs)
_CUT_NAMES = " ".join(predicates.cut_name(c, q) for c, qs in _CUT.items() for q in qs)


@query("whole_cutoffs", f"WITH {BOOKED}, cuts AS (SELECT symbol, {_CUT_SQL} FROM booked GROUP BY 1) SELECT symbol, t, {sql.rounded(_CUT_NAMES, 5)} FROM booked JOIN cuts USING (symbol)")
def whole_cutoffs(spark, sf_dir):
    df = predicates.with_cutoffs(booked(spark, sf_dir), _CUT)
    return df.select("symbol", "t", *rounded(df, _CUT_NAMES, 5))


_OVER = "OVER (PARTITION BY symbol ORDER BY day ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"


@query("trailing_cutoffs", f"""WITH {BOOKED}, daily AS (SELECT symbol, day, {_CUT_SQL} FROM booked GROUP BY 1, 2), days AS (SELECT symbol, unnest(range(a, b + 1, 86400)) AS day FROM (SELECT symbol, min(day) AS a, max(day) AS b FROM daily GROUP BY 1)),
  trail AS (SELECT symbol, day, {", ".join(f"CASE WHEN count({n}) {_OVER} >= 5 THEN avg({n}) {_OVER} END AS {n}" for n in _CUT_NAMES.split())} FROM days LEFT JOIN daily USING (symbol, day)) SELECT symbol, t, {sql.rounded(_CUT_NAMES, 5)} FROM booked LEFT JOIN trail USING (symbol, day)""")
def trailing_cutoffs(spark, sf_dir):
    df = predicates.with_daily_cutoffs(booked(spark, sf_dir), _CUT, 5)
    return df.select("symbol", "t", *rounded(df, _CUT_NAMES, 5))


#: Exponential means in SQL: one step for each row of a series.
PLAIN = f"""known AS (SELECT *, row_number() OVER w AS i, close - lag(close) OVER w AS step FROM {{source}} WHERE close IS NOT NULL {_W}),
  ewm AS (SELECT symbol, i, close AS e12, close AS e26, CAST(0 AS DOUBLE) AS macd, CAST(0 AS DOUBLE) AS e9 FROM known WHERE i = 1 UNION ALL
    SELECT symbol, i, e12, e26, e12 - e26 AS macd, e9 + 0.2 * (e12 - e26 - e9) AS e9 FROM (SELECT k.symbol, k.i, e12 + 2.0 / 13 * (k.close - e12) AS e12, e26 + 2.0 / 27 * (k.close - e26) AS e26, e9 FROM ewm e JOIN known k ON k.symbol = e.symbol AND k.i = e.i + 1)),
  plain AS (SELECT k.*, macd, macd - e9 AS macdhist, {", ".join(f"CASE WHEN count(step) OVER r{n} > 0 THEN 100 - 100 / (1 + avg(greatest(step, 0)) OVER r{n} / (avg(greatest(-step, 0)) OVER r{n} + 1e-10)) END AS rsi_{n}" for n in (7, 14, 28))}, avg(high - low) OVER r14 AS atr, stddev_samp(close) OVER r14 AS std,
    avg(close) OVER r20 + 2 * stddev_samp(close) OVER r20 AS bb_upper, avg(close) OVER r20 - 2 * stddev_samp(close) OVER r20 AS bb_lower, close - lag(close, 10) OVER w AS mom, 100 * (close / nullif(lag(close, 10) OVER w, 0) - 1) AS roc
    FROM known k JOIN ewm USING (symbol, i) WINDOW w AS (PARTITION BY symbol ORDER BY t), {", ".join(f"r{n} AS (PARTITION BY symbol ORDER BY t ROWS {n - 1} PRECEDING)" for n in (7, 14, 20, 28))})"""


@query("plain_indicators", f"WITH RECURSIVE {sql.uniform(HOUR)}, {sql.FLAT}, {PLAIN.format(source='flat')} SELECT b.symbol, b.t, round(rsi_14, 5) + 0.0 AS rsi, round(rsi_28, 5) + 0.0 AS rsi_28, {', '.join(f'round(p.{c}, 5) + 0.0 AS {c}' for c in 'rsi_7 macd macdhist atr std bb_upper bb_lower mom roc'.split())}, round(p.atr / (p.close + 1e-10) * 100, 5) + 0.0 AS natr FROM flat b LEFT JOIN plain p ON p.symbol = b.symbol AND p.t = b.t")
def plain_indicators(spark, sf_dir):
    df = indicators.plain_indicators(B.flat_where_empty(hourly(spark, sf_dir)))
    return df.select("symbol", "t", *rounded(df, " ".join(indicators.FALLBACK), 5))


@query("book_mid_indicators", f"WITH RECURSIVE {BOOKED}, mids AS (SELECT symbol, t, mid_price AS close, mid_price AS high, mid_price AS low FROM booked), {PLAIN.format(source='mids')} SELECT b.symbol, b.t, {', '.join(f'round(p.{c}, 5) + 0.0 AS {c}' for c in 'macd macdhist std mom'.split())} FROM booked b LEFT JOIN plain p ON p.symbol = b.symbol AND p.t = b.t")
def book_mid_indicators(spark, sf_dir):
    rows = indicators.priced(booked(spark, sf_dir).select("symbol", "t", "high", "low", "close", "mid_price"), "book_mid")
    df = indicators.plain_indicators(rows)
    return df.select("symbol", "t", *rounded(df, "macd macdhist std mom", 5))


_TOTALS = f"""flows AS (SELECT *, coalesce(sign(close - lag(close) OVER w), 0) * volume AS s, coalesce(((close - low) - (high - close)) / nullif(high - low, 0), 0) * volume AS p FROM candles {_W}), totals AS (SELECT *, sum(s) OVER u AS obv, sum(p) OVER u AS ad FROM flows WINDOW u AS (PARTITION BY symbol ORDER BY t ROWS UNBOUNDED PRECEDING))"""


@query("running_totals", f"WITH {sql.CANDLES}, {_TOTALS} SELECT symbol, t, {sql.rounded('obv ad', 3)}, round(coalesce(obv - lag(obv, 14) OVER w, 0), 3) + 0.0 AS obv_change, round(coalesce(ad - lag(ad, 14) OVER w, 0), 3) + 0.0 AS ad_change FROM totals {_W}")
def running_totals(spark, sf_dir):
    df = indicators.accumulation(tables.candles(spark, sf_dir))
    return df.select("symbol", "t", *rounded(df, "obv ad obv_change ad_change", 3))




_K5 = "100 * (close - {0}) / nullif({1} - {0}, 0)".format(sql.rolled("min(low)", "low", 5), sql.rolled("max(high)", "high", 5))


@query("more_windows", f"WITH {sql.CANDLES}, a AS (SELECT *, {_K5} AS fast FROM candles), b AS (SELECT *, {sql.mean('fast', 3)} AS stoch_k FROM a) SELECT symbol, t, round({sql.mean('close', 99)}, 4) + 0.0 AS sma_99, round(stoch_k, 4) + 0.0 AS stoch_k, round({sql.mean('stoch_k', 3)}, 4) + 0.0 AS stoch_d, round({sql.rolled('stddev_pop(close)', 'close', 14)}, 4) + 0.0 AS stddev_14, round({sql.mean('close', 5)} + 2 * {sql.rolled('stddev_pop(close)', 'close', 5)}, 4) + 0.0 AS tick_band_upper, round({sql.mean('close', 5)} - 2 * {sql.rolled('stddev_pop(close)', 'close', 5)}, 4) + 0.0 AS tick_band_lower FROM b")
def more_windows(spark, sf_dir):
    df = indicators.more_windows(tables.candles(spark, sf_dir))
    return df.select("symbol", "t", *rounded(df, "sma_99 stoch_k stoch_d stddev_14 tick_band_upper tick_band_lower", 4))


def smoothing(series: dict[str, tuple[str, int, str]], source: str, name: str) -> str:
    """Recursive SQL for smoothed series: output: (input column, n, share). Seeded with the mean of the first n known values."""
    start = ", ".join(f"CAST(0 AS BIGINT) AS n_{o}, CAST(0 AS DOUBLE) AS sum_{o}, CAST(NULL AS DOUBLE) AS {o}" for o in series)
    step = ", ".join(
        f"CASE WHEN k.{x} IS NULL THEN n_{o} ELSE n_{o} + 1 END, CASE WHEN k.{x} IS NULL THEN sum_{o} ELSE sum_{o} + k.{x} END, CASE WHEN k.{x} IS NULL THEN r.{o} WHEN n_{o} + 1 < {n} THEN NULL WHEN n_{o} + 1 = {n} THEN (sum_{o} + k.{x}) / {n} ELSE r.{o} + ({share}) * (k.{x} - r.{o}) END"
        for o, (x, n, share) in series.items()
    )
    outs = ", ".join(f"CASE WHEN k.{x} IS NOT NULL THEN r.{o} END AS {o}" for o, (x, _, _) in series.items())
    return f"{name}_r AS (SELECT symbol, CAST(0 AS BIGINT) AS i, {start} FROM (SELECT DISTINCT symbol FROM {source}) UNION ALL SELECT k.symbol, k.i, {step} FROM {name}_r r JOIN {source} k ON k.symbol = r.symbol AND k.i = r.i + 1), {name} AS (SELECT k.*, {outs} FROM {source} k JOIN {name}_r r ON r.symbol = k.symbol AND r.i = k.i)"


def _ema(x: str, n: int) -> tuple[str, int, str]:
    return x, n, f"2.0 / {n + 1}"


def _wilder(x: str, n: int) -> tuple[str, int, str]:
    return x, n, f"1.0 / {n}"


MOVES = f"""m0 AS (SELECT *, row_number() OVER w AS i, lag(close) OVER w AS before, close - lag(close) OVER w AS step, high - lag(high) OVER w AS rise, lag(low) OVER w - low AS fall FROM candles {_W}),
  moves AS (SELECT *, CASE WHEN step IS NOT NULL THEN greatest(step, 0) END AS gain, CASE WHEN step IS NOT NULL THEN greatest(-step, 0) END AS loss, CASE WHEN before IS NOT NULL THEN greatest(high, before) - least(low, before) END AS tr,
    CASE WHEN rise IS NOT NULL THEN CASE WHEN rise > fall AND rise > 0 THEN rise ELSE 0 END END AS up, CASE WHEN fall IS NOT NULL THEN CASE WHEN fall > rise AND fall > 0 THEN fall ELSE 0 END END AS down FROM m0)"""
_FIRST = {"e12": _ema("close", 12), "e26": _ema("close", 26), "e30": _ema("close", 30), **{f"g{n}": _wilder("gain", n) for n in (7, 14, 28)}, **{f"l{n}": _wilder("loss", n) for n in (7, 14, 28)}, **{f"a{n}": _wilder("tr", n) for n in (10, 14, 60)}, "plus": _wilder("up", 14), "minus": _wilder("down", 14)}
RECURSIVE = f"""{sql.CANDLES}, {MOVES}, {smoothing(_FIRST, 'moves', 's1')}, s2 AS (SELECT *, e12 - e26 AS macd, 100 * abs(plus - minus) / nullif(plus + minus, 0) AS dx, {", ".join(f"100 * g{n} / nullif(g{n} + l{n}, 0) AS rsi{n}" for n in (7, 14, 28))} FROM s1), {smoothing({'signal': _ema('macd', 9), 'adx': _wilder('dx', 14), 'f30': _ema('e30', 30)}, 's2', 's3')}, {smoothing({'h30': _ema('f30', 30)}, 's3', 's4')}"""


@query("recursive_indicators", f"WITH RECURSIVE {RECURSIVE} SELECT symbol, t, round(e12, 4) + 0.0 AS ema_12, round(macd, 4) + 0.0 AS macd, round(signal, 4) + 0.0 AS macd_signal, round(rsi14, 4) + 0.0 AS rsi, round(a14, 4) + 0.0 AS atr, round(adx, 4) + 0.0 AS adx FROM s4")
def recursive_indicators(spark, sf_dir):
    df = sequential.recursive_indicators(tables.candles(spark, sf_dir))
    return df.select("symbol", "t", *rounded(df, "ema_12 macd macd_signal rsi atr adx", 4))


@query("more_recursive", f"""WITH RECURSIVE {RECURSIVE}, k AS (SELECT *, CASE WHEN count(rsi14) OVER v >= 5 THEN 100 * (rsi14 - min(rsi14) OVER v) / nullif(max(rsi14) OVER v - min(rsi14) OVER v, 0) END AS sk, 100 * plus / a14 AS pd, 100 * minus / a14 AS md FROM s4 WINDOW v AS (PARTITION BY symbol ORDER BY t ROWS 4 PRECEDING))
  SELECT symbol, t, round(rsi7, 4) + 0.0 AS rsi_7, round(rsi28, 4) + 0.0 AS rsi_28, round(2 * rsi14 - 100, 4) + 0.0 AS cmo, round(a10, 3) + 0.0 AS atr_10, round(a60, 3) + 0.0 AS atr_60, round(100 * a14 / close, 4) + 0.0 AS natr, round(pd, 4) + 0.0 AS plus_di, round(md, 4) + 0.0 AS minus_di, round(100 * abs(pd - md) / nullif(pd + md, 0), 4) + 0.0 AS dx,
  round(100 * (h30 / lag(h30) OVER w - 1), 4) + 0.0 AS trix, round(sk, 3) + 0.0 AS stochrsi_k, round({sql.mean('sk', 3)}, 3) + 0.0 AS stochrsi_d FROM k {_W}""")
def more_recursive(spark, sf_dir):
    df = sequential.more_recursive(tables.candles(spark, sf_dir))
    return df.select("symbol", "t", *rounded(df, "rsi_7 rsi_28 cmo natr plus_di minus_di dx trix", 4), *rounded(df, "atr_10 atr_60 stochrsi_k stochrsi_d", 3))


SAR = f"""rows_ AS (SELECT *, row_number() OVER w AS i, lag(high) OVER w AS ph, lag(low) OVER w AS pl, lead(high) OVER w AS nh, lead(low) OVER w AS nl FROM candles {_W}),
  run AS (SELECT symbol, CAST(1 AS BIGINT) AS i, CAST(NULL AS DOUBLE) AS shown, nh + nl >= high + low AS rising, CASE WHEN nh + nl >= high + low THEN low ELSE high END AS stop, CASE WHEN nh + nl >= high + low THEN nh ELSE nl END AS far, CAST(0.02 AS DOUBLE) AS speed FROM rows_ WHERE i = 1
    UNION ALL SELECT symbol, i, shown, CASE WHEN hit THEN NOT rising ELSE rising END, CASE WHEN hit THEN far WHEN rising THEN least(moved, low, pl) ELSE greatest(moved, high, ph) END, CASE WHEN hit THEN CASE WHEN rising THEN low ELSE high END ELSE far2 END, CASE WHEN hit THEN CAST(0.02 AS DOUBLE) ELSE speed2 END
    FROM (SELECT *, stop + speed2 * (far2 - stop) AS moved FROM (SELECT k.symbol, k.i, k.high, k.low, k.ph, k.pl, r.stop AS shown, r.stop, r.rising, r.far, CASE WHEN rising THEN k.low <= r.stop ELSE k.high >= r.stop END AS hit, CASE WHEN rising THEN greatest(k.high, far) ELSE least(k.low, far) END AS far2, CASE WHEN (rising AND k.high > far) OR (NOT rising AND k.low < far) THEN least(0.2, speed + 0.02) ELSE speed END AS speed2 FROM run r JOIN rows_ k ON k.symbol = r.symbol AND k.i = r.i + 1))),
  sar AS (SELECT k.symbol, k.t, shown AS sar FROM rows_ k JOIN run r ON r.symbol = k.symbol AND r.i = k.i)"""


@query("parabolic_stop", f"WITH RECURSIVE {sql.CANDLES}, {SAR} SELECT symbol, t, round(sar, 4) + 0.0 AS stop FROM sar")
def parabolic_stop(spark, sf_dir):
    df = sequential.parabolic_stop(tables.candles(spark, sf_dir))
    return df.select("symbol", "t", *rounded(df, "stop", 4))


_TIGHT_W = {n: f"OVER (PARTITION BY symbol ORDER BY t ROWS {n - 1} PRECEDING)" for n in (3, 10)}


TIGHT = f"""tr AS (SELECT symbol, t, high, close, a10 / nullif(a60, 0) AS ratio, {sql.rolled('max(high)', 'high', 20)} AS level, {sql.mean('close', 9)} - {sql.mean('close', 21)} AS gap FROM s4), tq AS (SELECT *, {sql.rolled('quantile_cont(ratio, 0.4)', 'ratio', 60)} AS q, lag(level) OVER w AS lv FROM tr {_W}),
  tf AS (SELECT *, coalesce(ratio <= q AND close / nullif(lv, 0) - 1 BETWEEN -0.045 AND 0, false) AS tight, {sql.rolled('stddev_samp(gap)', 'gap', 10)} / nullif(close, 0) AS apart FROM tq), tightly AS (SELECT symbol, t, tight AND sum(CASE WHEN tight THEN 1 ELSE 0 END) {_TIGHT_W[3]} = 3 AND coalesce(apart < {{apart}}, false) AS convergence_tight FROM tf)"""


def _recursed(spark, sf_dir):
    """Candles with the indicators that need a recurrence: one sort by series serves all of them."""
    base = tables.candles(spark, sf_dir)
    rows = sequential.parabolic_stop(sequential.more_recursive(sequential.recursive_indicators(base)))
    return rows.select(*base.columns, "adx", "atr_10", "atr_60", F.col("stop").alias("sar"))


@query("convergence_tight", f"WITH RECURSIVE {RECURSIVE}, {TIGHT.format(apart=0.008)} SELECT symbol, t, convergence_tight FROM tightly")
def convergence_tight(spark, sf_dir):
    return indicators.convergence_tight(_recursed(spark, sf_dir)).select("symbol", "t", "convergence_tight")


@query("scale_free", f"""WITH RECURSIVE {sql.CANDLES}, {SAR}, {_TOTALS}, {PLAIN.format(source='totals')} SELECT symbol, t, round((close - sar) / nullif(close, 0), 5) + 0.0 AS sar_dist, round((close - bb_lower) / nullif(bb_upper - bb_lower, 0), 5) + 0.0 AS bb_pctb, round((bb_upper - bb_lower) / nullif(close, 0), 5) + 0.0 AS bb_width,
  round(macd / nullif(close, 0), 5) + 0.0 AS macd_norm, round(macdhist / nullif(close, 0), 5) + 0.0 AS macdhist_norm, {", ".join(f"round((({x}) - lag({x}, 20) OVER w) / nullif({sql.rolled('sum(volume)', 'volume', 20)}, 0), 5) + 0.0 AS {x}_slope" for x in ('obv', 'ad'))} FROM plain JOIN sar USING (symbol, t) {_W}""")
def scale_free(spark, sf_dir):
    rows = indicators.plain_indicators(indicators.accumulation(sequential.parabolic_stop(tables.candles(spark, sf_dir)).withColumnRenamed("stop", "sar")))
    df = indicators.scale_free(rows)
    return df.select("symbol", "t", *rounded(df, "sar_dist bb_pctb bb_width macd_norm macdhist_norm obv_slope ad_slope", 5))


def counted(rows, family: str):
    """One row for each atom and side: how many rows hold, and the sum of their times."""
    sums, names = [], []
    for atom in predicates.ATOMS[family]:
        for side in ("long", "short"):
            holds = predicates.predicate(atom, side, rows.columns, family)
            names.append((atom, side))
            sums.append(F.struct(F.lit(atom).alias("atom"), F.lit(side).alias("side"), F.count(F.when(holds, 1)).alias("n"), F.coalesce(F.sum(F.when(holds, F.col("t"))), F.lit(0)).alias("t_sum")))
    return rows.agg(F.array(*sums).alias("all")).select(F.explode("all").alias("x")).select("x.*")


def counts_sql(source: str, atoms: dict[str, tuple[str, str]]) -> str:
    """The same from SQL conditions (long, short); "false" for a side that an atom does not have."""
    return " UNION ALL ".join(f"SELECT '{a}' AS atom, '{side}' AS side, count(*) FILTER ({x}) AS n, CAST(coalesce(sum(t) FILTER ({x}), 0) AS BIGINT) AS t_sum FROM {source}" for a, both in atoms.items() for side, x in zip(("long", "short"), both, strict=True))


_UP, _DOWN = "close > mvg1 AND mvg1 > mvg2", "close < mvg1 AND mvg1 < mvg2"
_UNDER, _CALM = "(close < mvg1 AND close < mvg2 AND close < mvg3)", f"({_DOWN} AND price_range_pct < price_range_pct_q50)"
_SURGE = f"({_DOWN} AND quote_vol_ratio > 2)"
KLINE_SQL = {
    "low_vol": ("price_range_pct < price_range_pct_q50",) * 2, "high_vol": ("price_range_pct > price_range_pct_q50",) * 2, **{f"high_vol_q{q}": (f"price_range_pct > price_range_pct_q{q}",) * 2 for q in (80, 90, 95)}, "convergence_tight": ("convergence_tight",) * 2,
    "strong_candle": ("close / open - 1 > 0.005", "close / open - 1 < -0.005"), "rsi_oversold": ("rsi_14 < 30", "false"), "rsi_overbought": ("false", "rsi_14 > 70"), "macd_bullish": ("macdhist > 0", "false"), "macd_bearish": ("false", "macdhist < 0"), "stoch_bullish": ("stoch_k > stoch_d", "false"),
    "cci_reversal": ("cci > 100", "cci < -100"), "adx_trend": ("adx > 25",) * 2, "mom_positive": ("mom > 0", "mom < 0"), "low_volume": ("quote_vol_ratio < 1",) * 2, "high_volume": ("quote_vol_ratio > 1",) * 2, "vol_breakout": ("quote_vol_ratio > 2",) * 2,
    "buy_pressure": ("place > 0.55", "place < 0.45"), "mfi_oversold": ("mfi < 30", "false"), "mfi_overbought": ("false", "mfi > 70"), "bop_bullish": ("bop > 0.1", "false"), "bop_bearish": ("false", "bop < -0.1"), "roc_positive": ("roc > 0", "false"), "roc_negative": ("false", "roc < 0"),
    "trend_aligned": (_UP, _DOWN), "strong_trend": (f"{_UP} AND mvg2 > mvg3", f"{_DOWN} AND mvg2 < mvg3"), "ma_momentum": ("mvg1 > mvg2 AND mvg1 > mvg3", "mvg1 < mvg2 AND mvg1 < mvg3"), "above_all_mas": ("close > mvg1 AND close > mvg2 AND close > mvg3", _UNDER),
    "near_ma": ("(close - mvg1) / mvg1 < 0.02", "(mvg1 - close) / mvg1 < 0.02"), "bb_rebound": ("close < bb_lower", "close > bb_upper"), "sar_aligned": ("close > sar", "close < sar"), "combined_union": ("false", f"{_CALM} OR {_SURGE}"), "combined_intersection": ("false", f"{_CALM} AND {_SURGE}"),
    "combined_union_plus": ("false", f"{_CALM} OR {_SURGE} OR {_UNDER}"), "combined_union_alt": ("false", f"{_CALM} OR {_UNDER}"),
}


_W14 = "OVER (PARTITION BY symbol ORDER BY t ROWS 13 PRECEDING)"
_MONEY = f"""a0 AS (SELECT symbol, t, high, low, close, volume, (high + low + close) / 3 AS tp, lag(close) OVER w AS pc, lag((high + low + close) / 3) OVER w AS ptp, (high + low + close) / 3 * volume AS flow FROM candles {_W}), b0 AS (SELECT *, {sql.mean('tp', 14)} AS tpm, list(tp) {_W14} AS tps FROM a0),
  money AS (SELECT symbol, t, (tp - tpm) / nullif(0.015 * list_sum(list_transform(tps, lambda v: abs(v - tpm))) / 14, 0) AS cci, CASE WHEN count(pc) {_W14} >= 14 THEN 100 * sum(CASE WHEN tp > ptp THEN flow ELSE 0 END) {_W14} / nullif(sum(CASE WHEN tp > ptp THEN flow WHEN tp < ptp THEN flow ELSE 0 END) {_W14}, 0) END AS mfi FROM b0)"""


@query("kline_atoms", f"""WITH RECURSIVE {RECURSIVE}, {TIGHT.format(apart=0.008)}, {SAR}, {_MONEY}, base AS (SELECT c.*, (high - low) / nullif(close, 0) AS price_range_pct, {_K5} AS fast FROM candles c), {PLAIN.format(source='base')}, k AS (SELECT *, {sql.mean('fast', 3)} AS stoch_k FROM plain), x AS (SELECT *, {sql.mean('stoch_k', 3)} AS stoch_d, {sql.mean('close', 7)} AS mvg1, {sql.mean('close', 25)} AS mvg2, {sql.mean('close', 99)} AS mvg3,
  volume / nullif({sql.mean('volume', 7, 1)}, 0) AS quote_vol_ratio, (close - low) / nullif(high - low, 0) AS place, (close - open) / nullif(high - low, 0) AS bop FROM k), cuts AS (SELECT symbol, {", ".join(f"quantile_cont(price_range_pct, {q}) AS price_range_pct_q{round(100 * q)}" for q in (0.5, 0.8, 0.9, 0.95))} FROM x GROUP BY 1),
  f AS (SELECT x.*, cuts.* EXCLUDE (symbol), s4.adx, sar.sar, cci, mfi, convergence_tight FROM x JOIN cuts USING (symbol) JOIN s4 ON s4.symbol = x.symbol AND s4.t = x.t JOIN sar ON sar.symbol = x.symbol AND sar.t = x.t JOIN money ON money.symbol = x.symbol AND money.t = x.t JOIN tightly ON tightly.symbol = x.symbol AND tightly.t = x.t) {counts_sql('f', KLINE_SQL)}""")
def kline_atoms(spark, sf_dir):
    w = W.series()
    c, span = F.col("close"), F.col("high") - F.col("low")
    rows = _recursed(spark, sf_dir)
    rows = features.indicators(rows).select(*rows.columns, "cci", F.col("money_flow").alias("mfi"))
    rows = indicators.plain_indicators(indicators.more_windows(indicators.convergence_tight(rows)))
    rows = rows.withColumns({
        "price_range_pct": W.ratio(span, c), "open_close_pct": W.ratio(c, F.col("open")) - 1, "quote_vol_ratio": W.ratio(F.col("volume"), W.mean(F.col("volume"), 7, w, 1)), "buy_pressure": W.ratio(c - F.col("low"), span), "bop": W.ratio(c - F.col("open"), span),
        "mvg1": W.mean(c, 7, w), "mvg2": W.mean(c, 25, w), "mvg3": F.col("sma_99"),
    })
    return counted(predicates.with_cutoffs(rows, predicates.CUTOFFS["kline"]), "kline")


_TICK = {
    "high_liquidation_pressure": ("liq_burst_ratio > liq_burst_ratio_q75",) * 2, "low_liquidation_pressure": ("liq_burst_ratio < liq_burst_ratio_q25",) * 2, "funding_positive": ("funding_rate > 0",) * 2, "funding_negative": ("funding_rate < 0",) * 2, "deep_book": ("depth_imbalance_L5 > depth_imbalance_L5_q60", "depth_imbalance_L5 < depth_imbalance_L5_q40"),
    "trade_imbalance": ("trade_imbalance > 0", "trade_imbalance < 0"), "basis_premium": ("basis_pct > 0",) * 2, "basis_discount": ("basis_pct < 0",) * 2, "pre_funding_settlement": ("pre_funding > 0",) * 2, "ofi_positive": ("ofi_agg > 0", "ofi_agg < 0"), "tight_spread": ("round(relative_spread, 9) < round(relative_spread_q50, 9)",) * 2, "wide_spread": ("round(relative_spread, 9) > round(relative_spread_q50, 9)",) * 2,
    "rsi_oversold": ("rsi_14 < 30",) * 2, "rsi_overbought": ("rsi_14 > 70",) * 2, "macd_bullish": ("macdhist > 0", "macdhist < 0"), "macd_bearish": ("macdhist < 0", "macdhist > 0"), "adx_trend": ("adx > 25",) * 2, "low_volume": ("vol_ratio < 1",) * 2, "high_volume": ("vol_ratio > 1",) * 2, "vol_breakout": ("vol_ratio > 2",) * 2,
    "high_vol": ("price_range_pct > price_range_pct_q50",) * 2, "low_vol": ("price_range_pct < price_range_pct_q50",) * 2, "mom_positive": ("mom > 0", "mom < 0"),
}
_FLOW = {
    "buy_flow": "trade_imbalance > 0.2", "sell_flow": "trade_imbalance < -0.2", "bid_heavy": "depth_imbalance_L5 > 0.2", "ask_heavy": "depth_imbalance_L5 < -0.2", "ofi_positive": "ofi_agg > 0", "ofi_negative": "ofi_agg < 0", "short_liq_spike": "liq_burst_ratio > 2 AND liq_directional_imbalance > 0",
    "long_liq_spike": "liq_burst_ratio > 2 AND liq_directional_imbalance < 0", "liq_spike": "liq_burst_ratio > 2", "high_spread": "relative_spread > 1.5 * relative_spread_median", "low_spread": "relative_spread < 0.7 * relative_spread_median",
}
_TICK_CUTS = {"liq_burst_ratio": (0.75, 0.25), "depth_imbalance_L5": (0.6, 0.4), "relative_spread": (0.5,), "price_range_pct": (0.5,)}


def _tick_rows(spark, sf_dir):
    rows = indicators.plain_indicators(booked(spark, sf_dir))
    traded = rows.where("close is not null and high is not null and low is not null").select("symbol", "t", "high", "low", "close")
    rows = rows.join(sequential.recursive_indicators(traded).select("symbol", "t", "adx"), ["symbol", "t"], "left")
    return rows.withColumns({"price_range_pct": W.ratio(F.col("high") - F.col("low"), F.col("close")), "relative_spread": F.round("relative_spread", 9)})


_TICK_BASE = f"""WITH RECURSIVE {BOOKED}, tb AS (SELECT * REPLACE (round(relative_spread, 9) AS relative_spread), (high - low) / nullif(close, 0) AS price_range_pct FROM booked), {MOVES.replace('FROM candles', 'FROM (SELECT symbol, t, high, low, close FROM tb WHERE close IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL)')}, {smoothing({'plus': _wilder('up', 14), 'minus': _wilder('down', 14)}, 'moves', 't1')}, t2 AS (SELECT *, 100 * abs(plus - minus) / nullif(plus + minus, 0) AS dx FROM t1), {smoothing({'adx': _wilder('dx', 14)}, 't2', 'directed')}, {PLAIN.format(source='tb')}, cuts AS (SELECT symbol, {", ".join(f"quantile_cont({c}, {q}) AS {c}_q{round(q * 100)}" for c, qs in _TICK_CUTS.items() for q in qs)} FROM tb GROUP BY 1), f AS (SELECT b.*, adx, rsi_14, rsi_28, macdhist, mom, cuts.* EXCLUDE (symbol) FROM tb b LEFT JOIN plain p ON p.symbol = b.symbol AND p.t = b.t LEFT JOIN directed ON directed.symbol = b.symbol AND directed.t = b.t JOIN cuts ON cuts.symbol = b.symbol)"""


@query("tick_atoms", f"{_TICK_BASE} {counts_sql('f', _TICK)}")
def tick_atoms(spark, sf_dir):
    rows = predicates.with_cutoffs(_tick_rows(spark, sf_dir), predicates.CUTOFFS["tick"])
    return counted(rows.withColumn("relative_spread_q50", F.round("relative_spread_q50", 9)), "tick")


@query("flow_atoms", f"WITH {BOOKED}, f AS (SELECT *, {sql.rolled('quantile_cont(relative_spread, 0.5)', 'relative_spread', 30, 10)} AS relative_spread_median FROM booked) {counts_sql('f', {a: (x, x) for a, x in _FLOW.items()})}")
def flow_atoms(spark, sf_dir):
    rows = booked(spark, sf_dir)
    return counted(rows.withColumn("relative_spread_median", W.quantile(F.col("relative_spread"), 0.5, 30, W.series(), 10)), "flow")
