"""DuckDB SQL for the queries of catalog.py, built from shared common table expressions."""

from __future__ import annotations

TICKS = """ticks AS (SELECT event_type AS symbol, epoch_us(ts) AS us, event_id AS seq, CASE WHEN user_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, value AS price,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) + 1 AS amount FROM events)"""
QUOTES = """quotes AS (SELECT event_type AS symbol, epoch_us(ts) AS us, event_id AS seq, value * 0.999 AS bid, value * 1.001 AS ask,
  CAST(user_id % 7 + 1 AS DOUBLE) AS bid_size, CAST(user_id % 5 + 1 AS DOUBLE) AS ask_size FROM events)"""
CANDLES = """candles AS (SELECT o_orderpriority AS symbol, CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) AS t, arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
  arg_max(o_totalprice, o_orderkey) AS close, sum(coalesce(q, 0)) AS volume, count(o_totalprice) AS trades
  FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


def trade_bars(seconds: int) -> str:
    return f"""bars0 AS (SELECT symbol, (us // 1000000) // {seconds} * {seconds} AS t, first(price ORDER BY us, seq) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY us, seq) AS close,
  sum(amount) AS volume, count(price) AS trades, sum(CASE WHEN side = 'buy' THEN amount ELSE 0 END) AS buy_volume, sum(price * amount) AS pv FROM ticks GROUP BY 1, 2),
  tbars AS (SELECT symbol, t, open, high, low, close, volume, trades, buy_volume, volume - buy_volume AS sell_volume, pv / (volume + 1e-10) AS vwap, (2 * buy_volume - volume) / (volume + 1e-10) AS imbalance FROM bars0)"""


def uniform(seconds: int) -> str:
    return f"""{TICKS}, {QUOTES}, {trade_bars(seconds)},
  qbars AS (SELECT symbol, (us // 1000000) // {seconds} * {seconds} AS t, last(bid ORDER BY us, seq) AS bid, last(ask ORDER BY us, seq) AS ask, last(bid_size ORDER BY us, seq) AS bid_size, last(ask_size ORDER BY us, seq) AS ask_size FROM quotes GROUP BY 1, 2),
  grid AS (SELECT symbol, day, unnest(range(day, day + 86400, {seconds})) AS t FROM (SELECT DISTINCT symbol, us // 1000000 // 86400 * 86400 AS day FROM ticks)),
  joined AS (SELECT g.symbol, g.day, g.t, b.* EXCLUDE (symbol, t), q.* EXCLUDE (symbol, t) FROM grid g LEFT JOIN tbars b ON b.symbol = g.symbol AND b.t = g.t LEFT JOIN qbars q ON q.symbol = g.symbol AND q.t = g.t),
  bars AS (SELECT symbol, t, day, trades IS NOT NULL AS has_trade, open, high, low, last_value(close IGNORE NULLS) OVER w AS close, vwap, coalesce(volume, 0) AS volume, coalesce(trades, 0) AS trades, coalesce(buy_volume, 0) AS buy_volume,
    coalesce(sell_volume, 0) AS sell_volume, coalesce(imbalance, 0) AS imbalance, last_value(bid IGNORE NULLS) OVER w AS bid, last_value(ask IGNORE NULLS) OVER w AS ask, last_value(bid_size IGNORE NULLS) OVER w AS bid_size, last_value(ask_size IGNORE NULLS) OVER w AS ask_size
    FROM joined WINDOW w AS (PARTITION BY symbol, day ORDER BY t ROWS UNBOUNDED PRECEDING))"""


FLAT = "flat AS (SELECT * REPLACE (coalesce(open, close) AS open, coalesce(high, close) AS high, coalesce(low, close) AS low, coalesce(vwap, close) AS vwap) FROM bars)"


def rounded(columns: str, digits: int = 6) -> str:
    """round(x, digits) AS x for each name."""
    return ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in columns.split())


def mean(x: str, n: int, least: int | None = None) -> str:
    over = f"OVER (PARTITION BY symbol ORDER BY t ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({x}) {over} >= {n if least is None else least} THEN avg({x}) {over} END"


def rolled(f: str, x: str, n: int, least: int | None = None) -> str:
    over = f"OVER (PARTITION BY symbol ORDER BY t ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({x}) {over} >= {n if least is None else least} THEN {f} {over} END"


PRICE = f"""price AS (SELECT *, (high - low) / nullif(close, 0) AS range_pct, close / nullif(open, 0) - 1 AS open_close_pct, (close - low) / (high - low + 1e-10) AS close_in_range,
  close / nullif(lag(close) OVER w, 0) - 1 AS return_1, close / nullif(lag(close, 2) OVER w, 0) - 1 AS return_2, close / nullif(lag(close, 3) OVER w, 0) - 1 AS return_3,
  volume / nullif(lag(volume) OVER w, 0) - 1 AS volume_change, volume / nullif({mean("volume", 7, 1)}, 0) AS volume_ratio FROM {{source}} WINDOW w AS (PARTITION BY symbol ORDER BY t))"""

LADDER = """ladder0 AS (SELECT *, lead(close, {h}) OVER w / nullif(close, 0) - 1 AS gain, min(low) OVER (PARTITION BY symbol ORDER BY t ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING) AS lo, max(high) OVER (PARTITION BY symbol ORDER BY t ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING) AS hi
    FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY t)),
  ladder1 AS (SELECT *, CAST(coalesce(1 + least(floor(greatest((close - lo) / close, 0) / {step} + 1e-9), {top}), 1) AS INTEGER) AS rungs_long, CAST(coalesce(1 + least(floor(greatest((hi - close) / close, 0) / {step} + 1e-9), {top}), 1) AS INTEGER) AS rungs_short FROM ladder0),
  ladder AS (SELECT *, list_sum(list_transform(range(1, rungs_long + 1), lambda j: (1 + gain) / (1 - (j - 1) * {step}) - 1)) - 2 * {fee} * rungs_long AS target_long,
    -list_sum(list_transform(range(1, rungs_short + 1), lambda j: (1 + gain) / (1 + (j - 1) * {step}) - 1)) - 2 * {fee} * rungs_short AS target_short FROM ladder1)"""

PAIRS = f"""{CANDLES}, pairs AS (SELECT a.symbol || '/' || b.symbol AS pair, a.t, ln(a.close) AS x, ln(b.close) AS y FROM candles a JOIN candles b ON a.t = b.t AND a.symbol < b.symbol),
  fits AS (SELECT pair, CASE WHEN count(x) >= 10 THEN coalesce(regr_slope(y, x), 1) ELSE 1 END AS hedge, avg(x) AS mx, avg(y) AS my FROM pairs GROUP BY 1),
  spreads AS (SELECT pair, t, x, y, hedge, y - hedge * x - (my - hedge * mx) AS spread FROM pairs JOIN fits USING (pair)),
  zs AS (SELECT *, (spread - avg(spread) OVER w) / nullif(stddev_samp(spread) OVER w, 0) AS z0, count(spread) OVER w AS n0 FROM spreads WINDOW w AS (PARTITION BY pair ORDER BY t ROWS 95 PRECEDING)),
  scores AS (SELECT * EXCLUDE (z0, n0), CASE WHEN n0 >= 96 THEN z0 END AS z FROM zs)"""

CHAIN = """chain AS (SELECT l_linestatus AS asset, CAST(epoch(l_shipdate) AS BIGINT) // 2419200 * 2419200 AS day, CASE WHEN l_returnflag = 'R' THEN 'put' ELSE 'call' END AS kind, p_retailprice AS strike,
    CAST(epoch(l_shipdate) AS BIGINT) // 2419200 * 2419200 + 604800 * (1 + l_suppkey % 6) AS expiry, CASE WHEN l_linenumber <> 3 THEN l_discount + 0.2 END AS mark_iv, CASE WHEN l_linenumber <> 5 THEN l_discount + 0.19 END AS bid_iv, l_discount + 0.21 AS ask_iv,
    l_extendedprice / l_quantity AS spot, (l_suppkey % 100) / 100.0 AS delta, l_quantity AS open_interest, l_orderkey * 10 + l_linenumber AS seq FROM lineitem JOIN part ON p_partkey = l_partkey),
  marked0 AS (SELECT *, coalesce(mark_iv, (coalesce(bid_iv, ask_iv) + coalesce(ask_iv, bid_iv)) / 2) AS iv FROM chain),
  exps AS (SELECT asset, day, min(expiry) FILTER (expiry > day) AS weekly, first(expiry ORDER BY abs(expiry - day - 2592000), expiry) FILTER (expiry > day) AS monthly FROM marked0 GROUP BY 1, 2),
  spots AS (SELECT asset, day, first(spot ORDER BY seq, spot, strike, expiry, kind) AS spot_open, last(spot ORDER BY seq, spot, strike, expiry, kind) AS spot_close FROM marked0 GROUP BY 1, 2),
  base AS (SELECT m.* EXCLUDE (spot), weekly, monthly, spot_open, spot_close FROM marked0 m JOIN exps USING (asset, day) JOIN spots USING (asset, day)),
  atms AS (SELECT asset, day, first(strike ORDER BY abs(strike - spot_close), strike) AS atm FROM base WHERE expiry = weekly GROUP BY 1, 2),
  wings0 AS (SELECT asset, day, kind, strike, avg(delta) AS d, avg(iv) AS iv FROM base WHERE expiry = weekly GROUP BY 1, 2, 3, 4),
  wings AS (SELECT asset, day, first(iv ORDER BY abs(d - 0.25), strike) FILTER (kind = 'call') AS wc, first(iv ORDER BY abs(d - 0.25), strike) FILTER (kind = 'put') AS wp FROM wings0 WHERE abs(d - 0.25) <= 0.12 GROUP BY 1, 2)"""
