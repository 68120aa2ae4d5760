"""Queries on labels and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bars, decisions, features, labels
from ..operators import windows as W
from ..sources import driver_tables as tables
from . import oracles as sql
from .catalog import VOTES, hourly
from .registry import HOUR, query, rounded

STEP, MOST, FEE = 0.01, 4, 0.0005
_W = "WINDOW w AS (PARTITION BY symbol ORDER BY t)"


def _ahead(f: str, a: int, b: int) -> str:
    return f"{f} OVER (PARTITION BY symbol ORDER BY t ROWS BETWEEN {a} FOLLOWING AND {b} FOLLOWING)"


def _rungs(against: str) -> str:
    return f"CAST(coalesce(1 + least(floor(greatest({against}, 0) / {STEP} + 1e-9), {MOST - 1}), 1) AS INTEGER)"


def _ladder(gain: str, n: str, sign: str) -> str:
    total = f"list_sum(list_transform(range(1, {n} + 1), lambda j: (1 + {gain}) / (1 {sign} (j - 1) * {STEP}) - 1))"
    return f"{'-' if sign == '+' else ''}{total} - 2 * {FEE} * {n}"


def _filled(h: int, long: str, short: str, rungs: bool) -> str:
    n = (_rungs("(close - lo) / close"), _rungs("(hi - close) / close")) if rungs else ("1", "1")
    return f"""e AS (SELECT *, lead(close, {h}) OVER w AS ch, lead(close, {2 * h}) OVER w AS chh, {_ahead('min(low)', 1, h)} AS lo, {_ahead('max(high)', 1, h)} AS hi, {_ahead('min(low)', h + 1, 2 * h)} AS lo2, {_ahead('max(high)', h + 1, 2 * h)} AS hi2 FROM candles {_W}), g AS (SELECT *, {long} AS gl, {short} AS gs, {n[0]} AS nl, {n[1]} AS ns FROM e)
  SELECT symbol, t, round({_ladder('gl', 'nl', '-')}, 6) + 0.0 AS target_long, round({_ladder('gs', 'ns', '+')}, 6) + 0.0 AS target_short FROM g"""


_PLAIN = "ch / close - 1"
_TAKER = ("CASE WHEN chh IS NOT NULL THEN (CASE WHEN hi2 >= ch THEN ch ELSE chh END) / close - 1 END", "CASE WHEN chh IS NOT NULL THEN (CASE WHEN lo2 <= ch THEN ch ELSE chh END) / close - 1 END")


def _target(spark, sf_dir, horizon: int, fill: str):
    df = labels.filled_target(tables.candles(spark, sf_dir), horizon, STEP, MOST, FEE, fill)
    return df.select("symbol", "t", *rounded(df, "target_long target_short"))


@query("target_two_bars", f"WITH {sql.CANDLES}, {_filled(2, _PLAIN, _PLAIN, True)}")
def target_two_bars(spark, sf_dir):
    return _target(spark, sf_dir, 2, "ladder")


@query("target_flat", f"WITH {sql.CANDLES}, {_filled(3, _PLAIN, _PLAIN, False)}")
def target_flat(spark, sf_dir):
    return _target(spark, sf_dir, 3, "flat")


@query("target_limit_then_taker", f"WITH {sql.CANDLES}, {_filled(3, *_TAKER, True)}")
def target_limit_then_taker(spark, sf_dir):
    return _target(spark, sf_dir, 3, "limit_then_taker")


@query("return_modes", f"WITH {sql.CANDLES}, p AS (SELECT *, (high + low + close) / 3 AS tp FROM candles) SELECT symbol, t, round(lead(close) OVER w / close - 1, 6) + 0.0 AS close_to_close, round(lead(tp) OVER w / lead(open) OVER w - 1, 6) + 0.0 AS typical_over_open, round(lead(tp) OVER w / close - 1, 6) + 0.0 AS typical_over_close, round(lead(low) OVER w / close - 1, 6) + 0.0 AS dip, round(lead(high) OVER w / close - 1, 6) + 0.0 AS rip FROM p {_W}")
def return_modes(spark, sf_dir):
    rows = tables.candles(spark, sf_dir)
    dip, rip = labels.dip_and_rip(W.series())
    df = rows.select("symbol", "t", *[labels.mode_return(rows, m).alias(m) for m in labels.MODES], dip.alias("dip"), rip.alias("rip"))
    return df.select("symbol", "t", *rounded(df, "close_to_close typical_over_open typical_over_close dip rip"))


def _fills_sql(short: bool) -> str:
    sign, run, reach, hit = ("+", "max(fh)", ">=", "fl <= x") if short else ("-", "min(fl)", "<=", "fh >= x")
    n = " + ".join(["1"] + [f"CASE WHEN e {reach} c * (1 {sign} {j} * 0.02) THEN 1 ELSE 0 END" for j in (1, 2)])
    cost = f"c * (1 {sign} (n - 1) / 2.0 * 0.02)"
    taker = "(cl - fcl) / cl" if short else "(fcl - cl) / cl"
    aim = "0.99" if short else "1.01"
    return f"""want AS (SELECT symbol, t, close AS c, unnest(range(0, 6)) AS k FROM base), met AS (SELECT w.symbol, w.t, w.c, w.k, m.high AS fh, m.low AS fl, m.close AS fc FROM want w JOIN known m ON m.symbol = w.symbol AND m.t = w.t + 14400 + w.k * 3600),
  r AS (SELECT *, {run} OVER (PARTITION BY symbol, t ORDER BY k ROWS UNBOUNDED PRECEDING) AS e FROM met), s AS (SELECT *, CAST({n} AS DOUBLE) AS n FROM r), u AS (SELECT *, {cost} AS cost FROM s), v AS (SELECT *, lag(cost * {aim}) OVER q AS x, lag(n) OVER q AS n0, lag(cost) OVER q AS c0 FROM u WINDOW q AS (PARTITION BY symbol, t ORDER BY k)),
  z AS (SELECT symbol, t, count(*) AS m, min(k) FILTER ({hit}) AS hk, arg_min(n0, k) FILTER ({hit}) AS hn, arg_min(c0, k) FILTER ({hit}) AS hc, arg_max(n, k) AS nl, arg_max(cost, k) AS cl, arg_max(fc, k) AS fcl FROM v GROUP BY 1, 2)
  SELECT b.symbol, b.t, CASE WHEN m = 6 THEN CASE WHEN hk IS NOT NULL THEN hn ELSE nl END END AS size, round(CASE WHEN m = 6 THEN CASE WHEN hk IS NOT NULL THEN hc ELSE cl END END, 6) AS avg_cost, CASE WHEN m = 6 THEN hk IS NOT NULL END AS is_maker, round(CASE WHEN m = 6 THEN CASE WHEN hk IS NOT NULL THEN hn * 0.01 ELSE nl * ({taker} - 0.0005) END END, 6) + 0.0 AS pnl FROM base b LEFT JOIN z ON z.symbol = b.symbol AND z.t = b.t"""


def _fine(spark, sf_dir):
    fine = bars.flat_where_empty(hourly(spark, sf_dir)).where("close is not null")
    return fine.where(F.col("t") % (4 * HOUR) == 0), fine


_FINE_SQL = f"{sql.uniform(HOUR)}, {sql.FLAT}, known AS (SELECT * FROM flat WHERE close IS NOT NULL), base AS (SELECT * FROM known WHERE t % 14400 = 0)"


@query("maker_fills_long", f"WITH {_FINE_SQL}, {_fills_sql(False)}")
def maker_fills_long(spark, sf_dir):
    df = labels.minute_fills(*_fine(spark, sf_dir), 4 * HOUR, HOUR, 6, 0.02, 3, 0.01, FEE)
    return df.select("symbol", "t", "size", F.round("avg_cost", 6).alias("avg_cost"), "is_maker", *rounded(df, "pnl"))


@query("maker_fills_short", f"WITH {_FINE_SQL}, {_fills_sql(True)}")
def maker_fills_short(spark, sf_dir):
    df = labels.minute_fills(*_fine(spark, sf_dir), 4 * HOUR, HOUR, 6, 0.02, 3, 0.01, FEE, short=True)
    return df.select("symbol", "t", "size", F.round("avg_cost", 6).alias("avg_cost"), "is_maker", *rounded(df, "pnl"))


@query("further_return", f"WITH {_FINE_SQL}, n AS (SELECT symbol, t, lead(close) OVER w AS nx FROM base {_W}) SELECT n.symbol, n.t, round(k.close / nullif(nx, 0) - 1, 6) + 0.0 AS extra_return FROM n LEFT JOIN known k ON k.symbol = n.symbol AND k.t = n.t + 14400 + 3600")
def further_return(spark, sf_dir):
    df = labels.further_return(*_fine(spark, sf_dir), 4 * HOUR, HOUR)
    return df.select("symbol", "t", *rounded(df, "extra_return"))


@query("boundary_return", f"WITH {_FINE_SQL} SELECT a.symbol, a.t, round(b.close / nullif(a.close, 0) - 1, 6) + 0.0 AS boundary_return FROM known a LEFT JOIN known b ON b.symbol = a.symbol AND b.t = a.t + 14400 - a.t % 14400")
def boundary_return(spark, sf_dir):
    df = labels.boundary_return(_fine(spark, sf_dir)[1], "close", HOUR, 4 * HOUR)
    return df.select("symbol", "t", *rounded(df, "boundary_return"))


@query("cross_frame_target", f"""WITH {_FINE_SQL}, four AS (SELECT symbol, t // 14400 * 14400 AS o, arg_max(close, t) AS xc, min(low) AS xl, max(high) AS xh FROM known GROUP BY ALL), j AS (SELECT k.symbol, k.t, k.close, xc, xl, xh FROM known k ASOF LEFT JOIN four f ON f.symbol = k.symbol AND k.t >= f.o), m AS (SELECT *, xc / nullif(close, 0) - 1 AS g, {_rungs('(close - xl) / close')} AS nl, {_rungs('(xh - close) / close')} AS ns FROM j)
  SELECT symbol, t, round(xc, 6) + 0.0 AS exit_close, round({_ladder('g', 'nl', '-')}, 6) + 0.0 AS target_long, round({_ladder('g', 'ns', '+')}, 6) + 0.0 AS target_short FROM m""")
def cross_frame_target(spark, sf_dir):
    fine = _fine(spark, sf_dir)[1].select("symbol", "t", "open", "high", "low", "close", "volume")
    df = labels.cross_frame_target(fine.select("symbol", "t", "close"), bars.coarser(fine, 4 * HOUR), 4 * HOUR, STEP, MOST, FEE)
    return df.select("symbol", "t", *rounded(df, "exit_close target_long target_short"))


@query("ternary_labels", f"WITH {sql.CANDLES}, r AS (SELECT symbol, t, lead(high) OVER w / close - 1 AS up, 1 - lead(low) OVER w / close AS dn FROM candles {_W}), l AS (SELECT symbol, CASE WHEN coalesce(up > 0.3, false) AND coalesce(dn > 0.3, false) THEN CASE WHEN up >= dn THEN 1 ELSE -1 END WHEN coalesce(up > 0.3, false) THEN 1 WHEN coalesce(dn > 0.3, false) THEN -1 ELSE 0 END AS label FROM r) SELECT symbol, label, count(*) AS n FROM l GROUP BY 1, 2")
def ternary_labels(spark, sf_dir):
    dip, rip = labels.dip_and_rip(W.series())
    rows = tables.candles(spark, sf_dir).select("symbol", "t", rip.alias("up"), (-dip).alias("dn"))
    return rows.select("symbol", labels.ternary(F.col("up"), F.col("dn"), 0.3).alias("label")).groupBy("symbol", "label").agg(F.count(F.lit(1)).alias("n"))


_SIGNALS = f"{sql.CANDLES}, {sql.PRICE.format(source='candles')}, {VOTES}, two AS (SELECT *, prediction * 0.5 AS prediction_2bar, CASE WHEN t % 172800 = 0 THEN threshold END AS threshold_2bar FROM sig)"


def _signals(spark, sf_dir):
    rows = features.price_features(tables.candles(spark, sf_dir)).select("symbol", "t", "return_1", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("m"))
    even = F.col("m") % 2 == 0
    return rows.select("symbol", "t", F.when(even, "long").otherwise("short").alias("side"), (F.col("return_1") * F.when(even, 1).otherwise(-1) * F.col("m")).alias("prediction"), F.lit(0.05).alias("threshold"))


@query("dual_gate", f"WITH {_SIGNALS}, f AS (SELECT *, coalesce(CASE WHEN side = 'long' THEN prediction > threshold ELSE prediction < threshold END, false) AND (threshold_2bar IS NULL OR coalesce(CASE WHEN side = 'long' THEN prediction_2bar > threshold_2bar ELSE prediction_2bar < threshold_2bar END, false)) AS fires FROM two) SELECT symbol, t, count(*) FILTER (fires AND side = 'long') AS longs, count(*) FILTER (fires AND side = 'short') AS shorts, (count(*) FILTER (fires AND side = 'long') - count(*) FILTER (fires AND side = 'short')) * -2.5::DOUBLE + 0.0 AS quantity FROM f GROUP BY 1, 2")
def dual_gate(spark, sf_dir):
    rows = _signals(spark, sf_dir).withColumns({"prediction_2bar": F.col("prediction") * 0.5, "threshold_2bar": F.when(F.col("t") % 172800 == 0, F.col("threshold"))})
    fired = rows.withColumn("fires", decisions.dual_gate())
    by = fired.groupBy("symbol", "t").agg(F.count(F.when(F.col("fires") & (F.col("side") == "long"), 1)).alias("longs"), F.count(F.when(F.col("fires") & (F.col("side") == "short"), 1)).alias("shorts"))
    return by.select("symbol", "t", "longs", "shorts", (decisions.signed_quantity(F.col("longs") - F.col("shorts"), F.lit(2.5), -1) + 0.0).alias("quantity"))


@query("centred_edges", f"WITH {_SIGNALS} SELECT symbol, side, count(*) AS n FROM sig WHERE CASE WHEN side = 'long' THEN prediction > -0.01 + 0.1 ELSE prediction < 0.02 - 0.2 END GROUP BY 1, 2")
def centred_edges(spark, sf_dir):
    fires = decisions.centred_fires(F.col("prediction"), F.col("side"), {"long": 0.1, "short": 0.2}, {"long": -0.01, "short": 0.02})
    return _signals(spark, sf_dir).where(fires).groupBy("symbol", "side").agg(F.count(F.lit(1)).alias("n"))


@query("class_decisions", f"WITH {sql.CANDLES}, p AS (SELECT symbol, t, (close - low) / nullif(high - low, 0) AS pl, (high - open) / nullif(high - low, 0) AS ps FROM candles) SELECT symbol, CASE WHEN coalesce(pl > 0.5, false) AND (NOT coalesce(ps > 0.6, false) OR pl >= ps) THEN 1 WHEN coalesce(ps > 0.6, false) AND NOT coalesce(pl > 0.5, false) THEN -1 ELSE 0 END AS decision, count(*) AS n FROM p GROUP BY 1, 2")
def class_decisions(spark, sf_dir):
    span = F.col("high") - F.col("low")
    rows = tables.candles(spark, sf_dir).select("symbol", decisions.class_decision(W.ratio(F.col("close") - F.col("low"), span), W.ratio(F.col("high") - F.col("open"), span), 0.5, 0.6).alias("decision"))
    return rows.groupBy("symbol", "decision").agg(F.count(F.lit(1)).alias("n"))


@query("early_exits", f"WITH {_SIGNALS}, n AS (SELECT symbol, coalesce(avg(prediction) FILTER (side = 'long'), 0) - coalesce(avg(prediction) FILTER (side = 'short'), 0) AS net FROM sig GROUP BY 1), h AS (SELECT symbol, CAST(count(*) % 3 - 1 AS DOUBLE) AS quantity FROM candles GROUP BY 1) SELECT symbol, round(net, 6) + 0.0 AS net_score, CASE WHEN quantity > 0 THEN net < 0.5 WHEN quantity < 0 THEN net > -0.5 ELSE false END AS leaves FROM h JOIN n USING (symbol)")
def early_exits(spark, sf_dir):
    held = tables.candles(spark, sf_dir).groupBy("symbol").agg((F.count(F.lit(1)) % 3 - 1).cast("double").alias("quantity"))
    df = decisions.leaves_early(_signals(spark, sf_dir), held, 0.5)
    return df.select("symbol", *rounded(df, "net_score"), "leaves")


@query("price_at_scored_row", f"WITH {sql.CANDLES}, s AS (SELECT symbol, t + 43200 AS t FROM candles), k AS (SELECT * FROM candles WHERE volume > 100) SELECT s.symbol, s.t, round(k.close, 6) AS price, k.t AS priced_t FROM s ASOF LEFT JOIN k ON k.symbol = s.symbol AND s.t >= k.t")
def price_at_scored_row(spark, sf_dir):
    rows = tables.candles(spark, sf_dir)
    prices = rows.withColumn("close", F.when(F.col("volume") > 100, F.col("close")))
    df = decisions.price_at(rows.select("symbol", (F.col("t") + 43_200).alias("t")), prices)
    return df.select("symbol", "t", F.round("price", 6).alias("price"), "priced_t")


@query("lot_sizes", f"WITH {sql.CANDLES}, q AS (SELECT symbol, t, close, (volume % 50 - 20) / 7.0 AS quantity FROM candles) SELECT symbol, t, round(sign(quantity) * CASE WHEN quantity = 0 THEN 0 ELSE greatest(round_even(abs(quantity) / 0.25, 0) * 0.25, ceil(100 / close / 0.25) * 0.25) END, 6) + 0.0 AS lots FROM q")
def lot_sizes(spark, sf_dir):
    rows = tables.candles(spark, sf_dir).select("symbol", "t", "close", ((F.col("volume") % 50 - 20) / 7).alias("quantity"))
    df = rows.select("symbol", "t", decisions.lots(F.col("quantity"), F.col("close"), 0.25, 100.0).alias("lots"))
    return df.select("symbol", "t", *rounded(df, "lots"))


@query("linear_scores", f"WITH {sql.CANDLES}, {sql.PRICE.format(source='candles')} SELECT symbol, t, round(coalesce((return_1 - 0.1) / 0.5 * 2, 0) + coalesce((volume_ratio - 1) / 1 * -0.5, 0) + coalesce((range_pct - 0) / 1 * 0.25, 0), 6) + 0.0 AS score, t >= (SELECT max(t) FROM candles) - 864000 AS fresh FROM price")
def linear_scores(spark, sf_dir):
    rows = features.price_features(tables.candles(spark, sf_dir))
    model = F.array(*[F.struct(F.lit(c).alias("center"), F.lit(s).alias("scale"), F.lit(w).alias("weight")) for c, s, w in ((0.1, 0.5, 2.0), (1.0, 1.0, -0.5), (0.0, 0.0, 0.25))])
    now = rows.agg(F.max("t").alias("now"))  # one row
    df = rows.crossJoin(F.broadcast(now)).select("symbol", "t", decisions.linear_score(F.array("return_1", "volume_ratio", "range_pct"), model).alias("score"), decisions.fresh(F.col("t"), F.col("now"), 864_000).alias("fresh"))
    return df.select("symbol", "t", *rounded(df, "score"), "fresh")
