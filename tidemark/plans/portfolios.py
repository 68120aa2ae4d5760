"""Queries on pairs and baskets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import backtests, cointegration, pairs, portfolio, sequential
from ..operators import windows as W
from ..sources import driver_tables as tables
from . import oracles as sql
from .registry import query, rounded

_W = "WINDOW w AS (PARTITION BY pair ORDER BY t)"


def _spreads(spark, sf_dir):
    return pairs.hedged(pairs.aligned(tables.candles(spark, sf_dir)))


def _scores(spark, sf_dir):
    return pairs.scored(_spreads(spark, sf_dir))


@query("trendless_spreads", f"WITH {sql.PAIRS}, n AS (SELECT *, CAST(row_number() OVER w - 1 AS DOUBLE) AS n FROM spreads {_W}), f AS (SELECT pair, CASE WHEN count(spread) >= 20 THEN regr_slope(spread, n) ELSE 0 END AS drift, CASE WHEN count(spread) >= 20 THEN regr_intercept(spread, n) ELSE 0 END AS base FROM n GROUP BY 1) SELECT pair, t, round(drift, 8) + 0.0 AS drift, round(spread - base - drift * n, 6) + 0.0 AS trendless FROM n JOIN f USING (pair)")
def trendless_spreads(spark, sf_dir):
    df = pairs.detrended(_spreads(spark, sf_dir))
    return df.select("pair", "t", (F.round("drift", 8) + 0.0).alias("drift"), *rounded(df, "trendless"))


@query("basket_spreads", f"WITH {sql.CANDLES}, b(basket, symbol, weight) AS (VALUES ('a', '1-URGENT', 0.5), ('a', '2-HIGH', -0.3), ('a', '5-LOW', -0.2), ('b', '2-HIGH', 1.0), ('b', '3-MEDIUM', -1.0)) SELECT basket, t, round(sum(weight * ln(close)) / sum(abs(weight)), 6) + 0.0 AS spread FROM candles JOIN b USING (symbol) WHERE close > 0 GROUP BY 1, 2")
def basket_spreads(spark, sf_dir):
    weights = spark.createDataFrame([("a", "1-URGENT", 0.5), ("a", "2-HIGH", -0.3), ("a", "5-LOW", -0.2), ("b", "2-HIGH", 1.0), ("b", "3-MEDIUM", -1.0)], "basket string, symbol string, weight double")
    df = pairs.basket(tables.candles(spark, sf_dir), weights)
    return df.select("basket", "t", *rounded(df, "spread"))


@query("whole_sample_scores", f"WITH {sql.PAIRS}, f AS (SELECT pair, avg(spread) AS m, stddev_pop(spread) AS d FROM spreads GROUP BY 1) SELECT pair, t, round((spread - m) / nullif(d, 0), 5) + 0.0 AS z FROM spreads JOIN f USING (pair)")
def whole_sample_scores(spark, sf_dir):
    df = pairs.whole_sample_score(_spreads(spark, sf_dir))
    return df.select("pair", "t", *rounded(df, "z", 5))


def _laddered(size: str) -> str:
    k = " + ".join(f"CASE WHEN abs(z) > {2 + 0.5 * i} THEN 1 ELSE 0 END" for i in range(4))
    return f"""WITH RECURSIVE {sql.PAIRS}, k AS (SELECT pair, t, z, CAST({k} AS DOUBLE) AS n, row_number() OVER (PARTITION BY pair ORDER BY t) AS i FROM scores), run AS (SELECT pair, CAST(0 AS BIGINT) AS i, 0 AS side, 0 AS age, CAST(0 AS DOUBLE) AS now FROM (SELECT DISTINCT pair FROM k)
  UNION ALL SELECT pair, i, CASE WHEN out THEN 0 ELSE s END, CASE WHEN out OR s = 0 THEN 0 ELSE a END, CASE WHEN z IS NULL THEN now WHEN out THEN 0 ELSE s * ({size}) END FROM (SELECT *, s <> 0 AND z IS NOT NULL AND (abs(z) < 0.5 OR abs(z) > 4 OR a > 40) AS out FROM (SELECT k.pair, k.i, k.z, k.n, r.now, CASE WHEN k.z IS NULL OR side <> 0 THEN side WHEN k.z > 2 THEN -1 WHEN k.z < -2 THEN 1 ELSE 0 END AS s, CASE WHEN side <> 0 THEN age + 1 WHEN k.z IS NOT NULL AND abs(k.z) > 2 THEN 2 ELSE 0 END AS a FROM run r JOIN k ON k.pair = r.pair AND k.i = r.i + 1)))
  SELECT k.pair, k.t, round(now, 6) + 0.0 AS position FROM k JOIN run r ON r.pair = k.pair AND r.i = k.i"""


@query("laddered_positions", _laddered("n / 4"))
def laddered_positions(spark, sf_dir):
    df = sequential.laddered_positions(_scores(spark, sf_dir), stop=4.0, longest=40, rungs=4, by=("pair",))
    return df.select("pair", "t", *rounded(df, "position"))


@query("steep_positions", _laddered("n * (n + 1) / 20"))
def steep_positions(spark, sf_dir):
    df = sequential.laddered_positions(_scores(spark, sf_dir), stop=4.0, longest=40, rungs=4, steep=True, by=("pair",))
    return df.select("pair", "t", *rounded(df, "position"))


_CORR = f"c AS (SELECT pair, t, z, CASE WHEN count(*) OVER v >= 20 THEN covar_pop(x, y) OVER v / nullif(stddev_pop(x) OVER v * stddev_pop(y) OVER v, 0) END AS correlation FROM scores WINDOW v AS (PARTITION BY pair ORDER BY t ROWS 19 PRECEDING)), b AS (SELECT *, CASE WHEN count(correlation) OVER u >= 40 THEN avg(correlation) OVER u END AS baseline FROM c WINDOW u AS (PARTITION BY pair ORDER BY t ROWS 39 PRECEDING))"


@query("correlation_breaks", f"""WITH RECURSIVE {sql.PAIRS}, {_CORR}, k AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY t) AS i FROM b), run AS (SELECT pair, CAST(0 AS BIGINT) AS i, 0 AS held FROM (SELECT DISTINCT pair FROM k) UNION ALL SELECT k.pair, k.i, CASE WHEN k.correlation IS NULL OR k.baseline IS NULL OR k.z IS NULL THEN held WHEN held <> 0 AND k.correlation >= k.baseline THEN 0 WHEN held = 0 AND k.correlation < k.baseline - 0.1 THEN -CAST(sign(k.z) AS INTEGER) ELSE held END FROM run r JOIN k ON k.pair = r.pair AND k.i = r.i + 1)
  SELECT k.pair, k.t, CAST(held AS DOUBLE) AS position FROM k JOIN run r ON r.pair = k.pair AND r.i = k.i""")
def correlation_breaks(spark, sf_dir):
    w = W.series("pair")
    rows = _scores(spark, sf_dir).withColumn("correlation", W.correlation(F.col("x"), F.col("y"), 20, w))
    rows = rows.withColumn("baseline", W.mean(F.col("correlation"), 40, w))
    return sequential.positions_by_break(rows, 0.1, by=("pair",)).select("pair", "t", "position")


def _normal(z: str) -> str:
    """The normal distribution function, by the series of the error function."""
    x = f"(abs({z}) / sqrt(2))"
    series = f"list_sum(list_transform(range(0, 400), lambda n: exp(-{x} * {x} + (2 * n + 1) * ln({x}) + n * ln(4) + lgamma(n + 1) - lgamma(2 * n + 2))))"
    return f"(0.5 + sign({z}) / sqrt(pi()) * CASE WHEN {z} = 0 THEN 0 ELSE {series} END)"


def _tested(source: str, by: str, constant: bool = True, series: int = 1) -> str:
    """Common table expressions up to `tested` (by, lags, n, statistic, p) for the column spread of source, with one lag at most."""
    k, at = int(constant), series - 1
    m = (lambda x, y: f"covar_pop({x}, {y})") if constant else (lambda x, y: f"avg({x} * {y})")
    poly = lambda c: " + ".join(f"{v} * power(tau, {i})" for i, v in enumerate(c))
    return f"""lag1 AS (SELECT {by}, t, lag(spread) OVER w AS s, spread - lag(spread) OVER w AS d FROM {source} WHERE spread IS NOT NULL WINDOW w AS (PARTITION BY {by} ORDER BY t)), lag2 AS (SELECT *, lag(d) OVER w AS l FROM lag1 WINDOW w AS (PARTITION BY {by} ORDER BY t)),
  whole AS (SELECT {by}, count(*) AS n0, {m('s', 's')} AS ss0, {m('s', 'd')} AS sd0, {m('d', 'd')} AS dd0 FROM lag2 WHERE s IS NOT NULL GROUP BY ALL),
  common AS (SELECT {by}, count(*) AS n1, {m('s', 's')} AS ss, {m('l', 'l')} AS ll, {m('d', 'd')} AS dd, {m('s', 'l')} AS sl, {m('s', 'd')} AS sd, {m('l', 'd')} AS ld FROM lag2 WHERE s IS NOT NULL AND l IS NOT NULL GROUP BY ALL),
  solved AS (SELECT *, sd0 / nullif(ss0, 0) AS b0, ss * ll - sl * sl AS det, (sd * ll - ld * sl) / nullif(ss * ll - sl * sl, 0) AS b1, (ld * ss - sd * sl) / nullif(ss * ll - sl * sl, 0) AS c1 FROM whole LEFT JOIN common USING ({by})),
  orders AS (SELECT *, CASE WHEN n0 >= 19 AND n1 * ln(dd - b1 * sd - c1 * ld) + 2 < n1 * ln(dd - sd * sd / ss) THEN 1 ELSE 0 END AS lags FROM solved),
  taus AS (SELECT *, CASE WHEN n0 < 19 THEN NULL WHEN lags = 1 THEN b1 / sqrt((dd - b1 * sd - c1 * ld) / (n1 - 2 - {k}) * ll / det) ELSE b0 / sqrt((dd0 - b0 * sd0) / (n0 - 1 - {k}) / ss0) END AS tau FROM orders),
  zs0 AS (SELECT *, CASE WHEN tau <= {cointegration.TAU_STAR[at]} THEN {poly(cointegration.TAU_SMALL[at])} ELSE {poly(cointegration.TAU_LARGE[at])} END AS zt FROM taus),
  tested AS (SELECT {by}, lags, CASE WHEN lags = 1 THEN n1 ELSE n0 END AS n, tau AS statistic, CASE WHEN tau IS NULL OR tau > {cointegration.TAU_MAX[at]} THEN 1 WHEN tau < {cointegration.TAU_MIN[at]} THEN 0 ELSE {_normal('zt')} END AS p FROM zs0)"""


@query("unit_root_tests", f"WITH {sql.PAIRS}, {_tested('spreads', 'pair')} SELECT pair, lags, n, round(statistic, 6) + 0.0 AS statistic, round(p, 6) + 0.0 AS p FROM tested")
def unit_root_tests(spark, sf_dir):
    df = cointegration.unit_root_test(_spreads(spark, sf_dir), ["pair"], lags=1)
    return df.select("pair", "lags", "n", *rounded(df, "statistic p"))


@query("engle_granger_tests", f"WITH {sql.PAIRS}, {_tested('spreads', 'pair', constant=False, series=2)} SELECT pair, lags, n, round(statistic, 6) + 0.0 AS statistic, round(p, 6) + 0.0 AS p FROM tested")
def engle_granger_tests(spark, sf_dir):
    df = cointegration.engle_granger(_spreads(spark, sf_dir), ["pair"], lags=1)
    return df.select("pair", "lags", "n", *rounded(df, "statistic p"))


# Windows of 180 days, every 30 days; the slower frame has weekly closes in windows of 720 days.
_BACK, _STEP, _SLOW, _P = 180, 30, 720, 1e-5


def _window_spreads(source: str, back: int) -> str:
    """seen: the rows of each window's past; wfits, wspreads: hedged in the window."""
    return f"""seen AS (SELECT pair, t, x, y, t - t % {_STEP * 86400} + k * {_STEP * 86400} AS win FROM {source}, range(0, {-(-back // _STEP) + 1}) r(k) WHERE t < t - t % {_STEP * 86400} + k * {_STEP * 86400} AND t >= t - t % {_STEP * 86400} + k * {_STEP * 86400} - {back * 86400}),
  wfits AS (SELECT pair, win, CASE WHEN count(x) >= 10 THEN coalesce(regr_slope(y, x), 1) ELSE 1 END AS hedge, avg(x) AS mx, avg(y) AS my FROM seen GROUP BY 1, 2),
  wspreads AS (SELECT pair, win, t, y - hedge * x - (my - hedge * mx) AS spread FROM seen JOIN wfits USING (pair, win))"""


_STATE = f"""k AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY win) AS i FROM tested), run AS (SELECT pair, CAST(0 AS BIGINT) AS i, 'inactive' AS state FROM (SELECT DISTINCT pair FROM k) UNION ALL SELECT k.pair, k.i, CASE WHEN p < {_P} THEN CASE state WHEN 'inactive' THEN 'cointegrated' WHEN 'broken' THEN 'recovered' ELSE state END ELSE CASE state WHEN 'inactive' THEN state ELSE 'broken' END END FROM run r JOIN k ON k.pair = r.pair AND k.i = r.i + 1)"""
_WEEKLY = f"{sql.CANDLES}, weekly AS (SELECT symbol, t - t % 604800 AS t, arg_max(close, t) AS close FROM candles GROUP BY 1, 2), pairs AS (SELECT a.symbol || '/' || b.symbol AS pair, a.t, ln(a.close) AS x, ln(b.close) AS y FROM weekly a JOIN weekly b ON a.t = b.t AND a.symbol < b.symbol)"


def _window_tests(aligned, back):
    seen = pairs.walk_forward(aligned, back * pairs.DAY, _STEP * pairs.DAY).where("not test")
    keyed = seen.select(F.concat_ws("|", "pair", F.col("window").cast("string")).alias("pair"), "t", "x", "y")
    tests = cointegration.unit_root_test(pairs.hedged(keyed), ["pair"], lags=1)
    return tests.select(F.substring_index("pair", "|", 1).alias("pair"), F.substring_index("pair", "|", -1).cast("long").alias("t"), "p")


@query("break_states", f"WITH RECURSIVE {sql.PAIRS}, {_window_spreads('pairs', _BACK)}, {_tested('wspreads', 'pair, win')}, {_STATE} SELECT k.pair, k.win AS t, round(k.p, 6) + 0.0 AS p, state FROM k JOIN run r ON r.pair = k.pair AND r.i = k.i")
def break_states(spark, sf_dir):
    df = pairs.break_states(_window_tests(pairs.aligned(tables.candles(spark, sf_dir)), _BACK), threshold=_P)
    return df.select("pair", "t", *rounded(df, "p"), "state")


_BOTH = f"""WITH RECURSIVE quick AS (WITH RECURSIVE {sql.PAIRS}, {_window_spreads('pairs', _BACK)}, {_tested('wspreads', 'pair, win')}, {_STATE} SELECT k.pair, k.win AS t, state FROM k JOIN run r ON r.pair = k.pair AND r.i = k.i),
  slow AS (WITH RECURSIVE {_WEEKLY}, {_window_spreads('pairs', _SLOW)}, {_tested('wspreads', 'pair, win')}, {_STATE} SELECT k.pair, k.win AS t, state FROM k JOIN run r ON r.pair = k.pair AND r.i = k.i)
  SELECT pair, t, quick.state, slow.state AS slow_state, quick.state = 'recovered' AND coalesce(slow.state = 'recovered', false) AS tradeable FROM quick LEFT JOIN slow USING (pair, t)"""


@query("states_of_two_frames", _BOTH)
def states_of_two_frames(spark, sf_dir):
    candles = tables.candles(spark, sf_dir)
    weekly = candles.groupBy("symbol", (F.col("t") - F.pmod("t", F.lit(7 * pairs.DAY))).alias("week")).agg(F.max_by("close", "t").alias("close")).withColumnRenamed("week", "t")
    quick = pairs.break_states(_window_tests(pairs.aligned(candles), _BACK), threshold=_P)
    slow = pairs.break_states(_window_tests(pairs.aligned(weekly), _SLOW), threshold=_P)
    return pairs.both_recovered(quick, slow).select("pair", "t", "state", "slow_state", "tradeable")


def _yearly(spark, sf_dir):
    """Weekly closes, carried on over weeks without a candle, in windows of four years."""
    candles, week = tables.candles(spark, sf_dir), 7 * pairs.DAY
    closes = candles.groupBy("symbol", (F.col("t") - F.pmod("t", F.lit(week))).alias("week")).agg(F.max_by("close", "t").alias("close"))
    ends = closes.groupBy("symbol").agg(F.min("week").alias("a"), F.max("week").alias("b"))
    grid = ends.select("symbol", F.explode(F.sequence("a", "b", F.lit(week).cast("long"))).alias("week"))
    filled = grid.join(closes, ["symbol", "week"], "left").select("symbol", F.col("week").alias("t"), W.fill_forward(F.col("close"), W.series(order="week")).alias("close"))
    rows = pairs.walk_forward(filled, 4 * 365 * pairs.DAY, 365 * pairs.DAY)
    return rows.where("not test").select("window", "t", "symbol", "close")


@query("cointegrating_vectors")
def cointegrating_vectors(spark, sf_dir):
    prices = _yearly(spark, sf_dir)
    baskets = prices.groupBy("window").agg(F.slice(F.array_sort(F.collect_set("symbol")), 1, 3).alias("symbols"))
    df = cointegration.cointegrating_vectors(prices, baskets, ["window"])
    return df.select("window", "n", "rank", "place", *rounded(df, "eigenvalue"), *rounded(df, "trace", 4), F.transform("weights", lambda x: F.round(x, 4) + 0.0).alias("weights"))


@query("built_portfolios")
def built_portfolios(spark, sf_dir):
    df = portfolio.built(_yearly(spark, sf_dir), assets=3, most=0.6, rounds=100)
    return df.select("window", "symbols", F.transform("weights", lambda x: F.round(x, 3) + 0.0).alias("weights"), *rounded(df, "speed deviation half_life drift score", 4), "n")


_CARD = f"""{sql.PAIRS}, p AS (SELECT pair, t, spread, CASE WHEN z > 1.5 THEN -1.0 WHEN z < -1.5 THEN 1.0 ELSE 0.0 END AS position FROM scores), g AS (SELECT pair, t, coalesce(lag(position) OVER w, 0) * coalesce(spread - lag(spread) OVER w, 0) - abs(position - coalesce(lag(position) OVER w, 0)) * 0.001 AS gain FROM p WINDOW w AS (PARTITION BY pair ORDER BY t)),
  s AS (SELECT pair, t - t % 7776000 AS win, CASE WHEN count(gain) > 1 THEN coalesce(avg(gain) / nullif(stddev_samp(gain), 0), 0) ELSE coalesce(sum(gain), 0) END AS sharpe FROM (SELECT pair, t - t % 86400 AS t, sum(gain) AS gain FROM g GROUP BY 1, 2) GROUP BY 1, 2)"""


@query("scorecards", f'WITH {_CARD} SELECT pair, win AS "window", round(sharpe, 6) + 0.0 AS sharpe, sharpe > 0 AS good, round(CASE WHEN lag(sharpe) OVER w IS NULL THEN 1 ELSE least(greatest(lag(sharpe) OVER w, 0), 3) END, 6) + 0.0 AS weight, lag(sharpe) OVER w IS NULL OR coalesce(sum(CASE WHEN sharpe > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY pair ORDER BY win ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 0) >= 2 AS trades FROM s WINDOW w AS (PARTITION BY pair ORDER BY win)')
def scorecards(spark, sf_dir):
    rows = _scores(spark, sf_dir).withColumn("position", pairs.threshold_position(F.col("z"), F.lit(1.5)))
    days = pairs.daily(pairs.gains(rows, 0.001)).withColumn("window", F.col("day") - F.pmod("day", F.lit(7_776_000)))
    df = portfolio.scorecard(days, least_good=2, of_last=4)
    return df.select("pair", "window", *rounded(df, "sharpe"), "good", *rounded(df, "weight"), "trades")


_ENTER = "CASE WHEN z > 1.5 THEN -1.0 WHEN z < -1.5 THEN 1.0 ELSE 0.0 END"


@query("confirmed_entries", f"WITH {sql.PAIRS}, p AS (SELECT pair, t, z, CAST({_ENTER} AS DOUBLE) AS position FROM scores), l AS (SELECT *, coalesce(lag(position) OVER w, 0) AS before, lag(z) OVER w AS z1, lag(z, 2) OVER w AS z2 FROM p {_W}) SELECT pair, t, CASE WHEN before = 0 AND position <> 0 AND z2 IS NOT NULL AND NOT coalesce(CASE WHEN position > 0 THEN z > z1 AND z1 > z2 ELSE z < z1 AND z1 < z2 END, false) THEN CAST(0 AS DOUBLE) ELSE position END AS position FROM l")
def confirmed_entries(spark, sf_dir):
    rows = _scores(spark, sf_dir).withColumn("position", pairs.threshold_position(F.col("z"), F.lit(1.5)))
    return pairs.confirmed_entries(rows).select("pair", "t", (F.col("position") + 0.0).alias("position"))


_GAINS = f"p AS (SELECT pair, t, spread, CAST({_ENTER} AS DOUBLE) AS position FROM scores), g AS (SELECT *, coalesce(lag(position) OVER w, 0) * coalesce(spread - lag(spread) OVER w, 0) - abs(position - coalesce(lag(position) OVER w, 0)) * 0.001 AS gain FROM p {_W}), d AS (SELECT pair, t - t % 86400 AS day, sum(gain) AS gain FROM g GROUP BY 1, 2)"


def _gains(spark, sf_dir):
    return pairs.gains(_scores(spark, sf_dir).withColumn("position", pairs.threshold_position(F.col("z"), F.lit(1.5))), 0.001)


@query("yearly_performance", f"WITH {sql.PAIRS}, {_GAINS}, y AS (SELECT *, year(make_timestamp(day * 1000000)) AS year FROM d), e AS (SELECT *, sum(gain) OVER u AS e FROM y WINDOW u AS (PARTITION BY pair, year ORDER BY day ROWS UNBOUNDED PRECEDING)), f AS (SELECT *, e - max(e) OVER (PARTITION BY pair, year ORDER BY day ROWS UNBOUNDED PRECEDING) AS under FROM e) SELECT pair, CAST(year AS INTEGER) AS year, count(gain) AS days, round(sum(gain), 6) + 0.0 AS total, round(avg(gain) / nullif(stddev_samp(gain), 0) * sqrt(365), 4) + 0.0 AS sharpe, round(min(under), 6) + 0.0 AS drawdown FROM f GROUP BY 1, 2")
def yearly_performance(spark, sf_dir):
    df = pairs.by_year(pairs.daily(_gains(spark, sf_dir)))
    return df.select("pair", "year", "days", *rounded(df, "total drawdown"), *rounded(df, "sharpe", 4))


@query("holding_times", f"WITH {sql.PAIRS}, {_GAINS}, h AS (SELECT pair, position, coalesce(lag(position) OVER w, 0) AS before FROM g {_W}) SELECT pair, CAST(count(*) FILTER (position <> before) AS BIGINT) AS changes, round(count(*) FILTER (position <> 0) / nullif(count(*) FILTER (before = 0 AND position <> 0), 0), 6) + 0.0 AS mean_rows_held FROM h GROUP BY 1")
def holding_times(spark, sf_dir):
    df = pairs.holding(_gains(spark, sf_dir))
    return df.select("pair", "changes", *rounded(df, "mean_rows_held"))


_SETTINGS = "p AS (SELECT pair, t, spread, enter, CAST(CASE WHEN z > enter THEN -1 WHEN z < -enter THEN 1 ELSE 0 END AS DOUBLE) AS position FROM scores, (VALUES (1.0), (1.5), (2.0)) v(enter)), g AS (SELECT *, coalesce(lag(position) OVER w, 0) * coalesce(spread - lag(spread) OVER w, 0) - abs(position - coalesce(lag(position) OVER w, 0)) * 0.001 AS gain FROM p WINDOW w AS (PARTITION BY pair, enter ORDER BY t)), d AS (SELECT pair, CAST(enter AS DOUBLE) AS enter, t - t % 86400 AS day, sum(gain) AS gain FROM g GROUP BY 1, 2, 3), s AS (SELECT pair, enter, round(avg(gain) / nullif(stddev_samp(gain), 0) * sqrt(365), 6) + 0.0 AS sharpe FROM d GROUP BY 1, 2)"


@query("best_settings", f"WITH {sql.PAIRS}, {_SETTINGS} SELECT pair, sharpe, enter FROM (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY sharpe DESC NULLS LAST, enter) AS n FROM s) WHERE n = 1")
def best_settings(spark, sf_dir):
    grid = pairs.sweep(_scores(spark, sf_dir), [1.0, 1.5, 2.0], [0.001])
    rows = grid.withColumn("position", pairs.threshold_position(F.col("z"), F.col("enter"))).withColumn("setting", F.concat_ws("|", "pair", "enter"))
    daily = pairs.daily(pairs.gains(rows, 0.001, by="setting"), by="setting")
    results = pairs.performance(daily, by="setting").select(F.substring_index("setting", "|", 1).alias("pair"), F.substring_index("setting", "|", -1).cast("double").alias("enter"), (F.round("sharpe", 6) + 0.0).alias("sharpe"))
    return pairs.best_settings(results).select("pair", "sharpe", "enter")


@query("unit_root_statistics", f"""WITH {sql.PAIRS}, a AS (SELECT pair, t, lag(spread) OVER w AS s, spread - lag(spread) OVER w AS d FROM spreads {_W}), r AS (SELECT pair, s, d, lag(d) OVER w AS l FROM a {_W}), q AS (SELECT * FROM r WHERE s IS NOT NULL AND d IS NOT NULL AND l IS NOT NULL), m AS (SELECT pair, count(*) AS n, var_pop(s) AS ss, var_pop(l) AS ll, var_pop(d) AS dd, covar_pop(s, l) AS sl, covar_pop(s, d) AS sd, covar_pop(l, d) AS ld FROM q GROUP BY 1),
  b AS (SELECT *, (sd * ll - ld * sl) / (ss * ll - sl * sl) AS b, (ld * ss - sd * sl) / (ss * ll - sl * sl) AS c FROM m WHERE n > 4) SELECT pair, n, round(b, 6) + 0.0 AS level, round(b / sqrt((dd - b * sd - c * ld) * n / (n - 3) * ll / (ss * ll - sl * sl) / n), 4) + 0.0 AS statistic FROM b""")
def unit_root_statistics(spark, sf_dir):
    df = pairs.unit_root_statistic(_spreads(spark, sf_dir))
    return df.select("pair", "n", *rounded(df, "level"), *rounded(df, "statistic", 4))


@query("stable_pairs", f"WITH {sql.PAIRS}, w AS (SELECT pair, t // 7776000 * 7776000 AS win, spread, lag(spread) OVER (PARTITION BY pair, t // 7776000 ORDER BY t) AS s FROM spreads), f AS (SELECT pair, win, -regr_slope(spread - s, s) AS speed, sqrt(greatest(var_pop(spread - s) FILTER (s IS NOT NULL) - regr_slope(spread - s, s) * regr_slope(spread - s, s) * var_pop(s), 0)) AS deviation FROM w GROUP BY 1, 2 HAVING count(s) >= 10), n AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY win DESC) AS n FROM f), r AS (SELECT pair, count(*) AS windows, round(min(speed / nullif(deviation, 0)), 5) AS worst FROM n WHERE n <= 3 GROUP BY 1) SELECT * FROM r WHERE windows = 3 AND worst >= 0.5")
def stable_pairs(spark, sf_dir):
    windowed = _spreads(spark, sf_dir).withColumns({"window": F.col("t") - F.pmod("t", F.lit(7_776_000)), "pair": F.concat_ws("|", "pair", (F.col("t") - F.pmod("t", F.lit(7_776_000))).cast("string"))})
    fits = pairs.reversion(windowed).where("n >= 10").select(F.substring_index("pair", "|", 1).alias("pair"), F.substring_index("pair", "|", -1).cast("long").alias("window"), "speed", "deviation")
    df = pairs.stable(fits, 3, 0.5)
    return df.select("pair", "windows", F.round("worst", 5).alias("worst"))


_FITS = f"""{_window_spreads('pairs', _BACK)}, steps AS (SELECT pair, win, lag(spread) OVER w AS s, spread - lag(spread) OVER w AS d FROM wspreads WINDOW w AS (PARTITION BY pair, win ORDER BY t)), rev AS (SELECT pair, win, -regr_slope(d, s) AS speed, sqrt(greatest(var_pop(d) - regr_slope(d, s) ** 2 * var_pop(s), 0)) AS deviation FROM steps WHERE s IS NOT NULL GROUP BY 1, 2),
  widths AS (SELECT pair, win, stddev_samp(spread) AS width FROM wspreads GROUP BY 1, 2), live AS (SELECT wfits.*, speed, deviation, width FROM wfits JOIN widths USING (pair, win) JOIN rev USING (pair, win)),
  tr AS (SELECT pair, win, t, spread, spread / nullif(width, 0) AS z, row_number() OVER (PARTITION BY pair, win ORDER BY t) AS i FROM (SELECT p.pair, win, p.t, width, y - hedge * x - (my - hedge * mx) AS spread FROM pairs p JOIN live l ON l.pair = p.pair AND l.win = p.t - p.t % {_STEP * 86400} WHERE speed > 0 AND ln(2) / speed <= 500)),
  walked AS (SELECT pair, win, CAST(0 AS BIGINT) AS i, 0 AS held, 0 AS age FROM (SELECT DISTINCT pair, win FROM tr) UNION ALL SELECT pair, win, i, CASE WHEN out THEN 0 WHEN held <> 0 THEN held WHEN z < -1 THEN 1 WHEN z > 1 THEN -1 ELSE 0 END, CASE WHEN out THEN 0 WHEN held <> 0 THEN age + 1 WHEN abs(z) > 1 THEN 1 ELSE 0 END
    FROM (SELECT k.pair, k.win, k.i, k.z, held, age, held <> 0 AND k.z IS NOT NULL AND (abs(k.z) < 0.5 OR abs(k.z) > 4 OR age + 1 > 10) AS out FROM walked r JOIN tr k ON k.pair = r.pair AND k.win = r.win AND k.i = r.i + 1)),
  paid AS (SELECT tr.pair, tr.win, tr.t, z, CAST(held AS DOUBLE) AS position, coalesce(lag(held) OVER w, 0) * coalesce(spread - lag(spread) OVER w, 0) - abs(held - coalesce(lag(held) OVER w, 0)) * 0.001 AS gain FROM tr JOIN walked r ON r.pair = tr.pair AND r.win = tr.win AND r.i = tr.i WINDOW w AS (PARTITION BY tr.pair, tr.win ORDER BY tr.t))"""


def _walked(spark, sf_dir):
    aligned = pairs.aligned(tables.candles(spark, sf_dir))
    _, fits = backtests.fitted_windows(aligned, _BACK * pairs.DAY, _STEP * pairs.DAY)
    return fits, backtests.traded(aligned, fits, _STEP * pairs.DAY, enter=1.0, leave=0.5, stop=4.0, longest=10)


@query("walk_forward_trades", f'WITH RECURSIVE {sql.PAIRS}, {_FITS} SELECT pair, win AS "window", t, round(z, 6) + 0.0 AS z, position, round(gain, 6) + 0.0 AS gain FROM paid')
def walk_forward_trades(spark, sf_dir):
    df = _walked(spark, sf_dir)[1]
    return df.select("pair", "window", "t", *rounded(df, "z"), "position", *rounded(df, "gain"))


@query("walk_forward_outcomes", f"""WITH RECURSIVE {sql.PAIRS}, {_FITS}, e AS (SELECT pair, t, gain, sum(gain) OVER (PARTITION BY pair ORDER BY t) AS e FROM paid), u AS (SELECT *, e - max(e) OVER (PARTITION BY pair ORDER BY t) AS u FROM e),
  c AS (SELECT pair, win, CASE WHEN position <> coalesce(lag(position) OVER (PARTITION BY pair, win ORDER BY t), 0) THEN 1 ELSE 0 END AS c FROM paid), k AS (SELECT pair, CAST(sum(c) AS BIGINT) AS trades FROM c GROUP BY 1), h AS (SELECT pair, count(*) AS windows, avg(ln(2) / speed) AS half FROM (SELECT DISTINCT pair, win FROM tr) JOIN live USING (pair, win) GROUP BY 1)
  SELECT pair, count(*) AS days, round(sum(gain), 6) AS total, round(avg(gain) / nullif(stddev_samp(gain), 0) * sqrt(365), 5) AS sharpe, round(min(u), 6) + 0.0 AS drawdown, any_value(trades) AS trades, any_value(windows) AS windows, round(any_value(half), 6) AS mean_half_life FROM u JOIN k USING (pair) JOIN h USING (pair) GROUP BY 1""")
def walk_forward_outcomes(spark, sf_dir):
    fits, rows = _walked(spark, sf_dir)
    df = backtests.outcome(rows, fits)
    return df.select("pair", "days", *rounded(df, "total"), *rounded(df, "sharpe", 5), *rounded(df, "drawdown"), "trades", "windows", *rounded(df, "mean_half_life"))


@query("tradeable_pairs", f"""WITH RECURSIVE {sql.PAIRS}, {_FITS}, {_tested('wspreads', 'pair, win')}, days AS (SELECT pair, win, t - t % 86400 AS day, sum(gain) AS gain FROM paid GROUP BY 1, 2, 3), sh AS (SELECT pair, win, coalesce(avg(gain) / nullif(stddev_samp(gain), 0), 0) AS sharpe FROM days GROUP BY 1, 2),
  hist AS (SELECT pair, win, coalesce(p, 1) AS p, coalesce(speed / nullif(deviation, 0), 0) AS ratio, hedge, coalesce(sharpe, 0) AS sharpe, row_number() OVER (PARTITION BY pair ORDER BY win DESC) AS n, abs(hedge - lag(hedge) OVER v) / nullif(abs(lag(hedge) OVER v), 0) AS drift FROM live LEFT JOIN tested USING (pair, win) JOIN sh USING (pair, win) WINDOW v AS (PARTITION BY pair ORDER BY win)),
  j AS (SELECT pair, count(*) AS c, bool_and(coalesce(p < 0.05, false)) AS tested, bool_and(n = 2 OR coalesce(drift <= 20, false)) AS steady, max(ratio) FILTER (n = 1) AS ratio, max(sharpe) FILTER (n = 1) AS sharpe FROM hist WHERE n <= 2 GROUP BY 1)
  SELECT pair, round(ratio, 6) AS ratio, row_number() OVER (ORDER BY ratio DESC, pair) AS place FROM j WHERE c = 2 AND tested AND steady AND ratio >= 0.5 AND sharpe >= -1""")
def tradeable_pairs(spark, sf_dir):
    fits, rows = _walked(spark, sf_dir)
    tests = _window_tests(pairs.aligned(tables.candles(spark, sf_dir)), _BACK).withColumnRenamed("t", "window")
    df = backtests.tradeable_pairs(backtests.window_history(fits, tests, rows), last=2, most_drift=20.0, least_sharpe=-1.0)
    return df.select("pair", *rounded(df, "ratio"), "place")
