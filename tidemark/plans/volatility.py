"""Queries on the option panel over time: rolling columns, predicates, and straddle labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import options, predicates
from ..sources import driver_tables as tables
from . import oracles as sql
from .market import counted, counts_sql
from .registry import query, rounded

_PANEL = f"""{sql.CHAIN}, pan AS (SELECT asset, day, first(spot_open) AS spot_open, first(spot_close) AS spot_close, avg(iv) FILTER (expiry = weekly AND strike = atm AND kind = 'call') AS iv_call, avg(iv) FILTER (expiry = weekly AND strike = atm AND kind = 'put') AS iv_put,
  median(iv) FILTER (expiry = weekly AND kind = 'call') / nullif(median(iv) FILTER (expiry = monthly AND kind = 'call'), 0) AS term_structure_ratio, sum(open_interest) FILTER (kind = 'call') AS oi_call, sum(open_interest) FILTER (kind = 'put') AS oi_put FROM base LEFT JOIN atms USING (asset, day) GROUP BY 1, 2),
  p1 AS (SELECT pan.*, wp - wc AS skew_25d_rr, (coalesce(iv_call, 0) + coalesce(iv_put, 0)) / nullif(CAST(iv_call IS NOT NULL AS INT) + CAST(iv_put IS NOT NULL AS INT), 0) AS iv, coalesce(oi_call, 0) + coalesce(oi_put, 0) AS total_oi FROM pan LEFT JOIN wings USING (asset, day)),
  p2 AS (SELECT *, ln(spot_close / nullif(lag(spot_close) OVER w, 0)) AS r, spot_close - lag(spot_close) OVER w AS d FROM p1 WINDOW w AS (PARTITION BY asset ORDER BY day)),
  p3 AS (SELECT *, {", ".join(f"spot_close / nullif(lag(spot_close, {n}) OVER w, 0) - 1 AS spot_return_{n}d" for n in (5, 10, 20, 60))}, {", ".join(f"CASE WHEN count(r) OVER w{n} >= {n // 2} THEN stddev_samp(r) OVER w{n} * sqrt(252) END AS hv_{n}d" for n in (10, 20))},
    CASE WHEN count(spot_close) OVER w20 >= 5 THEN spot_close / avg(spot_close) OVER w20 - 1 END AS spot_vs_ma20, coalesce(100 - 100 / (1 + avg(CASE WHEN d IS NOT NULL THEN greatest(d, 0) END) OVER w7 / nullif(avg(CASE WHEN d IS NOT NULL THEN greatest(-d, 0) END) OVER w7, 0)), 50) AS rsi_7,
    coalesce(CASE WHEN count(iv) OVER w252 >= 10 THEN 100 * (iv - min(iv) OVER w252) / nullif(max(iv) OVER w252 - min(iv) OVER w252, 0) END, 50) AS iv_rank, total_oi - lag(total_oi) OVER w AS oi_1d_change
    FROM p2 WINDOW w AS (PARTITION BY asset ORDER BY day), {", ".join(f"w{n} AS (PARTITION BY asset ORDER BY day ROWS {n - 1} PRECEDING)" for n in (7, 10, 20, 252))}),
  rolled AS (SELECT *, iv / nullif(hv_20d, 0) AS iv_vs_hv20 FROM p3)"""
SHOWN = "spot_return_5d spot_return_10d spot_return_20d spot_return_60d hv_10d hv_20d spot_vs_ma20 rsi_7 iv_rank iv_vs_hv20 oi_1d_change"


def _rolled(spark, sf_dir):
    return options.rolling_panel(options.daily_panel(tables.option_chain(spark, sf_dir)))


@query("option_history", f"WITH {_PANEL} SELECT asset, day, {sql.rounded(SHOWN, 5)} FROM rolled")
def option_history(spark, sf_dir):
    df = _rolled(spark, sf_dir)
    return df.select("asset", "day", *rounded(df, SHOWN, 5))


_ATOMS = {
    "high_iv_rank": "iv_rank > 70", "low_iv_rank": "iv_rank < 30", "backwardation": "term_structure_ratio < 1", "contango": "term_structure_ratio > 1", "positive_skew": "skew_25d_rr > 0", "negative_skew": "skew_25d_rr < 0", "oi_expansion": "oi_1d_change > 0", "high_hv": "hv_20d > hv_20d_q66", "low_hv": "hv_20d < hv_20d_q33",
    "rsi_oversold": "rsi_7 < 30", "rsi_overbought": "rsi_7 > 70", "above_ma20": "spot_vs_ma20 > 0", "below_ma20": "spot_vs_ma20 < 0", "momentum_up": "spot_return_20d > 0.03", "momentum_down": "spot_return_20d < -0.03", "iv_premium": "iv_vs_hv20 > 1.2", "iv_discount": "iv_vs_hv20 < 0.8", "vol_compression": "hv_10d < hv_20d", "vol_expansion": "hv_10d > hv_20d",
}
_ROUND = ("term_structure_ratio", "skew_25d_rr")


@query("option_atoms", f"WITH {_PANEL}, cuts AS (SELECT asset, quantile_cont(hv_20d, 0.66) AS hv_20d_q66, quantile_cont(hv_20d, 0.33) AS hv_20d_q33 FROM rolled GROUP BY 1), f AS (SELECT rolled.* REPLACE ({', '.join(f'round({c}, 9) AS {c}' for c in _ROUND)}), cuts.* EXCLUDE (asset), day AS t FROM rolled JOIN cuts USING (asset)) {counts_sql('f', {a: (x, x) for a, x in _ATOMS.items()})}")
def option_atoms(spark, sf_dir):
    rows = predicates.with_cutoffs(_rolled(spark, sf_dir), predicates.CUTOFFS["options"], ("asset",))
    return counted(rows.withColumns({c: F.round(c, 9) for c in _ROUND}).withColumn("t", F.col("day")), "options")
