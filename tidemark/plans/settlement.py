"""Queries on option days and weeks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import option_days, options
from ..sources import archives
from ..sources import driver_tables as tables
from .registry import query, rounded

_SNAPSHOTS = """snaps AS (SELECT *, coalesce(mark_iv, (coalesce(bid_iv, ask_iv) + coalesce(ask_iv, bid_iv)) / 2) AS iv FROM (SELECT CASE WHEN l_returnflag = 'N' THEN 'ONE' ELSE 'TWO_USDC' END AS asset, d * 86400 AS day, d * 86400 + l_orderkey % 8 * 10800 AS ts, CASE WHEN l_suppkey % 2 = 0 THEN 'call' ELSE 'put' END AS kind,
    round(p_retailprice / 250) * 250 AS strike, (d + (8 - d % 7) % 7) * 86400 + 28800 + 604800 * (l_linenumber % 6) AS expiry, 1400.0::DOUBLE + (d * 37 + l_orderkey % 8 * 11) % 300 AS spot, CASE WHEN l_linenumber <> 3 THEN l_discount + 0.2 END AS mark_iv, CASE WHEN l_linenumber <> 5 THEN l_discount + 0.19 END AS bid_iv, l_discount + 0.21 AS ask_iv,
    CASE WHEN l_quantity > 2 THEN l_tax + 0.05 + CASE WHEN l_returnflag = 'N' THEN 0 ELSE 100 END END AS price, CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE -1 END * (l_partkey % 10) / 20.0::DOUBLE AS delta, l_discount / 100 AS gamma, l_tax AS vega, CASE WHEN l_linenumber <> 2 THEN -l_discount END AS theta, l_quantity AS open_interest, l_orderkey * 10 + l_linenumber AS seq
    FROM (SELECT *, CAST(floor(epoch(l_shipdate) / 864000) AS BIGINT) AS d FROM lineitem) JOIN part ON p_partkey = l_partkey)),
  opened AS (SELECT asset, day, first(spot ORDER BY ts, seq, spot, strike, expiry, kind) AS spot_open, first(spot ORDER BY ts DESC, seq, spot, strike, expiry, kind) AS spot_close, first(spot ORDER BY abs(ts - day - 28800), ts, seq, spot, strike, expiry, kind) AS spot_settlement,
    coalesce(min(expiry) FILTER (expiry > day + 43200 AND expiry <= day + 43200 + 604800), min(expiry) FILTER (expiry > day + 43200)) AS weekly, first(expiry ORDER BY abs(expiry - day - 43200 - 2592000), expiry) FILTER (expiry > day + 43200) AS monthly FROM snaps GROUP BY 1, 2),
  both_ AS (SELECT s.* EXCLUDE (spot), o.* EXCLUDE (asset, day) FROM snaps s JOIN opened o USING (asset, day) WHERE spot_open > 0 AND weekly IS NOT NULL AND (expiry = weekly OR expiry = monthly)),
  strikes AS (SELECT asset, day, first(strike ORDER BY ts, abs(strike - spot_open), seq) FILTER (expiry = weekly) AS atm, max(ts) FILTER (expiry = weekly) AS last_ts, first(strike ORDER BY abs(strike - spot_open), ts, seq) FILTER (expiry = monthly) AS atm_monthly FROM both_ GROUP BY 1, 2),
  base AS (SELECT * FROM both_ JOIN strikes USING (asset, day) WHERE atm IS NOT NULL),
  money AS (SELECT * FROM base WHERE expiry = weekly AND strike = atm)"""


def _leg(what: str, kind: str, low: bool) -> str:
    given = f"FILTER (kind = '{kind}' AND {what} IS NOT NULL)"
    out = f"first({what} ORDER BY ts, seq) {given} AS {what}_{kind}_open, max({what}) {given} AS {what}_{kind}_high, last({what} ORDER BY ts, seq) {given} AS {what}_{kind}_close"
    return out + (f", min({what}) {given} AS {what}_{kind}_low" if low else "")


def _wing(kind: str, n: int, target: float) -> str:
    return f"first(iv ORDER BY round(abs(d - {target}), 12), strike) FILTER (kind = '{kind}' AND round(abs(d - {target}), 12) <= 0.12) AS {kind}{n}"


_AVERAGE = ", ".join(f"(coalesce(iv_call_{p}, 0) + coalesce(iv_put_{p}, 0)) / nullif(CAST(iv_call_{p} IS NOT NULL AS INT) + CAST(iv_put_{p} IS NOT NULL AS INT), 0) AS iv_avg_{p}" for p in ("open", "high", "low", "close"))
_ROWS = f"""{_SNAPSHOTS},
  legs AS (SELECT asset, day, {_leg('iv', 'call', True)}, {_leg('iv', 'put', True)}, {_leg('price', 'call', False)}, {_leg('price', 'put', False)} FROM money GROUP BY 1, 2),
  met AS (SELECT c.asset, c.day, c.ts, c.seq AS cs, p.seq AS ps, c.price + p.price AS s FROM money c JOIN money p ON c.asset = p.asset AND c.day = p.day AND c.ts = p.ts WHERE c.kind = 'call' AND p.kind = 'put' AND c.price IS NOT NULL AND p.price IS NOT NULL),
  together AS (SELECT asset, day, first(s ORDER BY ts, cs, ps) AS so, max(s) AS sh, last(s ORDER BY ts, cs, ps) AS sc FROM met GROUP BY 1, 2),
  per_strike AS (SELECT asset, day, kind, strike, avg(delta) AS d, avg(iv) AS iv FROM base WHERE expiry = weekly GROUP BY 1, 2, 3, 4),
  wings AS (SELECT asset, day, {_wing('call', 25, 0.25)}, {_wing('call', 10, 0.10)}, {_wing('put', 25, -0.25)}, {_wing('put', 10, -0.10)} FROM per_strike GROUP BY 1, 2),
  sums AS (SELECT asset, day, coalesce(sum(open_interest) FILTER (expiry = weekly AND ts = last_ts AND kind = 'call'), 0) AS call_oi, coalesce(sum(open_interest) FILTER (expiry = weekly AND ts = last_ts AND kind = 'put'), 0) AS put_oi, {", ".join(f"avg({c}) FILTER (expiry = weekly AND strike = atm) AS atm_{c}" for c in option_days.GREEKS)}, avg(delta) FILTER (expiry = weekly AND strike = atm AND kind = 'call') AS atm_delta_call,
    median(iv) FILTER (expiry = weekly AND strike = atm AND kind = 'call') AS mw, median(iv) FILTER (expiry = monthly AND strike = atm_monthly AND kind = 'call') AS mm, any_value(spot_open) AS spot_open, any_value(spot_close) AS spot_close, any_value(spot_settlement) AS spot_settlement, any_value(weekly) AS weekly, any_value(monthly) AS monthly, any_value(atm) AS atm FROM base GROUP BY 1, 2),
  rows AS (SELECT asset, day, CAST(make_timestamp(day * 1000000) AS DATE) AS date, spot_open, spot_close, spot_settlement, weekly, monthly, atm, legs.* EXCLUDE (asset, day), {_AVERAGE}, coalesce(so, price_call_open + price_put_open) AS price_straddle_open, coalesce(sh, price_call_high + price_put_high) AS price_straddle_high, coalesce(sc, price_call_close + price_put_close) AS price_straddle_close,
    put25 - call25 AS skew_25, put10 - call10 AS skew_10, 0.5 * (put25 + call25) AS butterfly_25, CASE WHEN monthly <> weekly AND mm > 0 THEN mw / mm END AS term_ratio, call_oi + put_oi AS total_oi, call_oi, put_oi, put_oi / nullif(call_oi, 0) AS put_call, atm_gamma, atm_vega, atm_theta, atm_delta_call FROM sums LEFT JOIN legs USING (asset, day) LEFT JOIN together USING (asset, day) LEFT JOIN wings USING (asset, day))"""

NUMBERS = " ".join([
    "spot_open spot_close spot_settlement atm", *[f"iv_{k}_{p}" for k in ("call", "put", "avg") for p in ("open", "high", "low", "close")], *[f"price_{k}_{p}" for k in ("call", "put", "straddle") for p in ("open", "high", "close")],
    "skew_25 skew_10 butterfly_25 term_ratio total_oi call_oi put_oi put_call atm_gamma atm_vega atm_theta atm_delta_call",
])
_DATES = "weekly, monthly, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST((12 - isodow(date)) % 7 AS INTEGER) AS days_to_friday, CAST(week(date) AS INTEGER) AS week_number, CAST(weekly // 86400 - day // 86400 AS INTEGER) AS days_to_expiry"


def _days(spark, sf_dir):
    return option_days.daily_rows(options.with_mark(tables.option_snapshots(spark, sf_dir)))


@query("option_day_rows", f"WITH {_ROWS} SELECT asset, day, {_DATES}, {', '.join(f'round({c}, 10) + 0.0 AS {c}' for c in NUMBERS.split())} FROM rows")
def option_day_rows(spark, sf_dir):
    df = _days(spark, sf_dir)
    df = df.withColumns({c: F.round(c, 15) for c in df.columns if c.startswith("atm_")})  # means of hundredths that lie between two tenth digits
    return df.select("asset", "day", "weekly", "monthly", "day_of_week", "days_to_friday", "week_number", "days_to_expiry", *rounded(df, NUMBERS, 10))


def _gain(leg: str) -> str:
    worth = {kind: f"CASE WHEN atm > 0 AND target_price > 0 THEN greatest({'target_price - atm' if kind == 'call' else 'atm - target_price'}, 0) / CASE WHEN contains(asset, 'USDC') THEN 1 ELSE target_price END END" for kind in ("call", "put")}
    worth["straddle"] = f"({worth['call']}) + ({worth['put']})"
    p = f"price_{leg}_open"
    return f"round(CASE WHEN {p} > 0 THEN CASE WHEN coalesce(later_{leg} >= {p} * 1.1, false) THEN -0.1 ELSE ({p} - ({worth[leg]})) / {p} END END, 8) + 0.0 AS gain_short_{leg}"


_WEEKS = f"""{_ROWS}, dated AS (SELECT *, isoyear(date) * 100 + week(date) AS iso_week, isodow(date) - 1 AS dow FROM rows), held AS (SELECT *, {", ".join(f"max(price_{leg}_high) OVER w AS later_{leg}" for leg in ("call", "put", "straddle"))} FROM dated WINDOW w AS (PARTITION BY asset, iso_week ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
  fridays AS (SELECT asset, iso_week, CASE WHEN spot_settlement > 0 THEN spot_settlement ELSE spot_close END AS target_price FROM dated WHERE dow = 4),
  samples AS (SELECT asset, day, CAST(iso_week AS INTEGER) AS iso_week, target_price, CASE WHEN target_price / spot_open - 1 <= -0.05 THEN 0 WHEN target_price / spot_open - 1 >= 0.05 THEN 2 ELSE 1 END AS label, {_gain('call')}, {_gain('put')}, {_gain('straddle')}, {", ".join(f"price_{leg}_{p}" for leg in option_days.LEGS for p in ("open", "high"))} FROM held JOIN fridays USING (asset, iso_week) WHERE dow <= 3 AND spot_open > 0)"""


@query("weekly_samples", f"WITH {_WEEKS} SELECT asset, day, iso_week, target_price, label, gain_short_call, gain_short_put, gain_short_straddle FROM samples")
def weekly_samples(spark, sf_dir):
    df = option_days.weekly_samples(_days(spark, sf_dir), threshold=0.05)
    return df.select("asset", "day", "iso_week", "target_price", "label", *rounded(df, "gain_short_call gain_short_put gain_short_straddle", 8))


def _choose(name: str) -> str:
    return "CASE leg " + " ".join(f"WHEN '{x}' THEN {name.format(x)}" for x in option_days.LEGS) + " END"


@query("weekly_reentry", f"""WITH {_WEEKS}, l AS (SELECT *, CASE WHEN day // 86400 % 3 = 0 THEN 'call' WHEN day // 86400 % 3 = 2 THEN 'put' ELSE 'straddle' END AS leg FROM samples), n AS (SELECT *, CASE WHEN leg = lag(leg) OVER (PARTITION BY asset, iso_week ORDER BY day) THEN 0 ELSE 1 END AS fresh FROM l), r AS (SELECT *, sum(fresh) OVER (PARTITION BY asset, iso_week ORDER BY day) AS run FROM n),
  g AS (SELECT asset, iso_week, run, leg, arg_min({_choose('coalesce(price_{}_open, -1)')}, day) AS entry, arg_min({_choose('coalesce(gain_short_{}, 0)')}, day) AS held, max({_choose('price_{}_high')}) FILTER (fresh = 0) AS high, {", ".join(f"arg_min(coalesce(price_{x}_open, -1), day) AS open_{x}" for x in option_days.LEGS)} FROM r GROUP BY ALL),
  f AS (SELECT *, lead(run) OVER w AS following, {_choose('lead(open_{}) OVER w')} AS closed FROM g WINDOW w AS (PARTITION BY asset, iso_week ORDER BY run))
  SELECT asset, iso_week, count(*) AS legs, round(sum(CASE WHEN following IS NULL THEN held WHEN entry > 0 THEN CASE WHEN high >= entry * 1.1 THEN -0.1 WHEN closed > 0 THEN (entry - closed) / entry ELSE 0 END ELSE 0 END), 6) + 0.0 AS gain FROM f GROUP BY 1, 2""")
def weekly_reentry(spark, sf_dir):
    samples = option_days.weekly_samples(_days(spark, sf_dir), threshold=0.05).withColumn("prediction", F.pmod(F.col("day") / 86_400, F.lit(3)).cast("int"))
    df = option_days.weekly_reentry(samples)
    return df.select("asset", "iso_week", "legs", *rounded(df, "gain"))


@query("straddle_gains", f"WITH {_WEEKS} SELECT asset, day, gain_short_straddle AS gain FROM samples")
def straddle_gains(spark, sf_dir):
    df = option_days.weekly_samples(_days(spark, sf_dir), threshold=0.05)
    return df.select("asset", "day", (F.round("gain_short_straddle", 8) + 0.0).alias("gain"))


_HOLDS = {"short_call": "label = 0", "short_put": "label = 2", "short_straddle": "target_price < 1600"}


@query("position_slices", f"""WITH {_WEEKS}, s AS ({" UNION ALL ".join(f"SELECT '{p}' AS position, {option_days.POSITIONS[p]} AS gain FROM samples WHERE {holds} AND {option_days.POSITIONS[p]} IS NOT NULL" for p, holds in _HOLDS.items())}) SELECT position, count(*) AS n, round(sum(gain), 6) + 0.0 AS gain FROM s GROUP BY 1""")
def position_slices(spark, sf_dir):
    root = archives.scratch(spark, "positions")
    samples = option_days.weekly_samples(_days(spark, sf_dir), threshold=0.05)
    archives.write_slices(option_days.position_slices(samples, [(p, F.expr(holds)) for p, holds in _HOLDS.items()]), root, ("position",))
    return spark.read.parquet(root).groupBy("position").agg(F.count(F.lit(1)).alias("n"), (F.round(F.sum("gain"), 6) + 0.0).alias("gain"))
