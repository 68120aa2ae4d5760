"""From scores to orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import windows as W


def linear_score(features: Column, model: Column) -> Column:
    """Sum of (x - center) / scale * weight over an array of features and one of (center, scale, weight); null counts 0, scale 0 as 1."""
    terms = F.zip_with(features, model, lambda x, m: F.coalesce((x - m["center"]) / F.when(m["scale"] != 0, m["scale"]).otherwise(1.0), F.lit(0.0)) * m["weight"])
    return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)


def votes(signals: DataFrame, quantity: float, least: int = 1) -> DataFrame:
    """symbol, t, prediction, threshold, side -> net vote and signed quantity; ties and fewer than `least` votes give 0."""
    fired = F.coalesce(F.col("prediction") > F.col("threshold"), F.lit(False))
    ballot = signals.groupBy("symbol", "t").agg(
        F.sum(F.when(fired & (F.col("side") == "long"), 1).otherwise(0)).alias("longs"), F.sum(F.when(fired & (F.col("side") == "short"), 1).otherwise(0)).alias("shorts"),
        F.max(F.when(fired, F.col("prediction") - F.col("threshold"))).alias("best_margin"),
    )
    net = F.col("longs") - F.col("shorts")
    return ballot.select("*", F.when(F.greatest("longs", "shorts") >= least, F.sign(net) * quantity).otherwise(0.0).alias("quantity"))


def lots(quantity: Column, price: Column, step: float, least_value: float) -> Column:
    """quantity in whole steps (half to even), raised to the least value of an order."""
    whole = F.bround(F.abs(quantity) / step) * step
    return F.sign(quantity) * F.when(quantity == 0, 0.0).otherwise(F.greatest(whole, F.ceil(least_value / price / step) * step))


def held_on(side: Column, rows: int, w) -> Column:
    """A fired side (1, -1) lasts for so many rows without one."""
    return F.coalesce(F.last(F.when(side != 0, side), ignorenulls=True).over(w.rowsBetween(-rows, 0)), F.lit(0))


def fresh(t: Column, now: Column, most: int) -> Column:
    return (now - t) <= most


def reconciled(claims: DataFrame, truth: DataFrame, oldest: Column) -> DataFrame:
    """state of each position: orphan (only in truth), missing (only claimed), drifted, stale or agreed."""
    both = claims.select("symbol", F.col("quantity").alias("claimed"), "t").join(truth.select("symbol", F.col("quantity").alias("actual")), "symbol", "full")
    state = F.when(F.col("claimed").isNull(), "orphan").when(F.col("actual").isNull(), "missing").when(F.sign("claimed") != F.sign("actual"), "drifted").when(F.col("t") < oldest, "stale").otherwise("agreed")
    return both.select("symbol", "claimed", "actual", state.alias("state"))


def newest_only(rows: DataFrame, n: int = 1) -> DataFrame:
    w = W.series()
    return rows.withColumn("__n", F.row_number().over(w.orderBy(F.desc("t")))).where(F.col("__n") <= n).drop("__n")


LEAST_WIDTH = 2e-4


def dual_gate() -> Column:
    """Whether a row of (side, prediction, threshold, prediction_2bar, threshold_2bar) fires: both horizons must agree where the second has a threshold."""
    long, short = F.col("side") == "long", F.col("side") == "short"
    one = (long & (F.col("prediction") > F.col("threshold"))) | (short & (F.col("prediction") < F.col("threshold")))
    two = (long & (F.col("prediction_2bar") > F.col("threshold_2bar"))) | (short & (F.col("prediction_2bar") < F.col("threshold_2bar")))
    return F.coalesce(one, F.lit(False)) & (F.col("threshold_2bar").isNull() | F.coalesce(two, F.lit(False)))


def centred_fires(prediction: Column, side: Column, widths: dict[str, float], centres: dict[str, float]) -> Column:
    """Beyond centre + width for long, below centre - width for short; widths under LEAST_WIDTH are refused, predictions that are not finite never fire."""
    if any(not w >= LEAST_WIDTH for w in widths.values()):
        raise ValueError(f"a threshold below {LEAST_WIDTH} fires on nearly every row: {widths}")
    known = F.when(~F.isnan(prediction) & (F.abs(prediction) < float("inf")), prediction)
    fires = ((side == "long") & (known > centres["long"] + widths["long"])) | ((side == "short") & (known < centres["short"] - widths["short"]))
    return F.coalesce(fires, F.lit(False))


def signed_quantity(net: Column, size: Column, reverse: int = 1) -> Column:
    if reverse not in (1, -1):
        raise ValueError("reverse is 1 or -1")
    return net * size * reverse


def class_decision(p_long: Column, p_short: Column, least_long: float, least_short: float) -> Column:
    """1, -1 or 0 from the probabilities of two classes; of two that pass the larger counts, long first."""
    long, short = F.coalesce(p_long > least_long, F.lit(False)), F.coalesce(p_short > least_short, F.lit(False))
    return F.when(long & (~short | (p_long >= p_short)), 1).when(short & ~long, -1).otherwise(0)


def leaves_early(predictions: DataFrame, held: DataFrame, retain: float) -> DataFrame:
    """symbol, net_score, leaves: held positions whose mean long minus mean short prediction no longer backs them."""
    mean = lambda side: F.coalesce(F.avg(F.when(F.col("side") == side, F.col("prediction"))), F.lit(0.0))
    net = predictions.groupBy("symbol").agg((mean("long") - mean("short")).alias("net_score"))
    out = F.when(F.col("quantity") > 0, F.col("net_score") < retain).when(F.col("quantity") < 0, F.col("net_score") > -retain).otherwise(False)
    return held.join(net, "symbol").select("symbol", "net_score", out.alias("leaves"))


def price_at(rows: DataFrame, prices: DataFrame, strict: bool = False) -> DataFrame:
    """rows with the price of their own time; where that is missing or null, the last one before. strict: a row without either is an error."""
    from .asof import BLOCK, as_of

    known = prices.where("close is not null").select("symbol", F.col("t").alias("priced_t"), F.col("close").alias("price"))
    met = as_of(rows, known, "symbol", "t", "priced_t", "", block=BLOCK)
    return met.withColumn("price", F.when(F.col("price").isNull(), F.raise_error(F.lit("no price at or before a scored row"))).otherwise(F.col("price"))) if strict else met


def stack_rows(stack: DataFrame, threshold: str = "optimal_threshold") -> DataFrame:
    """The rows of a stack that name a predicate (not `__...`), with the threshold under one name."""
    named = [c for c in (threshold, "opt_threshold", "threshold") if c in stack.columns]
    if not named:
        raise ValueError("the stack has no threshold")
    return stack.where(~F.col("regime").startswith("__")).withColumn("threshold", F.coalesce(*[F.col(c) for c in named]))
