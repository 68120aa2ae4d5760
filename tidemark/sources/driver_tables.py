"""Ticks, quotes, liquidations, daily candles and an option chain, read out of the driver's tables.

Times are whole numbers since 1970-01-01 UTC (`us` microseconds, `t` seconds), so no session time zone takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = 86_400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def placed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with place: where a row stands in it (its file and its number there)."""
    return table(spark, sf_dir, name).select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias("place"))


def micros(ts: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {ts})")


def floor_to(t: Column, period: int) -> Column:
    """The start of the period that holds t, also before 1970."""
    return t - F.pmod(t, F.lit(period))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, us, seq, side, price, amount."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_type").alias("symbol"), micros("ts").alias("us"), F.col("event_id").alias("seq"),
        F.when(F.col("user_id") % 2 == 0, "buy").otherwise("sell").alias("side"),
        F.col("value").alias("price"), (F.get_json_object("props", "$.k").cast("double") + 1).alias("amount"),
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, us, seq, bid, ask, bid_size, ask_size: each event is a quote as well."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_type").alias("symbol"), micros("ts").alias("us"), F.col("event_id").alias("seq"),
        (F.col("value") * 0.999).alias("bid"), (F.col("value") * 1.001).alias("ask"),
        (F.col("user_id") % 7 + 1).cast("double").alias("bid_size"), (F.col("user_id") % 5 + 1).cast("double").alias("ask_size"),
    )


def books(spark: SparkSession, sf_dir: str, levels: int = 5) -> DataFrame:
    """symbol, us, seq, bids_<i>_qty, asks_<i>_qty: the sizes of a book's levels, each event being a snapshot."""
    sizes = [F.when(F.col("user_id") % (4 + i) != 0, (F.col("user_id") % (7 + i)).cast("double") + 1).alias(f"bids_{i}_qty") for i in range(levels)]
    sizes += [(F.col("user_id") % (5 + i)).cast("double") + i for i in range(levels)]
    named = [c if i < levels else c.alias(f"asks_{i - levels}_qty") for i, c in enumerate(sizes)]
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("symbol"), micros("ts").alias("us"), F.col("event_id").alias("seq"), *named)


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, us, seq, mark_price, index_price, open_interest, funding_rate of each event."""
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), micros("ts").alias("us"), F.col("event_id").alias("seq"), (F.col("value") * (1 + (k - 50) / 10000)).alias("mark_price"),
        F.col("value").alias("index_price"), F.col("user_id").cast("double").alias("open_interest"), ((k - 50) / 10000).alias("funding_rate"),
    )


def liquidations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, us, seq, side, price, amount: the ticks of large amounts stand for liquidations."""
    return ticks(spark, sf_dir).where("amount >= 80")


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, t, open, high, low, close, volume, trades: one row for each priority and day with orders."""
    volume = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("qty"))
    orders = table(spark, sf_dir, "orders").join(volume, "o_orderkey", "left")
    day = floor_to(F.floor(micros("o_orderdate") / 1_000_000).cast("long"), DAY)
    price = F.col("o_totalprice")
    return orders.groupBy(F.col("o_orderpriority").alias("symbol"), day.alias("t")).agg(
        F.min_by(price, F.col("o_orderkey")).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, F.col("o_orderkey")).alias("close"),
        F.sum(F.coalesce("qty", F.lit(0.0))).alias("volume"), F.count(price).alias("trades"),
    )


def option_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """asset, day, kind, strike, expiry, mark_iv, bid_iv, ask_iv, price, spot, delta, open_interest, seq, place."""
    lines = placed(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey")
    day = floor_to(F.floor(micros("l_shipdate") / 1_000_000).cast("long"), DAY * 28)
    return lines.select(
        F.col("l_linestatus").alias("asset"), day.alias("day"), F.when(F.col("l_returnflag") == "R", "put").otherwise("call").alias("kind"),
        F.col("p_retailprice").alias("strike"), (day + DAY * 7 * (1 + F.col("l_suppkey") % 6)).alias("expiry"),
        F.when(F.col("l_linenumber") != 3, F.col("l_discount") + 0.2).alias("mark_iv"),
        F.when(F.col("l_linenumber") != 5, F.col("l_discount") + 0.19).alias("bid_iv"), (F.col("l_discount") + 0.21).alias("ask_iv"),
        (F.col("l_tax") * 100 + 1).alias("price"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("spot"),
        (F.col("l_suppkey") % 100 / 100.0).alias("delta"), F.col("l_quantity").alias("open_interest"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), "place",
    )


def option_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """asset, day, ts, kind, strike, expiry, spot, mark_iv, bid_iv, ask_iv, price, delta, gamma, vega, theta, open_interest, seq, place.

    Ten shipping days make one day; hours come from order numbers, strikes are part prices in steps of 250, expiries the Fridays at 8 after the day.
    """
    lines = placed(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey")
    day = F.floor(micros("l_shipdate") / (10 * 1_000_000 * DAY)).cast("long") * DAY
    friday = day + DAY * F.pmod(F.lit(1) - F.floor(day / DAY), F.lit(7)) + 8 * 3600  # day 1 of 1970 was a Friday
    call = F.col("l_suppkey") % 2 == 0
    steps = (F.col("l_partkey") % 10) / 20.0
    return lines.select(
        F.when(F.col("l_returnflag") == "N", "ONE").otherwise("TWO_USDC").alias("asset"), day.alias("day"), (day + F.col("l_orderkey") % 8 * 3 * 3600).alias("ts"), F.when(call, "call").otherwise("put").alias("kind"),
        (F.round(F.col("p_retailprice") / 250) * 250).alias("strike"), (friday + 7 * DAY * (F.col("l_linenumber") % 6)).alias("expiry"), (F.lit(1400.0) + F.pmod(day / DAY * 37 + F.col("l_orderkey") % 8 * 11, F.lit(300))).alias("spot"),
        F.when(F.col("l_linenumber") != 3, F.col("l_discount") + 0.2).alias("mark_iv"), F.when(F.col("l_linenumber") != 5, F.col("l_discount") + 0.19).alias("bid_iv"), (F.col("l_discount") + 0.21).alias("ask_iv"),
        F.when(F.col("l_quantity") > 2, F.col("l_tax") + 0.05 + F.when(F.col("l_returnflag") == "N", 0).otherwise(100)).alias("price"), F.when(call, steps).otherwise(-steps).alias("delta"),
        (F.col("l_discount") / 100).alias("gamma"), F.col("l_tax").alias("vega"), F.when(F.col("l_linenumber") != 2, -F.col("l_discount")).alias("theta"),
        F.col("l_quantity").alias("open_interest"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), "place",
    )
