"""As-of joins: for each left row the last right row at or before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, prefix: str, within: int | None = None, block: int | None = None) -> DataFrame:
    """left with the columns of right (but key) under prefix; nulls where there is none, or none within so many units.

    Both sides are laid in one order by a union, and the last right row is carried on as one struct, so its nulls come
    along: one shuffle by key, one sort, no range join. Of right rows with one time the last by all columns counts.

    block: so many units of time are laid in order by one task; a series is then as many tasks as it has blocks. What a block
    begins with, the last right row of all blocks before it, comes from a table of one row for each key and block.
    """
    columns = [c for c in right.columns if c != key]
    row = F.struct(*[F.col(c) for c in columns])
    part = lambda at: F.floor(F.col(at) / block).cast("long") if block else F.lit(0).cast("long")
    rights = right.select(key, part(right_at).alias("__block"), F.col(right_at).alias("__at"), F.lit(0).alias("__side"), row.alias("__r"), F.lit(None).cast(left.select(F.struct(*left.columns).alias("l")).schema["l"].dataType).alias("__l"))
    lefts = left.select(key, part(left_at).alias("__block"), F.col(left_at).alias("__at"), F.lit(1).alias("__side"), F.lit(None).cast(rights.schema["__r"].dataType).alias("__r"), F.struct(*left.columns).alias("__l"))
    w = Window.partitionBy(key, "__block").orderBy("__at", "__side", "__r").rowsBetween(Window.unboundedPreceding, 0)
    carried = rights.unionByName(lefts).select(key, "__block", "__l", "__at", F.last("__r", ignorenulls=True).over(w).alias("__r")).where("__l is not null")
    if block:
        last = F.max(F.when(F.col("__r").isNotNull(), F.struct("__at", "__r"))).alias("__last")
        blocks = rights.select(key, "__block", "__at", "__r").unionByName(lefts.select(key, "__block", "__at", "__r")).groupBy(key, "__block").agg(last)
        before = F.last("__last", ignorenulls=True).over(Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
        begins = blocks.select(F.col(key).alias("__key"), F.col("__block").alias("__b"), before.alias("__before"))
        # Left rows without a key or a time meet nothing, as without blocks.
        met = carried.join(begins, carried[key].eqNullSafe(begins["__key"]) & carried["__block"].eqNullSafe(begins["__b"]), "left")
        carried = met.select("__l", "__at", F.coalesce("__r", "__before.__r").alias("__r"))
    near = F.col("__r") if within is None else F.when(F.col("__at") - F.col(f"__r.{right_at}") <= within, F.col("__r"))
    return carried.withColumn("__r", near).select("__l.*", *[F.col(f"__r.{c}").alias(f"{prefix}{c}") for c in columns])


#: Bars that are laid in order by one task: 30 days.
BLOCK = 30 * 86_400


def closed_bars(base: DataFrame, context: DataFrame, seconds: int, prefix: str) -> DataFrame:
    """base with the last bar of a longer period that had closed when each base row began."""
    return as_of(base, context.withColumn("closed", F.col("t") + seconds), "symbol", "t", "closed", prefix, block=BLOCK)
