"""Rolling expressions over rows of one series. Null means missing everywhere: NaN and infinities never enter a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def series(*partition: str, order: str = "t") -> WindowSpec:
    return Window.partitionBy(*(partition or ("symbol",))).orderBy(order)


def last_rows(n: int, w: WindowSpec) -> WindowSpec:
    """The row itself and the n - 1 before it."""
    return w.rowsBetween(-(n - 1), 0)


def next_rows(n: int, w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(1, n)


def so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def finite(x: Column) -> Column:
    """Null in place of NaN and infinities."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def ratio(a: Column, b: Column) -> Column:
    """Null where b is zero."""
    return a / F.when(b != 0, b)


def enough(value: Column, x: Column, over: WindowSpec, least: int) -> Column:
    """value where at least `least` rows of the frame have x."""
    return F.when(F.count(x).over(over) >= least, value)


def fill_forward(x: Column, w: WindowSpec, limit: int | None = None) -> Column:
    return F.last(x, ignorenulls=True).over(so_far(w) if limit is None else w.rowsBetween(-limit, 0))


def change(x: Column, n: int, w: WindowSpec) -> Column:
    """x relative to the row n before (n < 0: the later row relative to this one)."""
    return ratio(x, F.lag(x, n).over(w)) - 1 if n > 0 else ratio(F.lead(x, -n).over(w), x) - 1


def mean(x: Column, n: int, w: WindowSpec, least: int | None = None) -> Column:
    return enough(F.avg(x).over(last_rows(n, w)), x, last_rows(n, w), n if least is None else least)


def steady_mean(x: Column) -> Column:
    """The mean of a group's numbers under 8, the same in whatever order its rows are summed up: whole multiples of 2^-60 are
    summed exactly, and the sum is rounded once. A group with a greater number or NaN has its ordinary mean.
    """
    parts = F.when(F.abs(x) < 8, (x * 2.0**60).cast("long").cast("decimal(20,0)"))
    return F.when(F.count(parts) == F.count(x), F.sum(parts).cast("double") / 2.0**60 / F.count(x)).otherwise(F.avg(x))


def ordered_mean(x: Column, place: Column) -> Column:
    """The mean of a group's numbers, added up one after the other by place: what a plain sum over the rows in this order gives, to the last bit."""
    found = F.array_sort(F.collect_list(F.when(x.isNotNull(), F.struct(place.alias("place"), x.alias("x")))))
    return ratio(F.aggregate(found, F.lit(0.0), lambda s, r: s + r["x"]), F.size(found))


def std(x: Column, n: int, w: WindowSpec, least: int | None = None) -> Column:
    return enough(F.stddev_samp(x).over(last_rows(n, w)), x, last_rows(n, w), max(2, n if least is None else least))


def _spread(x: Column, over: WindowSpec) -> Column:
    return F.max(x).over(over) != F.min(x).over(over)


def skew(x: Column, n: int, w: WindowSpec) -> Column:
    """Bias-corrected; 0 in a constant window."""
    over = last_rows(n, w)
    # The built-in keeps central moments, so large prices with small moves do not cancel.
    unbiased = F.skewness(x).over(over) * ((n * (n - 1)) ** 0.5 / (n - 2))
    return enough(F.when(_spread(x, over), unbiased).otherwise(0.0), x, over, n)


def kurtosis(x: Column, n: int, w: WindowSpec) -> Column:
    """Bias-corrected excess; -3 in a constant window."""
    over = last_rows(n, w)
    unbiased = ((n + 1) * F.kurtosis(x).over(over) + 6) * (n - 1) / ((n - 2) * (n - 3))
    return enough(F.when(_spread(x, over), unbiased).otherwise(-3.0), x, over, n)


def correlation(x: Column, y: Column, n: int, w: WindowSpec) -> Column:
    """Pearson, over rows that have both; null in a constant window."""
    over = last_rows(n, w)
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return enough(ratio(F.covar_pop(x, y).over(over), F.stddev_pop(x).over(over) * F.stddev_pop(y).over(over)), x, over, n)


def beta(y: Column, x: Column, n: int, w: WindowSpec) -> Column:
    """Sample covariance over population variance, null where x hardly varies."""
    over = last_rows(n, w)
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    var = F.var_pop(x).over(over)
    return enough(F.covar_samp(x, y).over(over) / F.when(var > 1e-12, var), x, over, n)


def quantile(x: Column, q: float, n: int, w: WindowSpec, least: int | None = None) -> Column:
    """Linear interpolation. For frames of hundreds of rows use sequential.rolling_quantile."""
    return enough(F.percentile(x, F.lit(q)).over(last_rows(n, w)), x, last_rows(n, w), n if least is None else least)


def rank_in_range(x: Column, n: int, w: WindowSpec, least: int = 10, default: float = 50.0) -> Column:
    """Place of x between the least and the greatest of n rows, in percent."""
    over = last_rows(n, w)
    low, high = F.min(x).over(over), F.max(x).over(over)
    return F.coalesce(enough(ratio(100 * (x - low), high - low), x, over, least), F.lit(default))


def share_below(x: Column, n: int, w: WindowSpec) -> Column:
    """Share of the n - 1 rows before that are below x, in percent."""
    before = F.collect_list(x).over(w.rowsBetween(-(n - 1), -1))
    return F.when(F.size(before) > 0, 100.0 * F.size(F.filter(before, lambda v: v < x)) / F.size(before))


def slope_so_far(y: Column, x: Column, w: WindowSpec, least: int = 10) -> Column:
    """Least-squares slope of all rows until now, from running sums."""
    over = so_far(w)
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    n, sx, sy, sxx, sxy = (F.sum(v).over(over) for v in (F.when(x.isNotNull(), 1.0), x, y, x * x, x * y))
    return F.when(F.count(x).over(over) >= least, ratio(n * sxy - sx * sy, n * sxx - sx * sx))


def streak(condition: Column, n: int, w: WindowSpec) -> Column:
    return F.sum(F.coalesce(condition, F.lit(False)).cast("int")).over(last_rows(n, w)) == n


def drawdown(gain: Column, w: WindowSpec) -> tuple[Column, str]:
    """Running sum of gains, under a name to put a running maximum on."""
    return F.sum(gain).over(so_far(w)), "equity"


DAY = 86_400


def numbered(rows: DataFrame, by: str = "symbol", order: str = "t", name: str = "__n", per: int = DAY) -> DataFrame:
    """rows with their number in their series, from 0: numbered within periods, whose row counts are added up in front.

    So no task orders a whole series; what is laid in order for one is a row for each of its periods.
    """
    period = F.floor(F.col(order) / per).cast("long")
    dated = rows.withColumn("__period", period)
    counts = dated.groupBy(by, "__period").agg(F.count(F.lit(1)).alias("__c"))
    before = F.sum("__c").over(Window.partitionBy(by).orderBy("__period").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col(by).alias("__by"), F.col("__period").alias("__of"), F.coalesce(before, F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(by, "__period").orderBy(order)) - 1
    met = dated.withColumn("__i", inside).join(offsets, dated[by].eqNullSafe(offsets["__by"]) & dated["__period"].eqNullSafe(offsets["__of"]))
    return met.select(*rows.columns, (F.col("__i") + F.col("__before")).alias(name))


def in_blocks(rows: DataFrame, back: int, compute: Callable[[DataFrame, WindowSpec], DataFrame], size: int = 20_000, by: str = "symbol", order: str = "t") -> DataFrame:
    """What compute(rows, w) makes of windows that look back over at most `back` rows, a series being dealt in blocks of `size` rows.

    Each block also gets the `back` rows before it, and their results are dropped again, so long series are many tasks and
    nothing changes but that. compute must keep the rows and their columns.
    """
    if not 0 <= back <= size:
        raise ValueError(f"a block of {size} rows cannot be preceded by {back}")
    at = numbered(rows, by, order)
    block = F.floor(F.col("__n") / size)
    late = F.col("__n") % size >= size - back
    each = F.when(late, F.array(block, block + 1)).otherwise(F.array(block))
    dealt = at.select(*rows.columns, "__n", F.explode(each).alias("__block"))
    done = compute(dealt, Window.partitionBy(by, "__block").orderBy(order))
    return done.where(F.floor(F.col("__n") / size) == F.col("__block")).drop("__n", "__block")
