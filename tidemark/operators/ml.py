"""Model steps over feature tables, with pyspark.ml where it has them."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def standardised(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values become the column's median, then each column is centred and scaled by its population deviation."""
    stats = rows.agg(*[x for c in columns for x in (F.median(c).alias(f"{c}_m"),)]).first()
    filled = rows.withColumns({c: F.coalesce(c, F.lit(stats[f"{c}_m"])) for c in columns})
    scale = filled.agg(*[x for c in columns for x in (F.avg(c).alias(f"{c}_a"), F.stddev_pop(c).alias(f"{c}_s"))]).first()
    return filled.withColumns({c: (F.col(c) - scale[f"{c}_a"]) / (scale[f"{c}_s"] or 1.0) for c in columns})


def clustered(rows: DataFrame, array: str, components: int, k: int, seed: int = 1) -> DataFrame:
    """rows with cluster and components, by scaling, principal components and k-means on an array column."""
    vectors = rows.withColumn("__v", array_to_vector(F.transform(array, lambda x: x.cast("double"))))
    scaled = StandardScaler(inputCol="__v", outputCol="__s", withMean=True).fit(vectors).transform(vectors)
    reduced = PCA(k=components, inputCol="__s", outputCol="__p").fit(scaled).transform(scaled)
    found = KMeans(k=k, seed=seed, featuresCol="__p", predictionCol="cluster").fit(reduced).transform(reduced)
    return found.select(*rows.columns, "cluster", vector_to_array("__p").alias("components"))


def cluster_profile(rows: DataFrame, columns: list[str], top: int) -> DataFrame:
    """For each cluster the columns whose means lie furthest from the overall mean, in overall deviations."""
    whole = rows.agg(*[x for c in columns for x in (F.avg(c).alias(f"{c}_a"), F.stddev_pop(c).alias(f"{c}_s"))])
    by = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in columns])
    long = by.join(F.broadcast(whole)).select("cluster", "n", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), (F.abs(F.col(c) - F.col(f"{c}_a")) / F.when(F.col(f"{c}_s") > 0, F.col(f"{c}_s"))).alias("gap")) for c in columns])).alias("x")).select("cluster", "n", "x.*")
    w = Window.partitionBy("cluster").orderBy(F.desc_nulls_last("gap"), "feature")
    return long.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top)


def average_rank(x: str, *by: str) -> Column:
    """Ranks with ties at their mean."""
    w = Window.partitionBy(*by)
    return F.rank().over(w.orderBy(x)) + (F.count(F.lit(1)).over(Window.partitionBy(*by, x)) - 1) / 2.0


def spearman(rows: DataFrame, x: str, y: str, by: str) -> DataFrame:
    """Rank correlation of x and y in each group, over rows that have both."""
    both = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(by, average_rank(x, by).alias("rx"), average_rank(y, by).alias("ry"))
    return both.groupBy(by).agg(F.count(F.lit(1)).alias("n"), (F.covar_pop("rx", "ry") / F.nullif(F.stddev_pop("rx") * F.stddev_pop("ry"), F.lit(0.0))).alias("spearman"))


def assembled(rows: DataFrame, columns: list[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid="skip").transform(rows)
