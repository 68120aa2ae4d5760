"""Three-class boosting for each walk-forward window, on scaled features and what clusters say about a row.

Everything is fitted on a window's training rows: medians, scales, principal components, clusters (of all rows, or of each
group by itself) and one boosted ensemble for each class against the others. Windows are a handful of calendar periods;
a few of them are fitted at a time, and Spark does each fit and each pass over the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, OneVsRestModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..sources.archives import scratch
from ..sources.shared import settled
from . import windows as W

DOWN, NEUTRAL, UP = 0, 1, 2
#: Windows that are fitted at a time, and training rows that one task holds: levels of trees are many small jobs.
AT_ONCE, TASK_ROWS = 4, 20_000


@dataclass(frozen=True)
class Clusters:
    """How the rows of one group are clustered."""

    k: int = 8
    components: int = 10


@dataclass(frozen=True)
class Settings:
    rounds: int = 200
    depth: int = 5
    rate: float = 0.05
    #: One entry for each group number; a single entry clusters all rows together.
    clusters: list[Clusters] = field(default_factory=lambda: [Clusters()])
    #: Groups with fewer training rows have the one cluster 0.
    least_rows: int = 0
    seed: int = 42


def group_of(name: Column, groups: list[str]) -> Column:
    """Number of the first group whose name the text begins with; 0 for all others and for null."""
    out = F.lit(0)
    for i in range(len(groups) - 1, -1, -1):
        out = F.when(name.startswith(groups[i]), i).otherwise(out)
    return out


def label(up: Column, down: Column, threshold: float = 0.0) -> Column:
    """UP where the gain upwards is over the threshold, DOWN where the one downwards is under -threshold; the larger move where both are."""
    rises, falls = F.coalesce(up > threshold, F.lit(False)), F.coalesce(down < -threshold, F.lit(False))
    return F.when(rises & falls, F.when(F.abs(up) >= F.abs(down), UP).otherwise(DOWN)).when(rises, UP).when(falls, DOWN).otherwise(NEUTRAL)


def _doubles(rows: DataFrame, names: list[str]) -> DataFrame:
    """The features as doubles, NaN in place of what is missing or infinite, as the imputer wants them."""
    return rows.withColumns({f"__d_{c}": F.coalesce(W.finite(F.col(c).cast("double")), F.lit(float("nan"))) for c in names})


@dataclass(frozen=True)
class WindowModel:
    """What one window has learned: scaling, the clusters of each group (None: the one cluster 0) and the classes (None: all is neutral)."""

    features: list[str]
    scaling: PipelineModel
    clusters: list[PipelineModel | None]
    classes: OneVsRestModel | None

    def scaled(self, rows: DataFrame) -> DataFrame:
        """rows with scaled: training medians in place of what is missing, centred and scaled as in training."""
        return self.scaling.transform(_doubles(rows, self.features))

    def augmented(self, rows: DataFrame) -> DataFrame:
        """scaled rows with cluster, regime (group and cluster in one code) and the classes' input; groups without an entry have cluster 0."""
        alone = len(self.clusters) == 1
        parts = [] if alone else [rows.where(~F.coalesce(F.col("group") < len(self.clusters), F.lit(False))).withColumn("cluster", F.lit(0))]
        for g, own in enumerate(self.clusters):
            mine = rows if alone else rows.where(F.col("group") == g)
            parts.append(own.transform(mine).drop("__components") if own else mine.withColumn("cluster", F.lit(0)))
        out = reduce(DataFrame.unionByName, parts).withColumn("cluster", F.col("cluster").cast("int")).withColumn("regime", F.col("group") * 1000 + F.col("cluster"))
        return VectorAssembler(inputCols=["scaled", "cluster"] if alone else ["scaled", "cluster", "group"], outputCol="augmented").transform(out)

    def predict(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """keep, group, cluster, regime, predicted, p_down, p_neutral, p_up. rows: features and group."""
        asked = self.augmented(self.scaled(rows).select(*keep, "group", "scaled"))
        shown = [*keep, "group", "cluster", "regime"]
        if self.classes is None:
            return asked.select(*shown, F.lit(NEUTRAL).alias("predicted"), F.lit(0.0).alias("p_down"), F.lit(1.0).alias("p_neutral"), F.lit(0.0).alias("p_up"))
        # A margin of an ensemble is half its log odds.
        scored = self.classes.transform(asked).withColumn("__o", F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m))))
        p = F.transform("__o", lambda x: x / F.aggregate("__o", F.lit(0.0), lambda s, y: s + y))
        best = F.when((p[0] >= p[1]) & (p[0] >= p[2]), DOWN).when(p[1] >= p[2], NEUTRAL).otherwise(UP)
        return scored.select(*shown, best.alias("predicted"), p[0].alias("p_down"), p[1].alias("p_neutral"), p[2].alias("p_up"))

    def save(self, folder: str) -> None:
        """Into a new folder of the shared store."""
        spark = SparkSession.active()
        self.scaling.save(f"{folder}/scaling")
        for g, own in enumerate(self.clusters):
            if own:
                own.save(f"{folder}/clusters-{g}")
        if self.classes:
            self.classes.save(f"{folder}/classes")
        parts = [(self.features, [own is not None for own in self.clusters], self.classes is not None)]
        spark.createDataFrame(parts, "features array<string>, clusters array<boolean>, classes boolean").coalesce(1).write.json(f"{folder}/parts")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> WindowModel:
        parts = spark.read.schema("features array<string>, clusters array<boolean>, classes boolean").json(f"{folder}/parts").first()
        clusters = [PipelineModel.load(f"{folder}/clusters-{g}") if there else None for g, there in enumerate(parts["clusters"])]
        return WindowModel(list(parts["features"]), PipelineModel.load(f"{folder}/scaling"), clusters, OneVsRestModel.load(f"{folder}/classes") if parts["classes"] else None)


def numeric_features(frame: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """The numeric columns of a table that are not excluded (keys, times, targets), in its order."""
    return [f.name for f in frame.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def learn(train: DataFrame, features: list[str], settings: Settings) -> WindowModel:
    """A window's model from its training rows (features, label, group) alone. A feature that no row has is left out."""
    there = train.agg(*[F.count(W.finite(F.col(c).cast("double"))).alias(c) for c in features]).first()
    known = [c for c in features if there[c]]
    rows = _doubles(train, known)
    filled = [f"__f_{c}" for c in known]
    imputer = Imputer(strategy="median", inputCols=[f"__d_{c}" for c in known], outputCols=filled, relativeError=1e-4).fit(rows)
    assembler = VectorAssembler(inputCols=filled, outputCol="__raw")
    scaler = StandardScaler(inputCol="__raw", outputCol="scaled", withMean=True).fit(assembler.transform(imputer.transform(rows)))
    scaling = PipelineModel([imputer, assembler, scaler])
    scaled = settled(scaling.transform(rows).select("label", "group", "scaled"), "window-train")

    alone, clusters = len(settings.clusters) == 1, []
    sizes = {r["group"]: r["count"] for r in scaled.groupBy("group").count().collect()}  # a row for each group
    for g, own in enumerate(settings.clusters):
        mine = scaled if alone else scaled.where(F.col("group") == g)
        n = sum(sizes.values()) if alone else sizes.get(g, 0)
        if n < max(settings.least_rows, 2):
            clusters.append(None)
            continue
        pca = PCA(k=max(1, min(own.components, len(known), n - 1)), inputCol="scaled", outputCol="__components").fit(mine)
        means = KMeans(k=max(2, min(own.k, n)), seed=settings.seed, featuresCol="__components", predictionCol="cluster").fit(pca.transform(mine))
        clusters.append(PipelineModel([pca, means]))
    model = WindowModel(known, scaling, clusters, None)
    counts = {r["label"]: r["count"] for r in scaled.groupBy("label").count().collect()}
    if len(counts) < 3:
        return model
    # One boosted ensemble for each class; classes weigh alike.
    weight = F.coalesce(*[F.when(F.col("label") == c, sum(counts.values()) / (len(counts) * n)) for c, n in counts.items()])
    learned = model.augmented(scaled).select("augmented", F.col("label").cast("double").alias("label"), weight.alias("weight")).coalesce(-(-sum(counts.values()) // TASK_ROWS)).persist()
    if not train.sparkSession.sparkContext.getCheckpointDir():  # else the errors of a round hang on those of all rounds before
        train.sparkSession.sparkContext.setCheckpointDir(scratch(train.sparkSession, "boosting"))
    tree = GBTClassifier(featuresCol="augmented", maxIter=settings.rounds, maxDepth=settings.depth, stepSize=settings.rate, seed=settings.seed)
    try:
        return replace(model, classes=OneVsRest(classifier=tree, featuresCol="augmented", weightCol="weight", parallelism=3).fit(learned))
    finally:
        learned.unpersist()


def window_predictions(train: DataFrame, test: DataFrame, features: list[str], keep: list[str], settings: Settings) -> DataFrame:
    """What the model of train says of the test rows: keep, label and WindowModel.predict. Both frames: features, label, group."""
    return learn(train, features, settings).predict(test, [*keep, "label"])


def walk(dealt: DataFrame, features: list[str], keep: list[str], settings: Settings | None = None, models: str | None = None) -> DataFrame:
    """window_predictions of all windows (window, test), each written once it is there; models: a folder that keeps each window's model as window=<w>.

    dealt: window, test, features, label and group for each row and window. A window's test rows meet finished models only.
    """
    settings = settings or Settings()
    # Every fit reads its rows several times: what they are made of is not read again for each.
    dealt = settled(dealt, "dealt")

    def one(window) -> DataFrame | None:
        rows = dealt.where(F.col("window") == window)
        train = rows.where("not test")
        if train.isEmpty():
            return None
        model = learn(train, features, settings)
        if models:
            model.save(f"{models}/window={window}")
        found = model.predict(rows.where("test"), [*keep, "label"]).withColumn("window", F.lit(window))
        return settled(found, "window-predictions")

    windows = [r["window"] for r in dealt.select("window").where("test").distinct().orderBy("window").collect()]  # calendar periods
    with ThreadPool(AT_ONCE) as pool:
        out = [found for found in pool.map(inheritable_thread_target(dealt.sparkSession)(one), windows, 1) if found is not None]
    if not out:
        raise ValueError("no window has training and test rows")
    return reduce(DataFrame.unionByName, out)


def summary(predictions: DataFrame, up: str, down: str, per_year: float, by: str = "window") -> DataFrame:
    """For each window rows, labels, hits, and mean over deviation (scaled by per_year) of what longs, shorts, both, and holding all rows gain."""
    long, short = F.when(F.col("predicted") == UP, F.col(up)), F.when(F.col("predicted") == DOWN, -F.col(down))
    sharpe = lambda x: F.coalesce(F.when(F.count(x) >= 2, W.ratio(F.avg(x), F.stddev_pop(x)) * per_year), F.lit(0.0))
    return predictions.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col("label") == c, 1)).alias(name) for c, name in ((DOWN, "n_down"), (NEUTRAL, "n_neutral"), (UP, "n_up"))], F.count(F.when(F.col("label") == F.col("predicted"), 1)).alias("hits"),
        sharpe(long).alias("sharpe_long"), sharpe(short).alias("sharpe_short"), sharpe(F.coalesce(long, short)).alias("sharpe_both"), sharpe(F.col(up)).alias("sharpe_all_long"), sharpe(-F.col(down)).alias("sharpe_all_short"),
    )


def save_run(predictions: DataFrame, sums: DataFrame, folder: str, by: str = "window") -> None:
    """A run's tables: predictions in a folder for each window, the summary as one CSV file with a header."""
    predictions.repartition(by).write.partitionBy(by).option("compression", "zstd").parquet(f"{folder}/predictions")
    sums.orderBy(by).coalesce(1).write.option("header", True).csv(f"{folder}/summary")  # a row for each window
