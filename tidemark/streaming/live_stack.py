"""Decisions on a stream of bars by a table of rules that may change while the stream runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Decide = Callable[[DataFrame, DataFrame], DataFrame]


def modified(spark: SparkSession, path: str) -> int:
    """When a file last changed, or the latest change of the files in a folder; raises if it is not there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    status = fs.getFileStatus(at)
    times = [status.getModificationTime()]
    if status.isDirectory():
        times += [s.getModificationTime() for s in fs.listStatus(at)]
    return max(times)


class Stack:
    """The rules in a CSV file with a header, read again when the file has changed.

    Rows whose name begins with two underscores are comments. A file that is broken or half written fails the batch, which is then run
    again, rather than have a batch decided by rules nobody can see.
    """

    def __init__(self, path: str, schema: str, name: str = "regime"):
        self.path, self.schema, self.name = path, schema, name
        self.version: int | None = None
        self.rows: list = []

    def current(self, spark: SparkSession) -> DataFrame:
        now = modified(spark, self.path)
        if now != self.version:
            read = spark.read.schema(self.schema).option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).csv(self.path)
            self.rows = read.where(~F.coalesce(F.col(self.name).startswith("__"), F.lit(False))).collect()  # rules, a few hundred rows
            self.version = now
        return spark.createDataFrame(self.rows, self.schema).withColumn("stack_version", F.lit(self.version))


def decided_batches(bars: DataFrame, stack: Stack, decide: Decide, sink: str, checkpoint: str, **trigger):
    """Each micro-batch is decided by the rules as they are when it begins, and written to a folder of its own, which a rerun replaces.

    decide gets the batch and the rules (with stack_version, which it may pass on).
    """

    def write(batch: DataFrame, number: int) -> None:
        decide(batch, stack.current(batch.sparkSession)).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return bars.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
