"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset and all work is done on this machine, a temporary folder becomes it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Rows of one Arrow batch, where the session does not say: texts may be long, and a worker holds a batch as a whole.
BATCH_ROWS = 1000


def workers_find_library(spark: SparkSession) -> None:
    """Python workers import this library by name: the folder it lies in goes on their search path; their batches stay small."""
    if spark.sparkContext.getConf().get("spark.sql.execution.arrow.maxRecordsPerBatch") is None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(x for x in (root, known.get("PYTHONPATH")) if x)


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write df once as Parquet in the shared folder and return a scan of it.

    This cuts the lineage (a lost executor costs a reread, never a recomputation of the stages before) and gives the
    planner true sizes. The files stay until `dropped`, or until the folder is cleared, as checkpoints do.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    scan = spark.read.schema(df.schema).parquet(path)
    scan.settled_at = path
    return scan


def dropped(*tables: DataFrame) -> None:
    """Delete the files of settled tables that nothing reads any more."""
    for df in tables:
        spark, at = df.sparkSession, getattr(df, "settled_at", None)
        if at:
            path = spark._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: A table of integer keys up to this many rows (some 30 MB) may go to every executor.
MOST_KEYS = 1_000_000


def matching(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of df whose `on` is in keys, a settled table of that one integer column.

    A small key table is broadcast after it has been counted, so that df is not shuffled; a larger one is joined by a shuffle.
    """
    return df.join(F.broadcast(keys) if keys.count() <= MOST_KEYS else keys, on, "left_semi")


def row_key(text: str = "text") -> Column:
    """Two 64-bit hashes, equal for equal rows (doc_id, text) only; they stand for a row in joins, also where doc_id is null or repeated."""
    value = F.col(text).cast("string")
    return F.struct(F.xxhash64("doc_id", value, F.length(value)).alias("one"), F.xxhash64(value, F.lit(1), "doc_id").alias("two"))


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """Column names like these that docs does not have, whatever the case."""
    taken = {c.lower() for c in docs.columns}
    longest = max((len(c) for c in taken), default=0)
    return [n if n not in taken else n + "_" * (longest + 1) for n in names]
