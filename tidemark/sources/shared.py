"""Intermediate tables that are written once, so that what reads them several times neither recomputes them nor hangs on lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .archives import scratch


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and return a scan of it."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
