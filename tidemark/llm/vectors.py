"""Vectors of an array column, batch by batch in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_doubles(rows: DataFrame, vector: str, *others: str) -> DataFrame:
    """others and, last, the vector as doubles under a name of its own; any further columns go."""
    return rows.select(*others, F.col(vector).cast("array<double>").alias("__vector"))


def whole_vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a vector of finite numbers only (bool), and these vectors; shorter ones are filled up with zeros."""
    lists = batch.column(batch.num_columns - 1)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    row_of = np.repeat(np.arange(len(lengths)), lengths)
    good = pc.is_valid(lists).to_numpy(zero_copy_only=False).copy()
    good[row_of[~np.isfinite(values)]] = False
    width = int(lengths[good].max(initial=0))
    out, at = np.zeros((len(lengths), width)), good[row_of]
    out[row_of[at], (np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths))[at]] = values[at]
    return good, out[good]
