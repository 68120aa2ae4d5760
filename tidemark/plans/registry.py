"""The queries over the driver tables, and the SQL that each must agree with. The modules of this folder fill both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
HOUR = 3600


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return keep


def rounded(df: DataFrame, columns: str, digits: int = 6) -> list:
    return [(F.round(c, digits) + 0.0).alias(c) for c in columns.split()]  # no negative zeros
