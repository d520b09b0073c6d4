"""Where the query modules put what they define."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, day: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a key, with the SQL that must give the same rows.

    ``day`` names a date column; both sides show it as text, because clients
    of the two engines read dates into different types.
    """

    def add(query: Query) -> Query:
        def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
            rows = query(spark, sf_dir)
            return rows if day is None else rows.withColumn(day, F.col(day).cast("string"))

        QUERIES[name] = shown
        if sql is not None:
            ORACLES[name] = sql if day is None else f"SELECT * REPLACE (CAST({day} AS VARCHAR) AS {day}) FROM ({sql}) AS shown"
        return query

    return add
