"""Registry of the queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function ``(spark, folder) -> DataFrame`` under its own name."""

    def add(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(configure(spark), folder)

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
