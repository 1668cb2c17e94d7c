"""Registry of named queries and helpers to derive inputs from the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function ``(spark, folder) -> DataFrame`` under its own name."""

    def add(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(configure(spark), folder)

        run.__name__ = function.__name__
        run.__doc__ = function.__doc__
        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def message(role: Column | str, content: Column | str) -> Column:
    """One message struct; plain strings are constants."""
    role, content = (F.lit(x) if isinstance(x, str) else x for x in (role, content))
    return F.struct(role.alias("role"), content.alias("content"))
