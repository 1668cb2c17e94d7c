"""The query shapes the evaluation statements are made of, as DataFrame functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A number as text: digits with an optional decimal part.
NUMBER_PATTERN = r"^[0-9]+(\.[0-9]+)?$"


def count_rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def count_ones(df: DataFrame, name: str) -> DataFrame:
    """``SUM(1)``: like a count, but null on no rows."""
    return df.agg(F.sum(F.lit(1)).alias(name))


def count_distinct(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.countDistinct(column).alias(name))


def total(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.agg(F.sum(value).alias(name))


def average(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.agg(F.avg(value).alias(name))


def earliest(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.min(column).alias(name))


def highest(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.max(column).alias(name))


def averages_by(df: DataFrame, group: str, averages: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(group).agg(*[F.avg(v).alias(n) for n, v in averages.items()])


def total_of_number_text(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Sum of those texts that are numbers; the others are filtered out first."""
    numbers = df.filter(F.rlike(text, F.lit(NUMBER_PATTERN)))
    return numbers.agg(F.sum(text.try_cast("decimal(38,6)")).alias(name))
