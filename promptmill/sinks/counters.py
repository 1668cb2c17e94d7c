"""Counts of what is written, taken while it is written."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def observed(df: DataFrame, **conditions: Column) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df``, and how many of its rows meet each condition, known once it has been written.

    Counting is part of the one pass that writes.  A frame that is run twice reports the first run.
    """
    seen = Observation()
    counts = [F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("long")), F.lit(0)).alias(n) for n, c in conditions.items()]
    return df.observe(seen, *counts), lambda: {n: int(seen.get[n]) for n in conditions}


def write_counts(spark: SparkSession, counts: Mapping[str, int], path: str) -> None:
    """Rows ``what, n``, replacing what is there."""
    rows = spark.createDataFrame([(k, v) for k, v in counts.items()], "what string, n long")
    rows.coalesce(1).write.mode("overwrite").json(path)
