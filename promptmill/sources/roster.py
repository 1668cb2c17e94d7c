"""The model roster as a small table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import ModelSpec

ROSTER_TYPE = "model_idx int, name string, base_model_path string, adapters array<string>"


def _rows(models: Sequence[ModelSpec]) -> list[tuple]:
    return [(i, m.display_name, m.base_model_path, list(m.adapters)) for i, m in enumerate(models)]


def roster_table(spark: SparkSession, models: Sequence[ModelSpec]) -> DataFrame:
    """One row per model; ``model_idx`` keeps models with equal names apart and in order."""
    return spark.createDataFrame(_rows(models), ROSTER_TYPE)


def roster_column(models: Sequence[ModelSpec]) -> Column:
    """The roster as one constant array, to be exploded next to the items."""
    return F.array(
        *[
            F.struct(F.lit(i).alias("model_idx"), F.lit(m.display_name).alias("name"))
            for i, m in enumerate(models)
        ]
    )
