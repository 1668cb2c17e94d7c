"""What the jobs write: rendered lines, prompt logs, run logs, scores, counts, configuration."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import py_rstrip, safe_name
from ..session import materialize
from ..sources.records import PROVENANCE

RUN_LOG_COLUMNS = [
    "model_idx",
    "name",
    "item_id",
    "question",
    "prompt_text",
    "prediction",
    "expected",
    "exact",
]


LINES_PER_FILE = 1_000_000


def write_lines(df: DataFrame, text: Column, path: str, ordered: bool = False, lines_per_file: int = LINES_PER_FILE) -> None:
    """One text per line, trailing white space removed, replacing what is there.

    The output is a folder of part files.  With ``ordered`` they are, in name order, in input order,
    with ``lines_per_file`` lines each (the last one fewer).
    """
    line = py_rstrip(text).alias("value")
    if not ordered:
        df.select(line).write.mode("overwrite").text(path)
        return
    rows = materialize(df.select(*PROVENANCE, line), "unordered")
    files = max(1, -(-rows.count() // lines_per_file))
    place = numbered_in_input_order(rows)
    part = F.floor(F.col("index") / lines_per_file).cast("int")
    place.repartitionById(files, part).sortWithinPartitions("index").select("value").write.mode("overwrite").text(path)


def numbered_in_input_order(rows: DataFrame) -> DataFrame:
    """``rows`` with ``index``, their dense place (from 0) in input order.

    Rows are numbered within their input split; the counts of the splits, one small row each, are
    summed up in order.  Nothing is sampled or sorted as a whole.  ``rows`` is read twice: hand in a
    written table.
    """
    split = PROVENANCE[:3]
    counts = rows.groupBy(*split).agg(F.count("*").alias("_n"))
    before = f"sum(_n) over (order by {', '.join(split)} rows between unbounded preceding and 1 preceding)"
    starts = counts.select(*split, F.coalesce(F.expr(before), F.lit(0)).alias("_before"))
    in_split = F.expr(f"row_number() over (partition by {', '.join(split)} order by seq)")
    numbered = rows.withColumn("_place", in_split).join(starts, split)
    return numbered.select(*rows.columns, (F.col("_before") + F.col("_place") - 1).alias("index"))


def write_sorted_out(df: DataFrame, text: Column, valid: Column, path: str) -> None:
    """Texts that are valid and those that are not, in one pass, as folders ``status=good`` and
    ``status=bad`` of text lines, replacing what is there."""
    status = F.when(valid, F.lit("good")).otherwise(F.lit("bad")).alias("status")
    df.select(py_rstrip(text).alias("value"), status).write.mode("overwrite").partitionBy("status").text(path)


def write_prompt_log(df: DataFrame, prompt: str, path: str) -> None:
    """Every full prompt text with all its other columns (provenance, identity), before tokenising."""
    keys = [c for c in df.columns if c != prompt]
    df.select(*keys, F.col(prompt).alias("prompt_text")).write.mode("overwrite").parquet(path)


def write_run_log(rows: DataFrame, run_id: str, path: str) -> None:
    """Question, prompt, prediction and expectation of every item, a folder per run and model.

    The whole folder of the run is replaced, so a run that is repeated does not count twice, models
    that an earlier roster had are gone, and other runs stay.
    """
    named = rows.select(*RUN_LOG_COLUMNS, safe_name(F.col("name")).alias("model_safe"))
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("model_safe").parquet(f"{path.rstrip('/')}/run_id={quote(run_id, safe='')}")


def read_run_log(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """The rows of one run; other runs' folders are not read."""
    schema = (
        "model_idx int, name string, item_id string, question string, prompt_text string, "
        "prediction string, expected string, exact int, model_safe string, run_id string"
    )
    return spark.read.schema(schema).parquet(path).filter(F.col("run_id") == run_id)


def write_ingest(parsed: DataFrame, path: str) -> None:
    """Kept and rejected lines in one pass, as two folders ``status=kept`` and ``status=rejected``."""
    parsed.write.mode("overwrite").partitionBy("status").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_back(df: DataFrame, path: str) -> DataFrame:
    """What was just written from ``df``, with its schema; fails if the files lack a column of it.

    A reader that is given a schema fills columns the files do not have with nulls, so the files'
    own columns are looked at first (one footer).
    """
    spark = df.sparkSession
    found = set(spark.read.parquet(path).columns)
    if missing := [c for c in df.columns if c not in found]:
        raise ValueError(f"{path} lacks the columns {missing}")
    return spark.read.schema(df.schema).parquet(path)


def write_config(spark: SparkSession, config: Mapping[str, Any], path: str) -> None:
    """Keep the configuration of a run next to its output, as one JSON line."""
    row = spark.createDataFrame([(json.dumps(config, default=str),)], "value string")
    row.write.mode("overwrite").text(path)
