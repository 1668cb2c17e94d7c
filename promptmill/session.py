"""Session settings the package relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings that change results (not just speed).
RESULT_CONF = {
    # The last of two equal keys wins, as in most JSON parsers.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Names the shared folder of a local session without spark.checkpoint.dir.
SCRATCH_KEY = "spark.promptmill.scratch.dir"

# Settings that matter for speed at scale.  They are read at session start or per query.
SPEED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the result-relevant settings to an existing session and return it.

    A local session that names no shared folder gets one: on one machine any folder is shared.
    """
    for key, value in RESULT_CONF.items():
        spark.conf.set(key, value)
    local = spark.sparkContext.master.split("[")[0] == "local"
    if local and not _named_folder(spark):
        spark.conf.set(SCRATCH_KEY, _local_folder())
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("promptmill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SPEED_CONF, **RESULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _named_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_KEY, None)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it."""
    if not (named := _named_folder(spark)):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="promptmill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    The result has a file scan as its whole lineage, so costly steps above it (generation,
    tokenising) are never run twice, whatever executors are lost later.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

