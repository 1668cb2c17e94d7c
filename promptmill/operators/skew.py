"""Joins that stay even when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot from this share of all rows on, so there are never more hot keys than this number.
MAX_HOT_KEYS = 256
_SALT, _SALTS = "_lookup_salt", "_lookup_salts"


def hot_keys(left: DataFrame, keys: Sequence[str], parts: int) -> DataFrame | None:
    """Keys with at least 1/256 of the rows, each with its share of ``parts``, rounded up.

    The counts are pre-aggregated and read the key columns only.  At most 256 rows come to the
    driver, whatever the data; None if no key is hot.
    """
    n = F.count("*").alias("n")
    counts = left.select(*keys).na.drop(subset=list(keys)).groupBy(*keys).agg(n)
    total = left.count()
    hot = counts.filter(F.col("n") * MAX_HOT_KEYS >= total)
    salts = F.ceil(F.col("n") * parts / max(total, 1)).cast("int")
    rows = hot.select(*keys, salts.alias(_SALTS))
    found = rows.collect()
    return left.sparkSession.createDataFrame(found, rows.schema) if found else None


def join_lookup(left: DataFrame, lookup: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left join to a table that is unique on ``key`` (one column or several).

    Every key gets salts in proportion to its share of the rows: a key with a third of all rows is
    dealt over a third of the shuffle partitions, and its one lookup row goes to each of them.  Rows
    without a key match nothing and are dealt over all partitions.  The hot keys, at most 256, are
    found first by a pre-aggregated count; the join itself reads ``left`` once.  Salts follow the
    place of a row in its input split, so hand in a scan, a written table or something narrow
    above one: a task that runs again then deals its rows as before.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = [*left.columns, *[c for c in lookup.columns if c not in keys]]
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(left, keys, parts)
    place = F.monotonically_increasing_id()
    keyless = F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 1
    if hot is None:
        salted, spread = left.withColumn(_SALTS, F.lit(1)), lookup.withColumn(_SALT, F.lit(0))
    else:
        salted = left.join(F.broadcast(hot), keys, "left")
        spread = lookup.join(F.broadcast(hot), keys, "left")
        last = F.coalesce(F.col(_SALTS), F.lit(1)) - 1
        spread = spread.withColumn(_SALT, F.explode(F.sequence(F.lit(0), last))).drop(_SALTS)
    salts = F.when(keyless, F.lit(parts)).otherwise(F.coalesce(F.col(_SALTS), F.lit(1)))
    salted = salted.withColumn(_SALT, F.pmod(place, salts).cast("int")).drop(_SALTS)
    return salted.join(spread, [*keys, _SALT], "left").select(*columns)
