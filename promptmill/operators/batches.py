"""Which row goes into which batch, step and epoch."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the order hash that name a bucket: 4 digits are 65,536 buckets.
BUCKET_DIGITS = 4
# Tokens of a shard, and the number of shards from which on they get larger instead of more.
SHARD_TOKENS = 1 << 20
MOST_SHARDS = 200_000


def _order_hash(seed: int, key: Sequence[str]) -> Column:
    """The seeded place of a row in its epoch: depends on nothing but the row."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch"), *[F.col(k) for k in key]).cast("binary"))


def batch_layout(
    rows: DataFrame,
    key: Sequence[str],
    length: str,
    batch_size: int,
    accumulation_steps: int = 1,
    epochs: int = 1,
    seed: int = 42,
    bucket_digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Shuffle rows anew for every epoch and cut them into batches.

    ``key`` must be unique.  Returns only ``key`` plus ``epoch, row_index, batch_id, step_id,
    batch_length``; join it to the wide rows with :func:`with_layout`.

    The order is that of ``md5(seed|epoch|key)``.  A dense index over it needs no global window:
    the first digits of the hash split each epoch into even buckets, rows are numbered within
    their bucket, and the sizes of the buckets, at most ``16**bucket_digits`` numbers per epoch,
    are summed up.  The hash depends on nothing but the row, so a task that runs again gives the
    same result.
    """
    hashed = (
        rows.select(*key, F.col(length).alias("_length"))
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("_order", _order_hash(seed, key))
        .withColumn("_bucket", F.substring("_order", 1, bucket_digits))
    )
    before = "(partition by epoch order by _bucket rows between unbounded preceding and 1 preceding)"
    starts = (
        hashed.groupBy("epoch", "_bucket")
        .agg(F.count("*").alias("_n"))
        .select("epoch", "_bucket", F.expr(f"coalesce(sum(_n) over {before}, 0)").alias("_start"))
    )
    in_bucket = f"(partition by epoch, _bucket order by _order, {', '.join(key)})"
    return (
        hashed.withColumn("_place", F.expr(f"row_number() over {in_bucket}"))
        .join(F.broadcast(starts), ["epoch", "_bucket"])
        .withColumn("row_index", F.col("_start") + F.col("_place") - 1)
        .withColumn("batch_id", F.floor(F.col("row_index") / batch_size))
        .withColumn("step_id", F.floor(F.col("batch_id") / accumulation_steps))
        .withColumn("batch_length", F.expr("max(_length) over (partition by epoch, batch_id)"))
        .select(*key, "epoch", "row_index", "batch_id", "step_id", "batch_length")
    )


def with_layout(tokens: DataFrame, layout: DataFrame, key: Sequence[str]) -> DataFrame:
    """Bring the layout to the token rows: the one shuffle of the wide rows, on a unique key."""
    return tokens.join(layout, list(key))


def _cuts(buckets: pd.DataFrame, weight: int, step_rows: int) -> np.ndarray:
    """Row indices at which shards after the first begin, for the buckets of one epoch in order.

    A shard ends where the tokens before it pass a multiple of its weight: rows of a bucket are in
    random order, so its tokens are taken as evenly spread.  Cuts are put between whole steps.
    """
    n, tokens = buckets["n"].to_numpy(), buckets["tokens"].to_numpy()
    after = np.cumsum(tokens)
    passed = np.arange(weight, after[-1] + 1, weight)
    at = np.searchsorted(after, passed)
    share = (passed - (after - tokens)[at]) / np.maximum(tokens[at], 1)
    rows = ((np.cumsum(n) - n)[at] + np.floor(share * n[at])).astype(np.int64) // step_rows * step_rows
    return np.unique(rows[(rows > 0) & (rows < n.sum())])


def _shard_places(hashed: DataFrame, key: Sequence[str], step_rows: int, shard_tokens: int) -> tuple[DataFrame, int]:
    """For every bucket of the order hash, which shards its rows are in; and the number of shards.

    Rows epoch, _bucket, first (shard at the bucket's beginning), first_row (row index where that
    shard begins) and cuts (the shards that begin inside the bucket: hash of the first row, its index).
    The driver sees 65,536 rows an epoch and a row a shard at most, whatever the input.
    """
    spark = hashed.sparkSession
    buckets = hashed.groupBy("epoch", "_bucket").agg(F.count("*").alias("n"), F.sum("_length").alias("tokens")).toPandas()
    buckets = buckets.sort_values(["epoch", "_bucket"], ignore_index=True)
    weight = max(shard_tokens, -(-int(buckets["tokens"].sum()) // MOST_SHARDS), 1)
    places, inside, shards = [], [], 0
    for epoch, some in buckets.groupby("epoch", sort=True):
        cuts = _cuts(some, weight, step_rows)
        begin = np.cumsum(some["n"].to_numpy()) - some["n"].to_numpy()
        first = np.searchsorted(cuts, begin, "right")
        first_row = np.concatenate([[0], cuts])[first]
        places += zip([int(epoch)] * len(some), some["_bucket"], first.tolist(), first_row.tolist())
        of_cut = np.searchsorted(begin, cuts, "right") - 1
        place = cuts - begin[of_cut]
        names = some["_bucket"].to_numpy()[of_cut]
        inside += [(int(epoch), b, p + 1, r) for b, p, r in zip(names.tolist(), place.tolist(), cuts.tolist()) if p]
        shards += len(cuts) + 1
    lists: dict[tuple, list] = {}
    if inside:
        # Only rows of buckets with a cut inside are numbered.
        wanted = spark.createDataFrame(inside, "epoch int, _bucket string, _place long, row long")
        some = hashed.join(F.broadcast(wanted.select("epoch", "_bucket").distinct()), ["epoch", "_bucket"], "left_semi")
        in_bucket = Window.partitionBy("epoch", "_bucket").orderBy("_order", *key)
        numbered = some.select("epoch", "_bucket", "_order", F.row_number().over(in_bucket).cast("long").alias("_place"))
        found = numbered.join(F.broadcast(wanted), ["epoch", "_bucket", "_place"])
        for r in found.select("epoch", "_bucket", "_order", "row").collect():
            lists.setdefault((r[0], r[1]), []).append((r[2], r[3]))
    rows = [(*p, sorted(lists.get(p[:2], []))) for p in places]
    schema = "epoch int, _bucket string, first long, first_row long, cuts array<struct<_order:string,row:bigint>>"
    return spark.createDataFrame(rows, schema), shards


def sharded_batches(
    tokens: DataFrame,
    key: Sequence[str],
    length: Column,
    batch_size: int,
    accumulation_steps: int = 1,
    epochs: int = 1,
    seed: int = 42,
    devices: int = 1,
    shard_tokens: int = SHARD_TOKENS,
    bucket_digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """The order of :func:`batch_layout` on the wide rows themselves, which are shuffled once.

    Adds ``epoch, shard, row_index, batch_id, step_id, device, batch_length``.  Each shard is in one
    partition, in order, of about ``shard_tokens`` tokens (more only beyond ``MOST_SHARDS`` shards),
    and holds whole steps.  A step is one batch on each device, ``accumulation_steps`` times.

    Where shards are cut is found on key and length alone: token counts of the buckets of the order
    hash are summed up, and only in buckets with a cut rows are numbered.  The result, at most 65,536
    rows an epoch and a pair of values a shard, goes to every task, which then knows the shard of
    any row by itself.  ``key`` must be unique.
    """
    step_rows = batch_size * accumulation_steps * devices

    def hashed(rows: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))
        rows = rows.withColumn("epoch", every).withColumn("_order", _order_hash(seed, key))
        return rows.withColumn("_bucket", F.substring("_order", 1, bucket_digits))

    rows = tokens.withColumn("_length", length)
    places, shards = _shard_places(hashed(rows.select(*key, "_length")), key, step_rows, shard_tokens)
    begun = F.filter("cuts", lambda c: c["_order"] <= F.col("_order"))
    wide = (
        hashed(rows)
        .join(F.broadcast(places), ["epoch", "_bucket"])
        .withColumn("_begun", begun)
        .withColumn("shard", (F.col("first") + F.size("_begun")).cast("long"))
        .withColumn("_row", F.coalesce(F.try_element_at(F.col("_begun")["row"], F.lit(-1)), F.col("first_row")))
        .drop("cuts", "_begun", "first", "first_row", "_bucket")
        .repartition(max(shards, 1), "epoch", "shard")
    )
    in_shard = Window.partitionBy("epoch", "shard").orderBy("_order", *key)
    wide = wide.withColumn("row_index", F.col("_row") + F.row_number().over(in_shard) - 1)
    wide = wide.withColumn("batch_id", F.floor(F.col("row_index") / batch_size))
    longest = F.max("_length").over(Window.partitionBy("epoch", "shard", "batch_id"))
    return (
        wide.withColumn("batch_length", longest)
        .withColumn("step_id", F.floor(F.col("row_index") / step_rows))
        .withColumn("device", F.pmod(F.col("batch_id"), F.lit(devices)).cast("int"))
        .drop("_length", "_order", "_row")
        .sortWithinPartitions("epoch", "shard", "row_index")
    )
