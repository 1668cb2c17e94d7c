"""Groups of linked items: within a task (numpy) and over a whole edge table (Spark)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Items of one key compared in one task.  Larger groups are split into blocks of this size, and
#: every pair of blocks becomes a task group of its own.
BLOCK_ITEMS = 4096


def in_cells(items: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """``items`` for comparing all items of equal ``keys``: columns ``block`` and ``cell`` added.

    A key with up to ``BLOCK_ITEMS`` items is one cell.  A larger one is dealt to n blocks by a hash
    of ``spread``, and each item goes to the n cells of its block with every block, so that each
    pair of items meets in a cell and no cell outgrows two blocks.  Counting is pre-aggregated; only
    the large keys are looked up, and the adaptive join splits a hot one.
    """
    counts = items.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > BLOCK_ITEMS)
    blocks = counts.select(*keys, F.ceil(F.col("_n") / BLOCK_ITEMS).alias("_blocks"))
    others = F.sequence(F.lit(0), F.col("_blocks") - 1)
    cell = F.least("block", "_other") * F.col("_blocks") + F.greatest("block", "_other")
    return (
        items.join(blocks, keys, "left")
        .withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64(spread), F.col("_blocks")))
        .select("*", F.explode(others).alias("_other"))
        .withColumn("cell", cell)
        .drop("_blocks", "_other")
    )


def stars(count: int, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the items 0..count-1 into the groups that ``near`` makes.

    ``near(i, others)`` says which of ``others`` are linked with i.  Items already reached are never
    compared again, so a group of close copies costs about one pass.
    """
    left = np.arange(count)
    centre = left.copy()
    while len(left) > 1:
        seed, left = int(left[0]), left[1:]
        waiting = [seed]
        while waiting and len(left):
            found = near(waiting.pop(), left)
            if found.any():
                reached = left[found]
                centre[reached] = seed
                waiting += reached.tolist()
                left = left[~found]
    linked = np.flatnonzero(centre != np.arange(count))
    return centre[linked], linked


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows node, component (smallest node reachable) for all nodes of ``edges``.

    Alternates two steps until nothing changes: every node's larger neighbours are linked to its
    smallest neighbour, then every node's smaller neighbours are.  The number of rounds grows with
    the logarithm of the longest path.  Each round is written to the shared folder.
    """
    spark = edges.sparkSession
    now = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges"
    )
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(smallest, "u")
        # A node's own row gives (node, m); its other smaller neighbours are linked to m.
        small = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        keep = joined.select("u", F.col("m").alias("v"))
        now = materialize(small.unionByName(keep).filter("u <> v").distinct(), "edges")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.join(now.select(F.col("u").alias("node")), "node", "left_anti").withColumn("component", F.col("node"))
    )
