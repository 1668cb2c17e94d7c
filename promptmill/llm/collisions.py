"""Nearest vectors by largest inner product through collision counting on single projections.

The search for the largest inner product is turned into one for the smallest distance: vectors are
scaled by the largest norm and get one more component that fills their length up to one; queries are
scaled to length one and get a zero there.  Then distance^2 = 2 - 2 * product / (norms).

The index deals the vectors to shards by a hash.  A shard keeps, for each of ``PROJECTIONS`` random
directions, its vectors sorted by their single projection on it.  Around a query's own projection
lies a window of half width ``WIDTH`` times a radius in each sorted array.  The radius grows by a
constant factor from round to round (virtual rehashing: windows only widen, nothing is rehashed).
A vector inside the window of a direction collides with the query there; one that collides in at
least ``threshold`` directions is verified by its exact product.  A vector within the radius reaches
the threshold with a chance of at least ``RECALL``, so a query ends when its ``k``-th verified vector
lies within the radius (or all vectors are verified).  Shards' best are merged by rank.

Vectors are dealt once, each to one shard; queries go to every shard.  A task gets the vectors of a
shard, sorts their projections once, and then searches for its queries as they stream by: it holds a
shard and one batch of queries.  The work is queries times vectors, which is what the stated query set
asks for.

Defined cases: vectors that are null, zero or hold null or non-finite components take no part, as
queries or candidates; so does a row of null id; vectors of another length than the query's are no
candidates; repeated rows of one id are one candidate each, and no candidate of a query of that id; of
several query rows of one id the smallest vector asks;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import runs
from .vectors import matrix, usable

PROJECTIONS = 16
WIDTH = 1.5
RECALL = 0.92
FIRST_RADIUS, GROWTH = 0.2, 1.2
SHARD_VECTORS = 12_000
SEED = 17


def threshold(projections: int = PROJECTIONS, width: float = WIDTH, recall: float = RECALL) -> int:
    """Most collisions that a vector at the radius reaches with a chance of at least ``recall``."""
    p = erf(width / sqrt(2))
    tail = 0.0
    for count in range(projections, -1, -1):
        tail += comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if tail >= recall:
            return count
    return 0


@lru_cache(maxsize=4)
def _directions(dimensions: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((PROJECTIONS, dimensions))


class Shard:
    """Sorted projections of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float):
        self.ids, self.vectors, self.largest = ids, vectors, largest
        scaled = vectors / largest
        fill = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", scaled, scaled)))
        directions = _directions(vectors.shape[1] + 1)
        projected = directions @ np.column_stack([scaled, fill]).T
        self.order = np.argsort(projected, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(projected, self.order, axis=1)
        self.directions = directions[:, :-1]

    def search(self, query_id: int, query: np.ndarray, k: int, need: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and products of the ``k`` best vectors found, best first, ties to smaller ids."""
        n = len(self.ids)
        length = np.sqrt(query @ query)
        centre = self.directions @ (query / length)
        counts = np.zeros(n, np.int64)
        fresh = self.ids != query_id
        total = int(fresh.sum())
        low = high = None
        positions, products = [np.empty(0, np.int64)], [np.empty(0)]
        radius, verified = FIRST_RADIUS, 0
        while verified < total:
            begin = [int(np.searchsorted(v, c - WIDTH * radius, "left")) for v, c in zip(self.values, centre)]
            end = [int(np.searchsorted(v, c + WIDTH * radius, "right")) for v, c in zip(self.values, centre)]
            if low is None:
                parts = [o[b:e] for o, b, e in zip(self.order, begin, end)]
            else:
                parts = [o[b:e] for o, b, e in zip(self.order, begin, low)]
                parts += [o[b:e] for o, b, e in zip(self.order, high, end)]
            low, high = begin, end
            counts += np.bincount(np.concatenate(parts), minlength=n)
            found = np.flatnonzero(fresh & (counts >= need))
            if len(found):
                fresh[found] = False
                verified += len(found)
                positions.append(found)
                products.append(self.vectors[found] @ query)
                if verified >= k:
                    best = np.concatenate(products)
                    kth = np.partition(best, len(best) - k)[len(best) - k]
                    if 2 - 2 * kth / (length * self.largest) <= radius * radius:
                        break
            if radius > 2:  # nothing is farther apart than 2
                rest = np.flatnonzero(fresh)
                positions.append(rest)
                products.append(self.vectors[rest] @ query)
                break
            radius *= GROWTH
        at, product = np.concatenate(positions), np.concatenate(products)
        best = np.lexsort((self.ids[at], -product))[:k]
        return at[best], product[best]


def _search(batches: Iterator[pa.RecordBatch], largest: float, k: int) -> Iterator[pa.RecordBatch]:
    """Best vectors of each query in each shard; a shard's vectors come before its queries."""
    need = threshold()
    ids: list[pa.Array] = []
    vectors: list[np.ndarray] = []
    shard: Shard | None = None
    for is_new, run in runs(batches):
        if is_new:
            ids, vectors, shard = [], [], None
        asked = run.column(1).to_numpy(zero_copy_only=False)
        of_index = run.filter(pa.array(~asked))
        if len(of_index):
            ids.append(of_index.column(2).to_numpy())
            vectors.append(matrix(of_index.column(3)))
        queries = run.filter(pa.array(asked))
        if not len(queries) or not ids:
            continue
        if shard is None:
            shard = Shard(np.concatenate(ids), np.concatenate(vectors), largest)
            ids, vectors = ids[:1], []
        found = [[], [], []]
        for query_id, query in zip(queries.column(2).to_pylist(), matrix(queries.column(3))):
            at, score = shard.search(query_id, query, k, need)
            for column, part in zip(found, (np.full(len(at), query_id), shard.ids[at], score)):
                column.append(part)
        columns = [pa.array(np.concatenate(column)) for column in found]
        yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])


def nearest(rows: DataFrame, is_query: Column, k: int = 20, shard_vectors: int = SHARD_VECTORS) -> DataFrame:
    """Rows query_id, rank, vec_id, score for the rows of ``rows`` (vec_id, embedding) that are queries."""
    good = rows.filter(usable("embedding") & F.col("vec_id").isNotNull()).withColumn("_query", F.coalesce(is_query, F.lit(False)))
    good = good.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), "_query")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    facts = good.agg(F.count("*"), F.max(norm)).first()
    shards = max(1, -(-facts[0] // shard_vectors))
    largest = float(facts[1] or 1.0) * (1 + 1e-12)

    # Rows are dealt by their place in the scan, so repeated rows spread too.  The key is text: of one
    # type for vectors and queries, and vectors of different lengths never meet.
    def key(shard: Column) -> Column:
        return F.concat_ws(":", F.size("vector"), shard).alias("key")

    place = F.pmod(F.monotonically_increasing_id(), F.lit(shards))
    index = good.select(key(place), F.lit(False).alias("asked"), "id", "vector")
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    queries = good.filter("_query").groupBy("id").agg(F.min("vector").alias("vector"))
    asked = queries.select("id", "vector", every_shard).select(key(F.col("shard")), F.lit(True).alias("asked"), "id", "vector")
    dealt = index.unionByName(asked).repartition("key").sortWithinPartitions("key", "asked")
    found = dealt.mapInArrow(lambda batches: _search(batches, largest, k), "query_id long, vec_id long, score double")
    # At most k rows of each query and shard.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
