"""Near-duplicate vectors of equal label through an index of pivot permutations.

Every distinct vector is described by its nearest reference points (pivots), in order of nearness;
the pivots are a sample of the vectors, which grows with the square root of their number
(``pivots_for``), so that lists grow no faster.  The first ``PREFIX`` of them put the vector on the
inverted lists of its label and each of these pivots.  On a list, shared pivots are counted first:
vectors that share at least ``SHARED`` are candidates, on the list of the first pivot (by number) that
they share, so each pair is met once.  Only candidates are verified by their cosine in double precision.

Equal vectors are compared once and counted with their number, so copies are never paired.  A list
of many vectors is split into cells of bounded size (``graph.in_cells``).  A cell gives each vector's
number of links and enough links for the components, not the pairs.

Defined cases: a vector that is null, zero or holds a null or non-finite component, or whose label is
null, links with nothing; vectors of different lengths never link; repeated rows are copies; a
row of null id is never kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .graph import components, in_cells, stars
from .vectors import matrix, usable

LEAST_COSINE = 0.98
#: Pivots for few vectors, and for very many: 4 times as many vectors are all the driver sees.
LEAST_PIVOTS = 256
MOST_PIVOTS = 4096
#: Pivots for each square root of the number of vectors.
PIVOT_SHARE = 2.5
PREFIX = 8
SHARED = 2
#: Pivots are farther apart than this.
PIVOT_COSINE = 0.8
#: Rows of a cell compared at once.
_ROWS = 256


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def pivots_for(vectors: int) -> int:
    """How many pivots that many distinct vectors get."""
    return min(MOST_PIVOTS, max(LEAST_PIVOTS, math.ceil(PIVOT_SHARE * math.sqrt(vectors))))


def _apart(unit: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` vectors, in order, that are not close to one taken before.

    Pivots inside one group of close vectors would order differently for each of its members.
    """
    taken = np.empty((min(most, len(unit)), unit.shape[1]))
    count = 0
    for vector in unit:
        if count == len(taken):
            break
        if not count or (taken[:count] @ vector).max() < PIVOT_COSINE:
            taken[count] = vector
            count += 1
    return taken[:count]


def _bits(prefix: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """A bit for each pivot that ``wanted`` marks in several rows of ``prefix``, in 64-bit words."""
    values, counts = np.unique(prefix[wanted], return_counts=True)
    values = values[counts > 1]
    bits = np.zeros((len(prefix), -(-max(len(values), 1) // 64) * 64), bool)
    if len(values):
        place = np.minimum(np.searchsorted(values, prefix), len(values) - 1)
        row, column = np.nonzero(wanted & (values[place] == prefix))
        bits[row, place[row, column]] = True
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _cell(frame: pd.DataFrame, least: float, shared: int) -> pd.DataFrame:
    """Links of a cell: node, links (copies count), root (a node of the same component)."""
    pivot = int(frame["pivot"].iloc[0])
    unit = _unit(np.stack(frame["vector"].to_list()).astype(np.float64))
    prefix = np.stack([np.frombuffer(p, np.uint16) for p in frame["prefix"]])
    nodes, blocks = frame["node"].to_numpy(), frame["block"].to_numpy()
    copies = frame["copies"].to_numpy()
    n = len(nodes)
    parted = blocks.min() != blocks.max()
    # All share this pivot.  A pair that shares one before it is met on that list.
    earlier, later = _bits(prefix, prefix < pivot), _bits(prefix, prefix > pivot)
    linked = np.zeros((n, n), bool)
    for start in range(0, n, _ROWS):
        rows = slice(start, start + _ROWS)
        common = np.ones((len(nodes[rows]), n), np.uint8)
        for w in range(later.shape[1]):
            common += np.bitwise_count(later[rows, w, None] & later[None, :, w])
        candidates = common >= shared
        for w in range(earlier.shape[1]):
            candidates &= (earlier[rows, w, None] & earlier[None, :, w]) == 0
        if parted:
            candidates &= blocks[rows, None] != blocks[None, :]
        np.fill_diagonal(candidates[:, start:], False)
        some, others = np.flatnonzero(candidates.any(axis=1)), np.flatnonzero(candidates.any(axis=0))
        if len(some):
            near = unit[start + some] @ unit[others].T >= least
            linked[np.ix_(start + some, others)] = near & candidates[np.ix_(some, others)]
    links = linked @ copies
    centre, member = stars(n, lambda i, others: linked[i, others])
    root = nodes.copy()
    root[member] = nodes[centre]
    some = links > 0
    return pd.DataFrame({"node": nodes[some], "links": links[some], "root": root[some]})


def near_vectors(rows: DataFrame, least: float = LEAST_COSINE, pivots: int | None = None, prefix: int = PREFIX, shared: int = SHARED) -> DataFrame:
    """One row per row of ``rows`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    ``pivots``: how many (up to 65,536), by default ``pivots_for`` the distinct vectors.
    """
    spark = rows.sparkSession
    rows = rows.select("vec_id", "embedding", "label")
    good = rows.filter(usable("embedding") & F.col("label").isNotNull())
    distinct = good.groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    distinct = materialize(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")

    pivots = pivots or pivots_for(distinct.count())
    # A bounded sample: the vectors with the smallest hashes, of each length.
    sample = distinct.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(4 * pivots).toArrow()
    sample = sample.column(0).combine_chunks()
    sizes = pc.list_value_length(sample).to_numpy(zero_copy_only=False)
    parts = {size: sample.filter(pa.array(sizes == size)) for size in np.unique(sizes).tolist()}
    sent = spark.sparkContext.broadcast({size: _apart(_unit(matrix(part)), pivots) for size, part in parts.items()})

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(1)])
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                reference = sent.value.get(size)
                if reference is None:
                    # No pivot of this length: all vectors of the length are on one list.
                    near = np.zeros((len(part), 1), np.uint16)
                else:
                    cosines = _unit(matrix(part.column(1))) @ reference.T
                    near = np.argsort(-cosines, axis=1, kind="stable")[:, :prefix].astype(np.uint16)
                # A list is of use only where enough pivots after its own are left to share.
                lists = np.sort(near, axis=1)[:, : near.shape[1] + 1 - min(shared, near.shape[1])]
                times = lists.shape[1]
                row = pa.array(np.repeat(np.arange(len(part)), times))
                texts = [p.tobytes() for p in near for _ in range(times)]
                columns = [part.column(0).take(row), pa.array([size] * len(row), pa.int32()), pa.array(lists.ravel().astype(np.int32))]
                columns += [pa.array(texts, pa.binary()), *(part.column(i).take(row) for i in (2, 3, 1))]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "size", "pivot", "prefix", "node", "copies", "vector"])

    fields = distinct.schema
    kinds = {name: fields[name].dataType.simpleString() for name in ("label", "embedding")}
    schema = f"label {kinds['label']}, size int, pivot int, prefix binary, node long, copies long, vector {kinds['embedding']}"
    lists = distinct.select("label", "embedding", "node", "copies").mapInArrow(describe, schema)

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        return _cell(frame, least, min(shared, len(frame["prefix"].iloc[0]) // 2))

    keys = ["label", "size", "pivot"]
    cells = in_cells(lists, keys, "node").groupBy(*keys, "cell")
    found = materialize(cells.applyInPandas(compare, "node long, links long, root long"), "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    own = distinct.join(links, "node", "left").join(groups, "node", "left")
    own = own.withColumn("component", F.coalesce("component", "node"))
    smallest = own.groupBy("component").agg(F.min("first").alias("component_id"))
    n_links = F.col("copies") - 1 + F.coalesce("links", F.lit(0))
    own = own.join(smallest, "component").select("label", "embedding", n_links.alias("n_links"), "component_id")
    linked = good.join(own, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    others = rows.filter(~usable("embedding") | F.col("label").isNull())
    alone = others.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.unionByName(alone).withColumn("kept", kept)
