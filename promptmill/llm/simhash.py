"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by covering anchors.

Fingerprints that differ in at most ``distance`` bits differ in at most half as many in one of their
two halves.  The anchors are a covering code of the 32-bit halves: two Hamming [15,11] codes and two
free bits side by side, so every half is at most 2 bits (the covering radius) from an anchor.  Two
halves t bits apart have a midpoint within t/2 bits of both, and that midpoint has an anchor within
the covering radius.  So each distinct fingerprint is replicated to every anchor within the covering
radius plus t/2 of either half, and all linked fingerprints meet at an anchor, where they are
compared in full.  The search is exact.

Defined cases: null, empty or white-space texts have fingerprint 0 and are linked like any other;
equal fingerprints are compared once, whatever their number; documents of null id take part, but a
null id is nobody's component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .graph import components, in_cells, stars

SHINGLE_WORDS = 4
DISTANCE = 4
HASH_SEED = 42
COVERING_RADIUS = 2
#: Groups up to this size are compared position by position, all groups of a batch at once.
_SMALL_GROUP = 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit fingerprint: ASCII lower case, words between ASCII white space."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, HASH_SEED) for s in shingles], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
    ones = bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, columns: tuple[str, ...] = ()) -> DataFrame:
    """Rows doc_id, fp (the fingerprint as a signed long) and the long ``columns`` of ``docs``."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64)
            ids = batch.column(0).cast(pa.int64())
            others = [batch.column(i) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(found.view(np.int64)), *others], names=["doc_id", "fp", *columns])

    schema = ", ".join(f"`{c}` long" for c in ("doc_id", "fp", *columns))
    return docs.select("doc_id", "text", *columns).mapInArrow(batches, schema)


def _syndromes(halves: np.ndarray) -> np.ndarray:
    """Eight bits that are zero for anchors: the Hamming syndromes of bits 0-14 and 15-29."""
    found = np.zeros(len(halves), np.uint32)
    for start, shift in ((0, 0), (15, 4)):
        for bit in range(15):
            found ^= ((halves >> np.uint32(start + bit)) & np.uint32(1)) * np.uint32((bit + 1) << shift)
    return found


@cache
def _patterns(radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All 32-bit patterns with up to ``radius`` ones by syndrome, and where each syndrome starts."""
    patterns = np.array([sum(1 << b for b in c) for n in range(radius + 1) for c in combinations(range(32), n)], np.uint32)
    syndromes = _syndromes(patterns)
    order = np.argsort(syndromes, kind="stable")
    return patterns[order], np.searchsorted(syndromes[order], np.arange(257))


def anchors(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of unsigned fingerprints as (row, anchor): bit 32 of an anchor tells the half."""
    apart = distance // 2
    patterns, starts = _patterns(COVERING_RADIUS + (apart + 1) // 2)
    rows, found = [], []
    for half in range(2):
        part = ((fps >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        syndrome = _syndromes(part)
        counts = starts[syndrome + 1] - starts[syndrome]
        row = np.repeat(np.arange(len(fps)), counts)
        at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts - starts[syndrome], counts)
        rows.append(row)
        found.append((part[row] ^ patterns[at]).astype(np.int64) | (half << 32))
    return np.concatenate(rows), np.concatenate(found)


def _links(fps: np.ndarray, groups: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the groups (equal neighbours in ``groups``) that keep their components."""
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    ends = np.append(starts[1:], len(groups))
    a, b = [], []
    for start, end in zip(starts[ends - starts > _SMALL_GROUP].tolist(), ends[ends - starts > _SMALL_GROUP].tolist()):
        own = fps[start:end]
        centre, linked = stars(len(own), lambda i, others, own=own: np.bitwise_count(own[others] ^ own[i]) <= distance)
        a.append(own[centre])
        b.append(own[linked])
    small = ends - starts <= _SMALL_GROUP
    first = np.repeat(starts[small], (ends - starts)[small])
    row = first + np.arange(len(first)) - np.searchsorted(first, first)
    last = np.repeat(ends[small], (ends - starts)[small])
    for step in range(1, _SMALL_GROUP):
        row, last = row[row + step < last], last[row + step < last]
        near = row[np.bitwise_count(fps[row] ^ fps[row + step]) <= distance]
        a.append(fps[near])
        b.append(fps[near + step])
    pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def linked_fingerprints(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of ``fps``: enough for all components."""

    def replicate(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            own = batch.column(0).to_numpy()
            for at in range(0, len(own), 20_000):
                part = own[at : at + 20_000]
                row, anchor = anchors(part.view(np.uint64), distance)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[row])], names=["anchor", "fp"])

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def links(table: pa.Table) -> pa.RecordBatch:
            anchor, cell, fp = (table.column(i).to_numpy() for i in range(3))
            change = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1])])
            a, b = _links(fp.view(np.uint64), np.cumsum(change), distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in rows:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            # The last group may go on in the next batch.
            anchor, cell = table.column(0).to_numpy(), table.column(1).to_numpy()
            whole = len(table)
            while whole and anchor[whole - 1] == anchor[-1] and cell[whole - 1] == cell[-1]:
                whole -= 1
            held = table.slice(whole)
            if whole:
                yield links(table.slice(0, whole))
        if held is not None and len(held):
            yield links(held)

    replicas = fps.select("fp").distinct().mapInArrow(replicate, "anchor long, fp long")
    return (
        in_cells(replicas, ["anchor"], "fp")
        .select("anchor", "cell", "fp")
        .repartition("anchor", "cell")
        .sortWithinPartitions("anchor", "cell")
        .mapInArrow(compare, "a long, b long")
    )


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """Rows doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    fps = materialize(fingerprints(docs, words), "fingerprints")
    groups = components(linked_fingerprints(fps, distance)).withColumnRenamed("node", "fp")
    own = fps.groupBy("fp").agg(F.min("doc_id").alias("_first"))
    own = own.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = own.groupBy("component").agg(F.min("_first").alias("component_id"))
    ids = own.join(smallest, "component").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(ids, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def first_rows(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """The ``row`` of ``docs`` (row, doc_id, text) that each group keeps.

    A group is what links join, whatever its ids.  Its row of the smallest doc_id stays, then of the
    smallest text hash, then the first one; a null id is larger than any.
    """
    keyed = docs.select("row", "doc_id", "text", F.xxhash64("text").alias("hash"))
    fps = materialize(fingerprints(keyed, words, ("hash", "row")), "fingerprints")
    groups = components(linked_fingerprints(fps, distance)).withColumnRenamed("node", "fp")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "hash", "row")
    own = fps.groupBy("fp").agg(F.min(order).alias("first"))
    own = own.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    return own.groupBy("component").agg(F.min("first").alias("first")).select("first.row")
