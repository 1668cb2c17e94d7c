"""WARC records and their fixity audit by Merkle trees.

``warc_records`` turns pages into WARC/1.0 response records and deals them to files of bounded size,
each record at its offset.  ``audit`` compares two replicas of such files.  In every file, records
are hashed; ranges of ``RANGE_BYTES`` hash the records that start in them, in order of offset; ``FANOUT``
neighbouring nodes are hashed into one on the next level, up to the root.  Roots are compared first;
below a differing node only its children are, level by level, down to the records.

Everything is built-in functions: hashing is narrow, each level is a grouping with a bounded group
(the records of a range, ``FANOUT`` nodes), and the descent joins only what differs.

Defined cases: null fields of a page are empty; pages that repeat are records of their own; a
replica without a file lacks all its records; replicas equal in all bytes give no rows; empty tables give
no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

FILE_BYTES = 64 << 20
RANGE_BYTES = 64 << 10
FANOUT = 16


def _record(page_id: Column, url: Column, body: Column) -> Column:
    """Bytes of a response record.  Its id is derived from the page, so that it can be rebuilt."""
    payload = F.coalesce(F.encode(body, "UTF-8"), F.lit(b""))
    name = F.sha2(F.concat_ws("|", page_id.cast("string"), url), 256)
    parts = [F.substring(name, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:"),
        F.concat_ws("-", *parts),
        F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.length(payload).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(F.encode(head, "UTF-8"), payload, F.lit(b"\r\n\r\n"))


def warc_records(pages: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rows file, offset, page_id, record of ``pages`` (page_id, url, html)."""
    records = pages.select("page_id", _record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    total = records.agg(F.sum(F.length("record").cast("long"))).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    # A hash of id and bytes deals pages evenly, also when one id repeats.
    file = F.pmod(F.xxhash64("page_id", "record"), F.lit(files)).alias("file")
    before = Window.partitionBy("file").orderBy("page_id", F.xxhash64("record")).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.length("record").cast("long")).over(before), F.lit(0))
    return records.withColumn("file", file).select("file", offset.alias("offset"), "page_id", "record")


def _joined(order: Column, digest: Column) -> Column:
    """Hash over digests in order, with their places."""
    ordered = F.array_sort(F.collect_list(F.struct(order.alias("at"), digest.alias("digest"))))
    return F.sha2(F.array_join(F.transform(ordered, lambda e: F.concat_ws(":", e["at"].cast("string"), e["digest"])), ";"), 256)


def _levels(records: DataFrame, height: int) -> list[DataFrame]:
    """Trees of one replica: record hashes, then a table (file, node, digest) for each level."""
    leaves = records.select("file", "offset", F.sha2("record", 256).alias("digest"))
    leaves = materialize(leaves.withColumn("node", F.floor(F.col("offset") / RANGE_BYTES)), "fixity")
    level = leaves.groupBy("file", "node").agg(_joined(F.col("offset"), F.col("digest")).alias("digest"))
    levels = [leaves, materialize(level, "fixity")]
    for _ in range(height):
        parents = levels[-1].groupBy("file", F.floor(F.col("node") / FANOUT).alias("parent"))
        level = parents.agg(_joined(F.col("node"), F.col("digest")).alias("digest"))
        levels.append(materialize(level.withColumnRenamed("parent", "node"), "fixity"))
    return levels


def _differing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose digests differ or that one side lacks."""
    a, b = left.withColumnRenamed("digest", "_left"), right.withColumnRenamed("digest", "_right")
    return a.join(b, keys, "full").filter(~F.col("_left").eqNullSafe(F.col("_right")))


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows file, offset, finding for the records in which two replicas (file, offset, record) differ.

    ``finding`` is "altered", "missing" (not in ``right``) or "added" (not in ``left``).
    """
    last = max((r.agg(F.max("offset")).first()[0] or 0) for r in (left, right))
    height, nodes = 0, last // RANGE_BYTES + 1
    while nodes > 1:
        height, nodes = height + 1, -(-nodes // FANOUT)
    trees = _levels(left, height), _levels(right, height)
    suspects = _differing(trees[0][-1], trees[1][-1], ["file", "node"]).select("file", "node")
    for level in range(height, 0, -1):
        parents = suspects.select("file", F.col("node").alias("_parent"))
        children = []
        for tree in trees:
            nodes_below = tree[level].withColumn("_parent", F.floor(F.col("node") / FANOUT))
            children.append(nodes_below.join(parents, ["file", "_parent"], "left_semi").drop("_parent"))
        suspects = materialize(_differing(*children, ["file", "node"]).select("file", "node"), "suspects")
    records = []
    for tree in trees:
        inside = tree[0].join(suspects, ["file", "node"], "left_semi").drop("node")
        records.append(inside.groupBy("file", "offset").agg(F.array_join(F.array_sort(F.collect_list("digest")), ";").alias("digest")))
    finding = F.when(F.col("_right").isNull(), "missing").when(F.col("_left").isNull(), "added").otherwise("altered")
    return _differing(*records, ["file", "offset"]).select("file", "offset", finding.alias("finding"))
