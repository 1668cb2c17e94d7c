"""Token-id files: whole texts encoded, grammar-compressed block by block, and read back.

``write_tokens`` orders the documents by id (a range shuffle), encodes them in Arrow batches and
packs about ``block_tokens`` ids into each block (format: ``repair``).  The blocks are the binary
column of a Parquet folder, so Spark's committer guards them against lost executors and any file
system Spark reaches will do.  ``read_tokens`` gives each document's ids back with the position of
its first id among all ids.  Each block knows the ids before it in its partition; the
ids of all partitions before come from one total per partition of the writing job.

Defined cases: a null or empty text is only the end id; documents of equal id (null ids come first)
all stay, ordered by a hash of their texts; an empty table gives an empty folder and no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .repair import Block, pack
from .wordbpe import encoder, text_slices, vocabulary

BLOCK_TOKENS = 2_000_000
_BLOCKS = "part int, before long, n_docs long, n_tokens long, payload binary"


def with_end_id(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``end_id`` appended to every text of ``WordEncoder.encode``."""
    ends = np.insert(ids, offsets[1:], end_id).astype("<u4", copy=False)
    return ends, offsets + np.arange(len(offsets))


def write_tokens(
    docs: DataFrame, path: str, vocab: str = "word_bpe_49k.json", end_id: int = 2, block_tokens: int = BLOCK_TOKENS
) -> None:
    """Write the ids of ``docs`` (doc_id, text), each with ``end_id``, in ascending doc_id order."""
    vocab_json = docs.sparkSession.sparkContext.broadcast(vocabulary(vocab))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocab_json.value).encode
        part, before = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            payload = pack(doc_ids, np.concatenate(sizes), np.concatenate(ids))
            row = [[part], [before], [len(doc_ids)], [held], [payload]]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds)],
                names=["part", "before", "n_docs", "n_tokens", "payload"],
            )

        for batch in batches:
            at = 0
            for texts in text_slices(batch.column(1)):
                found, offsets = with_end_id(*encode(texts), end_id)
                doc_ids += batch.column(0).slice(at, len(texts)).to_pylist()
                at += len(texts)
                sizes.append(np.diff(offsets))
                ids.append(found)
                held += len(found)
                if held >= block_tokens:
                    yield flush()
                    before += held
                    doc_ids, sizes, ids, held = [], [], [], 0
        if doc_ids:
            yield flush()

    keys = ["doc_id", "_order"]
    (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_order"))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("doc_id", "text")
        .mapInArrow(blocks, _BLOCKS)
        .write.option("compression", "uncompressed")
        .parquet(path)
    )


def _with_start(blocks: DataFrame) -> DataFrame:
    """Blocks with ``start``, the ids of all blocks before."""
    # One row per partition of the writing job: small enough for one task and for every executor.
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("_all"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_earlier"))
    return blocks.join(F.broadcast(parts), "part").withColumn("start", F.col("_earlier") + F.col("before"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Rows doc_id, start, ids (4 little-endian bytes each) of the files below ``path``."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, start in zip(batch.column(0), batch.column(1).to_pylist()):
                block = Block(payload.as_buffer())
                ends = np.cumsum(block.n_tokens)
                starts = ends - block.n_tokens
                ids = pa.py_buffer(np.ascontiguousarray(block.tokens(), "<u4"))
                bounds = pa.py_buffer(np.append(starts, ends[-1:]) * 4)
                data = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, bounds, ids])
                for at in range(0, len(starts), 5_000):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(block.doc_ids[at : at + 5_000], pa.int64()),
                            pa.array(start + starts[at : at + 5_000], pa.int64()),
                            data.slice(at, 5_000).cast(pa.binary()),
                        ],
                        names=["doc_id", "start", "ids"],
                    )

    blocks = spark.read.schema(_BLOCKS).parquet(path)
    return (
        _with_start(blocks)
        .select("payload", "start")
        .mapInArrow(documents, "doc_id long, start long, ids binary")
    )
