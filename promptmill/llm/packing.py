"""Packing documents into sequences of a fixed number of tokens by the sum-of-squares rule.

``token_pieces`` encodes whole texts and cuts only documents longer than a sequence; ``pack_pieces``
deals the pieces to shards of about ``shard_pieces`` (by a number each piece got when it was
written, so equal keys spread too) and packs every shard on its own.  A piece goes where the sum over
all gaps of (open sequences with that gap) squared becomes smallest: an open sequence, or a new one.
Pieces are placed by falling length.  What then lies in sequences with room left is taken out and
placed again, as long as that saves a sequence; so a shard ends with at most a few sequences more
than its tokens need.  A piece as long as a sequence is one.

Defined cases: a null or empty text is only the end id; repeated rows are packed each on its own;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .token_files import with_end_id
from .wordbpe import encoder, text_slices, vocabulary

SEQUENCE_TOKENS = 2048
#: Pieces packed together: a task holds their lengths only.
SHARD_PIECES = 30_000
MOST_PASSES = 8
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, slot long"


def token_pieces(
    docs: DataFrame, size: int = SEQUENCE_TOKENS, vocab: str = "word_bpe_49k.json", end_id: int = 0, keep_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``size`` ids of ``docs`` (doc_id, text), each text with ``end_id``.

    ``slot`` numbers the pieces of a task and tells tasks apart; write the result before using it.
    ``keep_ids`` adds the column ``ids`` (4 little-endian bytes each).
    """
    vocab_json = docs.sparkSession.sparkContext.broadcast(vocabulary(vocab))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocab_json.value).encode
        slot = TaskContext.get().partitionId() << 40
        for batch in batches:
            at = 0
            for texts in text_slices(batch.column(1)):
                ids, offsets = with_end_id(*encode(texts), end_id)
                lengths = np.diff(offsets)
                counts = -(-lengths // size)
                doc = np.repeat(np.arange(len(texts)), counts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * size
                length = np.minimum(lengths[doc] - start, size)
                data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                begin = (offsets[doc] + start) * 4
                parts = [data[b:e] for b, e in zip(begin.tolist(), (begin + length * 4).tolist())]
                columns = [
                    batch.column(0).slice(at, len(texts)).take(pa.array(doc)).cast(pa.int64()),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                    pa.array(slot + np.arange(len(doc))),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "slot"]
                if keep_ids:
                    columns.append(pa.array([bytes(p) for p in parts], pa.binary()))
                    names.append("ids")
                slot += len(doc)
                at += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = _PIECES + (", ids binary" if keep_ids else "")
    return docs.select("doc_id", "text").mapInArrow(pieces, schema)


def _place(lengths: list[int], size: int) -> list[list[int]]:
    """Sequences (as positions in ``lengths``) by the sum-of-squares rule, in the order given."""
    open_by_gap = np.zeros(size + 1, np.int64)
    stacks: dict[int, list[int]] = {}
    sequences: list[list[int]] = []
    never = 1 << 60
    for item, length in enumerate(lengths):
        # Change of the sum when a sequence with gap ``length + k`` takes the item and keeps gap k.
        # The last entry stands for a new sequence.
        change = 1 - 2 * open_by_gap[length : size + 1]
        change[-1] = never if length == 0 else 0
        change[:-1][change[:-1] == 1] = never
        change[1:] += 2 * open_by_gap[1 : size - length + 1] + 1
        left = int(change.argmin())
        gap = length + left
        if gap == size:
            number = len(sequences)
            sequences.append([])
        else:
            open_by_gap[gap] -= 1
            number = stacks[gap].pop()
        sequences[number].append(item)
        if left:
            open_by_gap[left] += 1
            stacks.setdefault(left, []).append(number)
    return sequences


def sum_of_squares(lengths: np.ndarray, size: int = SEQUENCE_TOKENS) -> list[list[int]]:
    """Positions in ``lengths`` (each from 1 to ``size``) grouped into sequences."""
    done = [[i] for i in np.flatnonzero(lengths == size).tolist()]
    rest = np.flatnonzero(lengths < size)
    best: list[list[int]] = []
    for attempt in range(MOST_PASSES):
        rest = rest[np.argsort(-lengths[rest], kind="stable")]
        placed = [[int(rest[i]) for i in s] for s in _place(lengths[rest].tolist(), size)]
        if attempt and len(placed) >= len(best):
            break
        best = placed
        full = [sum(lengths[i] for i in s) == size for s in best]
        done += [s for s, f in zip(best, full) if f]
        best = [s for s, f in zip(best, full) if not f]
        rest = np.array([i for s in best for i in s], np.int64)
        if len(best) < 2:
            break
    return done + best


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE_TOKENS, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, their place in it."""
    written = materialize(pieces, "pieces")
    shards = max(1, -(-written.count() // shard_pieces))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("slot", ignore_index=True)
        lengths = frame["length"].to_numpy()
        number, offset = np.empty(len(frame), np.int64), np.empty(len(frame), np.int64)
        for k, sequence in enumerate(sum_of_squares(lengths, size)):
            number[sequence] = k
            offset[sequence] = np.cumsum(lengths[sequence]) - lengths[sequence]
        # Below 2^31 sequences in a shard and 2^32 shards, so numbers never meet.
        frame["sequence_id"] = (frame.pop("shard").to_numpy() << 31) + number
        frame["offset"] = offset
        return frame[["slot", "sequence_id", "offset", *columns]]

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = "slot long, sequence_id long, offset long, " + _PIECES.removesuffix(", slot long")
    return (
        written.select(*columns, "slot", F.pmod(F.xxhash64("slot"), F.lit(shards)).alias("shard"))
        .groupBy("shard")
        .applyInPandas(pack, schema)
        .drop("slot")
    )


def sequences(packed: DataFrame, pieces: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (4 bytes each, at most ``size`` ids).

    ``pieces`` are those of ``token_pieces(keep_ids=True)``; doc_id must be unique there.
    """
    ids = pieces.select("doc_id", "piece", "ids")
    parts = packed.join(ids, ["doc_id", "piece"]).groupBy("sequence_id")
    # At most ``size`` parts of at least one id.
    ordered = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return parts.agg(F.unhex(F.array_join(F.transform(ordered, lambda p: p["ids"]), "")).alias("ids"))
