"""Ordered groups (turns of conversations, lines of files) that need not fit into one task.

``in_order`` deals rows by ranges of (group, order), so a group of any size is cut by place and lies in
as many partitions as it needs, in order.  A task then sees groups one after the other; only its
first and its last group may go on elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame


def in_order(df: DataFrame, ranges: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """``df`` in partitions by ranges of ``ranges``, each sorted by ``order``.

    ``ranges`` must be a beginning of ``order`` (or shorter forms of its columns that order the same
    way): it is what the sample that cuts the ranges holds, so keep it short.  Rows equal in it stay
    together.
    """
    return df.repartitionByRange(*ranges).sortWithinPartitions(*order)


def runs(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Slices of batches with one value in column ``key``, nulls being equal; the flag tells whether
    the slice opens a new group."""
    last: object = _NONE
    for batch in batches:
        if not len(batch):
            continue
        column = batch.column(key)
        if len(batch) > 1:
            a, b = column.slice(0, len(batch) - 1), column.slice(1)
            same = pc.if_else(pc.and_(pc.is_null(a), pc.is_null(b)), True, pc.fill_null(pc.equal(a, b), False))
            cuts = [i + 1 for i in pc.indices_nonzero(pc.invert(same)).to_pylist()]
        else:
            cuts = []
        for begin, end in zip([0, *cuts], [*cuts, len(batch)]):
            value = column[begin].as_py()
            yield last is _NONE or value != last, batch.slice(begin, end - begin)
            last = value


_NONE = object()
