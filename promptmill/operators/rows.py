"""A user's function on rows, with state that each worker loads once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.worker import once_per_worker

Columns = Mapping[str, list]


def map_rows(
    df: DataFrame,
    load: Callable[[], Callable[[Columns], Columns]],
    schema: str,
    columns: Sequence[str] | None = None,
    batch_rows: int = 1000,
) -> DataFrame:
    """Rows that a function makes of the rows of ``df``.

    ``load`` runs once per worker process, for a tokenizer or model say, and returns the function.  That
    one gets up to ``batch_rows`` rows as lists by column name (``columns``, default all: name the ones
    it needs, the others are then not read) and returns lists of equal length for the columns of
    ``schema``: as many rows as it likes.  Missing columns are nulls, others an error.  Rows keep their
    partition; nothing is shuffled.
    """
    spark = df.sparkSession
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)
    loaded = uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function: Any = once_per_worker(("rows", loaded), load)
        for batch in batches:
            for at in range(0, len(batch), batch_rows):
                made = function(batch.slice(at, batch_rows).to_pydict())
                if unknown := sorted(set(made) - set(arrow.names)):
                    raise ValueError(f"columns {unknown} are not in the schema")
                if len({len(values) for values in made.values()}) > 1:
                    raise ValueError("columns of different length")
                n = len(next(iter(made.values()), []))
                arrays = [pa.array(made.get(f.name, [None] * n), f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.select(*(df.columns if columns is None else columns)).mapInArrow(run, schema)
