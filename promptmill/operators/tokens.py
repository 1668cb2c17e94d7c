"""Tokenising and padding."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variants import let
from ..functions.worker import once_per_worker

# Words, or single characters that are neither letter, digit nor space.
WORD_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\r\n]"

IGNORED_LABEL = -100

Encoder = Callable[[Sequence[str]], Sequence[Sequence[int]]]


def word_tokens(text: Column, pattern: str = WORD_PATTERN) -> Column:
    """Text as an array of word and punctuation tokens."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def hashed_ids(text: Column, vocabulary_size: int, reserved: int = 0, pattern: str = WORD_PATTERN) -> Column:
    """Token ids without a vocabulary: words hashed into ``[reserved, vocabulary_size)``.

    Needs no lookup table, no join and no Python worker.
    """
    slots = vocabulary_size - reserved
    if slots <= 0:
        raise ValueError("vocabulary_size must be larger than reserved")
    return F.transform(
        word_tokens(text, pattern),
        lambda t: (F.pmod(F.xxhash64(t), F.lit(slots).cast("long")) + reserved).cast("int"),
    )


def encoder_ids(text: Column, load: Callable[[], Encoder]) -> Column:
    """Token ids from a user's tokenizer.

    ``load`` runs once per worker process and returns a function from texts to id lists; only the text
    column travels to Python, in Arrow batches.
    """

    loaded = uuid4().hex

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = once_per_worker(("encoder", loaded), load)
        for texts in batches:
            yield pd.Series([list(ids) for ids in encoder(texts.tolist())], dtype=object)

    return F.pandas_udf(encode, "array<int>")(text)


def vocabulary_encoder(vocabulary: Mapping[str, int], unknown: int, pattern: str = r"\w+|[^\w\s]") -> Encoder:
    """An encoder over a fixed word list, for ``encoder_ids``."""
    import re

    words = re.compile(pattern)
    return lambda texts: [[vocabulary.get(w, unknown) for w in words.findall(t)] for t in texts]


def truncate(ids: Column, max_length: int | None) -> Column:
    """Keep the first ``max_length`` ids."""
    return ids if max_length is None else F.slice(ids, 1, max_length)


def pad(ids: Column, length: Column | int, fill: int) -> Column:
    """Fill up at the right end to ``length``."""
    target = F.lit(length) if isinstance(length, int) else length
    missing = F.greatest(target - F.size(ids), F.lit(0)).cast("int")
    return F.concat(ids, F.array_repeat(F.lit(fill), missing))


def mask(ids: Column) -> Column:
    """Attention mask of unpadded ids: ones."""
    return F.transform(ids, lambda _: F.lit(1))


def tokenize(
    df: DataFrame,
    ids: Column,
    keep: Sequence[str] = (),
    max_length: int | None = None,
    pad_id: int | None = None,
    add_labels: bool = True,
) -> DataFrame:
    """Token columns in place of the original ones.

    ``keep`` names the row key; ``pad_id`` pads to ``max_length``; ``n_tokens`` counts ids before
    padding, so later steps need not read the arrays to know their length.
    """
    if pad_id is not None and max_length is None:
        raise ValueError("padding to the maximum needs max_length")
    packed = let(
        truncate(ids, max_length),
        lambda x: F.struct(
            (x if pad_id is None else pad(x, max_length, pad_id)).alias("input_ids"),
            (mask(x) if pad_id is None else pad(mask(x), max_length, 0)).alias("attention_mask"),
            F.size(x).alias("n_tokens"),
        ),
    )
    out = df.select(*keep, packed.alias("t")).select(
        *keep, "t.input_ids", "t.attention_mask", "t.n_tokens"
    )
    return out.withColumn("labels", F.col("input_ids")) if add_labels else out


def collate(tokens: DataFrame, pad_id: int, batch_length: str = "batch_length") -> DataFrame:
    """Pad each row to the longest row of its batch and set the labels.

    Labels are the ids, except that every pad id is ignored; where the pad id is also the end
    token, real end tokens are ignored too.
    """
    length = F.col(batch_length)
    padded = pad(F.col("input_ids"), length, pad_id)
    return (
        tokens.withColumn("attention_mask", pad(F.col("attention_mask"), length, 0))
        .withColumn("input_ids", padded)
        .withColumn(
            "labels",
            F.transform(
                F.col("input_ids"), lambda x: F.when(x == pad_id, F.lit(IGNORED_LABEL)).otherwise(x)
            ),
        )
    )
