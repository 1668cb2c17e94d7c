"""Whole texts to ids with a ``tokenizers`` vocabulary that drops white space.

The vocabulary lower-cases, cuts the text at white space and encodes every word on its own, so the
ids of a text are the ids of its words in order.  Arrow splits a slice of texts into words and finds
the distinct ones; each worker remembers the ids of words it has met (a bounded memory that only
saves time).  A word of plain Latin letters and printable ASCII goes to the vocabulary's merge model
part by part; any other word takes the library's full path.  Words are cut at ASCII white space
only: what else the vocabulary takes for white space is inside a word, for the full path.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions.worker import once_per_worker

#: Words, and parts of words, remembered per worker before it starts anew (about 150 bytes each).
REMEMBERED = 450_000
#: Text encoded at once.
SLICE_BYTES = 8 << 20

_PLAIN = re.compile(r"[!-~À-ÖØ-öø-įĲ-ſ]+")
# Contractions, letter runs, single digits, other runs: how the vocabulary cuts a plain word.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+")


def vocabulary(name_or_path: str) -> str:
    """The JSON text of a vocabulary: a path, or the name of a file of the public collection.

    Read on the driver and sent with the tasks: a vocabulary file is a few megabytes whatever the
    corpus, and workers then need no copy of it.
    """
    path = name_or_path
    if not os.path.isabs(path):
        import public_tokenizers

        path = public_tokenizers.path(name_or_path)
    with open(path, encoding="utf-8") as file:
        return file.read()


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write bytes without a printable form as letters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Remembering(dict):
    """A dictionary that computes what it lacks and starts anew when it is full."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[key] = self.compute(key)
        return found


def text_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of about ``most`` bytes, one text at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield texts.slice(start, end - start)
        start = end


class WordEncoder:
    def __init__(self, vocabulary_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary_json)
        self.merge = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.parts = _Remembering(self._part)
        self.words = _Remembering(self._word)

    def _part(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.merge(part)]).tobytes()

    def _word(self, word: str) -> bytes:
        # Most words are one part: a run of letters.
        if word.isascii() and word.isalpha():
            return self.parts[word.lower()]
        if _PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join(map(self.parts.__getitem__, _PARTS.findall(word.lower())))
        return array("I", self.full(word)).tobytes()

    def full(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids start (one more at the
        end).  A null text has no ids."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = split.flatten().dictionary_encode()
        known = list(map(self.words.__getitem__, words.dictionary.to_pylist()))
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat = np.frombuffer(b"".join(known), "<u4")
        codes = words.indices.to_numpy()
        sizes = lengths[codes]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        shift = (np.cumsum(lengths) - lengths)[codes] - ends[:-1]
        ids = flat[np.repeat(shift, sizes) + np.arange(ends[-1])]
        offsets = split.offsets.to_numpy()
        return ids, ends[offsets - offsets[0]]


def encoder(vocabulary_json: str) -> WordEncoder:
    return once_per_worker(("word encoder", hash(vocabulary_json)), lambda: WordEncoder(vocabulary_json), alone=True)
