"""Quality grades by ordinal regression on hashed text.

Rated documents have one of the grades 0 (toxic), 1 (junk) and 2 (clean).  One weight
vector is shared by all grades and ordered thresholds cut its score: the chance of a grade of at
most k is logistic(threshold_k - score).  From these come the expected grade and the tail
probability of the best grade, by which documents are selected.

Features are hashed: which words (lower case), beginnings of words and runs of signs occur in a text, and, as shares
of all words, how words are written (upper case, digits, signs inside or at the end) and how often
words repeat.  Whole texts are read.  Weights are never positive: a feature is a defect or nothing,
so a short clean text is not marked down for the common words that it lacks.

The fit takes up to ``RATED_ROWS`` rated documents, chosen by a hash of doc_id (a documented bound on
the fit); features that fewer than ``LEAST_DOCS`` of them have are left out.

Defined cases: a null text has no words and is scored by the thresholds alone, like an empty one;
ratings with a null are ignored, and of several ratings of a document the lowest counts; without
any rating, or with ratings of one grade only, every document gets that grade (2 without any) with
certainty; repeated rows are scored each, and of rows that repeat a rated id the one whose text has the
smallest hash is learned from; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.worker import once_per_worker
from .wordbpe import text_slices

BUCKETS = 1 << 18
RATED_ROWS = 12_000
LEAST_DOCS = 10
PREFIXES = (4, 5)
SELECT_FROM = 0.4
#: Standard deviations above chance from which on a feature may count as a defect.
LEAST_EXCESS = 6.0
#: Fit: penalty on the size of weights and on their squares, steps, step length.
SPARSITY, PENALTY, STEPS, RATE = 2e-5, 1e-6, 400, 0.1
GRADES = 3
REMEMBERED = 150_000
_PARTS = re.compile(r"[^\W_]+|[\W_]+")
_SHAPES = 7


def grade(quality: Column, toxic: Column) -> Column:
    """Grade of a rating; null where the rating has a null."""
    bad = F.when(toxic == 1, 0).when(quality == 0, 1).otherwise(GRADES - 1)
    return F.when(quality.isNotNull() & toxic.isNotNull(), bad)


class Features:
    """Hashed features of texts; remembers those of words it has met."""

    def __init__(self):
        self.words: dict[str, tuple[tuple[int, ...], int]] = {}

    def _word(self, word: str) -> tuple[tuple[int, ...], int]:
        """Buckets of a word and its writing: a bit for each of the shapes."""
        if len(self.words) >= REMEMBERED:
            self.words.clear()
        parts = _PARTS.findall(word)
        # Words and signs as they are, and how words begin: inflected forms share their first letters.
        names = [p.lower() for p in parts]
        names += [f"{p[:n]}-" for p in names for n in PREFIXES if len(p) >= n and p[0].isalnum()]
        buckets = [crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS for name in names]
        letters = [p for p in parts if p[0].isalnum()]
        signs = [p for p in parts if not p[0].isalnum()]
        shapes = (
            not letters,
            bool(signs) and len(signs[-1]) > 1,
            bool(letters) and word.isupper() and len(word) > 2,
            any(c.isdigit() for c in word),
            len(parts) > 2,
            len(word) > 25,
        )
        found = self.words[word] = tuple(buckets), sum(1 << i for i, s in enumerate(shapes) if s)
        return found

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of all texts one after the other, where each text starts, and the shares."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = split.flatten().dictionary_encode()
        known = [self.words.get(w) or self._word(w) for w in words.dictionary.to_pylist()]
        codes = words.indices.to_numpy()
        offsets = split.offsets.to_numpy()
        offsets = offsets - offsets[0]
        flags = np.array([k[1] for k in known], np.int64)
        sizes = np.array([len(k[0]) for k in known], np.int64)
        flat = np.array([b for k in known for b in k[0]], np.int64)
        starts = np.cumsum(sizes) - sizes
        buckets, ends = [np.empty(0, np.int64)], [0]
        shares = np.zeros((len(texts), _SHAPES))
        for i in range(len(texts)):
            own = codes[offsets[i] : offsets[i + 1]]
            distinct = np.unique(own)
            n = sizes[distinct]
            if total := int(n.sum()):
                at = np.repeat(starts[distinct] - np.cumsum(n) + n, n) + np.arange(total)
                buckets.append(np.unique(flat[at]))
                bits = flags[own]
                shares[i, :6] = [(bits >> b & 1).mean() for b in range(6)]
                shares[i, 6] = 1 - len(distinct) / len(own)
            ends.append(ends[-1] + (len(buckets[-1]) if total else 0))
        return np.concatenate(buckets), np.array(ends), shares


def _features() -> Features:
    return once_per_worker("quality features", Features, alone=True)


@dataclass
class OrdinalModel:
    weights: np.ndarray  # of the buckets
    shares: np.ndarray  # of the shares of words
    thresholds: np.ndarray  # rising

    def tails(self, buckets: np.ndarray, ends: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """Chances of a grade of at least 1, 2, ... for each text."""
        scores = np.add.reduceat(np.append(self.weights[buckets], 0.0), ends[:-1]) if len(ends) > 1 else np.empty(0)
        scores[ends[1:] == ends[:-1]] = 0
        scores = scores + shares @ self.shares
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -500, 500)))


def _fit(grades: np.ndarray, buckets: np.ndarray, ends: np.ndarray, shares: np.ndarray) -> OrdinalModel:
    """Penalised maximum likelihood by Adam steps over all rows.

    A feature is a candidate if documents below the best grade have it much more often than chance
    would have it; all others keep a weight of zero.
    """
    bad = grades < GRADES - 1
    row = np.repeat(np.arange(len(grades)), np.diff(ends))
    having = np.bincount(buckets, minlength=BUCKETS)
    found = np.bincount(buckets, bad[row], BUCKETS)
    expected = having * bad.mean()
    above = (found - expected) / np.sqrt(np.maximum(expected * (1 - bad.mean()), 1e-9))
    names = np.flatnonzero((having >= LEAST_DOCS) & (above >= LEAST_EXCESS))
    place = np.full(BUCKETS, -1)
    place[names] = np.arange(len(names))
    used = place[buckets] >= 0
    start = np.zeros(len(names)), np.zeros(shares.shape[1]), np.zeros(GRADES - 1)
    words, own, cut = _descend(grades, row[used], place[buckets[used]], shares, *start)
    weights = np.zeros(BUCKETS)
    weights[names] = words
    return OrdinalModel(weights, own, _thresholds(cut))


def _thresholds(cut: np.ndarray) -> np.ndarray:
    """Rising thresholds from the lowest one and the logarithms of the steps between them."""
    return np.cumsum(np.concatenate([cut[:1], np.exp(cut[1:])]))


def _descend(grades, row, feature, shares, words, own, cut):
    n, n_words, n_shares = len(grades), len(words), len(own)
    value = np.concatenate([words, own, cut])
    first, second = np.zeros_like(value), np.zeros_like(value)
    # The thresholds above and below a grade; the outer grades have one only.
    upper, has_upper = np.minimum(grades, GRADES - 2), grades < GRADES - 1
    lower, has_lower = np.maximum(grades - 1, 0), grades > 0
    every = np.arange(n)
    for step in range(1, STEPS + 1):
        words, own, cut = np.split(value, [n_words, n_words + n_shares])
        scores = np.bincount(row, words[feature], n) + shares @ own
        below = 1 / (1 + np.exp(np.clip(scores[:, None] - _thresholds(cut)[None, :], -50, 50)))
        up = np.where(has_upper, below[every, upper], 1.0)
        low = np.where(has_lower, below[every, lower], 0.0)
        chance = np.maximum(up - low, 1e-12) * n
        d_up, d_low = up * (1 - up) / chance, low * (1 - low) / chance
        to_score = d_up - d_low
        to_threshold = np.bincount(lower, d_low, GRADES - 1) - np.bincount(upper, d_up, GRADES - 1)
        tail = np.cumsum(to_threshold[::-1])[::-1]
        slope = np.concatenate(
            [
                np.bincount(feature, to_score[row], n_words) + PENALTY * words - SPARSITY,
                to_score @ shares + PENALTY * own - SPARSITY,
                tail[:1],
                tail[1:] * np.exp(cut[1:]),
            ]
        )
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        value = value - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        value[: n_words + n_shares] = np.minimum(value[: n_words + n_shares], 0)
    return np.split(value, [n_words, n_words + n_shares])


def train(docs: DataFrame, ratings: DataFrame, rows: int = RATED_ROWS) -> OrdinalModel:
    """The model of ``docs`` (doc_id, text) and ``ratings`` (doc_id, quality, toxic)."""
    graded = ratings.select("doc_id", grade(F.col("quality"), F.col("toxic")).alias("_grade"))
    graded = graded.filter("doc_id is not null and _grade is not null").groupBy("doc_id").agg(F.min("_grade").alias("_grade"))
    # The documents with the smallest hashes: at most ``rows``, so one small table.
    chosen = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in text_slices(batch.column(1)):
                buckets, ends, shares = _features().of(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(buckets, pa.int32())),
                        pa.array(shares.tolist(), pa.list_(pa.float64())),
                    ],
                    names=["grade", "buckets", "shares"],
                )
                at += len(texts)

    rated = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # One row of each rated id, found by partial aggregation, so that the bound holds if ids repeat.
    rated = rated.groupBy("doc_id", "_grade").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("_grade", "text")
    found = rated.mapInArrow(features, "grade int, buckets array<int>, shares array<double>").toArrow().combine_chunks()
    # One order, whatever the order in which tasks end.
    buckets = [b.astype(np.int64) for b in (row.values.to_numpy() for row in found["buckets"])]
    order = sorted(range(len(found)), key=lambda i: (found["grade"][i].as_py(), crc32(buckets[i].tobytes()), len(buckets[i])))
    grades = found["grade"].to_numpy()[order].astype(np.int64)
    if len(set(grades.tolist())) < 2:
        certain = int(grades[0]) if len(grades) else GRADES - 1
        thresholds = np.where(np.arange(GRADES - 1) < certain, -500.0, 500.0)
        return OrdinalModel(np.zeros(BUCKETS), np.zeros(_SHAPES), thresholds)
    buckets = [buckets[i] for i in order]
    shares = np.array(found["shares"].to_pylist())[order]
    ends = np.concatenate([[0], np.cumsum([len(b) for b in buckets])])
    return _fit(grades, np.concatenate(buckets), ends, shares)


def rate(docs: DataFrame, model: OrdinalModel, select_from: float = SELECT_FROM, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``docs`` with expected_grade, tail_probability (of the best grade), selected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = 0
            for texts in text_slices(batch.column(batch.num_columns - 1)):
                tails = sent.value.tails(*_features().of(texts))
                own = [batch.column(i).slice(at, len(texts)) for i in range(batch.num_columns - 1)]
                best = tails[:, -1]
                found = [pa.array(tails.sum(axis=1)), pa.array(best), pa.array(best >= select_from)]
                yield pa.RecordBatch.from_arrays([*own, *found], names=names)
                at += len(texts)

    names = [*columns, "expected_grade", "tail_probability", "selected"]
    chosen = docs.select(*columns, F.col("text").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(batches, f"{schema}, expected_grade double, tail_probability double, selected boolean")
