"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A three-letter sequence is bound into one vector:
the letters' vectors, rotated by their place in the sequence, multiplied element by element.  A
document is the sum (bundle) of its sequences' vectors; a language's prototype is the sum of its
documents' vectors, each scaled to the same length.  The mean of all prototypes is taken off, since
it holds what languages share.  A document gets the language whose prototype has the largest cosine
with it; the score is (1 + cosine) / 2.

The best of centred cosines is never negative, so it cannot tell a document that is like no language.
``like_learned`` uses plain cosines for that: a document is like a language when its cosine reaches
``SHARE`` of the cosine that all but the lowest tenth of the language's documents of its length reach
(the length in classes of powers of two; each document compared with the sum of the others).

Sums and thresholds are learned from every whole text of a known language (of the ``LANGUAGES`` most
frequent ones); nothing is drawn.  The thresholds come from exact counts in bins of the cosine.

Defined cases: a text that is null or has no letter is ``und`` with score 0; with nothing to learn
from, every document is ``und``; equal cosines go to the alphabetically first language; documents of
null id or language are never learned from; repeated rows are predicted each; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.worker import once_per_worker

DIMENSIONS = 1024
SEED = 20_240_607
#: More than there are codes of languages; a bound on what the driver and the workers hold.
LANGUAGES = 8192
#: Sequences whose vectors a worker remembers, and documents bundled at once.
REMEMBERED = 16_384
_GROUP = 64
_STEP = 4_096
_UNDEFINED = "und"
_SCALE = 10_000
#: A document is like a language from this share of the lowest tenth's cosine; rows a class needs.
SHARE = 0.5
LEAST_ROWS = 20
_CLASSES = 32
#: Bins of a cosine's unit.
_BINS = 100_000


class Bundler:
    """Turns texts into document vectors of unit length."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.letters: dict[int, int] = {}
        self.table = np.zeros((0, dimensions), np.int8)
        self.index = np.full(0x110000, -1, np.int32)
        # By category: neither digits nor superscripts and fractions are letters.
        self.is_letter = np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000)
        self.forget()

    def forget(self) -> None:
        self.rows: dict[int, int] = {}
        self.vectors = np.empty((1024, self.dimensions), np.int8)

    def _letters(self, codes: np.ndarray) -> np.ndarray:
        found = self.index[codes]
        if (found < 0).any():
            for code in np.unique(codes[found < 0]).tolist():
                row = np.random.default_rng([SEED, code]).integers(0, 2, self.dimensions) * 2 - 1
                self.index[code] = len(self.table)
                self.table = np.vstack([self.table, row.astype(np.int8)])
            found = self.index[codes]
        return found

    def sequences(self, text: str | None) -> np.ndarray:
        """Keys of all three-letter sequences of a text; runs of other characters are one gap."""
        codes = np.frombuffer(f"{(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
        letter = self.is_letter[codes]
        if not letter.any():
            return np.empty(0, np.int64)
        # Letters, and the first other character after each run of them as its gap; a gap to begin with.
        kept = letter.copy()
        kept[1:] |= letter[:-1]
        codes = np.where(letter, codes, ord(" "))[kept]
        at = self._letters(np.concatenate([[ord(" ")], codes])).astype(np.int64)
        return at[:-2] << 42 | at[1:-1] << 21 | at[2:]

    def _rows(self, keys: np.ndarray) -> np.ndarray:
        new = [k for k in keys.tolist() if k not in self.rows]
        if len(self.rows) + len(new) > REMEMBERED:
            self.forget()
            new = keys.tolist()
        if new:
            first = len(self.rows)
            while first + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
            k = np.array(new, np.int64)
            mask = (1 << 21) - 1
            bound = np.roll(self.table[k >> 42], 2, axis=1) * np.roll(self.table[k >> 21 & mask], 1, axis=1)
            self.vectors[first : first + len(new)] = bound * self.table[k & mask]
            self.rows.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(self.rows.__getitem__, keys.tolist()), np.int64, len(keys))

    def bundle(self, texts: list[str | None], lengths: bool = False):
        """One row per text: its unit vector, or zeros for a text without letters; ``lengths``: its sequences too."""
        found = np.zeros((len(texts), self.dimensions), np.float32)
        keys, docs, counts = [], [], []
        for i, text in enumerate(texts):
            own, times = np.unique(self.sequences(text), return_counts=True)
            keys.append(own)
            counts.append(times)
            docs.append(np.full(len(own), i))
        key, doc, count = map(np.concatenate, (keys, docs, counts))
        distinct, inverse = np.unique(key, return_inverse=True)
        # A batch of very many sequences is bundled in steps, to bound the memory.
        for start in range(0, len(distinct), _STEP):
            part = distinct[start : start + _STEP]
            rows = self._rows(part)  # may grow the vectors
            vectors = self.vectors[rows].astype(np.float32)
            here = (inverse >= start) & (inverse < start + len(part))
            weights = np.zeros((len(texts), len(part)), np.float32)
            weights[doc[here], inverse[here] - start] = count[here]
            found += weights @ vectors
        norms = np.linalg.norm(found, axis=1, keepdims=True)
        unit = np.divide(found, norms, out=found, where=norms > 0)
        return (unit, np.array([c.sum() for c in counts], np.int64)) if lengths else unit


def bundler(dimensions: int) -> Bundler:
    return once_per_worker(("bundler", dimensions, SEED), lambda: Bundler(dimensions), alone=True)


def _learned_from(docs: DataFrame) -> DataFrame:
    known = docs.filter("lang is not null and doc_id is not null").select("text", "lang")
    counts = known.groupBy("lang").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "lang").limit(LANGUAGES)
    return known.join(F.broadcast(counts.select("lang")), "lang", "left_semi")


def sums_by_language(docs: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The sum of the unit vectors of each language of ``docs`` (doc_id, text, lang)."""
    chosen = _learned_from(docs)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for at in range(0, len(langs), _GROUP):
                vectors = bundler(dimensions).bundle(batch.column(1).slice(at, _GROUP).to_pylist())
                # Whole numbers, so that the sum does not depend on its order.
                for lang, row in zip(langs[at : at + _GROUP], np.rint(vectors * _SCALE).astype(np.int64)):
                    total[lang] = total[lang] + row if lang in total else row
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total)), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))],
                names=["lang", "vector"],
            )

    partial = chosen.select("lang", "text").mapInArrow(sums, "lang string, vector array<bigint>")
    summed = partial.select("lang", F.posexplode("vector")).groupBy("lang", "pos").agg(F.sum("col").alias("sum"))
    one = F.array_sort(F.collect_list(F.struct("pos", "sum")))
    rows = summed.groupBy("lang").agg(F.transform(one, lambda e: e["sum"]).alias("vector")).collect()
    found = {row["lang"]: np.array(row["vector"], np.float64) for row in sorted(rows, key=lambda r: r["lang"])}
    return {lang: v / _SCALE for lang, v in found.items() if v.any()}


def train(docs: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototypes by language of ``docs`` (doc_id, text, lang); all of them may be learned from."""
    sums = sums_by_language(docs, dimensions)
    prototypes = {lang: v / np.linalg.norm(v) for lang, v in sums.items()}
    if len(prototypes) > 1:
        mean = np.mean(list(prototypes.values()), axis=0)
        prototypes = {lang: v - mean for lang, v in prototypes.items()}
    return {lang: v / (np.linalg.norm(v) or 1) for lang, v in prototypes.items()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``docs`` with lang_pred and score; only the text decides."""
    langs = list(prototypes)
    dimensions = len(prototypes[langs[0]]) if langs else DIMENSIONS
    matrix = docs.sparkSession.sparkContext.broadcast(
        np.array(list(prototypes.values()), np.float32).reshape(len(langs), dimensions)
    )

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            best, score = [], []
            texts = batch.column(batch.num_columns - 1)
            for at in range(0, len(batch), _GROUP):
                group = texts.slice(at, _GROUP).to_pylist()
                vectors = bundler(dimensions).bundle(group)
                known = vectors.any(axis=1)
                cosines = vectors @ matrix.value.T if langs else np.zeros((len(group), 1))
                top = cosines.argmax(axis=1)
                best += [langs[t] if langs and k else _UNDEFINED for t, k in zip(top, known)]
                value = np.clip((1 + cosines.max(axis=1).astype(np.float64)) / 2, 0, 1)
                score += np.where(known & bool(langs), value, 0).tolist()
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(best, pa.string()), pa.array(score, pa.float64())], names=names)

    names = [*columns, "lang_pred", "score"]
    chosen = docs.select(*columns, F.col("text").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(batches, f"{schema}, lang_pred string, score double")


def least_cosines(docs: DataFrame, sums: dict[str, np.ndarray]) -> np.ndarray:
    """The cosine from which a document is like a language: a row per language, a column per length class.

    A class of too few rows takes the next shorter one; shorter than any, the shortest one scaled with
    the root of the length.  A language without classes takes the lowest of the others; without any
    class at all, three deviations of the cosine of a random vector.  All documents of the languages
    count; a class's lowest tenth is found from counts of bins, of at most two ``_BINS`` a class.
    """
    langs = list(sums)
    dimensions = len(sums[langs[0]]) if langs else DIMENSIONS
    place = {lang: i for i, lang in enumerate(langs)}
    matrix = docs.sparkSession.sparkContext.broadcast(np.array(list(sums.values())).reshape(len(langs), dimensions))

    def cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (matrix.value**2).sum(axis=1)
        for batch in batches:
            at_lang = [place.get(lang, -1) for lang in batch.column(0).to_pylist()]
            for at in range(0, len(batch), _GROUP):
                vectors, lengths = bundler(dimensions).bundle(batch.column(1).slice(at, _GROUP).to_pylist(), lengths=True)
                own = np.array(at_lang[at : at + _GROUP])
                use = (own >= 0) & (lengths > 0)
                own, vectors = own[use], vectors[use].astype(np.float64)
                dots = (vectors * matrix.value[own]).sum(axis=1)
                # Without the document's own part of the sum.
                others = squares[own] - 2 * dots + 1
                alone = others < 0.5
                value = (dots - 1) / np.sqrt(np.where(alone, 1, others))
                columns = [own[~alone], _length_class(lengths[use])[~alone], value[~alone]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["lang", "class", "cosine"])

    found = np.full((len(langs), _CLASSES), np.nan)
    if langs:
        rows = _learned_from(docs).select("lang", "text").mapInArrow(cosines, "lang long, class long, cosine double")
        group = ["lang", "class"]
        bins = rows.groupBy(*group, F.floor(F.col("cosine") * _BINS).alias("bin")).agg(F.count("*").alias("n"))
        upto = bins.withColumn("upto", F.sum("n").over(Window.partitionBy(*group).orderBy("bin")))
        upto = upto.withColumn("all", F.sum("n").over(Window.partitionBy(*group)))
        reached = upto.filter((F.col("all") >= LEAST_ROWS) & (F.col("upto") * 10 >= F.col("all")))
        for row in reached.groupBy(*group).agg((F.min("bin") / _BINS).alias("low")).collect():
            found[row["lang"], row["class"]] = SHARE * row["low"]
    for own in found:
        having = np.flatnonzero(~np.isnan(own))
        if len(having):
            shorter = np.searchsorted(having, np.arange(_CLASSES), "right") - 1
            first = own[having[0]] * 2.0 ** ((np.arange(_CLASSES) - having[0]) / 2)
            own[:] = np.where(shorter >= 0, own[having[shorter]], first)
    missing = np.isnan(found).all(axis=1)
    found[missing] = 3 / np.sqrt(dimensions) if missing.all() else found[~missing].min(axis=0)
    return found


def _length_class(lengths: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(lengths, 1)).astype(np.int64)


def like_learned(docs: DataFrame, sums: dict[str, np.ndarray], least: np.ndarray, columns: tuple[str, ...]) -> DataFrame:
    """``columns`` of ``docs``, with whether the text is ``like`` a language of ``sums``."""
    dimensions = len(next(iter(sums.values()))) if sums else DIMENSIONS
    units = np.array([v / np.linalg.norm(v) for v in sums.values()], np.float32).reshape(len(sums), dimensions)
    sent = docs.sparkSession.sparkContext.broadcast((units, least))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, least = sent.value
        for batch in rows:
            like = []
            texts = batch.column(batch.num_columns - 1)
            for at in range(0, len(batch), _GROUP):
                vectors, lengths = bundler(dimensions).bundle(texts.slice(at, _GROUP).to_pylist(), lengths=True)
                reached = vectors @ units.T >= least[:, _length_class(lengths)].T
                like += (reached.any(axis=1) & (lengths > 0)).tolist()
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(like, pa.bool_())], names=[*columns, "like"])

    chosen = docs.select(*columns, F.col("text").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(batches, f"{schema}, like boolean")
