"""Collocated phrases by Rabin-Karp fingerprints.

Phrases are runs of up to ``LONGEST`` words inside a piece of text.  Their fingerprints come from prefix
polynomials in numpy: sums over the bytes of a slice of texts give a value for every word, sums over
these values a fingerprint for every run of words, language and length mixed in.

1. Fingerprints are counted, level by level.  A block of slices counts its own, and the blocks' counts
   are added up, as packed sorted arrays dealt by ranges.  A run is only counted where the runs inside
   it are frequent: words, then pairs, then three and four words.
2. What is frequent so far goes to the tasks as a bit map over fingerprints.  Its size follows the
   number of frequent ones up to ``MOST_BITS``; bits that are set by chance only let more through.
3. Frequent phrases are read out.  A block numbers its words, compared byte by byte, and its runs by
   the numbers of their words, so runs of one number are equal; the text of the first goes on, packed
   with those of its range.  They are added up by text, so the counts are exact and what collided is
   told apart.  No other phrase is ever written as text.

Phrases are scored by their worst cut into two; a phrase inside a longer one nearly as frequent goes.

Defined cases: a null text is empty, a null language ``und``; repeated rows count each; ties go to the
smaller cut and the smaller phrase; an empty table gives no rows; other columns are ignored.  Texts
longer than a slice are cut behind a separator of pieces; a piece without one is read at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.worker import once_per_worker
from ..operators.skew import join_lookup
from ..session import materialize
from .wordbpe import text_slices

LONGEST = 4
LEAST_COUNT = 30
COVERED_PERCENT = 80
SCORE_SCALE = 2_000_000
MOST_ROWS = 2000
SLICE_BYTES = 1 << 20
BATCH_ROWS = 2_000
LEAST_BITS, MOST_BITS, BITS_EACH = 1 << 20, 1 << 28, 16
_PART_BITS = 1 << 20
#: Fingerprints added up at once, and words of a block whose phrases are read out at once.
BLOCK_RUNS, BLOCK_WORDS = 1 << 22, 1 << 19
#: Text of the table for each part that fingerprints and phrases are dealt to; beyond ``MOST_PARTS`` more.
PART_BYTES, MOST_PARTS, MOST_PART_BYTES = 4 << 20, 4096, 64 << 20
#: Text of phrases sent at once.
SENT_BYTES = 4 << 20

_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_SPACE, _SEPARATOR = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _SPACE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _SEPARATOR
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


class _Powers:
    """Powers of an odd base and of its inverse, modulo 2^64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            factors = np.full(n, self.base, np.uint64), np.full(n, self.inverse, np.uint64)
            for f in factors:
                f[0] = 1
            self.up, self.down = (np.cumprod(f, dtype=np.uint64) for f in factors)
        return self.up[:n], self.down[:n]


def _powers(base: int) -> _Powers:
    return once_per_worker(("powers", base), lambda: _Powers(base))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs_of(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial of ``values[start:end]`` for every start and end, from prefix sums."""
    up, down = _powers(base).upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def _cut_long(langs: list, texts: pa.Array) -> Iterator[tuple[list, pa.Array]]:
    """Slices of about ``SLICE_BYTES``; longer texts are cut behind a separator."""
    texts, at = pc.fill_null(texts, ""), 0
    for part in text_slices(texts, SLICE_BYTES):
        own = langs[at : at + len(part)]
        at += len(part)
        if len(part) > 1 or pc.binary_length(part)[0].as_py() <= SLICE_BYTES:
            yield own, part
            continue
        data = part[0].as_py().encode()
        breaks = np.flatnonzero(_KIND[np.frombuffer(data, np.uint8)] == _SEPARATOR)
        begin = 0
        while begin < len(data):
            i = int(np.searchsorted(breaks, begin + SLICE_BYTES))
            # The last separator within reach, else the next one.
            i = i - 1 if i and breaks[i - 1] >= begin else i
            end = int(breaks[i]) + 1 if i < len(breaks) and len(data) - begin > SLICE_BYTES else len(data)
            yield own, pa.array([data[begin:end].decode()])
            begin = end


class Slice:
    """Words of some texts with their fingerprints."""

    def __init__(self, langs: list[str], texts: pa.Array):
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        self.data = _LOWER[raw]
        kind = _KIND[raw]
        inside = kind == 0
        begins = np.zeros(len(raw) + 1, bool)
        begins[offsets] = True
        before = np.concatenate([[False], inside[:-1]]) if len(raw) else inside
        after = np.concatenate([inside[1:], [False]]) if len(raw) else inside
        self.starts = np.flatnonzero(inside & (~before | begins[:-1]))
        self.ends = np.flatnonzero(inside & (~after | begins[1:])) + 1
        doc = np.searchsorted(offsets, self.starts, "right") - 1
        # Grows at every separator and every document.
        self.piece = np.cumsum(kind == _SEPARATOR)[self.starts] + doc
        self.names = sorted(set(langs))
        place = {name: i for i, name in enumerate(self.names)}
        self.lang = np.array([place[x] for x in langs], np.int64)[doc]
        seeds = np.array([crc32(x.encode()) | len(x) << 32 for x in self.names], np.uint64)
        self.seed = _mixed(seeds)[self.lang] if len(doc) else np.empty(0, np.uint64)
        values = self.data.astype(np.uint64) + np.uint64(1)
        self.words = _mixed(runs_of(values, self.starts, self.ends, _BYTE_BASE) + (self.ends - self.starts).astype(np.uint64))

    def totals(self) -> np.ndarray:
        return np.bincount(self.lang, minlength=len(self.names))

    def places(self, n: int) -> np.ndarray:
        """Where a run of ``n`` words inside a piece begins."""
        count = len(self.words)
        return np.flatnonzero(self.piece[n - 1 :] == self.piece[: count - n + 1]) if count >= n else np.empty(0, np.int64)

    def fingerprints(self, n: int, at: np.ndarray) -> np.ndarray:
        """Fingerprints of the runs of ``n`` words at ``at``."""
        found = self.words[at] if n == 1 else runs_of(self.words, at, at + n, _WORD_BASE)
        return _mixed(found + self.seed[at] * np.uint64(2 * n + 1))

    def spaced(self) -> np.ndarray:
        """The bytes of all words, a space behind each."""
        size = self.ends - self.starts + 1
        ends = np.cumsum(size)
        found = np.append(self.data, np.uint8(0))[_within(self.starts, size)]
        found[ends - 1] = 0x20
        return found


def _within(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges that begin at ``begins``, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each of ``keys``, in order of appearance, and where each number comes first."""
    codes = pa.array(keys).dictionary_encode().indices.to_numpy()
    return codes, np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))


class Block:
    """Words of some slices, with the runs of each length (place and fingerprint) that may be frequent."""

    def __init__(self, slices: list[Slice], runs: list[list[tuple[np.ndarray, np.ndarray]]]):
        self.data = np.concatenate([s.spaced() for s in slices])
        sizes = np.concatenate([s.ends - s.starts for s in slices]) + 1
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.names = sorted({name for s in slices for name in s.names})
        place = {name: i for i, name in enumerate(self.names)}
        self.lang = np.concatenate([np.array([place[x] for x in s.names], np.int64)[s.lang] for s in slices])
        shift = np.cumsum([0, *(len(s.words) for s in slices)])
        self.runs = [tuple(np.concatenate(x) for x in zip(*((own[n][0] + k, own[n][1]) for own, k in zip(runs, shift)))) for n in range(LONGEST)]

    def _words(self) -> tuple[np.ndarray, np.ndarray]:
        """``_distinct`` of the words that may be frequent, by their bytes and language."""
        at, found = self.runs[0]
        codes, first = _distinct(found)
        size, other = self.ends[at] - self.starts[at], at[first][codes]
        equal = np.array_equal(size, self.ends[other] - self.starts[other]) and np.array_equal(self.lang[at], self.lang[other])
        if not (equal and np.array_equal(self.data[_within(self.starts[at], size)], self.data[_within(self.starts[other], size)])):
            # Two words of one fingerprint: told apart by their bytes.
            known: dict[tuple, int] = {}
            words = zip(self.lang[at].tolist(), self.starts[at].tolist(), self.ends[at].tolist())
            codes, first = _distinct(np.array([known.setdefault((x, self.data[s:e].tobytes()), len(known)) for x, s, e in words], np.int64))
        return codes, first

    def phrases(self) -> tuple[np.ndarray, ...]:
        """Of every distinct phrase: a place, its number of words, its fingerprint and how often it occurs.

        A run of n words is told by the number of its first n - 1 words and that of its last word, so
        equal numbers mean equal words whatever the fingerprints are.  Both are there: ``_to_read``.
        """
        out, words, shorter = [], np.empty(0, np.int64), np.empty(0, np.int64)
        for n, (at, found) in enumerate(self.runs, 1):
            if n == 1:
                codes, first = self._words()
            else:
                codes, first = _distinct(shorter[at] * len(words) + words[at + n - 1])
            shorter = np.full(len(self.lang), -1, np.int64)
            shorter[at] = codes
            words = shorter if n == 1 else words
            out.append((at[first], np.full(len(first), n), found[first], np.bincount(codes)))
        return tuple(np.concatenate(x) for x in zip(*out))


class BitMap:
    """Fingerprints that may be frequent."""

    def __init__(self, bits: bytes):
        self.words = np.frombuffer(bits, np.uint8)
        self.mask = np.uint64(len(bits) * 8 - 1)

    def has(self, fingerprints: np.ndarray) -> np.ndarray:
        slot = fingerprints & self.mask
        return (self.words[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _marked(piece: Slice, at: np.ndarray) -> np.ndarray:
    marks = np.zeros(len(piece.words), bool)
    marks[at] = True
    return marks


def _to_count(piece: Slice, lengths: Sequence[int], known: BitMap | None, level: int) -> Iterator[np.ndarray]:
    """Fingerprints of the runs of each length, all of whose runs of ``level`` words may be frequent."""
    if known is not None:
        inner = piece.places(level)
        good = _marked(piece, inner[known.has(piece.fingerprints(level, inner))])
    for n in lengths:
        at = piece.places(n)
        if known is not None:
            keep = np.ones(len(at), bool)
            for i in range(n - level + 1):
                keep &= good[at + i]
            at = at[keep]
        yield piece.fingerprints(n, at)


def _to_read(piece: Slice, known: BitMap) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each length, places and fingerprints of the runs that may be frequent, as may those inside them."""
    out, good = [], None
    for n in range(1, LONGEST + 1):
        at = piece.places(n)
        at = at if good is None else at[good[at] & good[at + 1]]
        found = piece.fingerprints(n, at)
        keep = known.has(found)
        out.append((at[keep], found[keep]))
        good = _marked(piece, at[keep])
    return out


def _slices(batch: pa.RecordBatch) -> Iterator[Slice]:
    for langs, texts in _cut_long(batch.column(0).to_pylist(), batch.column(1)):
        yield Slice(langs, texts)


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


def _parts(docs: DataFrame) -> int:
    """How many parts fingerprints and phrases of ``docs`` are dealt to."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, min(-(-size // PART_BYTES), MOST_PARTS), -(-size // MOST_PART_BYTES))


def _cuts(found: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of the sorted fingerprints begins, and their number."""
    bounds = np.array([-(-(i << 64) // parts) for i in range(parts)], np.uint64)
    return np.append(np.searchsorted(found, bounds), len(found))


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of ``values`` between each two of ``cuts``."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(rows: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column(name).to_pylist()), kind)


def _counted(docs: DataFrame, lengths: Sequence[int], level: int, bits: bytes | None, parts: int) -> DataFrame:
    """Rows fp, c, lang: how often each frequent fingerprint occurs; with ``bits`` None also, with a
    language and no fp, the number of words of each language.

    Fingerprints travel as packed arrays, a row for each part of their range, and are added up by part.
    """
    sent, least = docs.sparkSession.sparkContext.broadcast(bits), LEAST_COUNT
    names = ["part", "fps", "times", "lang", "c"]

    def dealt(found: list[np.ndarray]) -> pa.RecordBatch:
        values, times = np.unique(np.concatenate(found), return_counts=True)
        cuts = _cuts(values, parts)
        columns = [pa.array(np.arange(parts, dtype=np.int32)), _packed(values, cuts), _packed(times.astype(np.uint32), cuts), pa.nulls(parts, pa.string()), pa.nulls(parts, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(np.diff(cuts) > 0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = BitMap(sent.value) if sent.value is not None else None
        totals: dict[str, int] = {}
        held, size = [], 0
        for batch in batches:
            for piece in _slices(batch):
                if known is None:
                    for name, total in zip(piece.names, piece.totals().tolist()):
                        totals[name] = totals.get(name, 0) + total
                for found in _to_count(piece, lengths, known, level):
                    held.append(found)
                    size += len(found)
                if size >= BLOCK_RUNS:
                    yield dealt(held)
                    held, size = [], 0
        if held:
            yield dealt(held)
        if totals:
            # Parts of their own, below 0.
            part = [-1 - crc32(name.encode()) % parts for name in totals]
            columns = [pa.array(part, pa.int32()), pa.nulls(len(part), pa.binary()), pa.nulls(len(part), pa.binary()), pa.array(list(totals)), pa.array(list(totals.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def added(key: tuple, rows: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            sums = rows.group_by("lang", use_threads=False).aggregate([("c", "sum")])
            return pa.table({"fp": pa.nulls(len(sums), pa.int64()), "c": sums.column("c_sum"), "lang": sums.column("lang")})
        found = pa.table({"fp": _unpacked(rows, "fps", np.int64), "c": _unpacked(rows, "times", np.uint32).astype(np.int64)})
        sums = found.group_by("fp", use_threads=False).aggregate([("c", "sum")])
        sums = sums.filter(pc.greater_equal(sums.column("c_sum"), least))
        return pa.table({"fp": sums.column("fp"), "c": sums.column("c_sum"), "lang": pa.nulls(len(sums), pa.string())})

    rows = _read(docs).mapInArrow(count, "part int, fps binary, times binary, lang string, c long")
    return rows.groupBy("part").applyInArrow(added, "fp long, c long, lang string")


def bit_map(fingerprints: DataFrame) -> bytes:
    """The column ``fp`` as a bit map of at most ``MOST_BITS``: packed by Spark, a part at a time."""
    wanted = max(fingerprints.count() * BITS_EACH, LEAST_BITS)
    bits = min(1 << (wanted - 1).bit_length(), MOST_BITS)
    slot = F.col("fp").bitwiseAND(F.lit(bits - 1))
    part = F.floor(slot / _PART_BITS).cast("int")

    def pack(key: tuple, slots: pa.Table) -> pa.Table:
        packed = np.zeros(_PART_BITS, bool)
        packed[slots.column("at").to_numpy()] = True
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(packed, bitorder="little").tobytes()], pa.binary())})

    slots = fingerprints.select(part.alias("part"), F.pmod(slot, F.lit(_PART_BITS)).cast("int").alias("at")).distinct()
    whole = bytearray(bits // 8)
    for row in slots.groupBy("part").applyInArrow(pack, "part int, bits binary").toLocalIterator():
        begin = row["part"] * _PART_BITS // 8
        whole[begin : begin + _PART_BITS // 8] = row["bits"]
    return bytes(whole)


def _sent(block: Block, parts: int) -> Iterator[pa.RecordBatch]:
    """The distinct phrases of ``block`` as packed arrays, a row for each part of their fingerprints' range."""
    at, n, found, times = block.phrases()
    order = np.argsort(found)
    at, n, times = at[order], n[order], times[order].astype(np.uint32)
    cuts = _cuts(found[order], parts)
    begins, lang = block.starts[at], block.lang[at].astype(np.int32)
    sizes = block.ends[at + n - 1] - 1 - begins
    text_cuts = np.append(0, np.cumsum(sizes))[cuts]
    first = 0
    while first < parts:
        last = max(first + 1, int(np.searchsorted(text_cuts, text_cuts[first] + SENT_BYTES, "right")) - 1)
        own = slice(cuts[first], cuts[last])
        used, codes = np.unique(lang[own], return_inverse=True)
        inner, inner_text = cuts[first : last + 1] - cuts[first], text_cuts[first : last + 1] - text_cuts[first]
        names = pa.array([[block.names[i] for i in used.tolist()]], pa.list_(pa.string())).take(pa.array(np.zeros(last - first, np.int64)))
        columns = [
            pa.array(np.arange(first, last, dtype=np.int32)), names, _packed(codes.astype(np.int32), inner), _packed(times[own], inner),
            _packed(sizes[own].astype(np.int32), inner), _packed(block.data[_within(begins[own], sizes[own])], inner_text),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "names", "langs", "times", "sizes", "texts"]).filter(pa.array(np.diff(inner) > 0))
        first = last


def _texts(docs: DataFrame, bits: bytes, parts: int) -> DataFrame:
    """lang, n, phrase, a of every phrase of up to ``LONGEST`` words that is frequent."""
    sent, least = docs.sparkSession.sparkContext.broadcast(bits), LEAST_COUNT

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = BitMap(sent.value)
        held, runs, size = [], [], 0
        for batch in batches:
            for piece in _slices(batch):
                held.append(piece)
                runs.append(_to_read(piece, known))
                size += len(piece.words)
                if size >= BLOCK_WORDS:
                    yield from _sent(Block(held, runs), parts)
                    held, runs, size = [], [], 0
        if held:
            yield from _sent(Block(held, runs), parts)

    def added(rows: pa.Table) -> pa.Table:
        place: dict[str, int] = {}
        langs = []
        for names, codes in zip(rows.column("names").to_pylist(), rows.column("langs").to_pylist()):
            langs.append(np.array([place.setdefault(x, len(place)) for x in names], np.int64)[np.frombuffer(codes, np.int32)])
        offsets = np.append(0, np.cumsum(_unpacked(rows, "sizes", np.int32), dtype=np.int64))
        text = pa.py_buffer(b"".join(rows.column("texts").to_pylist()))
        phrases = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), text])
        found = pa.table({"lang": np.concatenate(langs), "phrase": phrases, "a": _unpacked(rows, "times", np.uint32).astype(np.int64)})
        sums = found.group_by(["lang", "phrase"], use_threads=False).aggregate([("a", "sum")])
        sums = sums.filter(pc.greater_equal(sums.column("a_sum"), least))
        phrase = sums.column("phrase").cast(pa.string())
        n = pc.add(pc.count_substring(phrase, " "), 1).cast(pa.int32())
        lang = pa.array(list(place), pa.string()).take(sums.column("lang"))
        return pa.table({"lang": lang, "n": n, "phrase": phrase, "a": sums.column("a_sum")})

    schema = "part int, names array<string>, langs binary, times binary, sizes binary, texts binary"
    rows = _read(docs).mapInArrow(cut, schema)
    return rows.groupBy("part").applyInArrow(added, "lang string, n int, phrase string, a long")


@contextmanager
def _short_batches(spark: SparkSession) -> Iterator[None]:
    """Texts go to Python at most ``BATCH_ROWS`` at a time: a batch is held by the JVM and by Python at
    once, beside the slice that is worked on."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def frequent_phrases(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Phrases (lang, n, phrase, a) and words per language (lang, n) of ``docs`` (lang, text)."""
    with _short_batches(docs.sparkSession):
        parts = _parts(docs)
        words = materialize(_counted(docs, (1,), 1, None, parts), "words")
        totals = words.filter("lang IS NOT NULL").select("lang", F.col("c").alias("n"))
        frequent = words.filter("lang IS NULL").select("fp")
        for lengths, level in (((2,), 1), ((3, 4), 2)):
            found = materialize(_counted(docs, lengths, level, bit_map(frequent), parts), "runs")
            frequent = frequent.unionByName(found.select("fp"))
        return materialize(_texts(docs, bit_map(frequent), parts), "phrases"), totals


def _exact(column: Column) -> Column:
    return column.cast("decimal(30,0)")


def collocations(docs: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """The ``most`` best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    phrases, totals = frequent_phrases(docs)
    candidates = phrases.filter("n > 1")
    words = F.split("phrase", " ")

    def part(begin: Column, size: Column) -> Column:
        return F.array_join(F.slice(words, begin, size), " ")

    # Every cut of every candidate: two parts, whose counts are looked up.
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("n") - 1),
        lambda k: F.array(
            F.struct(k.alias("k"), F.lit(True).alias("is_left"), part(F.lit(1), k).alias("part")),
            F.struct(k.alias("k"), F.lit(False).alias("is_left"), part(k + 1, F.col("n") - k).alias("part")),
        ),
    )
    parts = candidates.select("lang", "phrase", "a", F.explode(F.flatten(cuts)).alias("cut")).select("lang", "phrase", "a", "cut.*")
    counts = phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    parts = join_lookup(parts, counts, ["lang", "part"])

    # What lies inside a longer candidate, with the count of that one.
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("n") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("n") - size + 1), lambda begin: part(begin, size)),
        )
    )
    longer = candidates.filter("n > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))

    side = {f"{s}{k}": F.max(F.when((F.col("k") == k) & (F.col("is_left") == (s == "l")), F.col("f"))) for k in range(1, LONGEST) for s in "lr"}
    rows = parts.unionByName(longer, allowMissingColumns=True).groupBy("lang", "phrase")
    rows = rows.agg(F.max("a").alias("a"), F.max("longer").alias("longer"), *[c.alias(name) for name, c in side.items()])
    covered = 100 * _exact(F.col("longer")) >= COVERED_PERCENT * _exact(F.col("a"))
    rows = rows.filter(F.col("longer").isNull() | ~covered)

    def cut(k: int) -> Column:
        score = F.expr(f"(cast({SCORE_SCALE} as decimal(8,0)) * cast(a as decimal(30,0))) div (cast(l{k} as decimal(30,0)) + cast(r{k} as decimal(30,0)))")
        found = F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
        return F.when(F.col(f"l{k}").isNotNull(), found)

    worst = F.array_min(F.array(*[cut(k) for k in range(1, LONGEST)])).alias("worst")
    rows = rows.select("lang", "phrase", "a", worst).select("lang", "phrase", "a", "worst.l", "worst.r", "worst.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
