"""Quality rules on tokeniser fertility: how public vocabularies cut the words of a text.

Natural text of a language is cut alike everywhere: so many characters per token, hardly a byte
token, tokens spread so and so.  Text that a vocabulary was not made for (encoded data, wrong
encodings, letter noise, endless repetition) is cut otherwise.  Measured are, over the words of a
whole text, each encoded on its own:

* characters per token of every vocabulary,
* the share of byte-fallback tokens of the first one,
* the entropy of its tokens, as a share of the largest that their number allows.

The rejection bands are learned from all documents that pass the base rules.  Measures are put into
fixed bins and the bins counted for every language and length class (power of two of the words), so
the counts are exact, pre-aggregated and the same however rows are dealt.  A band reaches from the
median by ``REACH`` times the distance of the outer deciles, and at least by a fixed reach for each
measure.  A language and length with fewer than ``LEAST_DOCS`` documents takes the band of its
language, then of its script and length, then of its script; without any the base rules alone decide.

Defined cases: a null text has no words; a null language is the script's; repeated rows are measured
each; an empty table gives no rows; other columns are ignored.  Very long texts are read whole.
"""

from __future__ import annotations

from array import array
from base64 import b64decode
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.worker import once_per_worker
from ..operators.skew import join_lookup
from ..session import materialize
from .pieces import model_bytes
from .wordbpe import REMEMBERED, text_slices

PIECES, RANKS = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
# How the second vocabulary cuts text before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAST_WORDS, MOST_REPEATED = 50, 50
LEAST_DOCS = 200
REACH = 4.0
#: Measures, width of a bin and least reach of a band.
MEASURES = {
    "chars_per_piece": (0.01, 0.5),
    "chars_per_byte_token": (0.01, 0.5),
    "byte_share": (0.001, 0.02),
    "entropy_share": (0.001, 0.05),
}
#: Groups that may have a band of their own, the closest first.
LEVELS = ["by_language_length", "by_language", "by_script_length", "by_script"]
# First code points of runs of scripts (fixed values); 0 is any other.
_SCRIPTS = [
    (0x0000, 1), (0x0370, 2), (0x0400, 3), (0x0530, 0), (0x0590, 4), (0x0600, 5), (0x0700, 0), (0x0900, 6),
    (0x0980, 0), (0x0E00, 7), (0x0E80, 0), (0x10A0, 8), (0x1100, 9), (0x1200, 0), (0x1E00, 1), (0x1F00, 2),
    (0x2000, 0), (0x3040, 10), (0x3100, 0), (0x3400, 11), (0xA000, 0), (0xAC00, 9), (0xD7B0, 0), (0xF900, 11), (0xFB00, 0),
]
SCRIPT_NAMES = ["other", "latin", "greek", "cyrillic", "hebrew", "arabic", "devanagari", "thai", "georgian", "hangul", "kana", "han"]
_STARTS = [start for start, _ in _SCRIPTS]
_MIX = np.uint64(0x9E3779B97F4A7C15)


def script(word: str) -> int:
    """Script of the first letter of a word, 0 without any."""
    if word.isascii():
        return int(any(map(str.isalpha, word)))
    for c in word:
        if c.isalpha():
            return _SCRIPTS[bisect_right(_STARTS, ord(c)) - 1][1]
    return 0


class Vocabularies:
    """Facts of words; remembers those it has met (a bounded memory that only saves time)."""

    def __init__(self, pieces: bytes, ranks: bytes):
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        merges = {b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self.bytes = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
        self.known: dict[str, tuple[bytes, int, int]] = {}

    def facts(self, words: list[str]) -> list[tuple[bytes, int, int]]:
        """For each word its piece ids, number of tokens of the other vocabulary, and script."""
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        known, tokens = self.known, self.bytes.encode_ordinary
        new = [w for w in words if w not in known]
        for word, ids in zip(new, self.pieces.encode(new, num_threads=1)):
            known[word] = (array("I", ids).tobytes(), len(tokens(" " + word)), script(word))
        return list(map(known.__getitem__, words))


def _state(pieces: bytes, ranks: bytes) -> Vocabularies:
    key = ("fertility", hash(pieces), hash(ranks))
    return once_per_worker(key, lambda: Vocabularies(pieces, ranks), alone=True)


def _repeats(doc: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Whether each word lies in a window of three words that its document holds twice or more."""
    found = np.zeros(len(doc), bool)
    at = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.empty(0, np.int64)
    if len(at) < 2:
        return found
    key = doc[at].astype(np.uint64)
    for i in range(3):
        key = (key ^ (key >> np.uint64(29))) * _MIX + word[at + i].astype(np.uint64)
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]

    def equal() -> np.ndarray:
        a, b = at[order[1:]], at[order[:-1]]
        whole = doc[a] == doc[b]
        for i in range(3):
            whole &= word[a + i] == word[b + i]
        return whole

    # Windows of one hash are compared themselves; if two differ, the order is made of the words.
    if not np.array_equal(whole := equal(), same):
        order = np.lexsort((word[at + 2], word[at + 1], word[at], doc[at]))
        whole = equal()
    twice = np.concatenate([order[1:][whole], order[:-1][whole]])
    for i in range(3):
        found[at[twice] + i] = True
    return found


def _measures(texts: pa.Array, state: Vocabularies) -> dict[str, np.ndarray]:
    n = len(texts)
    texts = pc.fill_null(texts, "")
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    distinct = coded.dictionary
    code = coded.indices.to_numpy()
    bounds = split.offsets.to_numpy()
    doc = np.repeat(np.arange(n), np.diff(bounds))
    # White space at an end leaves an empty word.
    real = (pc.binary_length(distinct).to_numpy() > 0)[code]
    doc, code = doc[real], code[real]

    def total(of_word: np.ndarray) -> np.ndarray:
        return np.bincount(doc, of_word[code], n).astype(np.int64)

    out = {"n_words": np.bincount(doc, minlength=n).astype(np.int64)}
    out["word_chars"] = total(pc.utf8_length(distinct).to_numpy())
    out["n_symbols"] = total(pc.count_substring_regex(distinct, "[#*$%&|<>]").to_numpy())
    lines = pc.split_pattern(texts, "\n")
    line = lines.flatten().dictionary_encode()
    line_doc = np.repeat(np.arange(n), np.diff(lines.offsets.to_numpy()))
    line_code = line.indices.to_numpy()
    worded = pc.match_substring_regex(line.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)[line_code]
    line_doc, line_code = line_doc[worded], line_code[worded]
    firsts = np.unique((line_doc << 32) | line_code) >> 32
    out["n_dup_lines"] = np.bincount(line_doc, minlength=n) - np.bincount(firsts, minlength=n)
    out["n_repeat_words"] = np.bincount(doc[_repeats(doc, code)], minlength=n)

    facts = state.facts(distinct.to_pylist())
    sizes = np.fromiter((len(f[0]) for f in facts), np.int64, len(facts)) // 4
    flat = np.frombuffer(b"".join(f[0] for f in facts), "<u4")
    starts = np.cumsum(sizes) - sizes
    out["n_pieces"] = total(sizes)
    out["n_byte_tokens"] = total(np.fromiter((f[1] for f in facts), np.int64, len(facts)))
    of_bytes = np.bincount(np.repeat(np.arange(len(facts)), sizes), state.is_byte[flat], len(facts))
    out["n_bytes"] = total(of_bytes)
    # Ids of all words in order, and how often each document has each of them.
    size = sizes[code]
    ends = np.cumsum(size)
    ids = flat[np.repeat(starts[code] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
    key, count = np.unique((np.repeat(doc, size) << 32) | ids, return_counts=True)
    pieces = np.maximum(out["n_pieces"], 1)
    spent = np.bincount(key >> 32, count * np.log2(count), n) / pieces
    out["entropy"] = np.where(out["n_pieces"] > 0, np.log2(pieces) - spent, 0.0)
    scripts = np.fromiter((f[2] for f in facts), np.int64, len(facts))
    votes = np.bincount(doc * len(SCRIPT_NAMES) + scripts[code], minlength=n * len(SCRIPT_NAMES))
    # Words without a letter have no say unless there are no others.
    votes = votes.reshape(n, -1) * np.array([0] + [1] * (len(SCRIPT_NAMES) - 1))
    out["script"] = votes.argmax(axis=1).astype(np.int32) * (votes.max(axis=1, initial=0) > 0)
    return out


_FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_pieces long, "
    "n_byte_tokens long, n_bytes long, entropy double, script int"
)


def measure(docs: DataFrame, keep: Sequence[str] = ("doc_id",), pieces: str = PIECES, ranks: str = RANKS) -> DataFrame:
    """Base counts and token counts of every row of ``docs`` (text and the columns of ``keep``)."""
    context = docs.sparkSession.sparkContext
    sent = context.broadcast((model_bytes(pieces), model_bytes(ranks)))
    names = [f.split()[0] for f in _FIELDS.split(", ")]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = 0
            for texts in text_slices(batch.column(0)):
                found = _measures(texts, _state(*sent.value))
                own = [batch.column(i).slice(at, len(texts)) for i in range(1, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(found[c]) for c in names)], names=[*keep, *names])
                at += len(texts)

    own = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select("text", *keep).mapInArrow(batches, f"{own}, {_FIELDS}")


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _bins() -> Column:
    """The measures in bins."""

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))

    most = F.log2(F.greatest(F.col("n_pieces"), F.lit(2)))
    values = [share("word_chars", "n_pieces"), share("word_chars", "n_byte_tokens"), share("n_bytes", "n_pieces"), F.col("entropy") / most]
    return F.array(*[F.floor(v / width).cast("long") for v, (width, _) in zip(values, MEASURES.values())])


def bands(measured: DataFrame) -> DataFrame:
    """``group`` with ``low`` and ``high``, arrays of bins, of every group with enough documents."""
    at_level = F.array(*LEVELS)
    rows = measured.filter(~F.col("base_failed")).select(F.explode(at_level).alias("group"), F.posexplode("bins").alias("m", "bin"))
    counts = rows.filter(F.col("group").isNotNull()).groupBy("group", "m", "bin").agg(F.count("*").alias("n"))
    along = "over (partition by group, m order by bin)"
    whole = "over (partition by group, m)"
    shares = counts.selectExpr("group", "m", "bin", f"sum(n) {along} as upto", f"sum(n) {whole} as docs").filter(F.col("docs") >= LEAST_DOCS)

    def decile(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= share * F.col("docs"), F.col("bin")))

    found = shares.groupBy("group", "m").agg(decile(0.1).alias("lower"), decile(0.5).alias("middle"), decile(0.9).alias("upper"))
    least = F.array(*[F.lit(least / width) for width, least in MEASURES.values()])[F.col("m")]
    low = F.col("middle") - F.greatest(least, REACH * (F.col("middle") - F.col("lower")))
    high = F.col("middle") + F.greatest(least, REACH * (F.col("upper") - F.col("middle")))
    found = found.select("group", F.struct("m", low.alias("low"), high.alias("high")).alias("band"))
    # One struct for each measure.
    one = found.groupBy("group").agg(F.array_sort(F.collect_list("band")).alias("bands"))
    return one.select("group", F.col("bands")["low"].alias("low"), F.col("bands")["high"].alias("high"))


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang) as doc_id, base counts, ``base_failed``, ``kept`` and token counts."""
    measured = measure(docs, ("doc_id", "lang"))
    length = F.concat(F.lit(":"), F.floor(F.log2(F.greatest(F.col("n_words"), F.lit(1)))).cast("string"))
    by_script = F.concat(F.lit("script "), F.col("script").cast("string"))
    measured = measured.select(
        "*",
        base_failed().alias("base_failed"),
        _bins().alias("bins"),
        F.concat(F.lit("language"), length, F.lit(" "), F.col("lang")).alias("by_language_length"),
        F.concat(F.lit("language "), F.col("lang")).alias("by_language"),
        F.concat(by_script, length).alias("by_script_length"),
        by_script.alias("by_script"),
    )
    measured = materialize(measured, "fertility")
    found = bands(measured)
    # Which band holds for whom: few rows, one for each language, script and length that occur.
    wide = measured.groupBy(*LEVELS).agg(F.lit(1).alias("_one")).drop("_one")
    for i, level in enumerate(LEVELS):
        named = found.select(F.col("group").alias(level), F.struct("low", "high").alias(f"band_{i}"))
        wide = wide.join(named, level, "left")
    combined = F.concat_ws("\t", F.col("by_language_length"), F.lit("|"), F.col("by_script_length"))
    band = F.coalesce(*[F.col(f"band_{i}") for i in range(len(LEVELS))])
    lookup = materialize(wide.select(combined.alias("combined"), band.alias("band")), "bands")
    rows = join_lookup(measured.withColumn("combined", combined), lookup, "combined")
    inside = F.forall(
        F.arrays_zip(F.col("bins").alias("bin"), F.col("band.low").alias("low"), F.col("band.high").alias("high")),
        lambda x: (x["bin"] >= x["low"]) & (x["bin"] <= x["high"]),
    )
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return rows.select("doc_id", *base, kept.alias("kept"), "n_pieces", "n_byte_tokens", "n_bytes", "entropy")
