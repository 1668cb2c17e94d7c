"""SentencePiece encoding of merge-type (BPE) models by backtracking, and decoding.

Merging happens inside a run of spaces with the word after it, since no piece of such a model goes
on behind a space.  So a text is cut in front of spaces, and the ids of each distinct chunk are found
once per worker and remembered (a bounded memory that only saves time).

A chunk is encoded without a queue of merges.  An Aho-Corasick automaton gives the longest piece at
every position.  Pieces are taken greedily; a piece may follow another only if merging the
characters of both would end in exactly these two (``_Merges.fit``).  If no piece fits, the last one
is given up for its next shorter prefix, and a bit field marks the position as one that nothing
leads on from, so it is never tried again.  A sequence whose neighbours all fit is what merging gives.
Characters outside the vocabulary separate chunks and become byte pieces or the unknown id.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..functions.worker import once_per_worker
from .wordbpe import _Remembering, text_slices

SPACE = "▁"
_CHUNKS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def model_bytes(name_or_path: str) -> bytes:
    """A model file: a path, or the name of a file of the public collection.  Sent with the tasks."""
    path = name_or_path
    if not os.path.isabs(path):
        import public_tokenizers

        path = public_tokenizers.path(name_or_path)
    with open(path, "rb") as file:
        return file.read()


class _Merges:
    """What merging does to characters: pieces, their priority and how each is last merged."""

    def __init__(self, scores: dict[str, float]):
        # Equal scores share a rank: the leftmost pair goes first.
        ranks = {score: i for i, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {piece: ranks[score] for piece, score in scores.items()}
        self.halves: dict[str, tuple[str, str]] = {}
        self.reachable = {p for p in self.rank if len(p) == 1 or self._last_merge(p)}

    def _last_merge(self, piece: str) -> bool:
        """Merge the characters of a piece; true if it comes out whole.  Keeps its two halves."""
        parts = list(piece)
        last = None
        while len(parts) > 1:
            best = None
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best[0]):
                    best = rank, i
            if best is None:
                return False
            i = best[1]
            last = parts[i], parts[i + 1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        self.halves[piece] = last
        return True

    def fit(self, left: str, right: str) -> bool:
        """Whether merging the characters of both ends in exactly ``left`` and ``right``.

        Goes back in time: the later of the two merges that made the neighbours is undone, and the
        pair that then met at the border must not have been due earlier.  At equal rank the pair
        further left was due first.
        """
        limit = float("inf")
        while True:
            across = self.rank.get(left + right)
            if across is not None and across < limit:
                return False
            left_half, right_half = self.halves.get(left), self.halves.get(right)
            if left_half is None and right_half is None:
                return True
            if right_half is None or (left_half is not None and self.rank[left] > self.rank[right]):
                limit = self.rank[left]
                left = left_half[1]
            else:
                limit = self.rank[right] + 1
                right = right_half[0]


class PieceEncoder:
    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        sp, size = self.library, self.library.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        scores = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        if any(SPACE in piece.lstrip(SPACE) for piece in scores):
            raise ValueError("pieces of this model go on behind a space")
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.bytes = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.merges = _Merges(scores)
        self.automaton = ahocorasick.Automaton()
        for piece in self.merges.reachable:
            self.automaton.add_word(piece, (piece, len(piece) - 1))
        self.automaton.make_automaton()
        self.shorter = {}
        for piece in self.merges.reachable:
            cuts = (piece[:n] for n in range(len(piece) - 1, 0, -1))
            self.shorter[piece] = next((c for c in cuts if c in self.merges.reachable), None)
        letters = "".join(map(re.escape, sorted({c for piece in scores for c in piece})))
        self.known = re.compile(f"[{letters}]+|[^{letters}]")
        self.plain_spaces = sp.normalize(" a  Bﬁ ") == f"{SPACE}{SPACE}a{SPACE}{SPACE}Bﬁ{SPACE}"
        self.fits = _Remembering(lambda pair: self.merges.fit(*pair))
        self.chunks = _Remembering(self._chunk)

    def _backtrack(self, text: str) -> list[int]:
        """Ids of characters of the vocabulary."""
        longest: list[str | None] = [None] * len(text)
        # Matches come by their end, so the last one from a start is its longest.
        for end, (piece, reach) in self.automaton.iter(text):
            longest[end - reach] = piece
        open_at = (1 << len(text) + 1) - 1
        taken: list[str] = []
        at, piece = 0, longest[0]
        while at < len(text):
            while piece is not None:
                end = at + len(piece)
                if open_at >> end & 1 and (not taken or self.fits[taken[-1], piece]):
                    break
                piece = self.shorter[piece]
            if piece is not None:
                taken.append(piece)
                at += len(piece)
                piece = longest[at] if at < len(text) else None
            else:
                open_at &= ~(1 << at)
                piece = taken.pop()
                at -= len(piece)
        return [self.ids[p] for p in taken]

    def _chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        for part in self.known.findall(chunk):
            if part[0] in self.ids:
                ids += self._backtrack(part)
            elif self.bytes:
                ids += [self.bytes[b] for b in part.encode()]
            else:
                ids.append(self.unknown)
        return array("I", ids).tobytes()

    def text(self, text: str) -> bytes:
        """Ids of one text, 4 bytes each."""
        if not text:
            return b""
        normal = SPACE + text.replace(" ", SPACE) if self.plain_spaces else self.library.normalize(text)
        return b"".join(map(self.chunks.__getitem__, _CHUNKS.findall(normal)))

    def encode(self, texts: pa.Array, end: bool = True) -> pa.ListArray:
        """Ids of all texts, with the end id; a null text has only that."""
        texts = pc.fill_null(texts, "")
        odd = pc.or_(pc.match_substring_regex(texts, "^ |  | $"), pc.or_(pc.match_substring(texts, SPACE), pc.equal(texts, "")))
        found: list[bytes]
        if not self.plain_spaces:
            odd = pa.array([True] * len(texts))
        words = pc.split_pattern(texts, " ")
        coded = words.flatten().dictionary_encode()
        known = [self.chunks[SPACE + w] if w else b"" for w in coded.dictionary.to_pylist()]
        codes, bounds = coded.indices.to_numpy(), words.offsets.to_numpy()
        bounds = (bounds - bounds[0]).tolist()
        found = []
        tail = array("I", [self.library.eos_id()] if end else []).tobytes()
        for i, slow in enumerate(odd.to_pylist()):
            if slow:
                found.append(self.text(texts[i].as_py()) + tail)
            else:
                found.append(b"".join([known[c] for c in codes[bounds[i] : bounds[i + 1]].tolist()]) + tail)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4").astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids))


def encoder(model: bytes) -> PieceEncoder:
    return once_per_worker(("piece encoder", hash(model)), lambda: PieceEncoder(model), alone=True)


def encode_texts(docs: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """Rows doc_id, ids (array of int) of ``docs`` (doc_id, text), each with the end id.

    Defined cases: a null or empty text is only the end id; repeated rows stay; an empty table gives
    no rows; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model_bytes(model))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = 0
            for texts in text_slices(batch.column(1)):
                ids = encoder(sent.value).encode(texts)
                own = batch.column(0).slice(at, len(texts)).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([own, ids], names=["doc_id", "ids"])
                at += len(texts)

    return docs.select("doc_id", "text").mapInArrow(batches, "doc_id long, ids array<int>")


def _decoded(library, ids: pa.ListArray) -> pa.Array:
    """The library's own decoding of every list; null lists are empty."""
    texts: list[str] = []
    for at in range(0, len(ids), 200):
        part = ids.slice(at, 200)
        # Null lists have no values here; slices of one plain list are far cheaper than Arrow's lists.
        flat = part.flatten().to_numpy(zero_copy_only=False).tolist()
        ends = np.cumsum(pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)).tolist()
        texts += library.decode([flat[begin:end] for begin, end in zip([0, *ends], ends)])
    return pa.array(texts, pa.string())


def decode_ids(encoded: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """``encoded`` (doc_id, ids) with ``text``, by the library's own decoding.  Null ids are none."""
    sent = encoded.sparkSession.sparkContext.broadcast(model_bytes(model))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = _decoded(encoder(sent.value).library, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(batches, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """``decode_ids(encode_texts(docs))`` in one pass over the texts."""
    sent = docs.sparkSession.sparkContext.broadcast(model_bytes(model))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = 0
            for texts in text_slices(batch.column(1)):
                pieces = encoder(sent.value)
                ids = pieces.encode(texts)
                own = batch.column(0).slice(at, len(texts)).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([own, ids, _decoded(pieces.library, ids)], names=["doc_id", "ids", "text"])
                at += len(texts)

    return docs.select("doc_id", "text").mapInArrow(batches, "doc_id long, ids array<int>, text string")
