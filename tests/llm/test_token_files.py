"""Encoding, token files and packing against the libraries."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from promptmill.llm import packing, pieces, repair, token_files, wordbpe
from promptmill.session import scratch_path

WORDS = wordbpe.WordEncoder(wordbpe.vocabulary("word_bpe_49k.json"))
PIECES = pieces.PieceEncoder(pieces.model_bytes("piece_bpe_32k.model"))
LETTERS = st.one_of(
    st.sampled_from("abZ's'tre've'll'd 09.,!<|>endoftext|éÉßÖİſΣ́ \x85\xa0\x1c\x00_½▁\n"),
    st.characters(exclude_categories=["Cs"]),
)
TEXTS = st.lists(st.one_of(st.none(), st.text(LETTERS, max_size=40), st.text(" ▁\na", max_size=60)), max_size=4)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_words_encode_as_the_library_does(texts):
    ids, offsets = WORDS.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == WORDS.full(text or "")


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_pieces_encode_as_the_library_does(texts):
    found = PIECES.encode(pa.array(texts, pa.string())).to_pylist()
    assert found == [PIECES.library.encode(text or "", add_eos=True) for text in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=400), st.integers(0, 400), st.integers(0, 400))
def test_grammar_round_trip_and_ranges(ids, start, end):
    repair_least, repair.LEAST_COUNT = repair.LEAST_COUNT, 2
    try:
        data = repair.pack([1, None], np.array([len(ids), 0]), np.array(ids, "<u4"))
    finally:
        repair.LEAST_COUNT = repair_least
    block = repair.Block(data)
    assert block.tokens().tolist() == ids
    assert block.tokens(start, end).tolist() == ids[start:end]
    assert block.doc_ids == [1, None]


def test_grammar_saves_room_and_refuses_other_bytes():
    ids = np.tile(np.arange(50, dtype="<u4"), 2000)
    assert len(repair.pack([1], np.array([len(ids)]), ids)) < len(ids) / 2
    with pytest.raises(ValueError):
        repair.Block(b"x" * 100)


def test_token_files(spark, odd_docs):
    docs, rows = odd_docs
    path = scratch_path(spark, "files")
    token_files.write_tokens(docs, path, block_tokens=20_000)
    found = token_files.read_tokens(spark, path).collect()
    ids = {(r.doc_id, bytes(r.ids)): r for r in found}
    expected = sorted(((i, np.array([*WORDS.full(t or ""), 2], "<u4").tobytes()) for i, t, _ in rows), key=str)
    assert sorted(((r.doc_id, bytes(r.ids)) for r in found), key=str) == expected
    start = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == start
        start += len(r.ids) // 4
    ordered = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ordered == sorted(ordered, key=lambda i: -1 if i is None else i) and ids


def test_token_files_of_nothing(spark, make_docs):
    path = scratch_path(spark, "files")
    token_files.write_tokens(make_docs([]), path)
    assert token_files.read_tokens(spark, path).count() == 0


def _check_packing(spark, docs, rows, size):
    ids = packing.token_pieces(docs, size=size, keep_ids=True)
    found = packing.pack_pieces(packing.token_pieces(docs, size=size), size=size, shard_pieces=8).collect()
    expected = []
    for i, text, _ in rows:
        own = np.array([*WORDS.full(text or ""), 0], "<u4")
        expected += [(i, k, k * size, zlib.crc32(own[k * size :][:size].tobytes())) for k in range(-(-len(own) // size))]
    assert sorted(((r.doc_id, r.piece, r.start, r.ids_crc32) for r in found), key=str) == sorted(expected, key=str)
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    return found, ids


def test_packing(spark, odd_docs):
    docs, rows = odd_docs
    _check_packing(spark, docs, rows, 64)


def test_packed_sequences_hold_the_ids(spark, make_docs):
    rows = [(i, "some words " * i, "en") for i in range(1, 9)]
    found, ids = _check_packing(spark, make_docs(rows), rows, 16)
    packed = spark.createDataFrame(found)
    sequences = packing.sequences(packed, ids, 16).collect()
    assert sum(len(r.ids) for r in sequences) == 4 * sum(r.length for r in found)
    assert {r.sequence_id for r in sequences} == {r.sequence_id for r in found}


def test_packing_of_nothing(make_docs):
    assert packing.pack_pieces(packing.token_pieces(make_docs([]))).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=80))
def test_sum_of_squares_places_everything_once(lengths):
    found = packing.sum_of_squares(np.array(lengths, np.int64), 32)
    assert sorted(i for s in found for i in s) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in s) <= 32 for s in found)


def test_sum_of_squares_wastes_little():
    # Short enough that the tokens, not the pieces, bound the number of sequences.
    lengths = np.random.default_rng(1).integers(1, 700, 5000)
    assert len(packing.sum_of_squares(lengths)) <= 1.01 * lengths.sum() / 2048 + 1


def test_sentencepiece_round_trip(odd_docs):
    docs, rows = odd_docs
    library: sentencepiece.SentencePieceProcessor = PIECES.library
    found = pieces.decode_ids(pieces.encode_texts(docs)).collect()
    expected = [(i, ids := library.encode(t or "", add_eos=True), library.decode(ids)) for i, t, _ in rows]
    assert sorted(((r.doc_id, r.ids, r.text) for r in found), key=str) == sorted(expected, key=str)
