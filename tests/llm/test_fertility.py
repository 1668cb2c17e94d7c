"""Fertility rules: counts against a plain model, bands on noise and clean text."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from promptmill.llm import fertility
from promptmill.llm.pieces import model_bytes


@pytest.fixture(scope="module")
def state():
    return fertility.Vocabularies(model_bytes(fertility.PIECES), model_bytes(fertility.RANKS))


def _model(text, state):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    ids = [i for w in words for i in state.pieces.encode(w)]
    n = len(ids)
    entropy = math.log2(n) - sum(c * math.log2(c) for c in Counter(ids).values()) / n if n else 0.0
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_pieces": n,
        "n_byte_tokens": sum(len(state.bytes.encode_ordinary(" " + w)) for w in words),
        "n_bytes": sum(state.pieces.is_byte(i) for i in ids),
        "entropy": pytest.approx(entropy, abs=1e-9),
    }


_TEXT = st.lists(
    st.sampled_from(["a", "bc", "#x", "Ünï", "中文", " ", "  ", "\n", "\t", "\x0b", "\x1f", "\xa0", "<|b", "🙂", "a b a", "\r\n"]), max_size=40
).map(" ".join)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), _TEXT), min_size=1, max_size=5))
def test_counts_equal_a_plain_model(state, texts):
    found = fertility._measures(pa.array(texts, pa.string()), state)
    for i, text in enumerate(texts):
        expected = _model(text, state)
        assert {k: found[k][i] for k in expected} == expected


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    import numpy as np

    monkeypatch.setattr(fertility, "_MIX", np.uint64(0))
    doc = np.zeros(9, np.int64)
    word = np.array([1, 2, 3, 4, 1, 2, 3, 5, 3])
    assert fertility._repeats(doc, word).tolist() == [True, True, True, False, True, True, True, False, False]


def test_bands_reject_noise_and_keep_clean_text(spark, make_docs):
    rng = random.Random(1)
    syllables = ["ver", "ein", "lich", "ung", "ge", "keit", "sch", "ach", "der", "ie"]
    sounds = ["la", "mo", "ti", "re", "the", "in", "and", "on", "er"]
    rows = []
    for i in range(600):
        of = syllables if i % 2 else sounds
        words = ["".join(rng.choices(of, k=rng.randint(1, 4))) for _ in range(rng.randint(60, 300))]
        rows.append((i, " ".join(words), "de" if i % 2 else "en"))
    noise = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=4000))
    rows += [
        (1000, " ".join(noise[i : i + 40] for i in range(0, 4000, 40)), "en"),
        (1001, " ".join(chr(0x13000 + rng.randrange(900)) * 3 for _ in range(120)), "en"),
        (1002, "few words", "en"),
        (1003, "one two three " * 60, "en"),
        (1004, None, None),
        (None, rows[0][1], None),
        (1005, rows[0][1], "xx"),
        (1005, rows[0][1], "xx"),
    ]
    found = {}
    for r in fertility.judge(make_docs(rows)).collect():
        found.setdefault(r.doc_id, []).append((r.base_failed, r.kept))
    clean = [found[i] for i in range(600)]
    assert clean.count([(False, True)]) >= 598
    assert found[1000] == found[1001] == [(False, False)]
    assert found[1002] == found[1003] == found[1004] == [(True, False)]
    assert found[None] == [(False, True)]
    assert found[1005] == [(False, True)] * 2


def test_bands_equal_exact_deciles(spark, make_docs):
    rng = random.Random(2)
    rows = [(i, " ".join((str(rng.randrange(10 ** rng.randint(1, 6))) for _ in range(100))), "en") for i in range(250)]
    docs = make_docs(rows)
    measured = fertility.measure(docs).withColumn("base_failed", fertility.base_failed()).withColumn("bins", fertility._bins())
    measured = measured.selectExpr("*", "'g' as by_language_length", "cast(null as string) as by_language", "cast(null as string) as by_script_length", "'s' as by_script")
    bins = sorted(r.bins[0] for r in measured.filter("not base_failed").select("bins").collect())
    lower, middle, upper = (bins[math.ceil(s * len(bins)) - 1] for s in (0.1, 0.5, 0.9))
    band = {r.group: (r.low[0], r.high[0]) for r in fertility.bands(measured).collect()}
    expected = (middle - max(50, 4 * (middle - lower)), middle + max(50, 4 * (upper - middle)))
    assert band == {"g": pytest.approx(expected), "s": pytest.approx(expected)}


def test_empty_and_odd_tables(spark, make_docs, odd_docs):
    assert fertility.judge(make_docs([])).collect() == []
    docs, rows = odd_docs
    assert len(fertility.judge(docs).collect()) == len(rows)
