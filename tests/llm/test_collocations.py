"""Collocations against a plain model, also where fingerprints collide and texts are cut."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from promptmill.llm import collocations as co


def _lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def _model(rows, least, most):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", _lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + n])) for n in range(1, 5) for i in range(len(words) - n + 1))
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, words), a in candidates.items():
        longer = [
            b
            for (other, w), b in candidates.items()
            if other == lang and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w) - len(words) + 1))
        ]
        if any(100 * b >= 80 * a for b in longer):
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((2_000_000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
        out.append((lang, -score, -a, " ".join(words).encode(), left, right))
    ranked, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= most:
            ranked.append((lang, rank[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return ranked


@pytest.fixture
def texts():
    rng = random.Random(4)
    words = ["The", "big", "Ünï", "中文", "a", "of", "new", "york", "x'y", "<b>"]
    rows = []
    for i in range(120):
        said = [rng.choice(words[: 4 + i % 7]) + rng.choice(["", "", "", ",", ".", "\n", "\t"]) for _ in range(rng.randint(0, 60))]
        rows.append((" ".join(said).replace("new", "new york city"), rng.choice(["en", "en", "de", None])))
    return rows + [(None, "en"), ("", None), (" \t\n", "fr"), ("The big Ünï " * 3000, "en")] + [("copied text here again", "en")] * 40


def _check(spark, make_docs, rows, least, most=2000):
    docs = make_docs([(i % 7, text, lang) for i, (text, lang) in enumerate(rows)])
    found = co.collocations(docs, most)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == sorted(_model(rows, least, most))


def test_equal_to_a_plain_model(spark, make_docs, texts, monkeypatch):
    _check(spark, make_docs, texts, 30)
    monkeypatch.setattr(co, "LEAST_COUNT", 3)
    _check(spark, make_docs, texts, 3, most=25)


def test_collisions_are_told_apart(spark, make_docs, texts, monkeypatch):
    # 256 different values for words and as many fingerprints.
    monkeypatch.setattr(co, "_mixed", lambda x: x & np.uint64(255))
    monkeypatch.setattr(co, "LEAST_COUNT", 5)
    _check(spark, make_docs, texts, 5)


def test_long_texts_are_cut_behind_separators(monkeypatch):
    monkeypatch.setattr(co, "SLICE_BYTES", 40)
    text = "one two, three ü four. five\nsix " + "seven " * 20 + "! nine ten; " + "x" * 100
    parts = [part for _, slice_ in co._cut_long(["en", "en", "de"], pa.array(["a b", text, None])) for part in slice_.to_pylist()]
    assert "".join(parts) == "a b" + text
    assert all(len(p) <= 40 or not re.search("[.,;!\n].", p) for p in parts)


def test_empty_and_odd_tables(spark, make_docs, odd_docs):
    assert co.collocations(make_docs([])).collect() == []
    docs, _ = odd_docs
    found = {r.phrase: r for r in co.collocations(docs).collect()}
    assert found["word word word word"].a == 30_000 - 3 and set(found) <= {"word word word word"}


def test_bit_map_holds_all(spark):
    fps = [hash(str(i)) for i in range(500)] + [-1, 0, 2**63 - 1, -(2**63)]
    known = co.BitMap(co.bit_map(spark.createDataFrame([(f,) for f in fps], "fp long")))
    assert known.has(np.array(fps, np.int64).view(np.uint64)).all()
    others = np.random.default_rng(0).integers(0, 2**63, 1000, dtype=np.uint64)
    assert known.has(others).sum() < 10


def test_texts_go_to_python_in_short_batches(spark, make_docs, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, read = spark.conf.get(key), [], co._read
    monkeypatch.setattr(co, "_read", lambda docs: seen.append(int(spark.conf.get(key))) or read(docs))
    co.frequent_phrases(make_docs([(1, "a b a b", "en")]))
    assert len(seen) == 4 and max(seen) <= 2_000 and spark.conf.get(key) == before


def test_small_blocks_parts_and_slices(spark, make_docs, texts, monkeypatch):
    langs = [f"l{i}" for i in range(40)]
    rows = [(text, langs[i % 40] if i % 3 else lang) for i, (text, lang) in enumerate(texts)] + [("copied\ttext  here again", x) for x in langs] * 3
    for name, size in (("SLICE_BYTES", 300), ("BLOCK_RUNS", 400), ("BLOCK_WORDS", 200), ("PART_BYTES", 5_000), ("SENT_BYTES", 100), ("LEAST_COUNT", 3)):
        monkeypatch.setattr(co, name, size)
    _check(spark, make_docs, rows, 3, most=50)


def test_runs_travel_packed(spark, make_docs, monkeypatch):
    # Not a row for every run: each part of a block is one, for words (and a row a language), pairs, longer runs and phrases.
    docs = make_docs([(i, " ".join(f"w{(i * 31 + j) % 499}" for j in range(400)), "en") for i in range(60)]).coalesce(1)
    sent, real = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda *a, **b: sent.append(real(*a, **b)) or sent[-1])
    phrases, totals = co.frequent_phrases(docs)
    assert totals.collect() == [("en", 24_000)] and phrases.filter("n = 4").count() > 0
    assert [df.count() for df in sent] == [2, 1, 1, 1]
