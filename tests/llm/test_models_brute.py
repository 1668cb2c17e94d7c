"""Learned operators against plain loops that do the same step by step."""

from __future__ import annotations

import math
import random
import re
import unicodedata
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from promptmill.llm import langid, quality


def _letters_only(text):
    kept = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (text or "").lower())
    return " ".join(kept.split())


def _language_vector(text, dimensions):
    letters = _letters_only(text)
    total = np.zeros(dimensions)
    if not letters:
        return total

    def letter(c):
        return np.random.default_rng([langid.SEED, ord(c)]).integers(0, 2, dimensions) * 2 - 1

    padded = f" {letters} "
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        total += np.roll(letter(a), 2) * np.roll(letter(b), 1) * letter(c)
    return total / np.linalg.norm(total)


_TEXTS = ["The cat, the hat!", "Über den Fluß 12 ½ m² Ⅷ", "él niño_x", "² ½ Ⅷ 3", "", None, "a", "中文 文字", "İstanbul ﬁne"]


def test_language_vectors_equal_plain_binding_and_bundling():
    found = langid.Bundler(256).bundle(_TEXTS)
    for row, text in zip(found, _TEXTS):
        assert row == pytest.approx(_language_vector(text, 256), abs=1e-5)


def test_languages_equal_a_plain_model(make_docs):
    rng = random.Random(8)
    sounds = {"aa": ["ver", "ein", "lich", "ung"], "bb": ["la", "mo", "ti", "re"], "cc": ["shi", "ka", "tsu", "no"]}
    rows = [(i, " ".join("".join(rng.choices(sounds[lang], k=3)) for _ in range(25)), lang) for i, lang in enumerate("aa bb cc".split() * 12)]
    rows += [(100 + i, text, None) for i, text in enumerate(_TEXTS)] + [(0, "repeated id verlich", "aa")] * 3
    docs = make_docs(rows)
    found = sorted((r.doc_id, r.lang_pred, round(r.score, 4)) for r in langid.predict(docs, langid.train(docs)).collect())
    vectors = [_language_vector(text, langid.DIMENSIONS) for _, text, _ in rows]
    sums = {lang: sum(v for v, r in zip(vectors, rows) if r[2] == lang) for lang in sounds}
    unit = {lang: s / np.linalg.norm(s) for lang, s in sums.items()}
    mean = sum(unit.values()) / 3
    prototypes = {lang: (u - mean) / np.linalg.norm(u - mean) for lang, u in unit.items()}
    expected = []
    for (i, _, _), v in zip(rows, vectors):
        cosines = {lang: float(v @ p) for lang, p in prototypes.items()}
        best = max(sorted(cosines), key=cosines.get)
        expected.append((i, best, (1 + cosines[best]) / 2) if v.any() else (i, "und", 0.0))
    for got, want in zip(found, sorted(expected, key=lambda e: (e[0], e[1], round(e[2], 4)))):
        assert got[:2] == want[:2] and got[2] == pytest.approx(want[2], abs=2e-3)


def _features(text):
    words = re.findall(r"[^ \t\n\r\x0b\x0c]+", text or "")
    names, shapes = set(), Counter()
    for word in words:
        parts = re.findall(r"[^\W_]+|[\W_]+", word)
        names |= {p.lower() for p in parts}
        names |= {p.lower()[:n] + "-" for p in parts for n in (4, 5) if p[0].isalnum() and len(p) >= n}
        plain = [p for p in parts if p[0].isalnum()]
        signs = [p for p in parts if not p[0].isalnum()]
        for i, holds in enumerate(
            (not plain, bool(signs) and len(signs[-1]) > 1, bool(plain) and word.isupper() and len(word) > 2,
             any(c.isdigit() for c in word), len(parts) > 2, len(word) > 25)
        ):
            shapes[i] += holds
    shares = [shapes[i] / len(words) if words else 0.0 for i in range(6)]
    shares.append(1 - len(set(words)) / len(words) if words else 0.0)
    return {crc32(n.encode()) % quality.BUCKETS for n in names}, shares


@pytest.fixture
def rated(spark, make_docs):
    rng = random.Random(3)
    good = ["alpha", "beta", "gamma", "delta", "omega", "sigma"]
    rows, labels = [], []
    for i in range(240):
        words = rng.choices(good, k=30)
        grade = i % 3
        if grade < 2:
            words += rng.choices([["vile", "nasty"], ["$$$", "buy!!!"]][grade], k=6)
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(grade != 1), int(grade == 0)))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_grades_equal_a_plain_model(spark, make_docs, rated):
    rows, labels = rated
    docs = make_docs([*rows, (900, None, "en"), (901, "", "en"), (902, "vile $$$ Alpha UPPER x1!!", "en")])
    model = quality.train(docs, labels)
    texts = {i: text for i, text, _ in rows} | {900: None, 901: "", 902: "vile $$$ Alpha UPPER x1!!"}
    selected = Counter()
    for r in quality.rate(docs, model).collect():
        names, shares = _features(texts[r.doc_id])
        score = sum(model.weights[b] for b in names) + sum(w * s for w, s in zip(model.shares, shares))
        tails = [1 / (1 + math.exp(min(max(t - score, -500), 500))) for t in model.thresholds]
        assert r.expected_grade == pytest.approx(sum(tails)) and r.tail_probability == pytest.approx(tails[-1])
        assert r.selected == (r.tail_probability >= quality.SELECT_FROM)
        if r.doc_id < 900:
            selected[r.doc_id % 3] += r.selected
    assert selected[2] == 80 and selected[0] + selected[1] <= 8


def test_rows_that_repeat_a_rated_id_count_once(spark, make_docs, rated):
    rows, labels = rated
    once = quality.train(make_docs(rows), labels)
    again = quality.train(make_docs(rows + [rows[0]] * 50 + [rows[1]] * 70), labels)
    assert np.array_equal(once.weights, again.weights) and np.array_equal(once.thresholds, again.thresholds)


def test_every_document_counts_for_sums_and_thresholds(spark):
    words = ["alpha", "bravo", "lima", "oscar", "tango", "zulu", "kilo"]
    texts = [" ".join(words[(i * k) % 7] for k in range(1, 2 + i % 6)) + f" {chr(97 + i % 26)}" for i in range(6_500)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)] + [(None, "alpha", "en"), (1, "bravo", None)], "doc_id long, text string, lang string")
    vectors, lengths = langid.Bundler(64).bundle(texts, lengths=True)
    whole = np.rint(vectors * 10_000).astype(np.int64).sum(axis=0) / 10_000
    sums = langid.sums_by_language(docs, dimensions=64)
    assert np.array_equal(sums["en"], whole)
    least = langid.least_cosines(docs, sums)
    unit = vectors.astype(np.float64)
    dots = unit @ whole
    cosines = (dots - 1) / np.sqrt(whole @ whole - 2 * dots + 1)
    for size in set(np.log2(lengths).astype(int)):
        own = np.sort(cosines[np.log2(lengths).astype(int) == size])
        assert abs(least[0, size] - 0.5 * own[-(-len(own) // 10) - 1]) <= 1e-5
