"""Quality, language, pages, fixity and the pipeline."""

from __future__ import annotations

import base64
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from promptmill.llm import langid, pages, quality, queries, warc
from promptmill.llm.registry import table

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


def test_quality_separates_rated_documents(spark):
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    model = quality.train(docs, labels.filter(~part))
    rated = quality.rate(docs, model).join(labels.filter(part), "doc_id")
    rows = rated.select("selected", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"), "tail_probability").collect()
    clean = [r for r in rows if r.grade == quality.GRADES - 1]
    assert sum(r.selected for r in clean) >= 0.97 * len(clean)
    assert np.mean([not r.selected for r in rows if r.grade == 1]) >= 0.8
    assert list(np.diff(model.thresholds) > 0) == [True]


def test_quality_of_odd_input(spark, odd_docs):
    docs, rows = odd_docs
    ratings = "doc_id long, quality int, toxic int, text string"
    none = quality.train(docs, spark.createDataFrame([(4, None, 1, "t"), (None, 1, 1, "t")], ratings))
    assert quality.rate(docs, none).filter("selected and expected_grade = 2").count() == len(rows)
    one = quality.train(docs, spark.createDataFrame([(5, 0, 0, "t"), (3, 0, 0, "t")], ratings))
    assert quality.rate(docs, one).filter("not selected and expected_grade = 1").count() == len(rows)
    two = quality.train(docs, spark.createDataFrame([(5, 1, 0, "t"), (5, 1, 1, "t"), (7, 1, 0, "t"), (4, 0, 0, "t")], ratings))
    assert quality.rate(docs, two, columns=tuple(docs.columns)).count() == len(rows)
    assert quality.rate(docs.limit(0), two).count() == 0


def test_language_accuracy(spark):
    docs = queries._held_out(table(spark, MIDDLE, "documents"))
    found = langid.predict(docs, langid.train(docs.filter("not held_out")), ("doc_id", "held_out", "lang"))
    held = found.filter("held_out")
    assert held.filter("lang = lang_pred").count() >= 0.98 * held.count()
    assert found.filter("score < 0 or score > 1").count() == 0


def test_language_of_odd_input(odd_docs):
    docs, rows = odd_docs
    prototypes = langid.train(docs)
    found = langid.predict(docs, prototypes).collect()
    undefined = {r.doc_id for r in found if r.lang_pred == "und"}
    assert len(found) == len(rows) and undefined == {4, 2, 9, 3}
    assert all(r.score == 0 for r in found if r.lang_pred == "und")
    assert {r.lang_pred for r in langid.predict(docs, {}).collect()} == {"und"}
    assert langid.predict(docs.limit(0), prototypes).count() == 0


PAGE = """<html><body class="with-sidebar comments"><div id="cookieNotice"><p>We use cookies to make this site better for
everyone who reads it here today.</p></div><header>Site</header><nav><ul><li><a href=x>Home</a></ul></nav>
<article><header><h1>A &lt;title&gt;</h1></header><p>First&nbsp; paragraph<br>of <a href="y">text</a>.<p class="advert">Buy now
<p>Second &amp last.<script>if (a < b) "</p>"</script><aside>Read also</aside>
<section id="comments"><article class="comment"><p>A reader says that all this is very nice to have read on this day.</p></article></section>
</article><form><label>Mail</label></form><footer>&copy; all</footer><!-- open"""


@pytest.mark.parametrize(
    "page, text",
    [
        (PAGE, "A <title>\nFirst paragraph of text.\nSecond & last."),
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        ("a < b &unknown; c", "a < b &unknown; c"),
        ("<p>one<p>two", "one\ntwo"),
        ("<script>never closed <p>x</p>", ""),
        ("<article><p>" + "word " * 50_000 + "</p></article>", ("word " * 50_000).strip()),
    ],
)
def test_main_text(page, text):
    assert pages.main_text(page, pages.grow()) == text


def test_main_text_of_plain_markup():
    prose = "This is a sentence of some length, as paragraphs of articles have them, with a few more words in it."
    page = f"<div><a href=a>Home</a> <a href=b>News</a></div><h2>Head</h2><p>{prose}</p><p>{prose}</p><div><a href=c>Next</a></div>"
    assert pages.main_text(page, pages.grow()) == f"Head\n{prose}\n{prose}"


def test_tree_learns_its_examples():
    tree = pages.grow()
    for line in pages.EXAMPLES.strip().splitlines():
        *row, label = map(float, line.split())
        assert tree.decide(tuple(row)) == bool(label)


def test_pages_operator(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = pages.main_texts(frame).collect()
    assert len(found) == 3 and {r.text for r in found if r.page_id is None} == {""}
    assert pages.main_texts(frame.limit(0)).count() == 0


def test_fixity_audit(spark):
    rows = [(i, f"http://h/{i}", "x" * (i * 137 % 900), 0) for i in range(300)] + [(7, "http://h/7", "x", 0), (None, None, None, 0)]
    pages_ = spark.createDataFrame(rows, "page_id long, url string, html string, offset long")
    records = warc.warc_records(pages_, file_bytes=40_000)
    kept = [r.asDict() for r in records.collect()]
    for name in {r["file"] for r in kept}:
        end = 0
        for r in sorted((r for r in kept if r["file"] == name), key=lambda r: r["offset"]):
            assert r["offset"] == end and bytes(r["record"]).startswith(b"WARC/1.0\r\n")
            end += len(r["record"])
    schema = "file long, offset long, page_id long, record binary"
    left = spark.createDataFrame([tuple(r.values()) for r in kept], schema)
    assert warc.audit(left, left).count() == 0
    damaged, expected = [], set()
    for k, r in enumerate(sorted(kept, key=lambda r: (r["file"], r["offset"]))):
        if k % 50 == 3:
            expected.add((r["file"], r["offset"], "missing"))
            continue
        if k % 50 == 9:
            r = r | {"record": bytes(r["record"][:-5]) + b"?\r\n\r\n"}
            expected.add((r["file"], r["offset"], "altered"))
        damaged.append(tuple(r.values()))
    damaged.append((0, 10**9, None, bytearray(b"new")))
    expected.add((0, 10**9, "added"))
    found = warc.audit(left, spark.createDataFrame(damaged, schema)).collect()
    assert {(r.file, r.offset, r.finding) for r in found} == expected
    assert warc.audit(left.limit(0), left.limit(0)).count() == 0


def test_pipeline_stages(spark):
    docs = table(spark, SMALL, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    kept = docs.collect()
    assert 0 < len(kept) < len(before) and all(before[r.doc_id] == r for r in kept)
    packed = corpus_pipeline.run(spark, SMALL).select("doc_id").distinct().collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in kept}


def test_near_duplicate_stage_keeps_one_of_each_group(spark, odd_docs):
    docs, rows = odd_docs
    docs = docs.unionByName(docs.limit(0))
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, SMALL).select(*docs.columns).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["2", "3", "5", "7", "8", "None"]


def test_stages_of_nothing(spark, make_docs):
    docs = make_docs([])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0, name


def test_language_stage_rejects_gibberish_and_unlearned_languages(spark, make_docs):
    rng = random.Random(3)
    clean = table(spark, MIDDLE, "documents").join(table(spark, MIDDLE, "labels").filter("quality = 1 and toxic = 0"), "doc_id")
    rows = [(r.doc_id, r.text, r.lang) for r in clean.collect()]
    finnish = "talo kissa juoksee metsässä kauniisti vanha lapsi lukee kirjaa hyvää huomenta järvi kylmä tuuli".split()
    odd = [(-1, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(300)), "en")]
    odd += [(-2, base64.b64encode(rng.randbytes(2_000)).decode(), "en"), (-3, " ".join(rng.choices(finnish, k=300)), None)]
    odd += [(-4, "123", "en"), (-5, None, "en")]
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, make_docs(rows + odd), MIDDLE).collect()}
    assert min(kept) >= 0
    assert len(kept) >= 0.995 * len(rows)


def test_near_duplicate_stage_decides_by_row(spark, make_docs):
    one = "the first text has a number of words that nobody else in this table happens to use"
    two = "quite another story is told here, about ships and harbours and the wind of the north sea"
    three = "no identifier belongs to these lines of prose, which were found twice on an old server"
    rows = [(1, one, "en"), (5, one, "en"), (5, two, "en"), (None, three, "en"), (None, three, "en"), (9, two, "en")]
    rows += [(None, one, "en"), (7, None, "en"), (7, "a seventh document, with words of its own in every place", "en")]
    kept = corpus_pipeline.near_duplicate_stage(spark, make_docs(rows), SMALL).select("doc_id", "text").collect()
    expected = [(1, one), (5, two), (None, three), (7, None), (7, rows[-1][1])]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, expected))


@pytest.mark.parametrize(
    "lead",
    [
        '<svg viewBox="0 0 1 1"/>', "<button>", "<select>", "<object data=x>", '<svg-icon name="a"></svg-icon>', "<title-bar></title-bar>",
        "<button-group>", "<div><button>Menu</div>", "<svg><path d=x></svg>", "<button>Menu<div>it</div></button>", "<template><p>no</template>",
        "<noscript><p>Turn it on</p></noscript>", "<svg><svg/><text>a</text></svg>",
    ],
)
def test_pages_lose_no_text_to_unclosed_or_custom_elements(lead):
    prose = "This is a sentence of some length, as paragraphs of articles have them, with a few more words in it."
    tail = "<button>Send</button><svg><title>x</title></svg>"
    page = f"<body>{lead}<article><p>{prose}</p><p>A <svg><text>i</text></svg>line {prose}</p></article>{tail}</body>"
    assert pages.main_text(page, pages.grow()) == f"{prose}\nA line {prose}"


PROSE = "This is a sentence of some length, as paragraphs of articles have them, with a few more words in it."


@pytest.mark.parametrize(
    "start, end",
    [
        ('<div class="has-sidebar">', "</div>"), ('<div class="content-with-sidebar">', "</div>"), ('<div class="page no-comments">', "</div>"),
        ('<div class="social-history">', "</div>"), ('<div id="search-result-page">', "</div>"), ("<form>", "</form>"),
        ('<div class="social"><div class="search">', "</div></div>"), ('<div class="sidebar"><article>', "</article></div>"),
        ('<div class="comments"><main>', "</main></div>"), ('<div class="search"><div class="content">', "</div></div>"),
    ],
)
def test_a_name_alone_does_not_drop_the_article(start, end):
    tree = pages.grow()
    menu = '<div class="menu"><a href=a>Home</a> <a href=b>News</a></div>'
    notice = '<div class="cookie-notice"><p>We use cookies here.</p></div>'
    page = f"<body>{menu}{start}<h2>Head</h2><p>{PROSE}</p>{notice}<p>{PROSE}</p>{end}<div class=footer>All rights</div></body>"
    assert pages.main_text(page, tree) == f"Head\n{PROSE}\n{PROSE}"


def test_names_still_drop_what_is_beside_the_article():
    tree = pages.grow()
    comments = f'<div class="comments"><article><p>{PROSE}</p></article><p>{PROSE}</p><p>{PROSE}</p></div>'
    assert pages.main_text(f"<p>{PROSE}</p>{comments}", tree) == PROSE
    assert pages.main_text(f"<article><p>{PROSE}</p></article>{comments}<aside class=sidebar><p>{PROSE * 5}</p></aside>", tree) == PROSE
    assert pages.main_text(f"<div hidden class=social><main><p>{PROSE}</p></main></div>", tree) == ""
