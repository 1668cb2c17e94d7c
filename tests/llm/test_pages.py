"""Pages generated from known articles, deep nesting, and text without an end."""

from __future__ import annotations

import random
import time

import pytest

from promptmill.llm import pages

PROSE = "Some plain words that tell of a river and the towns along it, one after the other. " * 3
TREE = pages.grow()


def _generated(seed: int) -> tuple[str, str]:
    """A page and its main text; what surrounds the article is told by elements, by names or by links alone."""
    pick = random.Random(seed)

    def words(n: int) -> str:
        return " ".join("".join(pick.choices("abcdefghijklmnop", k=pick.randint(2, 9))) for _ in range(n))

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{words(pick.randint(1, 3))}</a></li>' for i in range(n)) + "</ul>"

    article = [words(pick.randint(25, 70)) for _ in range(pick.randint(2, 7))]
    inside = "".join(f"<p>{t.replace(' ', pick.choice([' ', chr(10) + '  ']), 3)}</p>" for t in article)
    style = pick.choice(["elements", "names", "links"])
    if style == "elements":
        page = f"<nav>{links(6)}</nav><article>{inside}</article><aside><p>{words(30)}</p></aside><footer><p>{words(9)}</p></footer>"
    elif style == "names":
        page = f'<div class="menu">{links(5)}</div><div id="content">{inside}</div><div class="comments"><p>{words(40)}</p></div>'
        page += f'<div class="cookie-notice"><p>{words(25)}</p></div>'
    else:
        page = f"<div>{links(8)}</div><div>{inside}</div><div>{links(9)}</div>"
    page = f"<html><head><title>{words(4)}</title><style>p {{}}</style></head><body><script>let a = '<p>{words(30)}</p>'</script>{page}</body></html>"
    wrapper = pick.choice(["", "page", "with-sidebar", "layout"])
    return page.replace("<body>", f'<body><div class="{wrapper}">').replace("</body>", "</div></body>"), "\n".join(article)


def test_generated_pages():
    for seed in range(300):
        page, text = _generated(seed)
        assert pages.main_text(page, TREE) == text, seed


@pytest.mark.parametrize("name", ["sidebar", "comments"])
@pytest.mark.parametrize("levels", [1, 7, 400])
def test_article_within_nested_named_elements(name, levels):
    page = f'<div class="{name}">' * levels + f"<p>{PROSE}</p><div class=widget><p>Short.</p></div>" + "</div>" * levels
    assert pages.main_text(page, TREE) == PROSE.strip()


def test_comments_beside_a_short_article_in_a_named_element():
    comments = "<div class=comments>" * 3 + f"<p>{PROSE * 5}</p>" + "</div>" * 3
    assert pages.main_text(f"<div class=sidebar><p>{PROSE}</p><p>{PROSE}</p>{comments}</div>", TREE) == "\n".join([PROSE.strip()] * 2)


@pytest.mark.parametrize(
    "page",
    [
        "<div class=sidebar>" * 20_000 + f"<p>{PROSE}</p>",
        "<div class=comments><b>x y z</b>" * 20_000 + f"<p>{PROSE}</p>",
        "<div>" * 20_000 + "</section>" * 20_000 + f"<p>{PROSE}</p>",
        f"<p>{PROSE}</p>" + "<a " * 200_000,
        "<svg>" + "<div>" * 20_000 + "</ul>" * 20_000 + f"</svg><p>{PROSE}</p>",
    ],
    ids=["wrappers", "wrappers with words", "foreign ends", "unended tags", "foreign ends in a drawing"],
)
def test_time_grows_with_the_page(page):
    start = time.process_time()
    text = pages.main_text(page, TREE)
    assert time.process_time() - start < 30
    # Among 60,000 words in names for what readers wrote, the paragraph is not most of the page.
    assert PROSE.strip() in text or "x y z" in page


def test_text_without_an_end():
    start = f"<p>{PROSE}</p>"
    for tail, kept in [("<!-- a > b", ""), ("<!-- a", ""), ("<script>a > b", ""), ("<script>a", "")]:
        assert pages.main_text(start + tail, TREE) == PROSE.strip() + kept, tail
    assert pages.main_text("1 < 2 and no tag", TREE) == "1 < 2 and no tag"
    assert pages.main_text("", TREE) == pages.main_text(None, TREE) == ""
