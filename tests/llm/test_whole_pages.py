"""Text that must not be lost from pages, the decoder against all labellings, and the article of given pages."""

import itertools
import re

import pytest

from tidemark.llm import html

PAGES = [
    ("<html><head><meta><title>x</title><article><p>Hello there.</p></article>", "Hello there."),
    ("<html><head><title>x<article><p>Hello there.</p></article>", "Hello there."),
    ("<article><p>One one.<svg><path d=1><p>Two two.<p>Three three.</article>", "One one.\n\nTwo two.\n\nThree three."),
    ("<article><p>See <object>this thing</object> and <math><mi>x</mi></math> too.</p></article>", "See this thing and x too."),
    ("<article><p>First.</p><noscript><p>Second one here.</p></noscript></article>", "First.\n\nSecond one here."),
    ("<head><noscript><img></noscript><style>p{}</style></head><body><article><p>Only this.", "Only this."),
    ("<article><p>A line.</p><svg><text>drawn</text></svg><template><p>unused</p></template><p>Another.</p></article>", "A line.\n\nAnother."),
]


@pytest.mark.parametrize("page", PAGES, ids=range(len(PAGES)))
def test_no_text_is_lost(page):
    assert html.main_text(page[0], *html.model()) == page[1]


def test_links_count_however_deep():
    deep = "<nav><a href=/>" + "<span>" * 40 + "Menu" + "</span>" * 40 + "</a></nav>"
    assert [b[3] for b in html.blocks(deep)] == [1.0]
    assert [b[3] for b in html.blocks("<p><a>one<a>two</a> rest of it</p><p>free</p>")] == [6 / 17, 0.0]


def test_viterbi_is_the_best_of_all_labellings():
    import random

    w, t = html.model()
    rng = random.Random(8)
    for _ in range(60):
        found = html.labelled_page(rng)[0][:9]
        if not found:
            continue
        s = [sum(w.get(f, 0.0) for f in html.features(b)) for b in found]
        score = lambda y: sum(x for x, k in zip(s, y, strict=True) if k) + sum(t[2 * i + j] for i, j in zip(y, y[1:]))  # noqa: B023, E731
        best = max(itertools.product((0, 1), repeat=len(found)), key=score)
        assert score(html.decode(found, w, t)) == pytest.approx(score(best))


def test_articles_of_given_pages(spark):
    """Of the blocks that stand in the article element of given pages, 95 in 100 are found, and few others are."""
    w, t = html.model()
    inside = found = right = 0
    for row in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        article = re.search(r"<article>.*?</article>", row["html"], re.DOTALL)[0]
        want = {b[0] for b in html.blocks(article)}
        got = set(html.main_text(row["html"], w, t).split("\n\n"))
        inside, found, right = inside + len(want), found + len(got), right + len(want & got)
    assert right / inside > 0.95 and right / found > 0.95
