"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is parsed to its leaf blocks: runs of text between tags that break lines, with the tags and class
words above them. Features of a block are its ancestors' tags and class words and its text (length, share
of links, punctuation); neighbours are tied by transition weights. The field is trained, by gradient
steps on the likelihood, on PAGES generated and labelled pages of many layouts, and decoded by Viterbi.

White space is decoded references' too: any run of it becomes one space. Text that browsers show is in
blocks, also that of object, math and noscript; what they never show isn't (scripts, styles, drawings, templates,
frames' fallbacks, the head). A head without an end tag ends at the first element that can't stand in it, a drawing at
the first that can't either, and other open elements with their parent.

Edge cases: null and empty pages give an empty text; text outside any tag is a block; unclosed and
crossed tags are tolerated; a page is handled within its row, whatever its length; repeated rows are each
extracted; an empty table gives none; further columns are not read.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from functools import cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import table

#: Generated pages for training, and passes over them.
PAGES, EPOCHS, RATE, DECAY = 400, 6, 0.2, 1e-4
#: Fixed sets of the HTML standard: elements that break a line, have no end tag, or hold no text to read.
BREAKING = frozenset("address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head iframe script style svg template title".split())
#: Elements that may stand in the head, and those whose start ends foreign content (both of the HTML standard).
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 hr i img li listing menu meta nobr ol p pre ruby s small span strike strong sub sup table tt u ul var".split())
#: A start tag of the key ends an open element of the value, up to the nearest tag that holds them.
ENDS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
CLOSES_P = BREAKING - frozenset("body head html option title tbody thead tfoot td th tr button li dd dt".split())
_PART = re.compile(r"[a-z]+")


class Blocks(HTMLParser):
    """Leaf blocks of a page: (text, tags above, class words above, share of text in links)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.silent = self.links = 0
        self.found: list[tuple[str, tuple, frozenset, float]] = []
        self.parts: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            tags = tuple(dict.fromkeys(t for t, _ in self.open if t in BREAKING))
            classes = frozenset(c for _, cs in self.open for c in cs)
            own = next((t for t, _ in reversed(self.open) if t in BREAKING), "")
            self.found.append((text, (own, *tags), classes, min(1.0, self.linked / len(text))))
        self.parts, self.linked = [], 0

    def pop(self, at: int) -> None:
        self.silent -= sum(t in SILENT for t, _ in self.open[at:])
        self.links -= sum(t == "a" for t, _ in self.open[at:])
        del self.open[at:]

    def end_silent(self, tag: str) -> None:
        """A head ends at the first element that can't stand in it, foreign content at the first that breaks out."""
        names = [t for t, _ in self.open]
        if "head" in names and tag not in IN_HEAD and "template" not in names and "noscript" not in names:
            self.pop(names.index("head"))
        elif tag in BREAKOUT and "svg" in names:
            self.pop(names.index("svg"))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.silent:
            self.end_silent(tag)
        if tag in BREAKING:
            self.flush()
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in CLOSES_P:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == "p":
                    self.pop(k)
                    break
                if self.open[k][0] in BREAKING:
                    break
        if tag in ENDS:
            names = ENDS[tag].split()
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] in names:
                    self.pop(k)
                    break
                if self.open[k][0] in ("ul", "ol", "dl", "table", "select", "menu"):
                    break
        if tag == "a" and self.links:  # one link ends at the next
            self.open = [("", c) if t == "a" else (t, c) for t, c in self.open]
            self.links = 0
        words = [w for n, v in attrs if n in ("class", "id", "role") and v for w in _PART.findall(v.lower())]
        self.open.append((tag, tuple(words)))
        self.silent += tag in SILENT
        self.links += tag == "a"

    def handle_endtag(self, tag: str) -> None:
        if tag in BREAKING:
            self.flush()
        if tag == "br":
            self.parts.append(" ")
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.pop(k)
                return

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def blocks(html: str | None) -> list[tuple[str, tuple, frozenset, float]]:
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.found


def features(block: tuple) -> list[str]:
    text, tags, classes, linked = block
    size = min(8, int(math.log2(1 + text.count(" "))))
    out = ["bias", f"own:{tags[0]}", f"size:{size}", f"links:{math.ceil(linked * 4)}", f"stop:{text[-1] in '.!?…。:;'}"]
    out += [f"in:{t}" for t in tags[1:]] + [f"class:{c}" for c in sorted(classes)]
    if text[0] in "©®":
        out.append("mark")
    return out


def _page(rng: random.Random) -> list[tuple[str, int]]:
    """A generated page as pieces of markup with the label of the text in them: 1 for the article's."""
    syllables = "an ber chi de el fa gor hi in jo ka lu men no or pa qui re sa ti un vo wer xi ya zu".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda a, b: words(a, b).capitalize() + rng.choice(". . . ! ?".split())
    prose = lambda: " ".join(sentence(1, 25) for _ in range(rng.choice([1, 1, 2, 4, 8])))
    link = lambda: f'<a href="/{word()}">{words(1, 3)}</a>'
    out: list[tuple[str, int]] = []

    def some(tag: str, names: list[str], inner, plain: float = 0.4) -> None:
        """An element, at times a div named for what it is."""
        name = rng.choice(names)
        mark = f' {rng.choice(["class", "id"])}="{name}"'
        tag, mark = (tag, rng.choice(["", mark])) if tag != "div" and rng.random() < plain + 0.2 else ("div", mark)
        out.append((f"<{tag}{mark}>", 0))
        inner()
        out.append((f"</{tag}>", 0))

    def listed() -> None:
        out.append(("<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 8))) + "</ul>", 0))

    def lines(a: int = 1, b: int = 3) -> None:
        for _ in range(rng.randint(a, b)):
            out.append((rng.choice(["<p>{}</p>", "{}", "<div>{}</div>", "<p>{} <a href='#'>x</a></p>"]).format(prose()), 0))

    def form() -> None:
        out.append((f"<label>{words(1, 4)}</label><input name=q><p>{prose()}</p><button>{words(1, 2)}</button>", 0))

    def top() -> None:
        out.append((rng.choice([f"<h1>{words(1, 5)}</h1>", f"<p>{sentence(3, 9)}</p>", f"<div>{link()}</div>", sentence(2, 8)]), 0))

    def advert() -> None:
        some("div", ["ad", "ads", "advert", "advertisement", "banner", "sponsored", "promo", "ad-slot"], lambda: lines(1, 2))

    def comments() -> None:
        for _ in range(rng.randint(1, 5)):
            out.append((f'<div class="{rng.choice(["comment", "comment-body", "reply"])}"><p>{prose()}</p></div>', 0))

    def article() -> None:
        out.append((f"<h1>{words(3, 10)}</h1>", 1) if rng.random() < 0.8 else ("", 0))
        for _ in range(rng.randint(1, 14)):
            kind = rng.random()
            if kind < 0.68:
                out.append((f"<p>{prose()}</p>", 1) if rng.random() < 0.9 else (f"<p><b>{prose()}<br>", 1))
            elif kind < 0.76:
                out.append((f"<h{rng.randint(2, 4)}>{words(2, 7)}</h2>", 1))
            elif kind < 0.82:
                tag = rng.choice(["ul", "ol"])
                out.append((f"<{tag}>" + "".join(f"<li>{sentence(2, 12)}</li>" for _ in range(rng.randint(2, 5))) + f"</{tag}>", 1))
            elif kind < 0.86:
                out.append((f"<blockquote>{prose()}</blockquote>", 1))
            elif kind < 0.89:
                out.append((f"<pre>{words(3, 20)}</pre>", 1))
            elif kind < 0.92:
                out.append((f"<table><tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr></table>", 1))
            elif kind < 0.94:
                out.append((f"<figure><img><figcaption>{sentence(3, 9)}</figcaption></figure>", 1))
            elif kind < 0.97:
                advert()
            else:
                some("aside", ["related", "share", "newsletter", "social"], rng.choice([listed, form, lines]))

    if rng.random() < 0.4:
        some("div", ["cookie", "cookie-notice", "notice", "consent", "alert", "gdpr"], lambda: lines(1, 2))
    if rng.random() < 0.6:
        some("header", ["header", "masthead", "site-header", "top"], top)
    if rng.random() < 0.8:
        some("nav", ["nav", "menu", "navigation", "breadcrumb", "navbar"], listed)
    if rng.random() < 0.5:
        advert()
    if rng.random() < 0.3:
        some("aside", ["sidebar", "aside", "widget", "related"], rng.choice([listed, lines]))
    if rng.random() < 0.75:
        out.append(("<article>" if rng.random() < 0.75 else "<main>", 0))
        article()
        out.append(("</p></article></main>", 0))
    else:
        some("div", ["content", "article", "post", "entry-content", "main", "article-body", "story"], article, 0)
    for chance, tag, names, inner in (
        (0.4, "section", ["comments", "comment-list", "discussion", "responses"], comments),
        (0.4, "aside", ["sidebar", "side", "related", "widget"], rng.choice([listed, lines])),
        (0.3, "form", ["subscribe", "newsletter", "search-form", "contact"], form),
        (0.3, "div", ["cookie", "notice", "disclaimer", "popup"], lines),
    ):
        if rng.random() < chance:
            some(tag, names, inner)
    if rng.random() < 0.85:
        some("footer", ["footer", "site-footer", "copyright", "bottom"], lambda: out.append((rng.choice([f"&copy; {words(1, 9)}", f"<p>{prose()}</p>", f"&copy; {word()} &middot; {prose()}"]), 0)))
    return out


def labelled_page(rng: random.Random) -> tuple[list[tuple], list[int]]:
    """Blocks of a generated page and their labels. Labelled text ends in a mark that is then taken off."""
    mark = "\u2063"
    pieces = [(re.sub(r"(?<=[^>\s])(?=\s*<|$)", mark, m) if y else m) for m, y in _page(rng)]
    found = blocks("<html><body>" + "".join(pieces) + "</body></html>")
    kept, labels = [], []
    for text, *rest in found:
        clean = text.replace(mark, "").strip()
        if clean:
            kept.append((clean, *rest))
            labels.append(int(mark in text))
    return kept, labels


def _log_add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


@cache
def model() -> tuple[dict[str, float], tuple[float, ...]]:
    """Weights of features for label 1, and of the transitions 00, 01, 10, 11."""
    rng = random.Random(11)
    pages = [([features(b) for b in x], y) for x, y in (labelled_page(rng) for _ in range(PAGES)) if y]
    w: dict[str, float] = {}
    t = [0.0] * 4
    for epoch in range(EPOCHS):
        rng.shuffle(pages)
        rate = RATE / (1 + epoch)
        for rows, y in pages:
            n = len(y)
            s = [sum(w.get(f, 0.0) for f in row) for row in rows]
            ahead = [(0.0, s[0])]
            for k in range(1, n):
                a, b = ahead[-1]
                ahead.append((_log_add(a + t[0], b + t[2]), s[k] + _log_add(a + t[1], b + t[3])))
            behind = [(0.0, 0.0)] * n
            for k in range(n - 2, -1, -1):
                a, b = behind[k + 1]
                behind[k] = _log_add(t[0] + a, t[1] + s[k + 1] + b), _log_add(t[2] + a, t[3] + s[k + 1] + b)
            total = _log_add(*ahead[-1])
            for k in range(n):
                error = y[k] - math.exp(min(0.0, ahead[k][1] + behind[k][1] - total))
                for f in rows[k]:
                    w[f] = w.get(f, 0.0) * (1 - rate * DECAY) + rate * error
                if k:
                    for i in (0, 1):
                        for j in (0, 1):
                            p = math.exp(min(0.0, ahead[k - 1][i] + t[2 * i + j] + j * s[k] + behind[k][j] - total))
                            t[2 * i + j] += rate * 0.1 * ((y[k - 1] == i and y[k] == j) - p)
    return w, tuple(t)


def decode(found: list[tuple], w: dict[str, float], t: tuple[float, ...]) -> list[int]:
    """The likeliest labels of blocks."""
    if not found:
        return []
    s = [sum(w.get(f, 0.0) for f in features(b)) for b in found]
    a, b, back = 0.0, s[0], []
    for x in s[1:]:
        back.append((a + t[0] < b + t[2], a + t[1] < b + t[3]))
        a, b = max(a + t[0], b + t[2]), x + max(a + t[1], b + t[3])
    labels = [int(b > a)]
    for step in reversed(back):
        labels.append(int(step[labels[-1]]))
    return labels[::-1]


def main_text(html: str | None, w: dict[str, float], t: tuple[float, ...]) -> str:
    found = blocks(html)
    return "\n\n".join(b[0] for b, y in zip(found, decode(found, w, t), strict=True) if y)


def _extractor(w: dict[str, float], t: tuple[float, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, w, t) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each page."""
    return pages.select("page_id", "url", "html").mapInArrow(_extractor(*model()), "page_id long, url string, text string, n_chars long")


def op8_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
