"""Label and value search in pages: a page as an array of nodes, searched by ordered rules with Spark's functions.

nodes() parses each page once, in Arrow batches, into its text and its elements in page order. An element's
descendants are the elements up to its `end`, its text is a piece of the page's text (white space collapsed),
so pages take as much room as they are long, however deep they nest. Rules are columns over a page: each looks through
matching elements in page order and stops at the first value; first_value() tries rules in order and says which
one found it. An empty text is no value. Patterns are regular expressions without groups that capture.

Edge cases: a null or empty page has no elements, and no rule finds anything; unclosed elements end with their
parent, stray end tags count for nothing; elements outside the body are not searched where a page has one;
texts of SILENT elements are left out; repeated rows are each searched; further columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = ("script", "style", "noscript", "template")
#: Elements whose start ends an open one, up to the element they stand in.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_BARRIER = frozenset("ul ol dl table select body html article section".split())
_BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_TAGS = ("dt", "th", "td", "span", "strong", "b", "label")
NUMBER = r"[-+]?[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?(?:\s*(?:%|yrs|years|yr|b|m))?"
PERCENT = r"[-+]?[0-9]+(?:\.[0-9]+)?\s*%"
#: Characters between a label and its number in one text, and of a value beside a word.
NEAR, SHORT = 120, 500
NODE = "struct<node:int,parent:int,end:int,next:int,tag:string,attrs:map<string,string>,lo:int,hi:int>"
_NODE = pa.struct([("node", pa.int32()), ("parent", pa.int32()), ("end", pa.int32()), ("next", pa.int32()), ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())), ("lo", pa.int32()), ("hi", pa.int32())])


class _Page(HTMLParser):
    """The elements of a page in order, each with its place in the page's text."""

    def __init__(self, silent: tuple[str, ...], apart: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.silent, self.quiet, self.apart = silent, 0, apart
        self.nodes, self.open, self.last, self.text, self.size = [], [], {}, [], 0
        self.space = True

    def _close(self, depth: int) -> None:
        while len(self.open) > depth:
            i = self.open.pop()
            node = self.nodes[i]
            node["end"], node["hi"] = len(self.nodes), self.size
            self.quiet -= node["tag"] in self.silent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        ends = _ENDS.get(tag, ("p",) if tag in _BLOCKS else ())
        for depth in range(len(self.open) - 1, -1, -1) if ends else ():
            at = self.nodes[self.open[depth]]["tag"]
            if at in ends:
                self._close(depth)
                if tag != "tr":
                    break
            elif at in _BARRIER:
                break
        if self.apart:
            self.handle_data(" ")
        parent, i = self.open[-1] if self.open else -1, len(self.nodes)
        if parent in self.last:
            self.nodes[self.last[parent]]["next"] = i
        self.last[parent] = i
        self.nodes.append({"node": i, "parent": parent, "end": i + 1, "next": None, "tag": tag, "attrs": [(k, v or "") for k, v in dict(attrs).items()], "lo": self.size, "hi": self.size})
        if tag not in VOID:
            self.open.append(i)
            self.quiet += tag in self.silent
        else:
            self.handle_data(" " if tag == "br" else "")

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[depth]]["tag"] == tag:
                self._close(depth)
                break
        if self.apart:
            self.handle_data(" ")

    def handle_data(self, data: str) -> None:
        if self.quiet or not data:
            return
        piece = re.sub(r"\s+", " ", data)
        if self.space and piece[0] == " ":
            piece = piece[1:]
        if piece:
            self.text.append(piece)
            self.size += len(piece)
            self.space = piece[-1] == " "


def _parsed(html: str | None, silent: tuple[str, ...], apart: bool) -> tuple[str, list[dict]]:
    page = _Page(silent, apart)
    page.feed(html or "")
    page.close()
    page._close(0)
    return "".join(page.text), page.nodes


def closed_references(html: Column) -> Column:
    """html, in which only references that end with a semicolon count: `&amp` alone stays as it is written."""
    return F.regexp_replace(html, "&(?!(?:[A-Za-z][A-Za-z0-9]*|#[0-9]+|#[xX][0-9A-Fa-f]+);)", "&amp;")


def nodes(df: DataFrame, html: str, text: str = "text", found: str = "nodes", silent: tuple[str, ...] = SILENT, apart: bool = False) -> DataFrame:
    """df without html, with the page's text and the array of its nodes. JavaScript counts text of scripts; so does
    silent=(). apart puts a blank between texts of different elements."""
    kept = [c for c in df.columns if c != html]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [_parsed(x.as_py(), silent, apart) for x in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([t for t, _ in pages], pa.string()), pa.array([n for _, n in pages], pa.list_(_NODE))], [*kept, text, found])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*[f"`{c}`" for c in kept]).schema.fields], f"`{text}` string, `{found}` array<{NODE}>"])
    return df.select(*[f"`{c}`" for c in kept], f"`{html}`").mapInArrow(run, schema)


class Page:
    """Rules over the columns of nodes(); each gives the value it finds, or null."""

    def __init__(self, text: str = "text", found: str = "nodes") -> None:
        self.page, self.all = F.col(text), F.col(found)
        body = F.filter(self.all, lambda n: n["tag"] == "body")
        self.searched = F.when(F.size(body) > 0, F.slice(self.all, F.get(body, 0)["node"] + 2, F.get(body, 0)["end"] - F.get(body, 0)["node"] - 1)).otherwise(self.all)

    def text(self, node: Column) -> Column:
        return F.trim(F.substring(self.page, node["lo"] + 1, node["hi"] - node["lo"]))

    def _value(self, node: Column) -> Column:
        return F.nullif(self.text(node), F.lit(""))

    def _at(self, i: Column) -> Column:
        return F.get(self.all, i)

    def within(self, node: Column) -> Column:
        """The descendants of an element."""
        return F.slice(self.all, node["node"] + 2, node["end"] - node["node"] - 1)

    def children(self, node: Column) -> Column:
        return F.filter(self.within(node), lambda x: x["parent"] == node["node"])

    def closest(self, node: Column, attribute: str, value: str) -> Column:
        """The nearest of an element and those around it with such an attribute; null if there is none."""
        around = F.filter(F.slice(self.all, F.lit(1), node["node"] + 1), lambda a: (a["end"] >= node["end"]) & (F.element_at(a["attrs"], attribute) == value))
        return F.try_element_at(around, F.lit(-1))

    def _parent(self, node: Column) -> Column:
        return F.when(node["parent"] >= 0, self._at(node["parent"]))

    def first(self, elements: Column, value: Callable[[Column], Column]) -> Column:
        """The first value of elements in order; later ones aren't looked at."""
        return F.aggregate(elements, F.lit(None).cast("string"), lambda a, n: F.coalesce(a, value(n)))

    def matching(self, pattern: str, among: Column | None = None) -> Column:
        return F.filter(self.searched if among is None else among, lambda n: self.text(n).rlike(pattern))

    def _after_match(self, parent: Column, pattern: str) -> Column:
        """The text of the child that follows an element's first child whose text matches."""
        kids = F.filter(F.transform(self.children(parent), lambda c: F.struct(c["next"].alias("next"), self.text(c).alias("text"))), lambda c: c["text"].rlike(pattern))
        return F.when(F.get(kids, 0)["next"].isNotNull(), self._value(self._at(F.get(kids, 0)["next"])))

    def labelled(self, pattern: str) -> Column:
        """The datum of a list item or parent whose "-label" element matches, else the child after the label."""
        ends = lambda n, k, end: F.coalesce(F.element_at(n["attrs"], k).endswith(end), F.lit(False))
        labels = F.filter(self.searched, lambda n: ends(n, "data-id", "-label"))
        datum = lambda n: ends(n, "data-id", "-data") | F.element_at(n["attrs"], "webqc-datapoint").isNotNull()

        def value(n: Column) -> Column:
            item = F.coalesce(self.closest(n, "role", "listitem"), self._parent(n))
            return F.coalesce(self._value(F.get(F.filter(self.within(item), datum), 0)), self._after_match(item, pattern))

        return self.first(self.matching(pattern, labels), value)

    def label_text(self, pattern: str) -> Column:
        """The text of the first "-label" element that matches."""
        labels = F.filter(self.searched, lambda n: F.coalesce(F.element_at(n["attrs"], "data-id").endswith("-label"), F.lit(False)))
        return self.first(self.matching(pattern, labels), self._value)

    def beside(self, pattern: str, tags: tuple[str, ...] = _TAGS) -> Column:
        """The text of the next sibling of a matching element, else of the child of its parent after the first that
        matches; elements of the first tag come before those of the second, and so on."""

        def value(n: Column) -> Column:
            beside = F.when(n["next"].isNotNull(), self._value(self._at(n["next"])))
            return F.coalesce(beside, F.when(n["parent"] >= 0, self._after_match(self._at(n["parent"]), pattern)))

        of_tag = lambda tag: F.filter(self.searched, lambda n: n["tag"] == tag)
        return F.coalesce(*[self.first(self.matching(pattern, of_tag(t)), value) for t in tags])

    def near(self, pattern: str) -> Column:
        """The number that follows the label within NEAR characters in the text of an element, else the text
        of its next sibling, else of the sibling after the first that matches."""
        flags, bare = re.match(r"((?:\(\?[a-z]+\))?)(.*)", pattern, re.DOTALL).groups()
        number = f"{flags}(?:{bare})[\\s\\S]{{0,{NEAR}}}?({NUMBER})"

        def value(n: Column) -> Column:
            beside = F.when(n["next"].isNotNull(), self._value(self._at(n["next"])))
            return F.coalesce(F.nullif(F.trim(F.regexp_extract(self.text(n), number, 1)), F.lit("")), beside, F.when(n["parent"] >= 0, self._after_match(self._at(n["parent"]), pattern)))

        return self.first(self.matching(pattern), value)

    def by_attribute(self, *patterns: str) -> Column:
        """Of the elements whose data id matches, by pattern and then in order: the text of the first "-data"
        element in it, else of the first with a percentage, else with an amount of dollars, else its own."""
        name = lambda n: F.coalesce(F.nullif(F.element_at(n["attrs"], "data-id"), F.lit("")), F.element_at(n["attrs"], "webqc-datapoint"))
        data = lambda n: F.coalesce(F.element_at(n["attrs"], "data-id").endswith("-data"), F.lit(False)) | F.coalesce(F.element_at(n["attrs"], "webqc-datapoint").endswith("-data"), F.lit(False))

        def value(n: Column) -> Column:
            inner = self.within(n)
            return F.coalesce(
                self._value(F.get(F.filter(inner, data), 0)),
                self._value(F.get(F.filter(inner, lambda x: self.text(x).contains("%")), 0)),
                self._value(F.get(F.filter(inner, lambda x: self.text(x).contains("$")), 0)),
                self._value(n),
            )

        named = lambda pattern: F.filter(self.searched, lambda n: F.coalesce(name(n).rlike(f"(?i){pattern}"), F.lit(False)))
        return F.coalesce(*[self.first(named(p), value) for p in patterns])

    def percent_near(self, pattern: str) -> Column:
        """The first percentage inside a matching element, its parent or its list item."""
        inside = lambda top: self.first(self.within(top), lambda d: F.nullif(F.regexp_extract(self.text(d), PERCENT, 0), F.lit("")))
        up = lambda n: F.coalesce(inside(n), F.when(n["parent"] >= 0, inside(self._at(n["parent"]))), inside(self.closest(n, "role", "listitem")))
        return self.first(self.matching(pattern), up)

    def page_text(self, pattern: str) -> Column:
        """What a pattern matches in the first element that it matches in."""
        return self.first(self.searched, lambda n: F.nullif(F.trim(F.regexp_extract(self.text(n), pattern, 0)), F.lit("")))

    def holding(self, *words: str) -> Column:
        """The text of the first element that holds any of the words, upper or lower case."""
        any_of = "(?i)" + "|".join(map(re.escape, words))
        return self.first(self.matching(any_of), self._value)

    def defined(self, word: str) -> Column:
        """What is defined by a word: the dd after a dt that holds it, the first td in the row of a th, or
        the next sibling's text below SHORT characters; upper or lower case."""
        holds = F.filter(self.searched, lambda n: n["tag"].isin("div", "dt", "th", "label", "span") & F.lower(self.text(n)).contains(word.lower()))

        def value(n: Column) -> Column:
            after = F.when(n["next"].isNotNull(), self._at(n["next"]))
            cell = F.when(n["parent"] >= 0, F.get(F.filter(self.within(self._at(n["parent"])), lambda x: x["tag"] == "td"), 0))
            return F.coalesce(
                F.when((n["tag"] == "dt") & (after["tag"] == "dd"), self._value(after)),
                F.when(n["tag"] == "th", self._value(cell)),
                F.when(F.length(self.text(after)) < SHORT, self._value(after)),
            )

        return self.first(holds, value)

    def element(self, tag: str, attribute: str | None = None, value: str | None = None) -> Column:
        """The text of the first element of a tag, or of those with a word in an attribute."""
        has = lambda n: F.lit(True) if attribute is None else F.coalesce(F.array_contains(F.split(F.element_at(n["attrs"], attribute), r"\s+"), value), F.lit(False))
        return self._value(F.get(F.filter(self.all, lambda n: (n["tag"] == tag) & has(n)), 0))


def first_value(**rules: Column) -> Column:
    """A struct of the value of the first rule that finds one, and the rule's name; nulls if none does."""
    found = F.coalesce(*[F.when(v.isNotNull(), F.struct(v.alias("value"), F.lit(k).alias("rule"))) for k, v in rules.items()])
    return F.coalesce(found, F.struct(F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("rule")))
