"""Label and value search in pages: each rule's own way, the order of rules, broken pages."""

import pytest
from pyspark.sql import functions as F

from tidemark.sources import dom

LABEL = r"(?i)NAV\s+as\s+of"


def found(spark, html, **rules):
    pages = dom.nodes(spark.createDataFrame([(1, html, "x")], "k int, html string, node string"), "html")
    assert pages.columns == ["k", "node", "text", "nodes"]
    return pages.select(*[v.alias(k) for k, v in rules.items()]).first().asDict()


CASES = [
    (lambda p: p.labelled(LABEL), '<ul><li role="listitem"><p data-id="a-label">x NAV  as\nof May</p><div><b webqc-datapoint="nav">12</b></div></li></ul>', "12"),
    (lambda p: p.labelled(LABEL), '<div><i data-id="a-label">NAV as of</i><i> </i></div><div><i data-id="b-label">NAV as of</i><i>7 &amp; 8</i></div>', "7 & 8"),
    (lambda p: p.labelled(LABEL), '<p data-id="b-label">other</p><p data-id="b-data">5</p>', None),
    (lambda p: p.label_text(LABEL), '<p data-id="b-label">NAV as of <b>June</b></p>', "NAV as of June"),
    (lambda p: p.beside(LABEL), "<span>NAV as of</span><i></i><dl><dt>NAV as of<dd>3</dl>", "3"),  # a dt comes before a span
    (lambda p: p.beside(LABEL), "<div><b>NAV as of</b></div>", None),
    (lambda p: p.beside(LABEL), "<tr><td><b>NAV as of</b></td><td>4</td></tr>", "4"),
    (lambda p: p.near(LABEL), "<p>NAV as of " + "x" * 130 + " 5</p><p>next</p>", "next"),
    (lambda p: p.near(LABEL), "<p>NAV as of: -1,234.5 yrs</p>", "-1,234.5 yrs"),
    (lambda p: p.near(LABEL), "<div><em>a</em><em>NAV as of</em></div>", None),
    (lambda p: p.by_attribute("nav", "net"), '<p data-id="NetValue">1</p><p data-id="x-NAV"><i>a</i><i data-id="q-data">2</i></p>', "2"),
    (lambda p: p.by_attribute("nav"), '<p webqc-datapoint="nav"><i>a</i><i>3 $</i><i>4%</i></p>', "4%"),
    (lambda p: p.by_attribute("nav"), '<p webqc-datapoint="nav"><i>a</i><i>3 $</i></p>', "3 $"),
    (lambda p: p.by_attribute("nav"), '<p webqc-datapoint="nav"></p><p data-id="nav">own</p>', "own"),
    (lambda p: p.percent_near("yield"), "<section><p>a yield</p><p>none</p><div><i>9.25 %</i></div></section>", "9.25 %"),
    (lambda p: p.percent_near("yield"), '<ul><li role="listitem"><p><b>yield</b></p><i>1%</i></li></ul>', "1%"),
    (lambda p: p.page_text(r"[0-9]+ units"), "<p>a</p><p>12 units of 13 units</p>", "12 units"),
    (lambda p: p.holding("MAT", "worst"), "<div><p>x</p></div><p>Yield to Worst</p>", "Yield to Worst"),
    (lambda p: p.defined("status"), "<dl><dt>Status<dd>open</dl>", "open"),
    (lambda p: p.defined("status"), "<table><tr><th>Status<td>shut<td>b</table>", "shut"),
    (lambda p: p.defined("status"), "<span>The STATUS</span><i>" + "y" * 499 + "</i>", "y" * 499),
    (lambda p: p.defined("status"), "<span>The STATUS</span><i>" + "y" * 500 + "</i>", None),
    (lambda p: p.element("h2", "class", "b"), '<h2>a</h2><h2 class="a b">c<br>d</h2>', "c d"),
]


@pytest.mark.parametrize("case", CASES, ids=range(len(CASES)))
def test_rules(spark, case):
    rule, html, want = case
    assert found(spark, html, v=rule(dom.Page())) == {"v": want}
    assert found(spark, f"<html><head><title>NAV as of 1% yield status</title></head><body>{html}</body></html>", v=rule(dom.Page())) == {"v": want}


def test_order_of_rules(spark):
    p = dom.Page()
    both = dom.first_value(labelled=p.labelled(LABEL), near=p.near(LABEL), page=p.page_text("z"))
    assert found(spark, "<p>NAV as of 5</p>", v=both)["v"].asDict() == {"value": "5", "rule": "near"}
    assert found(spark, "<p>a</p>", v=both)["v"].asDict() == {"value": None, "rule": None}


@pytest.mark.parametrize("html", [None, "", "no tags", "<", "</p></div>", "<p", "<!-- x --><br>", "&amp;"])
def test_pages_without_elements(spark, html):
    p = dom.Page()
    assert found(spark, html, a=p.labelled(LABEL), b=p.beside(LABEL), c=p.near(LABEL), d=p.percent_near("a"), e=p.defined("a"), f=p.element("p")) == dict.fromkeys("abcdef")


def test_nodes(spark):
    html = "<body><p>a  b<p>c<ul><li>1<ul><li>2</ul><li>3</ul><table><tr><td>x<td>y<tr><td>z</table></div>end<script>no</script>"
    row = dom.nodes(spark.createDataFrame([(html,)], "html string"), "html").first()
    text = lambda n: row["text"][n["lo"] : n["hi"]].strip()
    assert row["text"] == "a bc123xyzend"
    by_tag = [(n["tag"], text(n)) for n in row["nodes"]]
    assert by_tag == [("body", "a bc123xyzend"), ("p", "a b"), ("p", "c"), ("ul", "123"), ("li", "12"), ("ul", "2"), ("li", "2"), ("li", "3"), ("table", "xyz"), ("tr", "xy"), ("td", "x"), ("td", "y"), ("tr", "z"), ("td", "z"), ("script", "")]
    for n in row["nodes"]:  # descendants are the elements up to the end, siblings follow each other
        assert all((n["node"] < m["node"] < n["end"]) == _inside(row["nodes"], m, n) for m in row["nodes"])
        after = [m["node"] for m in row["nodes"] if m["parent"] == n["parent"] and m["node"] > n["node"]]
        assert n["next"] == (after[0] if after else None)


def _inside(nodes, m, n):
    while m["parent"] >= 0:
        m = nodes[m["parent"]]
        if m["node"] == n["node"]:
            return True
    return False


def test_scripts_count_if_asked(spark):
    df = spark.createDataFrame([("<p>a</p><script>b</script>",)], "html string")
    assert dom.nodes(df, "html", silent=()).first()["text"] == "ab"
    assert dom.nodes(df.limit(0), "html").count() == 0


def test_deep_and_long_pages(spark):
    p = dom.Page()
    html = "<div>" * 3000 + "NAV as of" + "</div>" * 3000 + "<p>word</p>" * 3000 + "<b>NAV as of</b><i>8</i>"
    assert found(spark, html, v=p.beside(LABEL), n=F.size("nodes")) == {"v": "8", "n": 6002}


def test_references_without_their_semicolon_stay(spark):
    page = "<h1 title='a&amp'>x &amp; y&amp</h1><h2>&#38; &#38 &middot; & &middot</h2>"
    pages = dom.nodes(spark.createDataFrame([(1, page)], "k int, html string").select("k", dom.closed_references(F.col("html")).alias("html")), "html")
    p = dom.Page()
    assert tuple(pages.select(p.element("h1"), p.element("h2")).first()) == ("x & y&amp", "& &#38 · & &middot")
