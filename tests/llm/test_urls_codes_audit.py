"""URL filters, vector codes and the filter audit: edge cases, plain versions, both ways of each join."""

import hashlib
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import shared
from tidemark.llm import audit, codes, urls

URLS = [None, "", "x", "http://", "://com/", "HTTP://WWW.Example.COM/en/a", "http://a.net/es/", "http://net/es", "u://com?x=/", "a://b://c/d", "http://com#/", "http://example.com./en/"]
URLS += ["http://notexample.com/en/", "http://m.example.com/EN/", "http://x.example.com/en/?q=/fr/", "http://x.net/fr/é\n/", "http://user@y.net:80/fr/", "https://casino-win.example.org/a/", "http://www.casino-win.example.org//a.html?x#y"]
URLS += ["http://example.org/casino/", "http://a.com" + "/b" * 20000, "http://" + "a." * 3000 + "org/" + "x" * 50000]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, "h", 1, "r") for i, u in enumerate(URLS)] + [(None, URLS[5], None, None, None), (5, URLS[5], "h", 1, "r"), (5, URLS[5], "h", 1, "r")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, block int, rule string").repartition(3)


def plain_verdict(url, rules, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    page = re.sub(r"^(www|m)\.", "", re.sub(r":(80|443)$", "", host)) + re.sub(r"(/|\.html?)$", "", re.sub("/{2,}", "/", path))
    best = max(fits, default=(0, 0, "block" if page in listed else "allow", None))
    return host, path, best[3], best[2]


def judge(spark, pages, rules, listed):
    found = urls.judged(pages, urls.entries(urls.rule_entries(spark, rules), spark.createDataFrame([(x,) for x in listed], "page string")))
    return sorted(map(tuple, found.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)


RULES = [urls.RULES, (("COM", "", "block"), ("example.com", "/e", "allow"), ("com", "/en/a", "block"), ("", "/", "block"), ("x.net", "/fr/é", "block"), ("x.net", "/fr/é", "block")), (("a.com", "/b/b/b/b", "block"),), ()]


@pytest.mark.parametrize("rules", RULES, ids=range(len(RULES)))
@pytest.mark.parametrize("small", [True, False])
def test_verdicts(spark, pages, monkeypatch, rules, small):
    if not small:
        monkeypatch.setattr(shared, "BROADCAST_ROWS", -1)
    listed = {"casino-win.example.org/a", "b:/c/d"}
    want = [(r["page_id"], *plain_verdict(r["url"], [(h.lower(), p, v) for h, p, v in rules], listed)) for r in pages.collect()]
    rules = rules or ((None, "/", "allow"),)
    assert judge(spark, pages, rules, sorted(listed)) == sorted(want, key=repr)


def test_a_full_filter_changes_no_verdict(spark, pages, monkeypatch):
    want = judge(spark, pages, urls.RULES, ["b:/c/d"])
    monkeypatch.setattr(urls, "MOST_BLOCKS", 1)
    monkeypatch.setattr(urls, "BITS_A_KEY", 0)
    assert judge(spark, pages, urls.RULES, [f"{i}.org/" for i in range(3000)] + ["b:/c/d"]) == want


def test_filter_passes_all_that_is_listed_and_little_else(spark):
    keys = spark.range(20000).select(F.lit("page").alias("kind"), F.concat(F.lit("h"), "id").alias("host"), F.lit("").alias("directory"))
    bits, blocks = urls.blocked_filter(keys, 20000)
    assert bits.count() <= blocks <= urls.MOST_BLOCKS
    assert urls.passing(keys, bits, blocks).count() == 20000
    others = spark.range(20000).select(F.lit("page").alias("kind"), F.concat(F.lit("g"), "id").alias("host"), F.lit("").alias("directory"))
    assert urls.passing(others, bits, blocks).count() < 600


def test_kept_pages_keep_their_columns(spark, pages):
    listed = urls.entries(urls.rule_entries(spark), urls.listed_pages(pages))
    kept = urls.kept_pages(pages.withColumnRenamed("block", "blocked_url"), listed)
    assert kept.columns == ["page_id", "url", "html", "blocked_url", "rule"]
    blocked = urls.judged(pages, listed).filter("verdict = 'block'")
    assert kept.count() == pages.count() - blocked.count() and blocked.count() > 4
    assert urls.kept_pages(pages.limit(0), listed).count() == 0


def plain_codes(rows):
    """(codes, errors, codebooks) of (id, vector) rows by comparing every part with every entry."""
    v = np.array([[int(np.floor(np.float64(x) * 4096)) for x in vec] for _, vec in rows], dtype=object)
    d = v.shape[1] // 8
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, list(rows[i][1])))[:16]
    books = [[tuple(v[i][p * d : (p + 1) * d]) for i in order] for p in range(8)]
    nearest = lambda x, b: min(range(len(b)), key=lambda e: (sum((a - c) ** 2 for a, c in zip(x, b[e], strict=True)), e))
    owners = lambda: [[nearest(x[p * d : (p + 1) * d], books[p]) for x in v] for p in range(8)]
    for _ in range(6):
        for p, own in enumerate(owners()):
            for e in set(own):
                mine = [x[p * d : (p + 1) * d] for x, o in zip(v, own, strict=True) if o == e]
                books[p][e] = tuple(sum(c) // len(mine) for c in zip(*mine, strict=True))
    own = owners()
    code = ["".join(f"{own[p][i]:02x}" for p in range(8)) for i in range(len(v))]
    error = [sum(int(a - c) ** 2 for p in range(8) for a, c in zip(x[p * d : (p + 1) * d], books[p][own[p][i]], strict=True)) for i, x in enumerate(v)]
    return code, error, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def coded(spark, folder, rows, **columns):
    schema = "vec_id long, embedding array<float>, label int, code string"
    spark.createDataFrame([(*r, "x") for r in rows], schema).repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    return codes.op12_vector_codes(spark, str(folder))


@pytest.mark.parametrize("kind", ["grid", "normal", "copies", "few", "wide"])
def test_codes(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(codes, "LEAF", 3)
    rng = np.random.default_rng(5)
    make = {"grid": lambda: rng.integers(-2, 3, 16) / 4096, "normal": lambda: rng.normal(size=16) / 5, "copies": lambda: np.full(16, rng.integers(0, 2)) * 0.3, "few": lambda: rng.normal(size=8), "wide": lambda: rng.normal(size=8) * 1e4}[kind]
    rows = [(i, [float(np.float32(x)) for x in make()], i % 3 or None) for i in range(7 if kind == "few" else 150)]
    rows += [(None, rows[3][1], None), (4, rows[4][1], 1), (4, rows[5][1], 1)]
    odd = [(900, None, 1), (901, [None, *rows[0][1][1:]], 1), (902, [float("nan"), *rows[0][1][1:]], 1), (903, [float("-inf"), *rows[0][1][1:]], None), (904, rows[0][1][:-1], 1), (905, [], 1)]
    found = coded(spark, tmp_path, rows + odd)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    code, error, sha = plain_codes([r[:2] for r in rows])
    by_label: dict = {}
    for r, e in zip(rows, error, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    want = [(r[0], c, e, by_label[r[2]], sha) for r, c, e in zip(rows, code, error, strict=True)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_codes_of_nothing(spark, tmp_path):
    assert coded(spark, tmp_path / "none", []).collect() == []
    assert coded(spark, tmp_path / "odd", [(1, None, None), (2, [float("inf")] * 8, 1)]).collect() == []


def test_balls_are_wholly_owned():
    """Far clusters are owned by balls with no look at their points, whose cached sums are those of the points."""
    rng = np.random.default_rng(2)
    middles = rng.integers(-(10**6), 10**6, (16, 8))
    points = np.unique(np.concatenate([m + rng.integers(-900, 900, (200, 8)) for m in middles]), axis=0)
    weights = rng.integers(1, 5, len(points))
    tree = codes.Tree(points, weights)
    assert sum(len(members) for _, _, members in tree.owners(middles)) < len(points) / 20
    own = codes.squared(points, middles).argmin(axis=1)
    total, count = tree.sums(middles)
    assert (tree.assigned(middles) == own).all()
    assert count == [int(weights[own == e].sum()) for e in range(16)]
    assert total == [(points[own == e] * weights[own == e][:, None]).sum(axis=0).tolist() for e in range(16)]


def plain_audit(docs, labels):
    """Every filter run over every order, document by document."""
    texts: dict = {}
    for i, t, _ in docs:
        if i is not None:
            texts[t or ""] = min(i, texts.get(t or "", i))
    value = lambda i, k: i is not None and any(x[0] == i and x[k] == 1 for x in labels)
    rows = []
    for i, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and texts[t] < i}
        rows.append((lang or "", {k for k in fails if fails[k]}, value(i, 1), value(i, 2)))
    out, shapley = [], {}
    for part in {r[0] for r in rows}:
        for order in itertools.permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                kept = [r for r in left if f not in r[1]]
                fail = [r for r in rows if r[0] == part and f in r[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out.append((part, "".join(order), step, len(kept), len(gone), len(fail) - len(gone), sum(r[1] == {f} for r in fail), sum(r[2] for r in gone), sum(r[3] for r in gone), f))
                left = kept
    return [(*r[:-1], shapley[r[0], r[-1]]) for r in out]


@pytest.mark.parametrize("small", [True, False])
def test_audit(spark, folder, tmp_path, monkeypatch, small):
    if not small:
        monkeypatch.setattr(shared, "BROADCAST_ROWS", -1)
        monkeypatch.setattr(audit, "A_SALT", 2)
    more = [(1000 + i % 40, "Many copies. " * 90, ["de", "", None][i % 3]) for i in range(60)] + [(None, "Many copies. " * 90, "de")] * 3
    more += [(2000, "w" + " x1 x2" * 200 + "$", "fr"), (2001, "ABC " * 9, "fr"), (2001, "ABC " * 9, "fr"), (1, "ABC " * 9, "en"), (2002, " ".join(map(str, range(200))), "fr"), (2003, "a " * 200 + " ".join(map(str, range(199))), "fr")]
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()] + more
    labels = [(i, int(i % 2 == 0), int(i % 7 == 0)) for i in range(0, 1040, 3)] + [(1000, 0, 1), (1000, 1, None), (None, 1, 1), (7, None, None)]
    spark.createDataFrame([(*d, "b", 1) for d in docs], "doc_id long, text string, lang string, bits string, n int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = audit.op13_filter_audit(spark, str(tmp_path))
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, found.collect())) == sorted(plain_audit(docs, labels))


def test_audit_of_nothing(spark, empty):
    assert audit.op13_filter_audit(spark, empty).count() == 0
    assert urls.op11_url_filters(spark, empty).count() == 0
