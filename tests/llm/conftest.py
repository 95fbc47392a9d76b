"""A small folder of tables with the awkward cases, and a runner of queries over it."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


def _texts() -> list:
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, base, item = prose(120), prose(160).split(), prose(25)
    texts = [None, "", "  \n\t ", "one", "One two", "one two", "a b c d e", "A b C d e", "x" * 3000, "ab " * 900, "é ü ß 漢字 " * 60]
    texts += [prose(n) for n in (3, 19, 20, 34, 35, 36, 80, 400)]
    texts += [f"{prose(30)} {shared} {prose(40)}" for _ in range(6)] + [shared, shared]
    for k in range(40):  # a chain of copies, each a few words from the last
        base[rng.randrange(160)] = word()
        texts.append(" ".join(base))
        if k % 9 == 0:
            texts.append(" ".join(base))
    for _ in range(25):  # copies of one text, each changed in two places of its own
        mine = list(base)
        for p in rng.sample(range(160), 2):
            mine[p] = word()
        texts.append(" ".join(mine))
    texts += [f"{prose(15)}. {item.upper()}! {prose(9)}", item, " ".join(item.split()[:10]), "tiny item here", "say tiny item  HERE now"]
    texts += [
        "This work is licensed under the GNU General Public License, version 3. MIT license; Apache-License mit-licensed",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "mail a.b@c.de, x@y, q@w.e.r. or f@g.h@i.jk; b@c.dd%z@q.ws 1.2.3.4 300.1.1.1 001.002.003.255 9.9.9.9.9.9.9.9",
        "card 4111 1111 1111 1111, 4111-1111-1111-1112 378282246310005 +1 (555) 010-2030, +49 30 12, +12345678901234567890",
        "call (555) 123-4567 or write jane [at] mail [dot] com; ip fe80:0:0:0:1:2:3:4 order 123456789012",
        "\n".join(["same line", "same line", "", " ", "other", "same line"]),
        " ".join(["p q r s t u v w"] * 5),
        "idiot " * 3 + prose(30),
    ]
    return texts


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """documents (with a repeated row, a null id and clashing columns), benchmark, labels and pages."""
    top = tmp_path_factory.mktemp("tables")
    texts = _texts()
    rows = [(i, t, "en" if i % 3 else None, "src0", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[20], (None, texts[22], None, None, None), (None, None, None, None, None)]
    rows = [(*r, "x", 1) for r in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string, n_words int").repartition(3).write.parquet(f"{top}/documents.parquet")
    item = next(t for t in texts if t and t.startswith("tiny"))
    items = [(1, next(texts[k - 2] for k, t in enumerate(texts) if t == item)), (2, item), (3, None), (4, "!!"), (5, item), (6, texts[18])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    labels = [(i, 1, int(i == len(texts) - 1)) for i in range(0, len(texts), 2)] + [(None, 1, 1), (10**9, 0, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{top}/labels.parquet")
    pages = [(1, "u", None), (2, "u", ""), (3, None, "just text"), (4, "u", "<nav><a href=/>Menu</a></nav><article><h1>A &amp; B</h1><p>First  line<br>goes on.<p>Second.</article><footer>&copy; x</footer>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{top}/pages.parquet")
    return str(top)


@pytest.fixture(scope="session")
def docs(spark, folder):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


@pytest.fixture(scope="session")
def run(spark, folder):
    from tidemark.llm.queries import QUERIES

    def rows(number: int, *columns: str) -> list[tuple]:
        f = next(f for n, f in QUERIES.items() if n.startswith(f"op{number}_"))
        found = f(spark, folder)
        return sorted(map(tuple, (found.select(*columns) if columns else found).collect()), key=repr)

    return rows


@pytest.fixture(scope="session")
def empty(spark, folder, tmp_path_factory):
    """The same tables without rows."""
    top = tmp_path_factory.mktemp("empty")
    for t in ("documents", "benchmark", "labels", "pages"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{top}/{t}.parquet")
    return str(top)
