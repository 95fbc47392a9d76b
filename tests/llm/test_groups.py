"""Maximal repeat groups, and what stays of rows that repeat an id or have none."""

import pytest


@pytest.mark.parametrize("most", [3, 20_000])
def test_groups_are_maximal(spark, docs, monkeypatch, most):
    """Of repeats that reach no horizon: all occurrences, and no further byte before or after that all share."""
    from tidemark.llm import repeats

    monkeypatch.setattr(repeats, "MOST", most)
    rows = [(i, t) for i, t in docs if i is not None]
    found: dict = {}
    for r in repeats.repeat_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault((r["group_id"], r["n_bytes"]), set()).add((r["doc_id"], r["start"]))
    data = {i: (t or "").encode() for i, t in rows}
    strings = {}
    for (_, n), places in found.items():
        texts = {data[i][s : s + n] for i, s in places}
        assert len(texts) == 1 and n >= repeats.LEAST
        strings[texts.pop()] = places
    for x, places in strings.items():
        assert places == {(i, s) for i, d in data.items() for s in range(len(d) - len(x) + 1) if d.startswith(x, s)}
    assert len(strings) > 20
    if most > 3:  # no further byte before or after that all share
        for x, places in strings.items():
            after = {data[i][s + len(x) : s + len(x) + 1] or i for i, s in places}
            before = {data[i][max(0, s - 1) : s] or (i, s) for i, s in places}
            assert len(places) == 1 or len(before) > 1 and (len(after) > 1 or len(x) >= repeats.RIGHT)


def test_one_row_of_each_id_and_set(spark):
    from tidemark.llm.minhash import deduplicated

    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, long, "a"), (1, long, "b"), (2, long + " end", "c"), (None, long.upper(), "d"), (None, "some other text of six words", "e"), (None, "Some other text of six words", "f"), (None, "", "g"), (None, None, "h"), (5, None, "i"), (6, "", "j")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, doc_id_gone string, text_name int")
    got = deduplicated(docs, 80)
    assert got.columns == docs.columns
    kept = sorted(got.collect(), key=repr)
    assert [r["doc_id"] for r in kept if r["doc_id"] is not None] == [1, 5, 6]
    left = [r["doc_id_gone"] for r in kept if r["doc_id"] is None]
    assert {"g", "h"} <= set(left) and len(left) == 3 and len({"e", "f"} & set(left)) == 1


def test_cells_follow_the_bytes():
    """As many cells a word at 1 TiB as at 1 MiB, and ranges of equal size."""
    from tidemark.llm.substrings import BYTES_PER_WORD, CELLS_PER_WORD, RANGE, shape

    for total in (1 << 20, 1 << 30, 1 << 40, 100 << 40):
        ranges, bits = shape(total)
        assert 2**bits >= CELLS_PER_WORD * total / BYTES_PER_WORD and (ranges - 1) * RANGE <= total


def test_windows_with_equal_first_hashes():
    import numpy as np

    from tidemark.llm import substrings

    words = [b"w%d" % k for k in range(40)]
    first, second = substrings.window_hashes(substrings.word_hashes(words), 35), substrings._second(words)
    rows = np.array([[first[0], first[1], first[1], first[2]], [second[0], second[1] + np.uint64(1), second[1], second[2] + np.uint64(5)]])
    assert substrings._hits(words, rows[:, np.lexsort(rows[::-1])]).tolist() == [True, True, False, False, False, False]


@pytest.mark.parametrize("number", [2, 3])
def test_many_equal_rows_come_once_to_a_chunk(spark, tmp_path, number):
    """Twenty thousand equal rows: one of them in one chunk, all of them in the result."""
    import hashlib

    from pyspark.sql import functions as F

    from tidemark.llm import common
    from tidemark.llm.queries import QUERIES

    text = " ".join(f"w{k * 7919 % 1000}" for k in range(300))
    hot = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    docs = hot.unionByName(spark.createDataFrame([(1, "short"), (1, "short"), (2, "x " + text[:900]), (3, "lone " * 3)], "doc_id long, text string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows, chunks, _, some = common.chunked(spark.read.parquet(f"{tmp_path}/documents.parquet"), 1 << 16, 1 << 16)
    sizes = {r["chunk"]: r["n"] for r in rows.groupBy("chunk").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    assert some and chunks > 100 and max(sizes.values()) < 1 << 16 and sorted(r["copies"] for r in rows.collect()) == [1, 1, 2, 20_000]
    f = next(f for n, f in QUERIES.items() if n.startswith(f"op{number}_"))
    got = f(spark, str(tmp_path)).groupBy("doc_id", "n_removed", "kept_sha256").count().collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    whole = len(text) if number == 2 else 300
    left = ("x " + text[:900])[:2] if number == 2 else "x"
    cut = text[:900].rfind(" ")
    if number == 3 and text[900] != " ":  # the last word is cut, so it is in no shared window
        left += text[cut:900]
    want = {(None, whole, sha(""), 20_000), (1, 0, sha("short"), 2), (2, 900 if number == 2 else len(("x " + text[:900]).split()) - len(left.split()), sha(left), 1), (3, 0, sha("lone " * 3 if number == 2 else "lone lone lone"), 1)}
    assert {tuple(r) for r in got} == want
