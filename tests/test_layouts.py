"""Nested values, related totals of hot keys, paged indexes, published tables, landed files, XML with faults."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from tidemark import shared
from tidemark.operators import diff, fiscal, graph, nested
from tidemark.sources import files, landed, published

LOTS = "lot int, owners array<string>, previous array<struct<day:string,owners:array<string>,deep:array<array<struct<who:string>>>>>, found int"
ROWS = [
    (1, ["b", None, "a", "a"], [("x", ["c", "?"], [[("a",)], [], None]), None, ("y", None, None)], 1),
    (2, [], [], 2),
    (3, None, None, None),
    (1, ["b", None, "a", "a"], [("x", ["c", "?"], [[("a",)], [], None]), None, ("y", None, None)], 1),
]


@pytest.mark.parametrize("small", [True, False])
def test_nested_lookups_keep_order_and_nesting(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(shared, "BROADCAST_ROWS", -1)
    ids = spark.createDataFrame([("a", 5), ("a", 1), ("b", 2), ("c", 3), ("c", None), (None, 9)], "name string, oid int")
    got = nested.looked_up(spark.createDataFrame(ROWS, LOTS), {"oids": "owners", "before": "previous.owners", "who": "previous.deep.who"}, ids, "name", "oid")
    assert got.columns == ["lot", "owners", "previous", "found", "oids", "before", "who"]
    rows = sorted(got.select("lot", "oids", "before", "who").collect())
    assert [tuple(r) for r in rows[:2]] == [(1, [2, None, 1, 1], [[3, None], None, None], [[[1], [], None], None, None])] * 2
    assert [tuple(r) for r in rows[2:]] == [(2, [], [], []), (3, None, None, None)]
    assert nested.looked_up(spark.createDataFrame(ROWS, LOTS), {"oids": "owners"}, ids.limit(0), "name", "oid").filter("lot = 1").first()["oids"] == [None] * 4


def test_changes_at_any_depth(spark):
    got = nested.changed_at(spark.createDataFrame(ROWS, LOTS), {"owners": F.upper, "previous.deep.who": lambda x: F.concat(x, x), "lot": lambda x: -x})
    row = got.first()
    assert (row["lot"], row["owners"]) == (-1, ["B", None, "A", "A"])
    assert row["previous"][0]["deep"] == [[("aa",)], [], None] and row["previous"][1] is None and row["previous"][0]["owners"] == ["c", "?"]
    with pytest.raises(ValueError, match="no field"):
        nested.changed_at(got, {"owners.x": F.upper})


def _related(links, values):
    of: dict = {}
    for k, r in links:
        if k is not None:
            of.setdefault(k, set()).add(r)
    near = {r: set().union(*(of[k] for k, x in links if x == r and k is not None)) - {r} for r in values}
    return {r: (v + sum(values.get(o, 0) for o in near[r]), len(near[r])) for r, v in values.items()}


@pytest.mark.parametrize("most", [1, 3, 6])
def test_related_totals(spark, monkeypatch, most):
    monkeypatch.setattr(graph, "FEW_KEYS", most)
    rng = random.Random(most)
    links = [(rng.choice(["hot", "k1", "k2", "k3", "k4", "k5", None]), rng.randrange(40)) for _ in range(90)] + [(f"k{i}", 7) for i in range(9)]
    values = {r: round(rng.uniform(-9, 9), 2) for r in range(45)}
    df, v = spark.createDataFrame(links, "k string, lot int"), spark.createDataFrame(list(values.items()), "lot int, v double")
    want = _related(links, values)
    got = {r["lot"]: r["total"] for r in graph.related_sums(df, "k", "lot", v, "v").collect()}
    assert got.keys() == want.keys() and all(abs(got[r] - want[r][0]) < 1e-7 for r in want)
    linked = {r for k, r in links if k is not None}
    assert {r["lot"]: r["n"] for r in graph.related_counts(df, "k", "lot").collect()} == {r: want[r][1] for r in linked}


def test_related_totals_in_one_pass(spark, monkeypatch):
    """Totals and counts of one pass over the links are those of two; pairs are dealt by their number."""
    monkeypatch.setattr(graph, "FEW_KEYS", 2)
    monkeypatch.setattr(graph, "PAIRS", 40)
    rng = random.Random(5)
    links = [(rng.choice(["k1", "k2", "k3", "k4", None]), rng.randrange(30)) for _ in range(70)]
    values = {r: round(rng.uniform(-9, 9), 2) for r in range(35)}
    df, v = spark.createDataFrame(links, "k string, lot int"), spark.createDataFrame(list(values.items()), "lot int, v double")
    want, linked, calls = _related(links, values), {r for k, r in links if k is not None}, []
    united = graph._united
    monkeypatch.setattr(graph, "_united", lambda *x: calls.append(x) or united(*x))
    got = {r["lot"]: (r["total"], r["n"]) for r in graph.related_totals(df, "k", "lot", v, "v").collect()}
    assert got.keys() == linked and all(abs(got[r][0] - want[r][0]) < 1e-7 and got[r][1] == want[r][1] for r in linked) and len(calls) == 1
    met = graph.related(df, "k", "lot")
    assert met.rdd.getNumPartitions() > 4  # the session's partitions, which would hold more than PAIRS each
    assert sorted(map(tuple, met.collect())) == sorted({(a, b) for k, a in links for j, b in links if k is not None and k == j and a != b})


def test_a_key_that_many_share_makes_no_pairs(spark):
    """A key of 10^5 records: their totals without their 10^10 pairs."""
    links = spark.range(100_000).select(F.lit("hot").alias("k"), F.col("id").alias("lot")).unionByName(spark.range(100_000).select(F.concat(F.lit("own"), F.floor(F.col("id") / 2)).alias("k"), F.col("id").alias("lot")))
    values = spark.range(100_000).select(F.col("id").alias("lot"), F.lit(1.5).alias("v"))
    got = graph.related_sums(links, "k", "lot", values, "v").agg(F.count("*"), F.min("total"), F.max("total")).first()
    assert tuple(got) == (100_000, 150_000.0, 150_000.0)


def test_pages_of_an_index(spark):
    links = [("hot", i, "own") for i in range(205)] + [("hot", 3, "gone"), ("b", 1, "own"), (None, 2, "own")]
    df = spark.createDataFrame(links, "owner string, lot int, kind string").repartition(4)
    got = {(r["owner"], r["page"]): [(x["record"], x["kinds"]) for x in r["records"]] for r in graph.paged_index(df, "owner", "lot", "kind", 50).collect()}
    assert sorted(k[1] for k in got if k[0] == "hot") == [0, 1, 2, 3, 4] and [len(got["hot", p]) for p in range(5)] == [50] * 4 + [5]
    assert sum((got["hot", p] for p in range(5)), []) == [(i, ["gone", "own"] if i == 3 else ["own"]) for i in range(205)]
    assert got["b", 0] == [(1, ["own"])] and got[None, 0] == [(2, ["own"])]


def test_added_columns_are_changes(spark):
    old, new = spark.createDataFrame([(1, 2), (2, 3)], "k int, a int"), spark.createDataFrame([(1, 2, None), (2, 3, "x")], "k int, a int, b string")
    assert [tuple(r) for r in diff.keyed_diff(old, new, ["k"]).collect()] == [(2, "changed", "b")]
    assert [tuple(r) for r in diff.keyed_diff(new, old, ["k"]).collect()] == [(2, "changed", "b")]


def test_publishing_is_all_or_nothing(spark, tmp_path, monkeypatch):
    rows = lambda *x: spark.createDataFrame(list(x), "v int, k string")
    read = lambda back=0: sorted(map(tuple, published.published(spark, str(tmp_path), "k", back).select("k", "v").collect()), key=repr)
    with pytest.raises(ValueError, match="nothing"):
        read()
    assert published.publish(rows((1, "a"), (2, "b"), (3, None), (4, "a")), str(tmp_path), "k") == 1
    assert read() == [("a", 1), ("a", 4), ("b", 2), (None, 3)]
    from pyspark.sql import DataFrameWriter

    written = DataFrameWriter.parquet

    def fails(self, path, *args, **kwargs):
        if path.endswith("/list"):
            raise OSError("lost between the steps")
        written(self, path, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", fails)
        with pytest.raises(OSError, match="between"):
            published.publish(rows((9, "a")), str(tmp_path), "k", ["b"])
    assert read() == [("a", 1), ("a", 4), ("b", 2), (None, 3)]  # the old table counts, whole
    assert published.publish(rows((9, "a"), (8, "c")), str(tmp_path), "k", ["b"]) == 2
    assert read() == [("a", 9), ("c", 8), (None, 3)] and read(1) == [("a", 1), ("a", 4), ("b", 2), (None, 3)]
    published.publish(rows((5, None)).limit(0), str(tmp_path), "k", ["a", "c"])
    assert read() == [(None, 3)]


def test_landed_files(spark, tmp_path):
    for day, name, n in (("2024-01-01", "x", 3), ("2024-01-02", "x", 2), ("2024-01-02", "y", 1), ("soon", "x", 1)):
        folder = tmp_path / f"landed={day}" / f"name={name}"
        folder.mkdir(parents=True)
        for i in range(n):
            (folder / f"f{i}").write_bytes(bytes([i]) * i)
    (tmp_path / "landed=2024-01-01" / "name=x" / ".f.crc").write_bytes(b"x")
    (tmp_path / "_SUCCESS").write_bytes(b"")
    df = landed.landed_files(spark, str(tmp_path), 0)
    assert df.count() == 7 and df.rdd.getNumPartitions() == 6  # two empty ones share
    some = df.filter((F.col("landed") >= dt.date(2024, 1, 2)) & (F.col("name") == "x") & (F.col("size") > 0))
    assert [tuple(r) for r in some.collect()] == [(dt.date(2024, 1, 2), "x", "f1", 1, bytearray(b"\x01"))]
    assert some.rdd.getNumPartitions() == 2  # the other files are not planned for
    assert df.filter("landed is null").select("name", "file").collect() == [("x", "f0")]
    assert landed.landed_files(spark, str(tmp_path / "none")).count() == 0
    assert landed.landed_files(spark, str(tmp_path)).rdd.getNumPartitions() == 1


def test_landed_lines_keep_their_order(spark, tmp_path):
    """Lines that come from several tasks, the later ones first."""
    lines = spark.range(0, 4000, 1, 4).select(F.lit("x").alias("name"), F.col("id").cast("string").alias("value"), (4000 - F.col("id")).alias("at"))
    landed.write_lines(lines, str(tmp_path), "2024-01-01", "at", 2)
    found = [[int(x) for x in open(f).read().split()] for f in glob.glob(f"{tmp_path}/landed=2024-01-01/name=x/part-*")]
    assert len(found) == 2 and sum(map(len, found)) == 4000 and all(x == sorted(x, reverse=True) for x in found)


def test_xml_faults(spark):
    texts = ["<p><a>1</a><b>x</b></p>", "<p><a>one</a><b>x</b></p>", "<p><a>1</a>", "<p><a>1</a></p>", "", None, "<p/>"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, parsed_from string")
    got = files.validated_xml(df, "parsed_from", "a int, b string", ("a", "b"))
    assert {r["i"]: r["fault"] for r in got.collect()} == {0: None, 1: "malformed", 2: "malformed", 3: "missing b", 4: "empty", 5: "empty", 6: "missing a"}
    assert got.filter("i = 0").select("parsed.*").first() == (1, "x")


@pytest.mark.parametrize("months", [12, 7])
def test_history_of_taxation(spark, months):
    rows = [("f", "1231", y, m, 100.0, 0.4 if (y, m) == low else 0.9, 0.0) for low in [(2023, 9)] for y in (2022, 2023) for m in range(1, 13 if y == 2022 else months + 1)]
    rows += [("g", None, 2023, m, 100.0, 0.9, 0.1) for m in range(1, 13)] + [("h", "0630", 2022, m, 100.0, 0.9, 0.1) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "fund string, year_end string, year int, month int, assets double, usgo double, muni double")
    got = {(r["fund"], r["year"]): (r["months"], r["passes"], r["history"], r["estimate"]) for r in fiscal.taxation(df, "fund", 2023).collect()}
    assert got["f", 2022] == (12, True, "complete", "complete")
    assert got["f", 2023] == ((12, False, "complete", "complete") if months == 12 else (7, True, "current-year", "YTD"))
    assert got["g", 2023] == (12, True, "missing fiscal year", "complete")
    assert got["h", 2022] == (12, True, "incomplete", "complete") and got["h", 2023] == (12, True, "incomplete", "new-year-placeholder")
    assert len(got) == 5


def test_csv_by_headings(spark, tmp_path):
    (tmp_path / "a.csv").write_text('B,"A x",C\n1,"2, two",3\n4\n')
    (tmp_path / "b.csv").write_text("A x,B\n5,6\n")
    got = files.csv_named(spark, str(tmp_path), {"first": "A x", "second": "B", "none": "Z"}, 3)
    assert sorted(map(tuple, got.collect()), key=repr) == [("2, two", "1", None), ("5", "6", None), (None, "4", None)]
    assert glob.glob(f"{tmp_path}/*.csv")
