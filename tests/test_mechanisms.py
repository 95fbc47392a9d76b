"""As-of rolls by ranges, containment by grams, upserts by keyed state: against plain versions."""

import bisect
import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark import shared
from tidemark.operators import dedupe, lookups, series
from tidemark.streaming import state, upsert


def plain_asof(left, right, roll):
    days: dict = {}
    for k, d in right:
        if k is not None and d is not None:
            days.setdefault(k, []).append(d)
    days = {k: sorted(v) for k, v in days.items()}
    out = []
    for k, t, n in left:
        of = days.get(k, []) if k is not None and t is not None else []
        i = bisect.bisect_left(of, t) if of and roll == "next" else bisect.bisect_right(of, t) - 1 if of else -1
        out.append((k, t, n, of[i] if 0 <= i < len(of) else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("roll", ["next", "prev"])
@pytest.mark.parametrize("keyed", [True, False])
def test_asof(spark, monkeypatch, roll, keyed, small):
    if not small:
        monkeypatch.setattr(shared, "BROADCAST_ROWS", -1)
    rng = random.Random(3)
    key = lambda: rng.choice(["hot"] * 8 + ["a", "b", "only left", None]) if keyed else "hot"
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(3000)) if rng.random() > 0.02 else None
    left = [(key(), at(), n) for n in range(900)]
    right = [(k, at()) for k in (key() for _ in range(300)) if k != "only left"] + [("only right" if keyed else "hot", dt.datetime(2024, 1, 1))]
    a, b = spark.createDataFrame(left, "k string, at timestamp, t int").repartition(5), spark.createDataFrame(right, "k string, day timestamp").repartition(3)
    if keyed:
        found = series.asof(a, b, ["k"], "at", "day", roll).select("k", "at", "t", "day")
    else:
        found = series.asof(a.drop("k"), b.drop("k"), [], "at", "day", roll).select(F.lit("hot"), "at", "t", "day")
    assert sorted(map(tuple, found.collect()), key=repr) == plain_asof(left, right, roll)


def test_asof_sorts_one_key_in_ranges(spark, tmp_path):
    """Whatever a key holds, its times go to several ranges of like size."""
    times = spark.range(40000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 61).alias("at"))
    days = spark.range(500).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 4000).alias("day"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = set(_tables(spark))
    try:
        found = series.asof(times, days, ["k"], "at", "day", "prev")
        assert found.filter(F.unix_timestamp("day") != F.least(F.lit(499 * 4000), F.floor(F.unix_timestamp("at") / 4000) * 4000)).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (ranged,) = set(_tables(spark)) - before
    sizes = [r["count"] for r in spark.read.parquet(ranged).groupBy("range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 20000


def _tables(spark):
    import glob

    return glob.glob(shared.shared_folder(spark).removeprefix("file:") + "/table-*")


def test_asof_of_nothing(spark):
    a, b = spark.createDataFrame([("x", dt.date(2024, 1, 1))], "k string, at date"), spark.createDataFrame([], "k string, day date")
    assert [tuple(r) for r in series.asof(a, b, ["k"], "at", "day").collect()] == [("x", dt.date(2024, 1, 1), None)]
    assert series.asof(a.limit(0), b, ["k"], "at", "day").collect() == []


@pytest.mark.parametrize("small", [True, False])
def test_containment(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(shared, "BROADCAST_ROWS", -1)
    rng = random.Random(9)
    text = lambda n: "".join(rng.choices("abcé漢", k=n))
    texts = [(i, text(rng.randrange(0, 40)), "x") for i in range(300)] + [(5, "abcabc", "x"), (6, None, "x"), (7, "", "x"), (8, "needle in hay" * 2000, "x"), (9, "aé" * 500, None), (9, "aé" * 500, None)]
    words = [text(rng.randrange(1, 9)) for _ in range(80)] + ["", None, "needle", "hayneedle", "zzzz", "z", "漢" * 3, "a%", "a_"]
    df = spark.createDataFrame(texts, "id int, body string, word string").repartition(3)
    other = spark.createDataFrame([(w,) for w in [*words, *words]], "term string")
    found = lookups.containing(df, other, "body", "term")
    assert found.columns == ["id", "body", "word", "term"]
    want = [(i, t, x, w) for i, t, x in texts for w in {w for w in words if w} if t is not None and w in t]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert lookups.containing(df, other.limit(0), "body", "term").count() == 0
    assert lookups.containing(df.limit(0), other, "body", "term").count() == 0


def test_first_containing(spark):
    files = spark.createDataFrame([(3, "0000000123-x"), (1, "0000001234-y"), (2, "0000000123-z")], "place int, path string")
    ids = spark.createDataFrame([("123", 1), ("1234", 2), ("9", 3), (None, 4)], "cik string, n int")
    got = {r["n"]: (r["cik"], r["place"], r["path"]) for r in lookups.first_containing(ids, files, "cik", "path", "place").collect()}
    assert got == {1: ("123", 1, "0000001234-y"), 2: ("1234", 1, "0000001234-y"), 3: ("9", None, None), 4: (None, None, None)}


@pytest.mark.parametrize("lengths,characters,small", [(16, 1000, True), (0, 1000, False), (0, 0, True), (16, 0, False)])
def test_containment_by_each_way(spark, monkeypatch, lengths, characters, small):
    monkeypatch.setattr(lookups, "LENGTHS", lengths)
    monkeypatch.setattr(lookups, "CHARACTERS", characters)
    if not small:
        monkeypatch.setattr(shared, "BROADCAST_ROWS", -1)
    rng = random.Random(lengths + characters)
    text = lambda n, of: "".join(rng.choices(of, k=n))
    texts = [(i, text(rng.randrange(0, 30), "ab^]\\-1. \U0001f600")) for i in range(120)] + [(i, None) for i in (7, 8)]
    words = [text(rng.randrange(1, 8), "ab^]\\-\U0001f600") for _ in range(60)] + ["aaaaaaaaaa", None, ""]
    df, other = spark.createDataFrame(texts, "id int, body string").repartition(3), spark.createDataFrame([(w,) for w in words], "term string")
    want = sorted((i, t, w) for i, t in texts for w in {w for w in words if w} if t is not None and w in t)
    assert sorted(map(tuple, lookups.containing(df, other, "body", "term").collect())) == want
    kept = spark.createDataFrame([x for x in texts if x[0] < 120][:120], "id int, body string")
    first = {}
    for i, t in texts[:120]:
        for w in words:
            if w and w in t:
                first.setdefault(w, i)
    assert {r["term"]: r["id"] for r in lookups.first_containing(other.distinct(), kept, "term", "body", "id").collect()} == {w: first.get(w) for w in words}


def test_containment_meets_pieces_not_rows(spark, monkeypatch):
    """Ten thousand rows of few pieces: what is met is the pieces, and each text is not exploded into its grams."""
    seen = []
    met = lookups._met
    monkeypatch.setattr(lookups, "_met", lambda pieces, *rest: seen.append(pieces.count()) or met(pieces, *rest))
    df = spark.range(10_000).select("id", F.concat_ws(" ", F.lit("alpha beta"), F.col("id").cast("string")).alias("body"))
    found = lookups.containing(df, spark.createDataFrame([("alp",), ("ta",)], "term string"), "body", "term")
    assert found.count() == 20_000 and seen == [3]


ROWS = "k string, at long, value string, day date, size double"


def test_state_survives_restarts_and_late_rows(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice("xyz"), dt.date(2024, 1, 1 + rng.randrange(9)), rng.choice([None, float("nan"), 0.1, 1e300])) for i in range(60)]
    late_first = [rows[40:], rows[5:40], rows[:5] + rows[50:52]]  # two rows come again
    for n, batch in enumerate(late_first):
        spark.createDataFrame(batch, ROWS).coalesce(2).write.mode("append").parquet(f"{tmp_path}/in")
        kept = state.kept_rows(upsert.stream_of(spark, f"{tmp_path}/in", spark.createDataFrame([], ROWS).schema), ["k"], "at")
        state.start(kept.select("k", "version", state.changes_of(F.col("rows"), "value", "day").alias("kept"), F.transform("rows", lambda x: x["at"]).alias("seen"), F.element_at("rows", -1)["size"].alias("size")), f"{tmp_path}/log", f"{tmp_path}/check").awaitTermination()
        seen = [r for b in late_first[: n + 1] for r in b]
        got = {r["k"]: r for r in state.compacted(spark.read.parquet(f"{tmp_path}/log"), ["k"]).collect()}
        for k in {r[0] for r in seen}:
            mine = sorted({r[1]: r for r in seen if r[0] == k}.values(), key=lambda r: r[1])
            a = mine[0]
            for x in mine[1:]:
                a = a if a[2] == x[2] or x[3] <= a[3] else x
            assert (got[k]["kept"]["at"], got[k]["kept"]["value"], got[k]["kept"]["day"]) == (a[1], a[2], a[3])
            assert got[k]["seen"] == [r[1] for r in mine]
            assert repr(got[k]["size"]) == repr(mine[-1][4])
    before = spark.read.parquet(f"{tmp_path}/log").count()
    state.start(kept.select("k", "version"), f"{tmp_path}/log2", f"{tmp_path}/check2").awaitTermination()
    again = state.kept_rows(upsert.stream_of(spark, f"{tmp_path}/in", spark.createDataFrame([], ROWS).schema), ["k"], "at")
    state.start(again.select("k", "version", state.changes_of(F.col("rows"), "value", "day").alias("kept"), F.transform("rows", lambda x: x["at"]).alias("seen"), F.element_at("rows", -1)["size"].alias("size")), f"{tmp_path}/log", f"{tmp_path}/check").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/log").count() == before  # nothing new, nothing written


def test_names_are_made_once_not_for_each_priority(spark):
    """Filters on the priority are pushed below the name's projection, which they repeat."""
    rates = spark.createDataFrame([("view", dt.date(2024, 1, 2), 1.0)], "kind string, asOfDate date, sevenDayYield double")
    named = rates.withColumn("source", F.regexp_replace("kind", "view", "cnbc"))
    plan = dedupe.trusted_rates(named, "2024-01-01")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") < 5


def test_state_is_kept_without_python(spark, tmp_path):
    """State is an aggregate of Spark's, not a process that is asked key by key."""
    kept = state.kept_rows(upsert.stream_of(spark, f"{tmp_path}", ROWS), ["k"], "at")
    assert "TransformWithState" not in kept._jdf.queryExecution().analyzed().toString()


def test_a_key_of_many_rows_is_sorted_once(spark):
    """Time grows with a key's rows, not with their square."""
    df = spark.range(20_000).select(F.lit("a").alias("k"), (F.col("id") % 15_000).alias("at"), (F.col("id") % 7).alias("value"))
    started = time.monotonic()
    assert state.kept_rows(df, ["k"], "at").select("version", F.size("rows")).collect() == [(15_000, 15_000)]
    assert time.monotonic() - started < 20


def test_rows_of_one_order_count_once_and_batches_that_run_again_write_once(spark, tmp_path):
    """The first batch's row stays, whatever comes later; a key without new rows has no new version."""
    rows = lambda *x: [(k, i, v, None, None) for k, i, v in x]
    batches = [rows(("a", 2, "z"), (None, None, "n")), rows(("a", 2, "b"), ("a", 1, "y")), rows(("a", 1, "c"), ("a", 2, "z"), (None, None, "m"))]

    def land():
        kept = state.kept_rows(upsert.stream_of(spark, f"{tmp_path}/in", ROWS), ["k"], "at")
        state.start(kept.select("k", "version", F.transform("rows", lambda x: F.struct(x["at"], x["value"])).alias("kept")), f"{tmp_path}/log", f"{tmp_path}/check").awaitTermination()
        return sorted(((r["k"], r["version"], [tuple(x) for x in r["kept"]]) for r in spark.read.parquet(f"{tmp_path}/log").collect()), key=repr)

    for batch in batches:
        spark.createDataFrame(batch, ROWS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        log = land()
    assert log == [("a", 1, [(2, "z")]), ("a", 2, [(1, "y"), (2, "z")]), (None, 1, [(None, "n")])]
    for name in ("2", ".2.crc"):
        (tmp_path / "check" / "commits" / name).unlink()  # as if it had stopped within the last batch
    assert land() == log
    assert sorted(r["k"] or "" for r in state.compacted(spark.read.parquet(f"{tmp_path}/log"), ["k"]).collect()) == ["", "a"]


def test_histories_lie_in_buckets(spark, tmp_path):
    """Three hundred tickers, some of them in two batches: as many folders as buckets at most, each ticker's history whole."""
    import os

    kind = "ticker string, asOfDate date, source string, oneDayYield double, sevenDayYield double, thirtyDayYield double, timestamp timestamp, ord long"
    row = lambda t, day, n: (t, dt.date(2024, 1, day), "fidelity", None, 1.5, None, dt.datetime(2024, 1, day), n)
    batches = [[row(f"0{i}", 2, i) for i in range(300)], [row(f"0{i}", 5, 1000 + i) for i in range(10)]]
    for batch in batches:
        spark.createDataFrame(batch, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        upsert.start(upsert.stream_of(spark, f"{tmp_path}/in", kind), f"{tmp_path}/raw", f"{tmp_path}/history", f"{tmp_path}/checkpoint", "2024-01-01").awaitTermination()
    assert sum(x.startswith("bucket=") for x in os.listdir(tmp_path / "history")) <= upsert.BUCKETS
    got = sorted((r["ticker"], r["asOfDate"].day, r["source"]) for r in spark.read.parquet(f"{tmp_path}/history").collect())
    filled = [(f"0{i}", d, "gapFiller (fidelity)") for i in range(10) for d in (3, 4)] + [(f"0{i}", 5, "fidelity") for i in range(10)]
    assert got == sorted([(f"0{i}", 2, "fidelity") for i in range(300)] + filled)
