"""Benchmark decontamination by winnowing [native].

A window is SPAN consecutive words of a benchmark item (an item of fewer words is one window). The
fingerprint of a window of SPAN words is the least hash of its GRAM-word grams, so equal windows have
equal fingerprints: every shared span of SPAN words shares one, whatever surrounds it. Documents'
fingerprints are joined with the benchmark's; where they meet, the hit is extended to the whole window
and confirmed word for word. Items shorter than SPAN are looked up by the hash of the whole item.

Both sides of each join are spread by hash; the benchmark's side is broadcast only while its counted
rows are within BROADCAST_ROWS. Per document, at most its own windows come together.

Edge cases: null or empty texts have no words and no hits; items without words are ignored; a null
item_id counts as the text "null"; repeated documents are each reported; repeated items of one id count
once; an empty benchmark hits nothing; further columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NON_WORD, broadcast_if_small, cut_lineage, free_name, let, lower_ascii, row_key, split_words, table

SPAN, GRAM = 10, 5
WORD = NON_WORD.replace("[", "[^", 1)


def _words(text: Column) -> Column:
    return split_words(lower_ascii(text), NON_WORD)


def _probes(words: Column, length: int) -> Column:
    """For each window of so many words, by its first word: its fingerprint."""

    def of_hashes(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - length)
        if length < SPAN:
            return F.transform(starts, lambda s: F.xxhash64(F.lit(length), *[F.get(h, s + j) for j in range(length)]))
        grams = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, GRAM)]))
        return let(grams, lambda g: F.transform(starts, lambda s: F.least(*[F.get(g, s + j) for j in range(SPAN - GRAM + 1)])))

    return F.when(F.size(words) >= length, let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)).otherwise(F.array().cast("array<bigint>"))


def _windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, length, window, probe): the windows of each item, once each."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), _words(F.col("text")).alias("w")).filter("size(w) > 0")
    length = F.least(F.size("w"), F.lit(SPAN))

    def text(w: Column, n: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda s: F.concat_ws(" ", *[F.when(n > j, F.get(w, s + j)) for j in range(SPAN)]))

    probes = F.when(F.size("w") >= SPAN, _probes(F.col("w"), SPAN))
    for n in range(1, SPAN):
        probes = probes.when(F.size("w") == n, _probes(F.col("w"), n))
    rows = items.select("item_id", length.alias("length"), F.explode(F.arrays_zip(text(F.col("w"), length).alias("window"), probes.alias("probe"))).alias("x"))
    return cut_lineage(rows.select("item_id", "length", F.col("x.window").alias("window"), F.col("x.probe").alias("probe")).distinct())


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, n_hit, n_items, items_sha256) of the documents with hits; key: row_key(doc_id, text)."""
    keyed = docs.select(row_key("doc_id", "text").alias("key"), "text")
    windows = _windows(benchmark)
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # SPAN of them at most
    if not lengths:
        lengths = [SPAN]
    probes = F.concat(*[F.array_distinct(_probes(F.col("w"), n)) for n in lengths])
    found = keyed.select("key", _words(F.col("text")).alias("w")).select("key", F.explode(probes).alias("probe"))
    met = cut_lineage(found.join(broadcast_if_small(windows.select("probe").distinct()), "probe").groupBy("key").agg(F.collect_set("probe").alias("met")))

    def starts(w: Column, hits: Column) -> Column:
        def of(n: int) -> Column:
            at = F.transform(_probes(w, n), lambda p, s: F.when(F.array_contains(hits, p), F.struct(s.alias("s"), F.lit(n).alias("n"))))
            return F.filter(at, lambda x: x.isNotNull())

        return F.concat(*map(of, lengths))

    hits = (
        keyed.join(broadcast_if_small(met), "key")
        .select("key", let(_words(F.col("text")), lambda w: let(starts(w, F.col("met")), lambda x: F.transform(x, lambda y: F.struct(y["s"].alias("s"), y["n"].alias("n"), F.concat_ws(" ", *[F.when(y["n"] > j, F.get(w, y["s"] + j)) for j in range(SPAN)]).alias("window"))))).alias("x"))
        .select("key", F.inline("x"))
        .withColumnRenamed("n", "length")
    )
    hits = cut_lineage(hits.join(broadcast_if_small(windows.select("length", "window").distinct()), ["length", "window"]).distinct())
    ends = F.array_sort(F.collect_list(F.struct("s", "length")))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    grow = lambda a, x: let(x["s"] + x["length"], lambda e: F.struct(F.greatest(a["end"], e).alias("end"), (a["n"] + F.greatest(F.lit(0), e - F.greatest(x["s"], a["end"]))).alias("n")))
    covered = hits.groupBy("key").agg(ends.alias("spans")).select("key", F.aggregate("spans", start, grow, lambda a: a["n"]).alias("n_hit"))
    items = hits.select("key", "length", "window").distinct().join(broadcast_if_small(windows.select("length", "window", "item_id")), ["length", "window"]).groupBy("key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    return covered.join(items, "key").select("key", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that share no window with the benchmark, with their columns."""
    name = free_name(docs, "row_key")
    dirty = cut_lineage(contamination(docs, benchmark).select(F.col("key").alias(name)))
    return docs.withColumn(name, row_key("doc_id", "text")).join(broadcast_if_small(dirty), name, "left_anti").drop(name)


def op6_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    counted = docs.select("doc_id", row_key("doc_id", "text").alias("key"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return counted.join(broadcast_if_small(found), "key", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
