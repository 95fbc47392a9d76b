"""Filter interaction audit: what each filter removes in every order of application.

Five filters judge a document; A to D look at its text, E at all texts: a left-semi join on the text's hash,
the exact text and a smaller doc_id marks documents that repeat one. Only texts whose hash comes twice go into
that join. Its right side is one row for each hash and text, with the least doc_id (copies combine before the
shuffle); the left side of a text with many copies is dealt to so many salts that none has over A_SALT rows.
The marked ids are united with the ids that fail other filters, and failures of a document come together as bits. Counts of
bit combinations, 32 for a part at most, answer every question about orders; documents are not read again.

Edge cases: a null text counts as empty, and repeats an empty one; a null doc_id is no smaller id and has none;
rows that repeat a doc_id are each counted, and aren't duplicates of each other; a null lang is the part "";
labels count if any row of a doc_id has the value 1, null ids and values never; an empty table gives none;
further columns take no part.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, broadcast_if_small, cut_lineage, let, split_words, table

FILTERS = "ABCDE"
#: Bits of a document besides those of its failed filters.
GOOD, TOXIC = 1 << 5, 1 << 6
#: Rows of one text that go to one salt of the duplicate join.
A_SALT = 4096


def text_failures(text: Column) -> Column:
    """The bits of filters A to D that a text fails."""

    def of(words: Column) -> Column:
        n = F.size(words)
        return F.when(n < 200, 1).otherwise(0) + F.when(F.lit(100).cast("long") * F.size(F.array_distinct(words)) < F.lit(50).cast("long") * n, 2).otherwise(0)

    upper = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    rest = F.when(F.lit(100).cast("long") * upper > F.lit(3).cast("long") * F.length(text), 4).otherwise(0) + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)
    return (let(split_words(text, SPACES), of) + rest).cast("int")


def repeating(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, part, hash), once each, of documents (doc_id, part, text) whose text a smaller doc_id has;
    keys: their doc_id and hash."""
    twice = keys.filter("doc_id is not null").groupBy("hash").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n")).filter("least < most")
    twice = cut_lineage(twice.select("hash", F.ceil(F.col("n") / A_SALT).cast("int").alias("salts")))
    texts = docs.filter("doc_id is not null").join(broadcast_if_small(twice), "hash")
    first = texts.groupBy("hash", "text").agg(F.min("doc_id").alias("first"), F.max("salts").alias("salts"))
    smaller = first.select("hash", "text", "first", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    dealt = texts.select("doc_id", "part", "hash", "text", F.pmod(F.xxhash64("doc_id", "part"), F.col("salts")).cast("int").alias("salt"))
    later = dealt.alias("d").join(smaller.alias("s"), (F.col("d.hash") == F.col("s.hash")) & (F.col("d.salt") == F.col("s.salt")) & (F.col("d.text") == F.col("s.text")) & (F.col("s.first") < F.col("d.doc_id")), "left_semi")
    return later.select("doc_id", "part", "hash").distinct()


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, bits, n): failed filters of all documents (doc_id, lang, text), equal rows as one with their count."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.xxhash64(text).alias("hash"), text.alias("text"))
    own = cut_lineage(rows.select("doc_id", "part", "hash", text_failures(F.col("text")).alias("bits")))
    marked = repeating(rows, own).select("doc_id", "part", "hash", F.lit(16).alias("bits"), F.lit(0).alias("n"))
    united = own.withColumn("n", F.lit(1)).unionByName(marked)
    return united.groupBy("doc_id", "part", "hash").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n")).drop("hash")


def combinations(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n): documents by part and combination of failed filters, GOOD and TOXIC."""
    value = lambda c, bit: F.when(F.max(F.col(c)) == 1, bit).otherwise(0)
    told = labels.filter("doc_id is not null and (quality = 1 or toxic = 1)").select("doc_id", F.when(F.col("quality") == 1, 1).alias("quality"), F.when(F.col("toxic") == 1, 1).alias("toxic"))
    told = cut_lineage(told.groupBy("doc_id").agg((value("quality", GOOD) + value("toxic", TOXIC)).alias("told")))
    known = failed.join(broadcast_if_small(told), "doc_id", "left")
    return known.groupBy("part", F.col("bits").bitwiseOR(F.coalesce("told", F.lit(0))).alias("bits")).agg(F.sum("n").cast("long").alias("n"))


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """For each part, order of the filters and step, what the filter does there. counts: as of combinations()."""
    every = (1 << len(filters)) - 1
    combos = counts.groupBy("part").agg(F.collect_list(F.struct("bits", "n")).alias("combos"))  # 4 * 2^5 at most
    orders = combos.select("part", "combos", F.explode(F.array(*[F.lit("".join(p)) for p in permutations(filters)])).alias("filter_order"))
    bit = lambda letter: F.call_function("shiftleft", F.lit(1), F.instr(F.lit(filters), letter) - 1)
    steps = orders.select("part", "combos", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step"))
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    before = F.aggregate(F.sequence(F.lit(0), F.col("step") - 1), F.lit(0), lambda a, i: a.bitwiseOR(F.when(i > 0, F.call_function("shiftleft", F.lit(1), F.instr(F.lit(filters), F.substring(F.col("filter_order"), i, F.lit(1))) - 1)).otherwise(0)))
    at = steps.select("part", "combos", "filter_order", "step", bit(letter).alias("mine"), before.alias("before"))
    mine, seen = F.col("mine"), F.col("before")

    def total(holds, weight=lambda x: x["n"]) -> Column:
        return F.aggregate("combos", F.lit(0).cast("long"), lambda a, x: a + F.when(holds(x["bits"]), weight(x)).otherwise(F.lit(0).cast("long")))

    fails = lambda b: b.bitwiseAND(mine) != 0
    alive = lambda b: b.bitwiseAND(seen) == 0
    ways = len(list(permutations(filters)))
    # of the orders of all filters, a document's failed ones come first equally often
    share = lambda x: x["n"] * F.floor(F.lit(ways) / F.bit_count(x["bits"].bitwiseAND(F.lit(every))))
    return at.select(
        "part",
        "filter_order",
        "step",
        total(lambda b: b.bitwiseAND(seen.bitwiseOR(mine)) == 0).alias("kept"),
        total(lambda b: fails(b) & alive(b)).alias("removed"),
        total(lambda b: fails(b) & ~alive(b)).alias("redundant"),
        total(lambda b: b.bitwiseAND(F.lit(every)) == mine).alias("unique_fails"),
        total(lambda b: fails(b) & alive(b) & (b.bitwiseAND(F.lit(GOOD)) != 0)).alias("good_lost"),
        total(lambda b: fails(b) & alive(b) & (b.bitwiseAND(F.lit(TOXIC)) != 0)).alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return interactions(combinations(failures(docs), table(spark, sf_dir, "labels")))
