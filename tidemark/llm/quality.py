"""Quality rules with risk-controlled thresholds [native].

Base rules reject what is too short or repeats itself. Further rules reject a document whose metric
(share of symbols, upper-case letters, repeated lines, repeated words) is over a cutoff. Each stratum
(language) and rule gets its own cutoff from labelled documents: cutoffs are tried from lenient to
strict, and a cutoff counts as safe while the exact binomial tail P(X <= k | n, limit) of its k false
rejections among n good documents stays within the error rate, which bounds the true share of good
documents it rejects (Clopper and Pearson). The first failure ends the sequence (fixed-sequence testing
needs no correction within it); the error rate is divided by the number of strata and rules
(Bonferroni). A stratum with too few labels gets no cutoff and loses no document.

Edge cases: a null or empty text has no words and fails the base rules; null languages form one stratum;
null labels and labels of unknown documents count for nothing; repeated rows are each judged; further
columns pass through unchanged; without labels only the base rules hold; an empty table gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, broadcast_if_small, cut_lineage, free_name, let, row_key, split_words, table

#: Most good documents, as a share, that all rules together may reject in a stratum; and the chance of more.
FALSE_REJECTION = 0.04
ERROR_RATE = 0.05
#: Cutoffs tried for each rule: 1, 1 - 1/STEPS, ... , 1/STEPS.
STEPS = 100
RULES = ("symbols", "upper", "dup_lines", "repeats")
#: Broadcast thresholds up to so many strata; beyond, they are joined as any table.
BROADCAST_STRATA = 10_000
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8


def _repeat_words(words: Column) -> Column:
    """Words in windows of WINDOW words found twice or more in the array."""

    def covered(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def union(s: Column) -> Column:
            twice = F.filter(
                F.sequence(F.lit(0), F.size(s) - 1),
                lambda j: F.coalesce(F.get(s, j)["h"] == F.get(s, j - 1)["h"], F.lit(False)) | F.coalesce(F.get(s, j)["h"] == F.get(s, j + 1)["h"], F.lit(False)),
            )
            starts = F.array_sort(F.transform(twice, lambda j: F.get(s, j)["i"].cast("long")))
            start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
            grow = lambda a, x: F.struct((x + WINDOW).alias("end"), (a["n"] + x + WINDOW - F.greatest(x, a["end"])).alias("n"))
            return F.aggregate(starts, start, grow, lambda a: a["n"])

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(let(ordered, union))

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(WINDOW)]))

    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(windows(h), covered)))


def metrics(text: Column) -> Column:
    """A struct of counts over the whole text; nulls count as empty."""
    text = F.coalesce(text, F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        let(split_words(text, SPACES), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long").alias("n_upper"),
    )


def _rates(m: Column) -> Column:
    """The share that each rule compares with its cutoff, 0 to 1."""
    share = lambda a, b: F.when(b > 0, F.least(F.lit(1.0), a / b)).otherwise(F.lit(0.0))
    return F.array(
        share(m["n_symbols"], m["w"]["word_chars"]),
        share(m["n_upper"], m["w"]["word_chars"]),
        share(m["l"]["n_dup_lines"], m["l"]["n_lines"]),
        share(m["w"]["n_repeat_words"], m["w"]["n_words"]),
    )


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """Logarithm of P(X <= k) for X of n trials at p, summed term by term in logarithms."""
    none = n * F.log1p(F.lit(-p))
    first = F.struct(none.alias("term"), none.alias("sum"))

    def step(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i) / (i + 1) * (p / (1 - p)))
        return let(term, lambda t: F.struct(t.alias("term"), (F.greatest(a["sum"], t) + F.log1p(F.exp(-F.abs(a["sum"] - t)))).alias("sum")))

    return F.when(k >= n, F.lit(0.0)).when(k <= 0, none).otherwise(F.aggregate(F.sequence(F.lit(0), (k - 1).cast("int")), first, step, lambda a: a["sum"]))


def measured(docs: DataFrame) -> DataFrame:
    """One row of counts for each row of docs, written once: key (row_key of doc_id, text and lang), doc_id,
    stratum, m. Texts are read here only, and never shuffled."""
    stratum = F.coalesce("lang", F.lit("und")).alias("stratum")
    return cut_lineage(docs.select(row_key("doc_id", "text", "lang").alias("key"), "doc_id", stratum, let(metrics(F.col("text")), lambda m: F.struct(m.alias("m"), _rates(m).alias("rates"))).alias("x")).select("key", "doc_id", "stratum", "x.*"))


def thresholds(counts: DataFrame, labels: DataFrame, false_rejection: float = FALSE_REJECTION, error_rate: float = ERROR_RATE) -> DataFrame:
    """(stratum, cutoffs): for each rule the strictest safe cutoff, null where none is."""
    limit = false_rejection / len(RULES)
    good = labels.filter("quality = 1 and doc_id is not null").select("doc_id")
    held = counts.select("doc_id", "stratum", "rates").join(good, "doc_id", "left_semi")
    # a rate r is rejected by the cutoffs step/STEPS below r: the strictest that spares it is ceil(r * STEPS)
    binned = held.select("stratum", F.posexplode("rates").alias("rule", "rate")).groupBy("stratum", "rule", F.ceil(F.col("rate") * STEPS).cast("int").alias("step")).count()
    # a few rows for each stratum and rule: its bins as a map, its cutoffs from lenient to strict
    bins = binned.groupBy("stratum", "rule").agg(F.map_from_entries(F.collect_list(F.struct("step", "count"))).alias("bins"), F.sum("count").cast("double").alias("n"))
    tests = cut_lineage(bins)
    level = math.log(error_rate / max(1, tests.count()))
    over = F.transform(F.sequence(F.lit(STEPS), F.lit(1), F.lit(-1)), lambda c: F.struct(c.alias("step"), F.aggregate(F.map_keys("bins"), F.lit(0.0), lambda a, k: a + F.when(k > c, F.element_at("bins", k)).otherwise(0)).alias("k")))
    # beyond the expected count the tail is over any error rate in use
    fails = lambda x: (x["k"] > F.col("n") * limit) | (binomial_tail(x["k"], F.col("n"), limit) > level)
    first_failure = lambda o: F.coalesce(F.array_max(F.transform(F.filter(o, fails), lambda x: x["step"])), F.lit(0))
    safe = tests.select("stratum", "rule", let(over, first_failure).alias("failed")).filter(F.col("failed") < STEPS)
    cutoff = ((F.col("failed") + 1) / STEPS).alias("cutoff")
    found = safe.select("stratum", "rule", cutoff)
    return found.groupBy("stratum").agg(F.array(*[F.max(F.when(F.col("rule") == i, F.col("cutoff"))) for i in range(len(RULES))]).alias("cutoffs"))


def judged(counts: DataFrame, labels: DataFrame, **risk: float) -> DataFrame:
    """key, doc_id, the counts, base_failed, kept and the reasons, for each row of measured()."""
    limits = cut_lineage(thresholds(counts, labels, **risk))
    if limits.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA:
        limits = F.broadcast(limits)
    w = F.col("m")["w"]
    failed = (w["n_words"] < MIN_WORDS) | (100 * w["n_repeat_words"] > MAX_REPEAT_PERCENT * w["n_words"])
    over = lambda r, i: F.when(F.coalesce(r > F.get(F.col("cutoffs"), i), F.lit(False)), F.get(F.array(*map(F.lit, RULES)), i))
    reasons = F.array_compact(F.transform(F.col("rates"), over))
    return counts.join(limits, "stratum", "left").select(
        "key",
        "doc_id",
        w["n_words"].alias("n_words"),
        w["word_chars"].alias("word_chars"),
        F.col("m")["n_symbols"].alias("n_symbols"),
        F.col("m")["l"]["n_dup_lines"].alias("n_dup_lines"),
        w["n_repeat_words"].alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & (F.size(reasons) == 0)).alias("kept"),
        F.array_join(reasons, ",").alias("reasons"),
    )


def kept_documents(docs: DataFrame, labels: DataFrame, **risk: float) -> DataFrame:
    """The documents that no rule rejects, with their columns."""
    name = free_name(docs, "row_key")
    rejected = judged(measured(docs), labels, **risk).filter("not kept").select(F.col("key").alias(name)).distinct()
    return docs.withColumn(name, row_key("doc_id", "text", "lang")).join(broadcast_if_small(cut_lineage(rejected)), name, "left_anti").drop(name)


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judged(measured(docs), table(spark, sf_dir, "labels")).drop("key")
