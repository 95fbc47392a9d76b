"""Toxicity by cumulative-link ordinal regression.

P(grade > k) = logistic(w . x - t_k) with one weight vector for all thresholds t_1 < t_2 < ...; the
expected severity is the sum of these chances. x holds log(1 + count) of selected words. The labels say
only toxic or not, so grades are made of them: 0 for clean, and toxic ones are graded by whether their
count of marked words is up to or over the median of toxic documents.

The model is fitted on a bounded sample: of each label, the SAMPLE documents whose hashed ids are least. The
chance from which a document counts as toxic is the best by F1 on all labelled documents that are not in the sample (on all, where
those left have one label only). Of rows that repeat a doc_id the sample takes one, by its text's hash. Scoring reads every whole text, and needs only the model (FEATURES words at most).

Edge cases: null and empty texts have no words and the base severity; documents without a label are
scored as any; null labels count for nothing; repeated rows are each scored; without toxic labels nothing
is toxic; an empty table gives none; further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, cut_lineage, table

#: Labelled documents of each label that the model is fitted on, at most.
SAMPLE = 3000
#: Words that the model weighs, at most; each differs between the labels by LEAST_Z deviations or more.
FEATURES, LEAST_Z, LEAST_DOCS = 400, 4.0, 3
STEPS, PENALTY = 600, 1e-3
#: Bins of chances among which the cutoff is chosen.
BINS = 1000
_WORD = re.compile(rb"[a-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().lower())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [Counter(words(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), pa.array([list(c) for c in counts], pa.list_(pa.binary())), pa.array([list(c.values()) for c in counts], pa.list_(pa.int32()))],
            ["doc_id", "toxic", "words", "counts"],
        )


COUNTED = "doc_id long, toxic int, words array<binary>, counts array<int>"


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Up to SAMPLE documents of each label with the counts of their words, written once."""
    told = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    least = lambda t: told.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = docs.select("doc_id", "text").join(F.broadcast(least(0).union(least(1))), "doc_id")
    one = rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # of rows that repeat an id
    return cut_lineage(one.select("doc_id", "toxic", "text").mapInArrow(_counted, COUNTED))


def selected(rows: DataFrame) -> list[bytes]:
    """Words whose document frequency tells toxic from clean, the most telling first; FEATURES at most."""
    size = {r["toxic"]: float(r["count"]) for r in rows.groupBy("toxic").count().collect()}
    ones, zeros = max(1.0, size.get(1, 0)), max(1.0, size.get(0, 0))
    seen = rows.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).filter(F.col("n") >= LEAST_DOCS)
    p = F.col("n") / (ones + zeros)
    spread = F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / ones + 1 / zeros))
    scored = seen.select("word", ((F.col("t") / ones - (F.col("n") - F.col("t")) / zeros) / spread).alias("z")).filter(F.col("z") >= LEAST_Z)
    return [bytes(r["word"]) for r in scored.orderBy(F.desc("z"), "word").limit(FEATURES).collect()]


def _marked(index: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[(index[w], c) for w, c in zip(ws, cs, strict=True) if w in index] for ws, cs in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True)]
            lists = [pa.array([[x[k] for x in f] for f in found], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *lists], ["toxic", "words", "counts"])

    return run


def fit(x: np.ndarray, grade: np.ndarray, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds by gradient steps on the likelihood of the grades."""
    n, f = x.shape
    at = np.zeros(f + grades)  # weights, first threshold, logarithms of the rises
    at[f] = 1.0
    mean, square = np.zeros_like(at), np.zeros_like(at)
    logistic = lambda v: 1 / (1 + np.exp(-np.clip(v, -40, 40)))
    for step in range(1, STEPS + 1):
        rises = np.exp(at[f + 1 :])
        cuts = at[f] + np.concatenate([[0], np.cumsum(rises)])
        score = x @ at[:f]
        over = logistic(score[:, None] - cuts)  # P(grade > k)
        full = np.concatenate([np.ones((n, 1)), over, np.zeros((n, 1))], 1)
        slope = np.concatenate([np.zeros((n, 1)), over * (1 - over), np.zeros((n, 1))], 1)
        row = np.arange(n)
        p = np.maximum(full[row, grade] - full[row, grade + 1], 1e-12)
        by_score = (slope[row, grade] - slope[row, grade + 1]) / p
        by_cut = np.zeros((n, grades + 2))
        by_cut[row, grade] -= slope[row, grade] / p
        by_cut[row, grade + 1] += slope[row, grade + 1] / p
        cut = by_cut[:, 1:-1].mean(0)
        gradient = np.concatenate([x.T @ by_score / n - PENALTY * at[:f], [cut.sum()], rises * cut[::-1].cumsum()[::-1][1:]])
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        at += 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return at[:f], at[f] + np.concatenate([[0], np.cumsum(np.exp(at[f + 1 :]))])


def cutoff(hits: np.ndarray, said: np.ndarray, toxic: int) -> float:
    """The chance from which a document counts as toxic: best F1, by numbers of toxic and of all documents for each of BINS
    chances, in the middle of the chances that do as well."""
    hit, all_of = hits[::-1].cumsum()[::-1], said[::-1].cumsum()[::-1]
    f1 = 2 * hit / np.maximum(all_of + toxic, 1)
    best = np.flatnonzero(f1 == f1.max())
    end = best[0] + int(np.argmax(np.append(np.diff(best) > 1, True)))  # the first run of bins that do as well
    return float((best[0] + end + 1) / 2 / BINS) if best[0] else 1 / BINS


def chances(docs: DataFrame, labels: DataFrame, sampled: DataFrame, weights: dict[bytes, float], cuts: list[float]) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers of toxic and of all labelled documents by chance, in BINS bins: of those that the model was not fitted on,
    if some of them are toxic and some clean, else of all."""
    told = cut_lineage(labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")))
    fitted = sampled.select("doc_id").withColumn("fitted", F.lit(True))  # 2 * SAMPLE rows at most
    known = docs.select("doc_id", "text").join(broadcast_if_small(told), "doc_id").join(F.broadcast(fitted), "doc_id", "left")
    kept = known.select("doc_id", "text", F.struct("label", F.coalesce("fitted", F.lit(False)).alias("fitted")).alias("more"))
    seen = kept.mapInArrow(_scorer(weights, cuts, 1.0, "more"), "doc_id long, severity double, probability double, toxic boolean, more struct<label:int,fitted:boolean>")
    bins = seen.groupBy("more.fitted", "more.label", F.least(F.floor(F.col("probability") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")).count().collect()
    for rows in ([r for r in bins if not r["fitted"]], bins):
        if {r["label"] for r in rows} == {0, 1} or rows is bins:
            hits, said = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
            for r in rows:
                said[r["bin"]] += r["count"]
                hits[r["bin"]] += r["count"] * r["label"]
            return hits, said, int(hits.sum())
    raise AssertionError


def model(sampled: DataFrame) -> tuple[dict[bytes, float], list[float]]:
    """Weights of words and thresholds of the grades. Only the counts of selected words in the
    sample's documents come to the driver."""
    vocabulary = selected(sampled)
    if not vocabulary:
        return {}, [40.0]
    marked_in = _marked({w: k for k, w in enumerate(vocabulary)})
    rows = sampled.orderBy("doc_id").mapInArrow(marked_in, "toxic int, words array<int>, counts array<int>").collect()
    counts = np.zeros((len(rows), len(vocabulary)))
    for i, r in enumerate(rows):
        counts[i, r["words"]] = r["counts"]
    toxic = np.array([r["toxic"] for r in rows])
    marked = counts.sum(1)
    middle = np.median(marked[toxic == 1])
    grade = toxic * (1 + (marked > middle))
    grades = int(grade.max())
    weights, cuts = fit(np.log1p(counts), grade, grades)
    return dict(zip(vocabulary, weights.tolist(), strict=True)), cuts.tolist()


def _scorer(weights: dict[bytes, float], cuts: list[float], least: float, *more: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            severity, chance = [], []
            for text in batch.column("text").to_pylist():
                found = Counter(w for w in words(text) if w in weights)
                score = sum(weights[w] * np.log1p(c) for w, c in sorted(found.items()))
                over = [1 / (1 + np.exp(np.clip(c - score, -40, 40))) for c in cuts]
                severity.append(round(float(sum(over)), 6))
                chance.append(round(float(over[0]), 6))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(severity, pa.float64()), pa.array(chance, pa.float64()), pa.array([p >= least for p in chance], pa.bool_()), *[batch.column(c) for c in more]],
                ["doc_id", "severity", "probability", "toxic", *more],
            )

    return run


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, severity, probability, toxic) for each row: expected grade, chance of a grade over 0."""
    sampled = sample(docs, labels)
    weights, cuts = model(sampled)
    least = cutoff(*chances(docs, labels, sampled, weights, cuts)) if weights else 1.0
    return docs.select("doc_id", "text").mapInArrow(_scorer(weights, cuts, least), "doc_id long, severity double, probability double, toxic boolean")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
