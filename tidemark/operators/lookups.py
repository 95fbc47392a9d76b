"""Lookups and set operations between tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedupe import first_by
from tidemark.shared import broadcast_if_small, cut_lineage, free_name, is_small


def tracked(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def missing(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys, on, "left_anti")


def with_missing(df: DataFrame, extra: DataFrame, on: list[str]) -> DataFrame:
    """df and the extra rows whose keys it lacks."""
    return df.unionByName(missing(extra, df, on), allowMissingColumns=True)


def first_match(df: DataFrame, other: DataFrame, on: list[str], order: str) -> DataFrame:
    """df with the first row of other for each key; null where there is none."""
    return df.join(first_by(other, on, F.col(order).asc()).drop(order), on, "left")


def by_class(df: DataFrame, funds: DataFrame, class_id: str, order: str) -> DataFrame:
    """df with the first fund of its class, by order; rows of unknown classes go. The class alone decides, as it
    tells funds apart; a fund's other ids come with it."""
    return df.join(first_by(funds.filter(F.col(class_id).isNotNull()), [class_id], F.col(order).asc()).drop(order), class_id)


def checked_join(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """An inner join that fails if a row of df finds nothing."""
    found = free_name(df, "found", other)
    marked = df.join(other.withColumn(found, F.lit(True)), on, "left")
    return marked.filter(F.coalesce(found, F.raise_error(F.lit("a row found no match")).cast("boolean"))).drop(found)


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new, and what of old it doesn't have: union by key, new wins."""
    return new.unionByName(missing(old, new, keys), allowMissingColumns=True)


def substring_lookup(df: DataFrame, words: DataFrame, text: str, word: str) -> DataFrame:
    """(df, word) for each word of the text that is in words: an equi-join on the split text, in place of
    a join on containment; words are whole words here, as the look-ups mean them."""
    w = free_name(df, "w")
    split = df.withColumn(w, F.explode(F.array_distinct(F.split(F.lower(text), r"[^a-z0-9]+"))))
    return split.join(words.select(F.lower(word).alias(w), word).distinct(), w).drop(w)


#: Characters of the grams by which _met() meets texts and patterns of many lengths.
GRAM = 4
#: Lengths of patterns up to which texts are met by their substrings of just these lengths.
LENGTHS = 16
#: Different characters of all patterns up to which texts are split at the others.
CHARACTERS = 1000


def _substrings(text, n):
    """All substrings of n characters, in order; none of shorter texts."""
    cut = F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))
    return F.when(F.length(text) >= n, cut).otherwise(F.array().cast("array<string>"))


def _shapes(words: DataFrame):
    """(pieces, lengths): a column function that cuts a text at characters that no pattern has, and the patterns'
    lengths, None for more than LENGTHS. A pattern stands in a text if it stands in one of its pieces, and texts have far
    fewer different pieces than places."""
    at = F.sequence(F.lit(1), F.length("pattern"))
    found = [r[0] for r in words.select(F.explode(F.transform(at, lambda i: F.substring("pattern", i, F.lit(1))))).distinct().limit(CHARACTERS + 1).collect()]
    lengths = sorted(r[0] for r in words.select(F.length("pattern")).distinct().limit(LENGTHS + 1).collect())
    split = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in sorted(found)) + "]+"
    pieces = (lambda t: F.array_distinct(F.split(t, split))) if 0 < len(found) <= CHARACTERS else (lambda t: F.array(t))
    return pieces, lengths if len(lengths) <= LENGTHS else None


def _met(pieces: DataFrame, words: DataFrame, lengths: list[int] | None) -> DataFrame:
    """(piece, pattern) for each of the distinct patterns that one of the distinct pieces contains.

    Patterns of few lengths are met by an equi-join with the pieces' substrings of these lengths. Others meet only
    the pieces that hold their rarest gram of GRAM characters, by the counts of grams over the pieces; of
    what meets, `contains` decides. Shorter patterns are their own gram. There is no nested loop.
    """
    if lengths is not None:
        each = pieces.select("piece", F.explode(F.array_distinct(F.flatten(F.array(*[_substrings(F.col("piece"), n) for n in lengths or [GRAM]])))).alias("pattern"))
        return each.join(broadcast_if_small(words), "pattern").select("piece", "pattern")
    short = sorted(r[0] for r in words.select(F.least(F.length("pattern"), F.lit(GRAM)).alias("n")).distinct().collect())  # GRAM at most
    n = F.least(F.length("pattern"), F.lit(GRAM))
    mine = cut_lineage(words.select("pattern", F.explode(F.transform(F.sequence(F.lit(1), F.length("pattern") - n + 1), lambda i: F.substring(F.col("pattern"), i, n))).alias("gram")).distinct())
    grams = pieces.select("piece", F.explode(F.array_distinct(F.flatten(F.array(*[_substrings(F.col("piece"), n) for n in short])))).alias("gram"))
    met = grams.join(broadcast_if_small(mine.select("gram").distinct()), "gram", "left_semi")
    often = met.groupBy("gram").agg(F.count("*").alias("texts"))
    rarest = cut_lineage(mine.join(often, "gram").groupBy("pattern").agg(F.count("*").alias("found"), F.min_by("gram", F.struct("texts", "gram")).alias("gram")))
    # a pattern with a gram that no text has is in no text
    whole = rarest.join(mine.groupBy("pattern").agg(F.count("*").alias("found")), ["pattern", "found"], "left_semi").select("pattern", "gram")
    return grams.join(broadcast_if_small(cut_lineage(whole)), "gram").filter(F.col("piece").contains(F.col("pattern"))).select("piece", "pattern")


def containing(df: DataFrame, patterns: DataFrame, text: str, pattern: str) -> DataFrame:
    """(df, pattern) for each distinct pattern that a row's text contains, wherever it stands in it.

    Texts are cut at the characters that no pattern has; patterns meet the distinct pieces of all texts, once each. Few
    meetings are broadcast, and nothing is shuffled but pieces; of a row's pieces with a pattern the first one
    counts. Many are met by the texts' hashes, and `contains` decides. Empty and null patterns and null texts match nothing.
    """
    words = cut_lineage(patterns.select(F.col(pattern).alias("pattern")).filter("pattern <> ''").distinct())
    pieces, lengths = _shapes(words)
    vocabulary = cut_lineage(df.filter(F.col(text).isNotNull()).select(F.explode(pieces(F.col(text))).alias("piece")).filter("piece <> ''").distinct())
    meetings = cut_lineage(_met(vocabulary, words, lengths))
    if is_small(meetings):
        mine, at, piece, word = (free_name(df, x) for x in ("pieces", "at", "piece", "pattern"))
        cut = df.filter(F.col(text).isNotNull()).withColumn(mine, pieces(F.col(text))).select("*", F.posexplode(mine).alias(at, piece))
        rows = cut.join(F.broadcast(meetings.toDF(piece, word)), piece)
        first = rows.filter(~F.exists(F.slice(mine, F.lit(1), F.col(at)), lambda x: x.contains(F.col(word))))
        return first.select(*df.columns, F.col(word).alias(pattern))
    cut = df.filter(F.col(text).isNotNull()).select(F.xxhash64(text).alias("h"), F.explode(pieces(F.col(text))).alias("piece"))
    candidates = cut_lineage(cut.join(meetings, "piece").select("h", F.col("pattern").alias(pattern)).distinct())
    h = free_name(df, "text_hash")
    rows = df.withColumn(h, F.xxhash64(text)).join(broadcast_if_small(candidates).withColumnRenamed("h", h), h).drop(h)
    return rows.filter(F.col(text).contains(F.col(pattern)))


def first_containing(df: DataFrame, other: DataFrame, word: str, text: str, order: str) -> DataFrame:
    """df with the first row of other, by order, whose text contains df's word; null where there is none.

    Each piece of the texts has its first order, each of its substrings the first of theirs, so that what is met grows
    with the distinct pieces, not with the rows that contain a word. The row itself is looked up at the end."""
    words = cut_lineage(df.select(F.col(word).alias("pattern")).filter("pattern <> ''").distinct())
    pieces, lengths = _shapes(words)
    cut = other.filter(F.col(text).isNotNull()).select(F.explode(pieces(F.col(text))).alias("piece"), F.col(order).alias("first"))
    firsts = cut_lineage(cut.filter("piece <> ''").groupBy("piece").agg(F.min("first").alias("first")))
    if lengths is None:
        met = _met(firsts.select("piece"), words, lengths).join(firsts, "piece").groupBy("pattern").agg(F.min("first").alias("first"))
    else:
        each = firsts.select("first", F.explode(F.array_distinct(F.flatten(F.array(*[_substrings(F.col("piece"), n) for n in lengths or [GRAM]])))).alias("pattern"))
        few = is_small(words)
        met = (each.join(F.broadcast(words), "pattern") if few else each).groupBy("pattern").agg(F.min("first").alias("first"))
        met = met if few else met.join(words, "pattern")
    w, at = free_name(other, word), free_name(other, "first_order")
    rows = other.join(cut_lineage(met).select(F.col("pattern").alias(w), F.col("first").alias(at)), F.col(order) == F.col(at)).filter(F.col(text).contains(F.col(w)))
    rest = [c for c in other.columns if c != word]
    first = rows.groupBy(F.col(w).alias(w)).agg(F.min_by(F.struct(*rest), order).alias("first_found"))
    return df.join(first.withColumnRenamed(w, word), word, "left").select(*df.columns, *[F.col(f"first_found.{c}").alias(c) for c in rest])
