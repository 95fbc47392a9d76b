"""URL filters: a blocked Bloom filter of listed canonical URLs before an exact hash join [native].

An entry of the list is a rule (a host with its subdomains, and how the path starts) or a page (one canonical
URL). Each entry has a key: a rule's host and the directory of its path, or the canonical URL. A URL probes
the keys that could fit it: suffixes of its host by directories of its path, and its canonical URL. The
probes go through a blocked Bloom filter (one block of eight 64-bit words a key, one bit in each word), which
lets every listed key pass; what passes meets the list in an exact hash join, which removes false positives,
and the rest of a rule's path is compared there. The longest fitting rule gives the verdict; where none fits,
a listed page is blocked and any other allowed.

The filter has as many blocks as the list needs, MOST_BLOCKS at most, so that it can always be broadcast;
longer lists make more false positives, not other results. Probes go no deeper into host and path than the
list does, so long URLs cost no more than short ones. The list itself is broadcast only within a counted bound.

Edge cases: a null URL, or one without "://", has an empty host and path, fits no rule and is allowed; rules
without a host are ignored; of rules of equal length the one with the longer host wins, then block; entries
listed twice count once; repeated pages are each judged; an empty list allows all; an empty table gives none;
further columns take no part in judging, and kept_pages() passes them through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, cut_lineage, free_name, lower_ascii, table

#: Words of 64 bits in a block, bits of the filter for each key, and the most blocks: 8 MiB in all.
WORDS, BITS_A_KEY, MOST_BLOCKS = 8, 12, 1 << 17
#: (host, path, verdict): the rules of the query.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Parts of host names, between dots and hyphens, whose pages listed_pages() lists.
UNWANTED = ("ads", "adult", "bets", "casino", "pills", "spam")


def host_of(url: Column) -> Column:
    """What follows the first "://" up to "/", "?", "#" or the end, A-Z lower-cased."""
    return lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """The URL without what leads to the same page: scheme, query and fragment, default ports, "www." and "m.",
    doubled slashes, an ending slash or ".html"."""
    bare = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^(www|m)\.", "")
    return F.concat(bare, F.regexp_replace(F.regexp_replace(path, r"/{2,}", "/"), r"(/|\.html?)$", ""))


def _directory(path: Column) -> Column:
    return F.regexp_extract(path, r"^(?s)(.*/)?", 0)


def rule_entries(spark: SparkSession, rules: tuple = RULES) -> DataFrame:
    """The entries of a few rules given as tuples of host, path and verdict."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def listed_pages(pages: DataFrame) -> DataFrame:
    """(page): canonical URLs of the pages whose host has one of the UNWANTED parts: the list of the query, as
    no table names unwanted URLs."""
    parts = F.split(host_of(F.col("url")), r"[.\-]")
    bad = F.arrays_overlap(parts, F.array(*map(F.lit, UNWANTED)))
    return pages.filter(bad).select(canonical(host_of(F.col("url")), path_of(F.col("url"))).alias("page")).distinct()


def entries(rules: DataFrame, listed: DataFrame) -> DataFrame:
    """(kind, host, directory, path, rule, verdict): the keys of rules (host, path, verdict) and of listed pages (page)."""
    host, path = lower_ascii(F.col("host")), F.coalesce("path", F.lit(""))
    r = rules.filter("host <> '' and verdict in ('allow', 'block')").select(F.lit("rule").alias("kind"), host.alias("host"), _directory(path).alias("directory"), path.alias("path"), F.concat(host, path).alias("rule"), "verdict")
    nothing = F.lit(None).cast("string")
    p = listed.filter("page <> ''").select(F.lit("page").alias("kind"), F.col("page").alias("host"), F.lit("").alias("directory"), F.lit("").alias("path"), nothing.alias("rule"), F.lit("block").alias("verdict"))
    return r.unionByName(p).distinct()


def _places(kind: Column, host: Column, directory: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key, and its bit in each of the block's words."""
    of = F.xxhash64(F.lit("place"), kind, host, directory)
    bits = F.xxhash64(F.lit("bits"), kind, host, directory)
    return F.pmod(of, F.lit(blocks)).cast("int"), [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(bits, 6 * j).bitwiseAND(F.lit(63)).cast("int")) for j in range(WORDS)]


def blocked_filter(keys: DataFrame, n: int) -> tuple[DataFrame, int]:
    """(block, w0, ...), and the number of blocks, for n keys: MOST_BLOCKS rows at most."""
    blocks = max(1, min(MOST_BLOCKS, -(-n * BITS_A_KEY // (64 * WORDS))))
    block, masks = _places(F.col("kind"), F.col("host"), F.col("directory"), blocks)
    return keys.select(block.alias("block"), *[m.alias(f"w{j}") for j, m in enumerate(masks)]).groupBy("block").agg(*[F.bit_or(f"w{j}").alias(f"w{j}") for j in range(WORDS)]), blocks


def passing(probes: DataFrame, bits: DataFrame, blocks: int) -> DataFrame:
    """The probes (kind, host, directory and others) that the filter lets pass: all listed keys, and few others."""
    block, masks = _places(F.col("kind"), F.col("host"), F.col("directory"), blocks)
    hit = lambda j: F.col(f"w{j}").bitwiseAND(masks[j]) != 0
    met = probes.withColumn("block", block).join(F.broadcast(bits), "block")
    test = hit(0)
    for j in range(1, WORDS):
        test = test & hit(j)
    return met.filter(test).select(*probes.columns)


def _probes(host: Column, path: Column, labels: int, depth: int) -> Column:
    """The keys that could fit a URL, with at most so many labels of its host and directories of its path."""

    def suffixes(parts: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))), lambda i: F.array_join(F.slice(parts, F.size(parts) - i + 1, i), "."))

    def directories(parts: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(depth))), lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/"))))

    of = lambda kind, h, d: F.struct(F.lit(kind).alias("kind"), h.alias("host"), d.alias("directory"))
    page = F.array(of("page", canonical(host, path), F.lit("")))
    if not labels:  # no rule is listed
        return page
    dirs = directories(F.split(path, "/"))
    rules = F.flatten(F.transform(suffixes(F.split(host, r"\.")), lambda h: F.transform(dirs, lambda d: of("rule", h, d))))
    return F.when(host == "", F.array().cast("array<struct<kind:string,host:string,directory:string>>")).otherwise(F.concat(rules, page))


def url_verdicts(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """(url, rule, verdict) of the distinct urls that some entry of `listed` (as of entries()) fits."""
    listed = cut_lineage(listed)
    is_rule = F.col("kind") == "rule"
    deepest = lambda c, sep: F.max(F.when(is_rule, F.size(F.split(c, sep))))
    n, labels, depth = listed.agg(F.count("*"), deepest("host", r"\."), deepest("directory", "/")).first()
    bits, blocks = blocked_filter(listed.select("kind", "host", "directory"), n)
    distinct = urls.filter(F.instr("url", "://") > 0).select("url").distinct()
    at = distinct.select("url", host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"))
    probes = at.select("url", "p", F.explode(_probes(F.col("h"), F.col("p"), labels or 0, (depth or 1) - 1)).alias("x")).select("url", "p", "x.*")
    possible = passing(probes, bits, blocks)
    fits = possible.join(broadcast_if_small(listed), ["kind", "host", "directory"]).filter(F.col("p").startswith(F.col("path")) | ~is_rule)
    rank = F.struct(is_rule.alias("is_rule"), F.length("rule").alias("length"), F.length("host").alias("host"), "verdict", "rule")
    return fits.groupBy("url").agg(F.max(rank).alias("best")).select("url", "best.rule", "best.verdict")


def judged(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """page_id, url, host, path, rule and verdict of every page."""
    found = broadcast_if_small(cut_lineage(url_verdicts(pages, listed)))
    url = F.col("url")
    verdict = F.coalesce("verdict", F.lit("allow"))
    return pages.select("page_id", "url").join(found, "url", "left").select("page_id", "url", host_of(F.coalesce(url, F.lit(""))).alias("host"), path_of(F.coalesce(url, F.lit(""))).alias("path"), "rule", verdict.alias("verdict"))


def kept_pages(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """The pages that are allowed, with their columns."""
    blocked = cut_lineage(url_verdicts(pages, listed).filter("verdict = 'block'"))
    key = free_name(pages, "blocked_url")
    return pages.join(broadcast_if_small(blocked.select(F.col("url").alias(key))), F.col("url") == F.col(key), "left_anti")


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages, entries(rule_entries(spark), listed_pages(pages))).select("page_id", "host", "path", "rule", "verdict")
