"""What several operators share: native word arrays, the shared folder, streams of whole groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import broadcast_if_small, cut_lineage, free_name, is_small, written

__all__ = ["broadcast_if_small", "cut_lineage", "free_name", "is_small", "written"]

#: Separators of words that may hold any other character: ASCII white space.
SPACES = r"[\x20\x09\x0A\x0B\x0C\x0D]+"
#: On text as it is: what lower-casing A-Z and splitting at anything but a-z, 0-9 and non-ASCII leaves out.
NON_WORD = "[" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, _UPPER, _LOWER)


def split_words(text: Column, separators: str) -> Column:
    """The non-empty words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body and its lambdas read it."""
    return F.transform(F.array(value), body)[0]


def row_key(*names: str) -> Column:
    """16 bytes that tell rows apart by these columns; null counts as a value. Repeated rows share it."""
    return F.unhex(F.md5(F.concat_ws("\x00", *[F.coalesce(F.concat(F.lit("V"), F.col(n).cast("string")), F.lit("N")) for n in names])))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Batches sorted by keys, cut anew into tables that hold whole groups of equal keys: the last group of
    a batch waits for what follows. Groups must be bounded; what is yielded is a batch and a group at most."""
    rest: list[pa.RecordBatch] = []
    at = lambda batch, i: [batch.column(batch.schema.get_field_index(k))[i].as_py() for k in keys]
    for batch in batches:
        if not batch.num_rows:
            continue
        last, low, high = at(batch, batch.num_rows - 1), 0, batch.num_rows - 1
        while low < high:  # the first row of the last group
            middle = (low + high) // 2
            low, high = (low, middle) if at(batch, middle) == last else (middle + 1, high)
        if rest and at(rest[0], 0) != at(batch, 0):
            yield pa.Table.from_batches(rest)
            rest = []
        if low:
            yield pa.Table.from_batches([*rest, batch.slice(0, low)])
            rest = []
        rest.append(batch.slice(low))
    if rest:
        yield pa.Table.from_batches(rest)


def group_starts(*columns: np.ndarray) -> np.ndarray:
    """Where groups of equal rows start in sorted columns, and the end."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64 bits (the finalizer of a well-known public hash)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each window of so many hashes, by doubling; empty if there are fewer."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, at, power, size = None, 0, mixed(hashes + np.uint64(0x9E3779B97F4A7C15)), 1
    while True:
        if length & size:
            part = power[at : at + n]
            out = part if out is None else mixed(out * np.uint64(0xD6E8FEB86659FD93) + part)
            at += size
        size *= 2
        if size > length:
            return out
        power = mixed(power[: -size // 2 or None] * np.uint64(0xA0761D6478BD642F) + power[size // 2 :])


def chunked(docs: DataFrame, least: int = 8 << 20, most: int = 64 << 20) -> tuple[DataFrame, int, int, bool]:
    """(chunk, doc, doc_id, text, copies), the number of chunks, the bytes of all texts, and whether any row has copies. doc is 64 bits of a hash of
    doc_id and text, and the chunk comes of other bits of it, so rows are taken for one only if both agree.
    Rows that are equal in doc_id and text come once, with their number, so that they can't fill a chunk.
    Chunks grow with the square root of the corpus, up to `most` bytes, so that a chunk fits a task."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size = min(most, int(least * max(1.0, total / 2**30) ** 0.5))
    n = total // size + 1
    rows = docs.select(F.xxhash64("doc_id", "text").alias("doc"), "doc_id", "text")
    repeated = cut_lineage(rows.groupBy("doc").count().filter("count > 1").select("doc"))
    some = bool(repeated.limit(1).count())
    if some:
        repeated = broadcast_if_small(repeated)
        once = rows.join(repeated, "doc", "left_semi").groupBy("doc", "doc_id", "text").agg(F.count("*").alias("copies"))
        rows = rows.join(repeated, "doc", "left_anti").withColumn("copies", F.lit(1).cast("long")).unionByName(once)
    else:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    return rows.select(F.pmod(F.hash("doc_id", "text"), F.lit(n)).cast("int").alias("chunk"), "doc", "doc_id", "text", "copies"), n, total, some


#: Copies of a row that are written out in one place.
A_RUN = 1 << 16


def copied(rows: DataFrame, some: bool) -> DataFrame:
    """rows, each as often as its copies say; those of many copies are dealt anew in runs. some: whether any has copies."""
    if not some:
        return rows.drop("copies")
    rows = written(rows)  # read twice
    once, many = rows.filter("copies = 1").drop("copies"), rows.filter("copies > 1")
    runs = many.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / A_RUN))).alias("run"))
    size = F.least(F.lit(A_RUN).cast("long"), F.col("copies") - F.col("run") * A_RUN)
    return once.unionByName(runs.repartition("run").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), size))).drop("copies", "run", "copy"))
