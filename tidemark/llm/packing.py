"""Best-fit packing planned on the histogram of lengths.

Documents become token ids and an end token; longer ones than CAPACITY are cut into pieces of CAPACITY.
Only the counts of piece lengths (CAPACITY numbers at most) come to the driver, which packs them by
best-fit decreasing: each length goes, as often as it fits, to the open sequences with the least room
that still hold it, many equal sequences at a time. The plan gives each length runs of slots. Each piece
takes the slot of its rank among the pieces of its length. Ranks come in two steps, within sqrt(n) parts
of a length's n pieces and over the parts' sizes, so no length comes together in one task.

The plan has at most a few runs for each length and room, whatever the number of documents; it is
broadcast. Token ids never leave their task.

Edge cases: null and empty texts are the end token alone; repeated rows are each packed; a null doc_id is
kept; an empty table gives no pieces; further columns are not read.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import cut_lineage, table

CAPACITY, END, TOKENIZER = 4096, 1, "word_bpe_49k.json"
#: Words whose ids a worker remembers in each of two generations, and half as many pieces of words; one takes about 200 bytes.
MEMORY = 500_000
#: Bytes of the longest word that is remembered.
LONGEST = 128
#: How the tokenizer cleans and parts texts. One that does otherwise gets all words whole.
CLEANED = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
PARTED = {"type": "Sequence", "pretokenizers": [SPLIT, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Words of visible ASCII and Latin-1 letters, which NFC leaves as they are, and their pieces by SPLIT once in lower case.
LATIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: The characters that stand for bytes in a byte-level vocabulary, where not those of the same number.
SHOWN = {b: 256 + k for k, b in enumerate([*range(33), *range(127, 161), 173])}


class Recent(dict):
    """key -> make(key), kept in two generations of at most `most` keys."""

    def __init__(self, make: Callable, most: int) -> None:
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


@cache
def encoder(path: str | None = None, memory: int = MEMORY) -> Callable[[str | None], bytes]:
    """text -> bytes of little-endian 32-bit ids with the end token. The tokenizer drops white space, so
    each word between ASCII white space has ids of its own. Words of LATIN are parted here and their pieces
    go to the tokenizer's model; other words, and those that may hold an added token, go whole to the
    tokenizer. A worker keeps the ids of recent words and pieces from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    tokenizer, end = Tokenizer.from_file(path), END.to_bytes(4, "little")
    model, spec = tokenizer.model, json.loads(Path(path).read_text(encoding="utf-8"))
    known = spec["normalizer"] == CLEANED and spec["pre_tokenizer"] == PARTED and all("<|" in t["content"] for t in spec["added_tokens"])

    def of_piece(piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(SHOWN)
        return b"".join([t.id.to_bytes(4, "little") for t in model.tokenize(shown)])

    def of_word(word: bytes) -> bytes:
        text = word.decode()
        if known and LATIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(pieces.__getitem__, PIECES.findall(text.lower())))
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    pieces, words = Recent(of_piece, memory // 2), Recent(of_word, memory)
    return lambda text: b"".join(map(words.__getitem__, (text or "").encode().split())) + end


def _pieces(path: str | None, memory: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, memory)
        for batch in batches:
            rows: list[tuple] = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text)
                for piece, at in enumerate(range(0, len(ids), 4 * CAPACITY)):
                    part = ids[at : at + 4 * CAPACITY]
                    rows.append((i, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, rank from, rank to, first sequence, pieces a sequence, offset) of best-fit decreasing."""
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> sequences [from, to)
    rooms: list[int] = []
    runs, sequences = [], 0

    def put(left: int, low: int, high: int) -> None:
        if left and low < high:
            if left not in room:
                insort(rooms, left)
                room[left] = []
            room[left].append((low, high))

    for length in sorted(counts, reverse=True):
        rank, n = 0, counts[length]
        while rank < n:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                left = rooms[k]
                low, high = room[left].pop()
                if not room[left]:
                    del room[left], rooms[k]
            else:
                left, low = capacity, sequences
                high = sequences = sequences + -(-(n - rank) // (capacity // length))
            each = left // length
            full = min(high - low, (n - rank) // each)
            if full:
                runs.append((length, rank, rank + full * each, low, each, capacity - left))
                rank += full * each
                put(left - each * length, low, low + full)
                low += full
            if low < high and rank < n:  # fewer are left than one sequence takes
                runs.append((length, rank, n, low, n - rank, capacity - left))
                put(left - (n - rank) * length, low, low + 1)
                rank, low = n, low + 1
            put(left, low, high)
    return runs


def packed(docs: DataFrame, tokenizer: str | None = None, memory: int = MEMORY) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. memory: words whose ids a
    worker remembers, as above."""
    spark = docs.sparkSession
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = cut_lineage(docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, memory), schema))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # CAPACITY rows at most
    runs = spark.createDataFrame(plan(counts), "run_length long, low long, high long, first long, each long, base long")
    parts = spark.createDataFrame([(n, math.isqrt(c - 1) + 1) for n, c in counts.items()], "length long, parts int")
    dealt = pieces.join(F.broadcast(parts), "length").withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("parts")))
    sizes = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = dealt.withColumn("within", within).join(sizes, ["length", "part"]).withColumn("rank", F.col("before") + F.col("within"))
    slot = (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    nth = F.col("rank") - F.col("low")
    return ranked.join(F.broadcast(runs), slot).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("base") + nth % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
