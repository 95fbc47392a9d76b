"""Substring deduplication: repeated windows of words, with a count-min prefilter.

Rows are spread over chunks. Each chunk sketches the hashes of its windows: the cells of a wide count-min
row that it touches, with counts up to two, sent as compressed gaps, a range of cells to each task. The
tasks merge the chunks' sketches and answer each chunk which of its cells hold two windows or more in
all; cells overestimate, so no repeated window is lost. The second pass sends the full hashes of only the
windows in such cells, and groups them exactly. Last, each chunk learns its repeated windows and removes
the words they cover.

A chunk sends each window once, so a window of many copies costs one entry a chunk. The sketch has one row
(depth one) of CELLS_PER_WORD cells or more for each word of the corpus, by its counted bytes, and is never
whole in one place: each range of cells is merged in one task, and a range has the cells of RANGE bytes of
text, however large the corpus. The exact pass tells windows apart by 128 bits of hashes.

Edge cases: null and empty texts have no words and the hash of nothing; texts shorter than a window lose
nothing; repeated rows count as copies of each other; a null doc_id is kept; an empty table gives none;
further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame

from tidemark.llm.common import chunked, copied, group_starts, table, window_hashes, word_hashes

WINDOW = 35
#: Cells of the count-min row for each word, a power of two above; a word has five bytes or more in most texts.
CELLS_PER_WORD, BYTES_PER_WORD = 32, 5
#: Bytes of text whose cells make a range.
RANGE = 32 << 20
SKETCH = "range int, chunk int, entries binary, twice binary"
SUSPECT = "range int, chunk int, entries binary, second binary, twice binary"
ANSWER = "chunk int, range int, answer binary"


def _packed(sorted_values: np.ndarray) -> bytes:
    gaps = np.diff(sorted_values, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(1).compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _windows(docs: pa.Table) -> np.ndarray:
    """Hashes of all windows of a chunk."""
    found = [window_hashes(word_hashes(w), WINDOW) for t in docs.column("text").to_pylist() if len(w := _words(t)) >= WINDOW]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _second(words: list[bytes]) -> np.ndarray:
    """Further hashes of the windows of a text, independent of the first."""
    return window_hashes(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), WINDOW)


def shape(total: int) -> tuple[int, int]:
    """Ranges of cells, and the bits of a cell's number, for a corpus of so many bytes."""
    return total // RANGE + 1, min(60, max(24, int(total / BYTES_PER_WORD * CELLS_PER_WORD).bit_length()))


def _by_range(values: np.ndarray, ranges: int, bits: int) -> np.ndarray:
    """Where each range of sorted values of so many bits starts, and the end."""
    edges = (np.arange(1, ranges, dtype=np.float64) * (2.0**bits / ranges)).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(values, edges), [len(values)]])


def _sketcher(ranges: int, bits: int):
    def sketch(docs: pa.Table) -> pa.Table:
        cells, counts = np.unique(_windows(docs) >> np.uint64(64 - bits), return_counts=True)
        chunk, at, rows = docs.column("chunk")[0].as_py(), _by_range(cells, ranges, bits), []
        for r, (low, high) in enumerate(zip(at[:-1], at[1:], strict=True)):
            if low < high:
                rows.append((r, chunk, _packed(cells[low:high]), np.packbits(counts[low:high] > 1).tobytes()))
        return _table(rows, SKETCH)

    return sketch


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _twice(flags: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(flags, np.uint8), count=n).astype(bool)


def _merged(sketches: pa.Table) -> pa.Table:
    """For each chunk, which of its cells in this range count two or more in all."""
    chunks, parts = sketches.column("chunk").to_pylist(), [_unpacked(x) for x in sketches.column("entries").to_pylist()]
    twice = [_twice(f, len(p)) for f, p in zip(sketches.column("twice").to_pylist(), parts, strict=True)]
    cells, where = np.unique(np.concatenate(parts), return_inverse=True)
    counts = np.bincount(where, minlength=len(cells)) + np.bincount(where[np.concatenate(twice)], minlength=len(cells))
    full, at, rows = counts[where] > 1, 0, []
    r = sketches.column("range")[0].as_py()
    for chunk, part in zip(chunks, parts, strict=True):
        mine = full[at : at + len(part)]
        at += len(part)
        if mine.any():
            rows.append((chunk, r, np.packbits(mine).tobytes()))
    return _table(rows, ANSWER)


def _counted(first: np.ndarray, second: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs in order, the sums of their weights, and which pair each entry is."""
    order = np.lexsort((second, first))
    at = group_starts(first[order], second[order])
    which = np.empty(len(order), np.int64)
    which[order] = np.repeat(np.arange(len(at) - 1), np.diff(at))
    return order[at[:-1]], np.bincount(which, weights, len(at) - 1), which


def _suspects(ranges: int, bits: int):
    def suspects(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """The chunk's windows in cells of two or more, each once, by range of their hashes."""
        if not docs.num_rows or not answers.num_rows:
            return _table([], SUSPECT)
        texts = [w for t in docs.column("text").to_pylist() if len(w := _words(t)) >= WINDOW]
        windows = [window_hashes(word_hashes(w), WINDOW) for w in texts]
        ends = np.cumsum([len(h) for h in windows])
        cells, where = np.unique(np.concatenate(windows) >> np.uint64(64 - bits), return_inverse=True)
        at, full = _by_range(cells, ranges, bits), np.zeros(len(cells), bool)
        for r, mask in zip(answers.column("range").to_pylist(), answers.column("answer").to_pylist(), strict=True):
            full[at[r] : at[r + 1]] = _twice(mask, at[r + 1] - at[r])
        masks = np.split(full[where], ends[:-1])
        some = [(h[m], _second(w)[m]) for w, h, m in zip(texts, windows, masks, strict=True) if m.any()]
        if not some:
            return _table([], SUSPECT)
        first, second = (np.concatenate(x) for x in zip(*some, strict=True))
        kept, counts, _ = _counted(first, second, np.ones(len(first)))
        first, second, twice = first[kept], second[kept], counts > 1
        chunk, at, rows = docs.column("chunk")[0].as_py(), _by_range(first, ranges, 64), []
        for r, (low, high) in enumerate(zip(at[:-1], at[1:], strict=True)):
            if low < high:
                rows.append((r, chunk, first[low:high].tobytes(), second[low:high].tobytes(), np.packbits(twice[low:high]).tobytes()))
        return _table(rows, SUSPECT)

    return suspects


def _grouped(suspects: pa.Table) -> pa.Table:
    """For each chunk, its windows of this range that start twice or more in all: first hashes, then second."""
    parts, others = ([np.frombuffer(x, np.uint64) for x in suspects.column(c).to_pylist()] for c in ("entries", "second"))
    twice = np.concatenate([_twice(f, len(p)) for f, p in zip(suspects.column("twice").to_pylist(), parts, strict=True)])
    _, counts, which = _counted(np.concatenate(parts), np.concatenate(others), 1 + twice)
    repeated, at, rows = counts[which] > 1, 0, []
    r = suspects.column("range")[0].as_py()
    for chunk, part, other in zip(suspects.column("chunk").to_pylist(), parts, others, strict=True):
        mine = repeated[at : at + len(part)]
        at += len(part)
        if mine.any():
            rows.append((chunk, r, part[mine].tobytes() + other[mine].tobytes()))
    return _table(rows, ANSWER)


def _pairs(answers: list[bytes]) -> np.ndarray:
    """Repeated windows: a column of first hashes, in order, and one of second hashes."""
    parts = [np.frombuffer(x, np.uint64).reshape(2, -1) for x in answers]
    found = np.concatenate(parts, 1) if parts else np.zeros((2, 0), np.uint64)
    return found[:, np.lexsort(found[::-1])]


def _hits(words: list[bytes], repeated: np.ndarray) -> np.ndarray:
    """Which windows of a text are repeated."""
    h = window_hashes(word_hashes(words), WINDOW)
    low, high = (np.searchsorted(repeated[0], h, side) for side in ("left", "right"))
    hit = low < high
    if hit.any():
        second, same = _second(words), np.zeros(len(h), bool)
        for step in range(int((high - low).max())):  # windows with equal first hashes; nearly always one
            same |= (low + step < high) & (repeated[1][np.minimum(low + step, repeated.shape[1] - 1)] == second)
        hit = same
    return hit


KEPT = "doc_id long, n_words long, n_removed long, kept string, copies long"


def _removed(digest: bool):
    def remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
        repeated, rows = _pairs(answers.column("answer").to_pylist()), []
        for doc_id, text, copies in zip(*(docs.column(c).to_pylist() for c in ("doc_id", "text", "copies")), strict=True):
            words, kept = _words(text), None
            if copies > 1 and len(words) >= WINDOW:
                kept = []  # each of its windows starts in its copy too
            elif repeated.size and len(words) >= WINDOW:
                hit = _hits(words, repeated)
                if hit.any():
                    change = np.zeros(len(words) + 1, np.int64)
                    change[: len(hit)] += hit
                    change[WINDOW : WINDOW + len(hit)] -= hit
                    kept = [w for w, c in zip(words, np.cumsum(change[:-1]).tolist(), strict=True) if not c]
            kept = words if kept is None else kept
            left = b" ".join(kept)
            rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(left).hexdigest() if digest else left.decode(), copies))
        return _table(rows, KEPT)

    return remove


def without_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for each row; kept: the words that stay, or their SHA-256."""
    rows, _, total, some = chunked(docs)
    ranges, bits = shape(total)
    by_chunk = rows.groupBy("chunk")
    answers = by_chunk.applyInArrow(_sketcher(ranges, bits), SKETCH).groupBy("range").applyInArrow(_merged, ANSWER)
    suspects = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(_suspects(ranges, bits), SUSPECT)
    repeated = suspects.groupBy("range").applyInArrow(_grouped, ANSWER)
    return copied(by_chunk.cogroup(repeated.groupBy("chunk")).applyInArrow(_removed(digest), KEPT), some)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs, digest=True).withColumnRenamed("kept", "kept_sha256")
