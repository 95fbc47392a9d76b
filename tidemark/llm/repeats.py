"""Suffix-array deduplication of repeated bytes, by a sparse enhanced suffix array.

Suffixes are sampled: of each LEAST-byte window, the place of its least GRAM-byte hash is an anchor, so equal
windows have anchors at the same place in them, and only suffixes at anchors need sorting. Anchors whose
gram is found once are dropped. Of the rest, those with equal contexts (LEFT bytes before, RIGHT after) are
one class with a count of occurrences, stood for by one of them.

Spark sorts the classes of each gram by the bytes from the anchor on. A stack scan over common-prefix
lengths walks the interval tree of the sorted suffixes. In each interval the preceding bytes, sorted
backwards, give the tree of left extensions: each of its inner nodes that holds suffixes of two or more child
intervals, and each class of two or more occurrences, is a maximal repeat group, with all its occurrences
and not only neighbours. repeat_groups() lists each group at the anchor of its first LEAST bytes, which all
its occurrences have, with RIGHT bytes after the anchor at most. A class's cover comes from the deepest groups
it is in.

A gram of over MOST classes is parted by longer strings around the anchor until its parts are small: a match
of `target` bytes reaches far to the right or else far to the left, so the parts (which overlap) miss none,
and after log2(target) partings all members of a part share `target` bytes. So no group of unbounded size
meets in one task.

The query removes what groups of LENGTH bytes or more cover. Passages of 50 words can be shorter than that;
the column n_shared counts the bytes that groups of LEAST bytes or more cover, which shows them.

Edge cases: null and empty texts have no bytes and the hash of nothing; texts shorter than LENGTH lose
nothing; repeated rows count as copies of each other; a null doc_id is kept; runs of one byte are
repeats of themselves; an empty table gives none; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, chunked, copied, group_starts, mixed, table, whole_groups, written

#: Bytes of a string that is removed where it repeats, of the shortest repeat found, and of a gram.
LENGTH, LEAST, GRAM = 400, 240, 120
#: Bytes before an anchor that its windows reach, and one more to tell what precedes them; and bytes after it.
LEFT, RIGHT = LEAST - GRAM + 1, LENGTH
#: Classes that are sorted and scanned in one task.
MOST = 20_000
#: Window starts handled at once in one text.
SEGMENT = 8 << 20
_LOW = np.uint64((1 << 24) - 1)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours: block prefixes and suffixes."""
    n = len(x) - w + 1
    pad = np.full(-len(x) % w, np.iinfo(x.dtype).max, x.dtype)
    blocks = np.concatenate([x, pad]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


class _Grams:
    """Hashes of all GRAM-byte strings of a text, by running sums."""

    def __init__(self) -> None:
        rng = np.random.default_rng(3)
        self.value = rng.integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.base, self.inverse = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            n = max(1 << 17, len(data) + 1)
            self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, b))]) for b in (self.base, self.inverse))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.value[data] * self.up[: len(data)], dtype=np.uint64)])
        n = len(data) - GRAM + 1
        return mixed((sums[GRAM:] - sums[:n]) * self.down[:n])


def _places(data: bytes, grams: _Grams) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of a text, rising, and the hashes of their grams."""
    places, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(data) - LEAST + 1, SEGMENT):
        part = np.frombuffer(data, np.uint8)[at : at + SEGMENT + LEAST - 1]
        h = grams(part)
        least = _sliding_min((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), LEAST - GRAM + 1)
        found = np.unique(least & _LOW).astype(np.int64)
        places.append(found + at)
        keys.append(h[found].view(np.int64))
    places, first = np.unique(np.concatenate(places), return_index=True)  # segments overlap
    return places, np.concatenate(keys)[first]


ANCHOR = "chunk int, doc long, pos int, tail int, leads boolean, more binary, key long, context long, n int"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each gram and context of a text: its first place, the distances of others, and their count (twice, if
    the text has copies)."""
    grams, context = _Grams(), xxhash.xxh3_64_intdigest
    for batch in batches:
        parts: list[tuple] = []
        for chunk, doc, text, copies in zip(*(batch.column(c).to_pylist() for c in ("chunk", "doc", "text", "copies")), strict=True):
            data = (text or "").encode()
            if len(data) < LEAST:
                continue
            places, keys = _places(data, grams)
            around = np.array([context(data[max(0, p - LEFT) : p + RIGHT], min(p, LEFT)) for p in places.tolist()], np.uint64).view(np.int64)
            order = np.lexsort((places, around, keys))
            at = group_starts(keys[order], around[order])
            low, n = order[at[:-1]], np.diff(at)
            more: list = [None] * len(n)
            for k in np.flatnonzero(n > 1).tolist():
                more[k] = places[order[at[k] + 1 : at[k + 1]]].astype(np.int32).tobytes()
            parts.append((np.full(len(n), chunk, np.int32), np.full(len(n), doc, np.int64), places[low].astype(np.int32), np.minimum(len(data) - places[low], RIGHT).astype(np.int32), places[low] == places[0], more, keys[low], around[low], (n * min(copies, 2)).astype(np.int32)))
        columns = [list(chain.from_iterable(x)) if isinstance(x[0], list) else np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [()] * 9
        yield _batch_of(columns, ANCHOR)


def _batch_of(columns: list, schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    return _batch_of(list(zip(*rows, strict=True)) if rows else [()] * len(schema.split(", ")), schema)


#: part: the gram's hash, or that of the longer string by which a hot gram is parted; all of a part share
#: `a` bytes before the anchor and `b` after; target 0: matches of either length are sought, in whole grams.
CONTEXT = "part long, target int, a int, b int, key long, context long, n long, chunk int, doc long, pos int, before binary, after binary"


def _contexts(docs: pa.Table, wanted: pa.Table) -> pa.Table:
    """The bytes around the wanted anchors of a chunk; those before are reversed."""
    rows: list[tuple] = []
    texts = {d: t for d, t in zip(docs.column("doc").to_pylist(), docs.column("text").to_pylist(), strict=True)} if wanted.num_rows else {}
    last, data = None, b""
    for doc, pos, key, context, n in sorted(zip(*(wanted.column(c).to_pylist() for c in ("doc", "pos", "key", "context", "n")), strict=True)):
        if doc != last:
            last, data = doc, texts[doc].encode()
        rows.append((key, 0, 0, GRAM, key, context, n, docs.column("chunk")[0].as_py(), doc, pos, data[max(0, pos - LEFT) : pos][::-1], data[pos : pos + RIGHT]))
    return pa.Table.from_batches([_batch(rows, CONTEXT)])


def _parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of parts that are too large, in smaller parts: of a match of `target` bytes, half of what is
    missing lies to the right of what they share, or else the other half to the left."""
    for batch in batches:
        rows = []
        for part, target, a, b, *same, before, after in zip(*(batch.column(x.split()[0]).to_pylist() for x in CONTEXT.split(", ")), strict=True):
            for t in (target,) if target else (LEAST, LENGTH):
                reach = b + (t - a - b + 1) // 2
                for x, y in ((a, reach), (t - reach + 1, b)):
                    if len(before) >= x and len(after) >= y and x <= LEFT and y <= RIGHT:
                        new = xxhash.xxh3_64_intdigest(before[:x][::-1] + after[:y], seed=(part + t * 1_000_003 + x) % 2**64) - 2**63
                        rows.append((new, t, x, y, *same, before, after))
        yield _batch(rows, CONTEXT)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(after: list[bytes]) -> Iterator[tuple[int, list[list[int]]]]:
    """Inner nodes of the interval tree of sorted suffixes, children first: (common prefix, the members of
    each child)."""
    stack: list[tuple[int, list[list[int]]]] = []
    for i in range(1, len(after) + 1):
        common, node = (_common(after[i - 1], after[i]) if i < len(after) else -1), [i - 1]
        while stack and stack[-1][0] > common:
            right, children = stack.pop()
            children.append(node)
            yield right, children
            node = list(chain.from_iterable(children))
        if stack and stack[-1][0] == common:
            stack[-1][1].append(node)
        elif common >= 0:
            stack.append((common, [node]))


def _extensions(before: list[bytes], right: int, children: list[list[int]]) -> tuple[list[int], list[int], list[int]]:
    """An interval's members by their preceding bytes, the child each is of, and the left extensions that
    neighbours share."""
    members = sorted((before[i], k, i) for k, child in enumerate(children) for i in child)
    shared = [_common(x[0], y[0]) for x, y in zip(members, members[1:])]
    return [i for *_, i in members], [k for _, k, _ in members], shared


def covers(before: list[bytes], after: list[bytes], lengths: tuple[int, ...]) -> list[list[list[int]]]:
    """For each length, how far before and after the anchor repeats of that length or more reach, for each
    suffix (sorted by the bytes after it): the deepest group that a suffix shares with any other."""
    out = [[[-1, -1] for _ in after] for _ in lengths]
    for right, children in intervals(after):
        members, _, shared = _extensions(before, right, children)
        for k, i in enumerate(members):
            left = max(shared[max(0, k - 1) : k + 1])
            for best, length in zip(out, lengths, strict=True):
                if left + right >= length:
                    best[i] = [max(best[i][0], left), max(best[i][1], right)]
    return out


def groups(before: list[bytes], after: list[bytes], counts: list[int], least: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats of `least` bytes or more: (bytes before, bytes after, members)."""
    within = set()  # suffixes whose whole context others have too
    for right, children in intervals(after):
        members, child, shared = _extensions(before, right, children)
        within.update(i for k, i in enumerate(members) if right == len(after[i]) and len(before[i]) in shared[max(0, k - 1) : k + 1])
        stack: list[tuple[int, int]] = []  # left extension, first member
        for k in range(len(members)):
            now, first = (shared[k] if k + 1 < len(members) else -1), k
            while stack and stack[-1][0] > now:
                left, first = stack.pop()
                if left + right >= least and len(set(child[first : k + 1])) > 1:
                    yield left, right, members[first : k + 1]
            if now >= 0 and (not stack or stack[-1][0] < now):
                stack.append((now, first))
    for i, n in enumerate(counts):
        if n > 1 and i not in within and len(before[i]) + len(after[i]) >= least:
            yield len(before[i]), len(after[i]), [i]


def _columns(rows: pa.Table, *names: str) -> list[list]:
    return [rows.column(c).to_pylist() for c in names]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    for rows in whole_groups(batches, ["part"]):
        at = group_starts(rows.column("part").to_numpy()).tolist()
        yield rows, list(zip(at, at[1:]))


COVER = "chunk int, doc long, low int, high int, strong boolean"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cover of the classes of one occurrence in whole parts, sorted by the bytes from the anchor on."""
    for rows, parts in _parts(batches):
        target, n, chunk, doc, pos, before, after = _columns(rows, "target", "n", "chunk", "doc", "pos", "before", "after")
        out = []
        for low, high in parts:
            lengths = (target[low],) if target[low] else (LEAST, LENGTH)
            for length, found in zip(lengths, covers(before[low:high], after[low:high], lengths), strict=True):
                out += [(chunk[i], doc[i], pos[i] - left, pos[i] + right, length >= LENGTH) for i, (left, right) in enumerate(found, low) if left >= 0 and n[i] == 1]
        yield _batch(out, COVER)


GROUP = "key long, first long, bytes_before int, bytes_after int, context long"


def _leads(before: bytes, after: bytes, left: int, right: int, grams: _Grams) -> bool:
    """Whether the anchor is that of the first LEAST bytes of this repeat."""
    places, _ = _places((before[:left][::-1] + after[:right])[:LEAST], grams)
    return places[0] == left


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each class of each maximal repeat group; a group is named by key, lengths and first class."""
    grams = _Grams()
    for rows, parts in _parts(batches):
        target, key, context, n, before, after = _columns(rows, "target", "key", "context", "n", "before", "after")
        out = []
        for low, high in parts:
            if target[low] != LENGTH:  # parts of the other target have them all
                for left, right, members in groups(before[low:high], after[low:high], n[low:high], LEAST):
                    if _leads(before[low + members[0]], after[low + members[0]], left, right, grams):
                        first = min(context[low + i] for i in members)
                        out += [(key[low], first, left, right, context[low + i]) for i in members]
        yield _batch(out, GROUP)


def _listed_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same of parts whose members all share LEAST bytes; such a group is named by its part."""
    grams = _Grams()
    for batch in batches:
        columns = _columns(batch, "target", "part", "a", "b", "key", "context", "before", "after")
        yield _batch([(key, part, a, b, context) for target, part, a, b, key, context, before, after in zip(*columns, strict=True) if target == LEAST and _leads(before, after, a, b, grams)], GROUP)


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, n_shared long, copies long"


def _union(low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by intervals sorted by their starts."""
    if not len(low):
        return []
    reach = np.maximum.accumulate(high)
    new = np.append(True, low[1:] > reach[:-1])
    return list(zip(low[new].tolist(), reach[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)].tolist(), strict=True))


def _removed(digest: bool):
    def remove(docs: pa.Table, cover: pa.Table) -> pa.Table:
        doc, low, high = (cover.column(c).to_numpy() for c in ("doc", "low", "high"))
        strong = cover.column("strong").to_numpy(zero_copy_only=False).astype(bool)
        more = [(k, np.frombuffer(x, np.int32).astype(np.int64) - low[k] - LEFT) for k, x in enumerate(cover.column("more").to_pylist()) if x]
        if more:  # further places of the same context in its document
            at, moved = np.concatenate([np.full(len(x), k) for k, x in more]), np.concatenate([x for _, x in more])
            doc, low, high, strong = (np.concatenate(p) for p in ((doc, doc[at]), (low, low[at] + moved), (high, high[at] + moved), (strong, strong[at])))
        order = np.lexsort((low, doc))
        doc, low, high, strong = doc[order], low[order], high[order], strong[order]
        rows = []
        for name, doc_id, text, copies in zip(*(docs.column(c).to_pylist() for c in ("doc", "doc_id", "text", "copies")), strict=True):
            data = (text or "").encode()
            own = slice(int(np.searchsorted(doc, name)), int(np.searchsorted(doc, name, "right")))
            a, b = np.maximum(low[own], 0), np.minimum(high[own], len(data))
            real = b - a >= np.where(strong[own], LENGTH, LEAST)  # contexts at a text's edge can be shorter
            shared = _union(a[b - a >= LEAST], b[b - a >= LEAST])
            spans = _union(a[real & strong[own]], b[real & strong[own]])
            kept, at = [], 0
            for x, y in spans:
                kept.append(data[at:x])
                at = y
            kept = b"".join([*kept, data[at:]])
            rows.append((doc_id, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest().encode() if digest else kept, sum(y - x for x, y in shared), copies))
        return pa.Table.from_batches([_batch(rows, KEPT)])

    return remove


class _Array:
    """The sparse suffix array of a table: anchors of shared grams, and their classes."""

    def __init__(self, docs: DataFrame) -> None:
        self.rows, _, _, self.copies = chunked(docs)
        anchors = written(self.rows.select("chunk", "doc", "text", "copies").mapInArrow(_anchors, ANCHOR))
        shared = written(anchors.groupBy("key").agg(F.sum("n").alias("total")).filter("total > 1").select("key"))
        self.anchors = written(anchors.join(broadcast_if_small(shared), "key"))
        self.classes = written(self.anchors.groupBy("key", "context").agg(F.sum("n").alias("n"), F.min(F.struct("chunk", "doc", "pos", "tail", "leads")).alias("rep")))

    def around(self, keys: DataFrame) -> DataFrame:
        wanted = self.classes.join(keys, "key").select("rep.*", "key", "context", "n")
        return self.rows.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(_contexts, CONTEXT)

    def parts(self) -> tuple[DataFrame, list[DataFrame]]:
        """Parts of MOST classes at most, in the order of the suffix array, and larger ones whose members all
        share `target` bytes."""
        sizes = written(self.classes.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"))
        found, whole = self.around(sizes.filter(F.col("size") <= MOST).select("key")), []
        hot = sizes.filter(F.col("size") > MOST).select("key")
        left = written(self.around(hot)) if hot.limit(1).count() else None
        while left is not None and left.limit(1).count():
            parts = written(left.mapInArrow(_parted, CONTEXT))
            sized = parts.join(written(parts.groupBy("part").agg(F.count("*").alias("size")).filter("size > 1")), "part")
            large, equal = F.col("size") > MOST, F.col("a") + F.col("b") >= F.col("target")
            found = found.unionByName(sized.filter(~large).drop("size"))
            whole.append(sized.filter(large & equal).drop("size"))
            left = written(sized.filter(large & ~equal).drop("size"))
        return found.repartition("part").sortWithinPartitions("part", "after"), whole


def without_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, n_shared) for each row; kept: the bytes that stay (a cut may
    fall within a character), or their SHA-256 in hexadecimal."""
    array = _Array(docs)
    parts, whole = array.parts()
    cover = parts.mapInArrow(_scan, COVER)
    for x in whole:
        cover = cover.unionByName(x.filter("n = 1").select("chunk", "doc", (F.col("pos") - F.col("a")).alias("low"), (F.col("pos") + F.col("b")).alias("high"), (F.col("target") >= LENGTH).alias("strong")))
    # a class of several occurrences is a group of its own
    several = array.anchors.join(array.classes.filter("n > 1").select("key", "context"), ["key", "context"])
    place = [(F.col("pos") - LEFT).alias("low"), (F.col("pos") + RIGHT).alias("high"), F.lit(True).alias("strong"), "more"]
    cover = several.select("chunk", "doc", *place).unionByName(cover.withColumn("more", F.lit(None).cast("binary")))
    return copied(array.rows.groupBy("chunk").cogroup(cover.groupBy("chunk")).applyInArrow(_removed(digest), KEPT), array.copies)


PLACE = "key long, context long, doc long, pos int"


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each place of an anchor."""
    for batch in batches:
        rows = []
        for key, context, doc, pos, more in zip(*(batch.column(c).to_pylist() for c in ("key", "context", "doc", "pos", "more")), strict=True):
            rows += [(key, context, doc, p) for p in (pos, *np.frombuffer(more or b"", np.int32).tolist())]
        yield _batch(rows, PLACE)


def repeat_groups(docs: DataFrame) -> DataFrame:
    """(group_id, n_bytes, doc_id, start): a row for each occurrence of each maximal repeat group of LEAST bytes
    or more, by bytes; of a longer one, its first bytes up to RIGHT after its anchor. Hot parts whose members
    all share LEAST bytes are groups of just these bytes."""
    array = _Array(docs)
    parts, whole = array.parts()
    listed = parts.mapInArrow(_listed, GROUP)
    for x in whole:
        listed = listed.unionByName(x.mapInArrow(_listed_whole, GROUP))
    alone = array.classes.groupBy("key").agg(F.count("*").alias("size"), F.first("context").alias("context"), F.first("n").alias("n"), F.first("rep").alias("rep")).filter("size = 1 and n > 1")
    alone = alone.filter(F.col("rep.leads") & (F.col("rep.pos") < LEFT) & (F.col("rep.pos") + F.col("rep.tail") >= LEAST))
    alone = alone.select("key", F.col("context").alias("first"), F.col("rep.pos").alias("bytes_before"), F.col("rep.tail").alias("bytes_after"), "context")
    places = array.anchors.select("key", "context", "doc", "pos", "more").mapInArrow(_each, PLACE)
    found = written(listed.unionByName(alone).distinct()).join(places, ["key", "context"]).join(array.rows.select("doc", "doc_id"), "doc")
    name = F.concat_ws(":", *[F.hex(c) for c in ("key", "first")], "bytes_before", "bytes_after").alias("group_id")
    return found.select(name, (F.col("bytes_before") + F.col("bytes_after")).alias("n_bytes"), "doc_id", (F.col("pos") - F.col("bytes_before")).alias("start")).distinct()


def op2_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    kept = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.decode("kept", "UTF-8").alias("kept_sha256"), "n_shared")
