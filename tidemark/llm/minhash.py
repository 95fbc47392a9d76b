"""MinHash near-duplicates.

A document's set holds the hashes of its distinct five-word shingles (A-Z lower-cased). Many universal
hash minima make its signature; bands of minima put it into buckets. Equal sets are one class, stood for
by its smallest doc_id. Candidates are compared by signature, then confirmed on full sets, made anew from
the whole texts: a link is 100 * intersection >= percent * union. Connected components come from
alternating large-star and small-star steps.

No bucket's pairs are all emitted. First each member meets only its bucket's smallest doc_id. Then, in
buckets that still hold several components, the members outside the bucket's largest component meet all
others, block by block, by signatures alone; what comes out are the members with a partner in their block, and
no pairs. Texts come to those, and pairs are confirmed there on full sets, unless links found have joined them; only
links that join components come out. Blocks are bounded by members and by shingles. So every candidate pair of a bucket is either in one component already or is compared.

The threshold is a parameter: 85 in the query, 80 in the pipeline's stage. Bands and the least agreement of
signatures follow from it: of two texts at the threshold s, all bands miss with a chance of
(1 - s ** ROWS) ** bands <= MISS (24 bands at 85, 35 at 80).

Edge cases: texts of fewer than five words have their whole sequence as one shingle; null and empty
texts have no set and link with nothing; rows with a null doc_id link with nothing and keep a null
component (deduplicated() drops those whose set a row with a doc_id has, and all but one of equal sets); rows that repeat a doc_id are one document (their sets' links are joined) and are each
reported (deduplicated() keeps one of them); an empty table gives none; further columns pass through
unchanged. Components that do not settle in _MOST_ROUNDS rounds, more than any graph of this size takes, end
in an error and not in a wrong result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, cut_lineage, free_name, group_starts, mixed, row_key, table, whole_groups, window_hashes, word_hashes, written

#: Words of a shingle, and the query's threshold.
SHINGLE, PERCENT = 5, 85
#: Minima of a band, and the chance at most that all bands miss a pair at the threshold.
ROWS, MISS = 5, 1e-6
#: Signatures that agree in fewer places than so many standard deviations below the threshold are no candidates.
DEVIATIONS = 5.3
#: Members of a bucket that meet in one block, and their shingles, about.
BLOCK, ROOM = 256, 4_000_000
_MOST_ROUNDS = 60
#: Any word.
WORD = r"[^\x20\x09-\x0D]"


def bands_of(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def least_agreement(percent: int) -> int:
    n, s = bands_of(percent) * ROWS, percent / 100
    return int(n * s - DEVIATIONS * math.sqrt(n * s * (1 - s)))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(word_hashes(words), min(SHINGLE, len(words))))


def _minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least values of universal hashes (multiply, add, shift) of 32-bit keys."""
    keys = (shingles ^ (shingles >> np.uint64(32))) & np.uint64(0xFFFFFFFF)
    least = np.full(len(a), 2**32 - 1, np.uint64)
    for k in range(0, len(keys), 1024):
        least = np.minimum(least, ((a[:, None] * keys[None, k : k + 1024] + b[:, None]) >> np.uint64(32)).min(1))
    return least


def _signatures(batches: Iterator[pa.RecordBatch], n_bands: int) -> Iterator[pa.RecordBatch]:
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2**63, (2, n_bands * ROWS), np.uint64)
    a, odd = a * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    for batch in batches:
        out: list[tuple] = []
        for text in batch.column(1):  # one by one, as a batch may hold long texts
            s = shingle_set(text.as_py())
            if not len(s):
                out.append((0, None, None, None))
                continue
            m = _minima(s, a, b)
            bands = mixed((m.reshape(n_bands, ROWS) * odd).sum(1, dtype=np.uint64) + np.arange(n_bands, dtype=np.uint64)).view(np.int64)
            out.append((len(s), xxhash.xxh128_digest(s.tobytes()), (m & np.uint64(0xFFFF)).astype(np.uint16).tobytes(), bands))
        n, sets, signatures, bands = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(signatures, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "name", "n_shingles", "set_hash", "signature", "bands"],
        )
    pa.default_memory_pool().release_unused()  # workers live on, and hold what they have


def _as_rows(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _same_signature(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            good = (_as_rows(batch.column("sa")) == _as_rows(batch.column("sb"))).sum(1) >= least_agreement(percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are near; rows of one a mostly follow each other."""
    before, near = None, None
    for batch in batches:
        good = []
        for a, x, y in zip(batch.column("a").to_pylist(), batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
            if before != (a, x):
                before, near = (a, x), shingle_set(x)
            good.append(_near(near, shingle_set(y), percent))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _near(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


CELL = ["bucket", "i", "j"]
MEMBER = "bucket long, i int, j int, side int, rep long, component long, signature binary, bands array<long>"


def _agreeing(cell: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, rows, agreement): the pairs of one block, of different components, whose signatures agree. Of a pair that
    shares several buckets, only the first one's block has it."""
    bucket, side, component = cell.column("bucket")[0].as_py(), cell.column("side").to_numpy(), cell.column("component").to_numpy()
    signatures, bands = _as_rows(cell.column("signature")), cell.column("bands").combine_chunks().flatten().to_numpy().reshape(cell.num_rows, -1)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    for x in left.tolist():
        here = int(np.flatnonzero(bands[x] == bucket)[0])
        agree = (signatures[right] == signatures[x]).sum(1)
        likely = (agree >= least_agreement(percent)) & ((bands[right] == bands[x]).argmax(1) == here) & (component[right] != component[x])
        if likely.any():
            yield x, right[likely], agree[likely]


def _partnered(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The members of each block that have a partner there: their texts are needed, and no pair is written."""
    for cells in whole_groups(batches, CELL):
        starts, needed = group_starts(*(cells.column(k).to_numpy() for k in CELL)), []
        for low, high in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            found = [np.append(rows, x) for x, rows, _ in _agreeing(cells.slice(low, high - low), percent)]
            needed += [low + i for i in np.unique(np.concatenate(found)).tolist()] if found else []
        yield from cells.take(pa.array(needed, pa.int64())).select([x.split()[0] for x in MEMBER.split(", ")]).combine_chunks().to_batches()


def _joining(percent: int):
    def links(members: pa.Table, texts: pa.Table) -> pa.Table:
        """Confirmed links of a block that join components; what is joined already is not compared again. The
        block's shingles are numbered once; a document's are marked, and those of each of its partners counted."""
        sets = [shingle_set(t.as_py()) for t in texts.column("text")]
        codes = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)[1]
        codes = np.split(codes, np.cumsum([len(s) for s in sets]))[:-1]
        of: dict[int, list[np.ndarray]] = {}
        for rep, c in zip(texts.column("rep").to_pylist(), codes, strict=True):
            of.setdefault(rep, []).append(c)
        marked, up = np.zeros(sum(map(len, sets)), np.uint8), {}

        def root(c: int) -> int:
            while up.setdefault(c, c) != c:
                up[c] = c = up[up[c]]
            return c

        def near(a: int, b: int) -> bool:
            for x in of[a]:
                marked[x] = 1
                both = [(len(x) + len(y), int(marked[y].sum(dtype=np.int64))) for y in of[b]]
                marked[x] = 0
                if any(100 * n >= percent * (total - n) for total, n in both):
                    return True
            return False

        ids, component, found = members.column("rep").to_pylist(), members.column("component").to_pylist(), []
        pairs = [(-n, ids[x], ids[y], component[x], component[y]) for x, rows, agree in _agreeing(members, percent) for y, n in zip(rows.tolist(), agree.tolist(), strict=True)] if members.num_rows else []
        for _, a, b, ca, cb in sorted(pairs):
            x, y = root(ca), root(cb)
            if x != y and near(a, b):
                up[max(x, y)] = min(x, y)
                found.append((min(a, b), max(a, b)))
        a, b = zip(*found, strict=True) if found else ((), ())
        pa.default_memory_pool().release_unused()
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return links


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (a, b): the smallest node reachable."""
    edges = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    before = None
    for _ in range(_MOST_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: larger neighbours move to the smallest of the neighbourhood
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        edges = cut_lineage(small)
        now = edges.agg(F.count("*"), F.count_distinct("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:  # one edge for each node that is not smallest, and no change
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return cut_lineage(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v")).distinct())


def _verified(pairs: DataFrame, signatures: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree and whose full sets are near."""
    side = lambda k: signatures.select(F.col("rep").alias(k), F.col("signature").alias(f"s{k}"))
    likely = cut_lineage(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb").mapInArrow(partial(_same_signature, percent=percent), "a long, b long"))
    ids = cut_lineage(likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    texts = docs.select("doc_id", "text").join(broadcast_if_small(ids), "doc_id", "left_semi")
    text = lambda k: texts.select(F.col("doc_id").alias(k), F.col("text").alias(f"t{k}"))
    return likely.join(text("b"), "b").join(text("a"), "a").select("a", "b", "ta", "tb").mapInArrow(partial(_confirmed, percent=percent), "a long, b long")


def _left_over(buckets: DataFrame, signatures: DataFrame, docs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components that share a bucket."""
    member = buckets.join(found, F.col("rep") == F.col("node"), "left").select("bucket", "rep", "n_shingles", F.coalesce("component", "rep").alias("component"))
    sizes = member.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("room"))
    mixed_ones = sizes.groupBy("bucket").agg(F.sum("n").alias("members"), F.sum("room").alias("room"), F.max(F.struct("n", "component", "room")).alias("major"), F.count("*").alias("parts")).filter("parts > 1")
    most = lambda n, room: F.greatest(F.ceil(n / BLOCK), F.ceil(room / ROOM)).cast("int")
    mixed_ones = mixed_ones.select("bucket", F.col("major.component").alias("major"), most(F.col("members"), F.col("room")).alias("members"), most(F.col("members") - F.col("major.n"), F.col("room") - F.col("major.room")).alias("others"))
    rows = written(member.drop("n_shingles").join(mixed_ones, "bucket")).join(signatures.select("rep", "signature", "bands"), "rep")
    blocks = F.col
    own = lambda n: F.pmod(F.xxhash64("rep"), blocks(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    columns = [*CELL, "side", "rep", "component", "signature", "bands"]
    left = rows.filter("component != major").withColumn("i", own("others")).withColumn("j", each("members")).withColumn("side", F.lit(0)).select(columns)
    right = rows.withColumn("j", own("members")).withColumn("i", each("others")).withColumn("side", F.lit(1)).select(columns)
    needed = written(left.union(right).repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(partial(_partnered, percent=percent), MEMBER))
    ids = written(needed.select("rep").distinct())
    texts = needed.select(*[F.col(c).alias(c) for c in (*CELL, "rep")]).distinct().join(docs.select(F.col("doc_id").alias("rep"), "text").join(broadcast_if_small(ids), "rep", "left_semi"), "rep")
    return needed.groupBy(*CELL).cogroup(texts.groupBy(*CELL)).applyInArrow(_joining(percent), "a long, b long")


def _judged(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, name, n_shingles, set_hash, component_id) for each row; name: of its text, for rows without a doc_id."""
    name = F.when(F.col("doc_id").isNull(), row_key("text")).alias("name")
    signed = cut_lineage(docs.select("doc_id", "text", name).mapInArrow(partial(_signatures, n_bands=bands_of(percent)), "doc_id long, name binary, n_shingles long, set_hash binary, signature binary, bands array<long>"))
    linkable = signed.filter("doc_id is not null and set_hash is not null")
    classes = cut_lineage(linkable.groupBy("set_hash").agg(F.min("doc_id").alias("rep")))
    stand = linkable.join(classes, "set_hash").filter("doc_id = rep")
    signatures = cut_lineage(stand.groupBy("rep", "set_hash").agg(F.first("signature").alias("signature"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles")))
    # buckets with one member link nothing
    buckets = signatures.select(F.explode("bands").alias("bucket"), "rep", "n_shingles")
    shared = buckets.groupBy("bucket").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).filter("a < last").drop("last")
    member = cut_lineage(buckets.join(shared, "bucket"))
    stars = member.filter("a < rep").select("a", F.col("rep").alias("b")).distinct()
    # documents whose rows have several sets link through their doc_id
    several = linkable.select("doc_id", "set_hash").distinct().join(classes, "set_hash").filter("doc_id != rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    repeated = linkable.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("b"))
    links = cut_lineage(_verified(stars, signatures, docs, percent).union(several.join(repeated, "b", "left_semi").select("a", "b")).distinct())
    found = components(links)
    more = cut_lineage(_left_over(member.select("bucket", "rep", "n_shingles"), signatures, docs, found, percent))
    if more.limit(1).count():
        found = components(found.select(F.col("component").alias("a"), F.col("node").alias("b")).union(more))
    of_set = classes.join(found, F.col("rep") == F.col("node"), "left").select("set_hash", F.coalesce("component", "rep").alias("component_id"))
    return signed.select("doc_id", "name", "n_shingles", "set_hash").join(broadcast_if_small(cut_lineage(of_set)), "set_hash", "left")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row."""
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    return _judged(docs, percent).select("doc_id", "n_shingles", component).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _one_of_each(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each value of keys, with all columns."""
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    name = free_name(rows, "row")
    return rows.groupBy(*keys).agg(F.min_by(whole, F.xxhash64(whole)).alias(name)).select(f"{name}.*")


def deduplicated(docs: DataFrame, percent: int) -> DataFrame:
    """One document of each group of near duplicates, with its columns: one row of the smallest doc_id. Of rows
    without a doc_id, one of each set stays if no row with a doc_id has that set; those without words all stay."""
    judged = written(_judged(docs, percent))
    other = free_name(docs, "doc_id_gone")
    gone = written(judged.filter("doc_id != component_id").select(F.col("doc_id").alias(other)).distinct())
    known = docs.filter("doc_id is not null").join(broadcast_if_small(gone), F.col("doc_id") == F.col(other), "left_anti")
    repeated = written(judged.filter("doc_id is not null").groupBy(F.col("doc_id").alias(other)).agg(F.count("*").alias("n")).filter("n > 1").select(other))
    if repeated.limit(1).count():
        same, small = F.col("doc_id") == F.col(other), broadcast_if_small(repeated)
        known = known.join(small, same, "left_anti").unionByName(_one_of_each(known.join(small, same, "left_semi"), "doc_id"))
    if not judged.filter("name is not null").limit(1).count():
        return known
    sets = judged.filter("doc_id is not null and set_hash is not null").select("set_hash").distinct()
    name = free_name(docs, "text_name")
    stay = judged.filter("name is not null and set_hash is not null").groupBy("set_hash").agg(F.min("name").alias(name)).join(sets, "set_hash", "left_anti").select(name)
    unknown, empty = docs.filter("doc_id is null"), ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    named = unknown.filter(~empty).withColumn(name, row_key("text")).join(broadcast_if_small(written(stay)), name, "left_semi")
    return known.unionByName(unknown.filter(empty)).unionByName(_one_of_each(named, name).drop(name).select(docs.columns))


def op1_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
