"""Vector code compression: product codes by exact k-means over metric trees of vector parts.

Vectors are made of integers, floor(4096 * x), and cut into equal consecutive parts; each part position has a
codebook of its own, refined by rounds of assignment and means. Blocks of at most BLOCK vectors, as Spark reads
them, get one metric tree for each part position, once, and are written to the shared folder. A tree is built
by the anchors hierarchy, middle-out: about sqrt(n) anchors are placed, each at the point farthest from its
anchor so far, and win the points nearer to them (a point whose distance is at most half of that between the anchors is
not looked at); pairs of anchors are merged into balls, the tightest first, up to a root; each anchor is parted
the same way, down to leaves of LEAF points. Balls keep the count and sum of their points.

A round walks each tree from the root with the list of codebook entries that may own a point. A ball inherits
the list of its parent and strikes out every entry that for all its points is farther than the one nearest to its
centre; once one entry is left, the ball is wholly owned and its cached sum and count are added. Leaves compare
their points with what is left. Tests on balls are floating-point with a margin, so they only ever leave
entries in; distances of points, sums and means are exact integers, ties go to the lower index. Blocks send sums and
counts only; Spark adds them up, and the codebooks (16 entries for each part) go back with the next round.

Edge cases: vectors that are null or hold null or non-finite components are dropped; so are vectors whose length
isn't the most frequent one (of equally frequent ones the greatest), which must be a multiple of the parts; an empty
vector has empty parts. Of fewer than 16 vectors each starts an entry; null ids start entries only after all others,
and equal ids in order of their vectors. Repeated rows each count; unused entries stay; label_error takes null labels
together; errors beyond a long end the query; further columns take no part; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, table, written

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors of a block, whose trees fit a task, and points of a leaf.
BLOCK, LEAF = 4096, 24

_WIDE = 2**62 // BLOCK

Codebooks = list[list[tuple[int, ...]]]


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), as int64, or as Python's integers where sums over a block might not fit."""
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    return scaled.astype(np.int64) if np.abs(scaled).max(initial=0) < _WIDE else np.array([[int(x) for x in v] for v in scaled], dtype=object).reshape(vectors.shape)


def _exact(points: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in a type that holds their squared distances exactly."""
    reach = max((int(np.abs(a).max()) for a in (points, others) if a.size), default=0)
    kind = np.int64 if max(1, points.shape[-1]) * 4 * (reach + 1) ** 2 < 2**63 else object
    return points.astype(kind), others.astype(kind)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, points by entries, exact."""
    a, b = _exact(points, entries)
    return ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)


class Tree:
    """A metric tree over the distinct points of a block's part, its nodes as arrays.

    Node i is a ball of centre `centre[i]` and `radius[i]`, with `count[i]` points that sum up to `total[i]`. Its
    children are `left[i]` and `right[i]`, or -1 at a leaf; its points are `order[low[i]:high[i]]`.
    """

    def __init__(self, points: np.ndarray, weights: np.ndarray):
        self.points, self.weights, self.place = points, weights, points.astype(np.float64)
        self.nodes: list[list] = []  # centre, radius, left, right, members
        root = self._grown(np.arange(len(points))) if len(points) else -1
        self._laid_out(root)

    def _ball(self, members: np.ndarray, left: int = -1, right: int = -1) -> int:
        """A ball around the mean of its members' corners, and its number."""
        x = self.place[members]
        centre = (x.min(axis=0) + x.max(axis=0)) / 2
        radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1).max())) if len(members) else 0.0
        self.nodes.append([centre, radius, left, right, members])
        return len(self.nodes) - 1

    def _anchors(self, members: np.ndarray) -> list[np.ndarray]:
        """Members by the anchor that is nearest, of about sqrt(n) anchors."""
        x = self.place[members]
        far = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
        pivots, owned, reach = [0], [np.argsort(-far, kind="stable")], [far]
        # each anchor keeps its points from the farthest to the nearest, so that those it surely keeps are a tail
        reach[0] = far[owned[0]]
        for _ in range(int(np.ceil(np.sqrt(len(members)))) - 1):
            widest = max(range(len(pivots)), key=lambda i: reach[i][0])
            if reach[widest][0] == 0:
                break
            new = int(owned[widest][0])
            won, won_far = [], []
            for i, pivot in enumerate(pivots):
                half = np.sqrt(((x[new] - x[pivot]) ** 2).sum()) / 2
                head = int(np.searchsorted(-reach[i], -half * (1 - 1e-9), side="left"))
                if not head:
                    continue
                near = np.sqrt(((x[owned[i][:head]] - x[new]) ** 2).sum(axis=1))
                leaves = near < reach[i][:head]
                won.append(owned[i][:head][leaves])
                won_far.append(near[leaves])
                stays = np.concatenate([~leaves, np.ones(len(reach[i]) - head, bool)])
                owned[i], reach[i] = owned[i][stays], reach[i][stays]
            mine, mine_far = np.concatenate(won), np.concatenate(won_far)
            by_far = np.argsort(-mine_far, kind="stable")
            pivots.append(new)
            owned.append(mine[by_far])
            reach.append(mine_far[by_far])
        return [members[o] for o in owned]

    def _grown(self, members: np.ndarray) -> int:
        """The number of the ball over members, with all below it."""
        groups = self._anchors(members) if len(members) > LEAF else []
        if len(groups) < 2:
            return self._ball(members)
        tops = [self._grown(g) for g in groups]
        corners = [(self.place[g].min(axis=0), self.place[g].max(axis=0)) for g in groups]
        low, high = np.array([c[0] for c in corners]), np.array([c[1] for c in corners])
        live = list(range(len(tops)))
        # the room that two balls need together, by their corners; the tightest pair merges first
        room = ((np.maximum(high[:, None], high[None]) - np.minimum(low[:, None], low[None])) ** 2).sum(axis=2)
        np.fill_diagonal(room, np.inf)
        while len(live) > 1:
            a, b = divmod(int(room.argmin()), len(room))
            tops[a] = self._ball(np.concatenate([self.nodes[tops[a]][4], self.nodes[tops[b]][4]]), tops[a], tops[b])
            low[a], high[a] = np.minimum(low[a], low[b]), np.maximum(high[a], high[b])
            live.remove(b)
            room[b], room[:, b] = np.inf, np.inf
            others = [i for i in live if i != a]
            room[a, others] = room[others, a] = ((np.maximum(high[a], high[others]) - np.minimum(low[a], low[others])) ** 2).sum(axis=1)
        return tops[live[0]]

    def _laid_out(self, root: int) -> None:
        """Nodes as arrays; the points of a node become a range of one order."""
        n, dims = len(self.nodes), self.points.shape[1]
        self.centre = np.array([x[0] for x in self.nodes]).reshape(n, dims)
        self.radius = np.array([x[1] for x in self.nodes])
        self.left, self.right = (np.array([x[k] for x in self.nodes], dtype=np.int64) for k in (2, 3))
        self.low, self.high = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.root, order, pending = root, [], [root] if n else []
        at = 0
        while pending:
            i = pending.pop()
            self.low[i], self.high[i] = at, at + len(self.nodes[i][4])
            if self.left[i] < 0:
                order.append(self.nodes[i][4])
                at += len(self.nodes[i][4])
            else:
                pending += [self.right[i], self.left[i]]
        self.order = np.concatenate(order) if order else np.zeros(0, np.int64)
        weighted = self.points[self.order] * self.weights[self.order][:, None]
        sums = np.concatenate([np.zeros((1, dims), weighted.dtype), np.cumsum(weighted, axis=0)])
        counts = np.concatenate([[0], np.cumsum(self.weights[self.order])])
        self.total, self.count = sums[self.high] - sums[self.low], counts[self.high] - counts[self.low]
        del self.nodes

    def owners(self, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(nodes, entry of each) of wholly owned balls with no third, or (-1s, entry of each, points) at leaves."""
        if self.root < 0:
            return
        z = entries.astype(np.float64)
        apart = np.sqrt(((z[:, None] - z[None]) ** 2).sum(axis=2))
        nodes, mask = np.array([self.root]), np.ones((1, len(z)), bool)
        while len(nodes):
            far = ((self.centre[nodes][:, None] - z[None]) ** 2).sum(axis=2)
            best = np.where(mask, far, np.inf).argmin(axis=1)
            row = np.arange(len(nodes))
            nearest = far[row, best][:, None]
            # |x - z|^2 - |x - best|^2 over the ball is at least this, by Cauchy and Schwarz
            lead = far - nearest - 2 * self.radius[nodes][:, None] * apart[best]
            mask = mask & (lead <= 1e-9 * (far + nearest) + 1e-3)
            mask[row, best] = True
            alone, leaf = mask.sum(axis=1) == 1, self.left[nodes] < 0
            yield nodes[alone], best[alone], np.zeros(0, np.int64)
            for left in np.unique(np.packbits(mask[leaf & ~alone], axis=1), axis=0) if (leaf & ~alone).any() else ():
                some = np.unpackbits(left)[: len(z)].astype(bool)
                same = leaf & ~alone & (mask == some).all(axis=1)
                spans = [np.arange(self.low[i], self.high[i]) for i in nodes[same]]
                members, which = self.order[np.concatenate(spans)], np.flatnonzero(some)
                yield np.full(len(members), -1), which[squared(self.points[members], entries[which]).argmin(axis=1)], members
            down = ~alone & ~leaf
            nodes, mask = np.concatenate([self.left[nodes[down]], self.right[nodes[down]]]), np.concatenate([mask[down], mask[down]])

    def sums(self, entries: np.ndarray) -> tuple[list[list[int]], list[int]]:
        """The sum and the count of the points that each entry owns."""
        total, count = np.zeros((len(entries), self.points.shape[1]), self.total.dtype), np.zeros(len(entries), np.int64)
        for nodes, owner, members in self.owners(entries):
            x, n = (self.points[members] * self.weights[members][:, None], self.weights[members]) if len(members) else (self.total[nodes], self.count[nodes])
            np.add.at(total, owner, x)
            np.add.at(count, owner, n)
        return total.tolist(), count.tolist()

    def assigned(self, entries: np.ndarray) -> np.ndarray:
        """The entry of each point."""
        out = np.zeros(len(self.points), np.int64)
        for nodes, owner, members in self.owners(entries):
            if len(members):
                out[members] = owner
            for i, e in zip(nodes if not len(members) else (), owner, strict=False):
                out[self.order[self.low[i] : self.high[i]]] = e
        return out


_ARRAYS = ("centre", "radius", "left", "right", "low", "high", "order", "total", "count", "weights")


def _packed(tree: Tree, member: np.ndarray) -> dict:
    """A tree as a row; integers beyond 64 bits as decimal text."""
    big = tree.points.dtype == object
    plain = lambda a: (",".join(map(str, a.ravel())).encode() if a.dtype == object else np.ascontiguousarray(a).tobytes())
    return {"root": tree.root, "big": big, "points": plain(tree.points), "member": member.astype(np.int64).tobytes()} | {k: plain(getattr(tree, k)) for k in _ARRAYS}


def _unpacked(row: dict, dims: int) -> tuple[Tree, np.ndarray]:
    """The tree of a row, and for each vector of the block its point."""
    tree = Tree.__new__(Tree)
    ints = lambda b: np.array([int(x) for x in b.decode().split(",") if x], dtype=object) if row["big"] else np.frombuffer(b, np.int64)
    for k in _ARRAYS:
        setattr(tree, k, ints(row[k]) if k == "total" else np.frombuffer(row[k], np.float64 if k in ("centre", "radius") else np.int64))
    n = len(tree.weights)
    tree.points = ints(row["points"]).reshape(n, dims)
    tree.total, tree.centre = tree.total.reshape(-1, dims), tree.centre.reshape(-1, dims)
    tree.place, tree.root = tree.points.astype(np.float64), row["root"]
    return tree, np.frombuffer(row["member"], np.int64)


_TREE = pa.struct([("root", pa.int64()), ("big", pa.bool_()), *[(k, pa.binary()) for k in ("points", "member", *_ARRAYS)]])
_TREE_SQL = "struct<root:bigint,big:boolean," + ",".join(f"{k}:binary" for k in ("points", "member", *_ARRAYS)) + ">"


def tree_blocks(kept: DataFrame, dims: int, parts: int) -> DataFrame:
    """(rows, trees): blocks of kept vectors (row, vector), each with its rows and one tree for each part; written."""
    kind = kept.schema["row"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                rows, flat = some.column("row"), some.column("vector").flatten().to_numpy(zero_copy_only=False)
                vectors = whole(flat.reshape(some.num_rows, dims))
                trees = []
                for p in range(parts):
                    mine = vectors[:, p * dims // parts : (p + 1) * dims // parts]
                    if mine.dtype == object:
                        keys = sorted(set(map(tuple, mine)))
                        number = {k: i for i, k in enumerate(keys)}
                        points, member = np.array(keys, dtype=object).reshape(len(keys), -1), np.array([number[tuple(v)] for v in mine])
                    else:
                        points, member = np.unique(mine, axis=0, return_inverse=True) if dims else (mine[:1], np.zeros(len(mine), np.int64))
                    member = member.ravel()
                    trees.append(_packed(Tree(points, np.bincount(member, minlength=len(points))), member))
                yield pa.RecordBatch.from_arrays([pa.array([rows.to_pylist()], pa.list_(rows.type)), pa.array([trees], pa.list_(_TREE))], ["rows", "trees"])

    return written(kept.select("row", "vector").mapInArrow(blocks, f"rows array<{kind}>, trees array<{_TREE_SQL}>"))


def _per_tree(blocks: DataFrame, dims: int, parts: int, books: Codebooks, of: Callable, schema: str) -> DataFrame:
    """of(rows, [(tree, member, entries)]) for each block: lists of columns as the schema has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [np.array(b, dtype=object).reshape(len(b), dims // parts) for b in books]
        entries = [e.astype(np.int64) if max(map(abs, e.ravel()), default=0) < _WIDE else e for e in entries]
        for batch in batches:
            for i in range(batch.num_rows):
                trees = [_unpacked(t.as_py(), dims // parts) for t in batch.column("trees")[i]]
                yield of(batch.column("rows")[i].values, [(t, m, e) for (t, m), e in zip(trees, entries, strict=True)])

    return blocks.mapInArrow(run, schema)


def _means(blocks: DataFrame, dims: int, parts: int, books: Codebooks) -> Codebooks:
    """One round: the codebooks of means. What comes to the driver is one row for each component of an entry."""

    def partial(_: pa.Array, trees: list) -> pa.RecordBatch:
        found: list[tuple[int, int, int, str, int]] = []
        for p, (tree, _, entries) in enumerate(trees):
            total, count = tree.sums(entries)
            found += [(p, e, k, str(x), n) for e, n in enumerate(count) if n for k, x in enumerate(total[e])]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 5, (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64()), strict=True)], ["part", "entry", "position", "total", "n"])

    sums = _per_tree(blocks, dims, parts, books, partial, "part int, entry int, position int, total string, n long")
    rows = sums.groupBy("part", "entry", "position").agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total"), F.sum("n").alias("n")).collect()
    out = [[list(e) for e in b] for b in books]
    for r in rows:
        out[r["part"]][r["entry"]][r["position"]] = int(r["total"]) // r["n"]
    return [[tuple(e) for e in b] for b in out]


def _finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def trained(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks, int]:
    """The blocks of vectors (id, row, vector; row comes back with the codes), the codebooks and the vectors' length."""
    finite = vectors.filter(_finite(F.col("vector")))
    length = finite.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if length is None:
        return finite.select("row").limit(0), [], 0
    dims = length["size"]
    if dims % parts:
        raise ValueError(f"vectors of {dims} components can't be cut into {parts} equal parts")
    kept = finite.filter(F.size("vector") == dims)
    first = [whole(np.array([r["vector"]], dtype=np.float64).reshape(1, dims))[0] for r in kept.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()]
    books = [[tuple(int(x) for x in v[p * dims // parts : (p + 1) * dims // parts]) for v in first] for p in range(parts)]
    blocks = tree_blocks(kept, dims, parts)
    for _ in range(rounds):
        books = _means(blocks, dims, parts, books)
    return blocks, books, dims


def coded(blocks: DataFrame, books: Codebooks, dims: int) -> DataFrame:
    """row, code (two hex digits of the entry for each part) and error (squared distances, summed) of each vector."""
    kind = blocks.schema["rows"].dataType.elementType.simpleString()
    parts = len(books)

    def final(rows: pa.Array, trees: list) -> pa.RecordBatch:
        codes, error = [], 0
        for tree, member, entries in trees:
            owner = tree.assigned(entries)
            a, b = _exact(tree.points, entries[owner])
            codes.append(owner[member])
            error = error + ((a - b) ** 2).sum(axis=1).astype(object)[member]
        hexes = ["".join(f"{c:02x}" for c in v) for v in np.stack(codes, axis=1)]
        return pa.RecordBatch.from_arrays([rows, pa.array(hexes, pa.string()), pa.array([int(x) for x in error], pa.int64())], ["row", "code", "error"])

    return _per_tree(blocks, dims, parts, books, final, f"row {kind}, code string, error long")


def books_sha256(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.struct("vec_id", "label").alias("row"), F.col("embedding").alias("vector"))
    blocks, books, dims = trained(rows)
    if not books:
        none = [F.lit(None).cast(t).alias(n) for n, t in (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))]
        return blocks.select("row.vec_id", *none)
    codes = written(coded(blocks, books, dims).select("row.vec_id", F.col("row.label").alias("label"), "code", "error"))
    same = F.struct(F.col("label").isNull().alias("none"), F.coalesce("label", F.lit(0)).alias("label"))
    by_label = codes.groupBy(same.alias("same")).agg(F.sum("error").alias("label_error"))
    return codes.withColumn("same", same).join(broadcast_if_small(by_label), "same").select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
