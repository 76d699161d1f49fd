"""Hard-negative mining over an R-tree packed by sort-tile-recursive.

Points are integer vectors with a label; the score of two points is their inner product. An
anchor's positives are its best other points of the same label; the hard negatives of a
positive are the best points of other labels whose score lies in a window below the
positive's: ``low * positive <= 100 * negative <= 100 * positive``.

1. **Index.** Spark range-partitions the points by (length, label, the coordinate that varies
   most, id) with sampled bounds and sorts each partition. Runs of ``TILE`` points become one
   row: inside, the points are sorted by one coordinate after the other, the widest first, cut
   into equal slabs each time, down to leaves of ``LEAF`` points. Label and id are part of the
   range key, so neither a hot label nor a vector that a third of the rows repeat lands in one task.
2. **Boxes.** Every node has its minimum bounding box. With an anchor ``a`` a box gives an
   interval for each coordinate's product, and their sum bounds all inner products inside:
   ``sum(min(a*lo, a*hi))`` to ``sum(max(a*lo, a*hi))``.
3. **Search.** A best-first queue takes the node with the highest upper bound. A node goes if
   its labels do not fit, its interval misses every score window, or its upper bound lies
   strictly below the k-th best score found; an equal bound stays, as ties go to smaller ids.
   An anchor first searches its own tile, which gives a bound for all others.
4. **Merge.** Each task keeps k candidates an anchor (and positive) over all its tiles; Spark
   ranks them.

Anchors are a stated query set and meet all tiles in passes: a pass broadcasts at most about
``PASS_BYTES`` of anchors, so the size of what is broadcast does not grow with the data, and
the index is read once a pass.

Rows with a NULL id, label or vector, an empty vector, or a component that is NULL, not finite
or beyond ``LIMIT`` take no part. Vectors of different lengths have no score together. A
point's copies (rows with its id) count once, with the best score that fits, and never with
themselves; of an anchor's copies the least (label, vector) mines. Further columns are ignored.
An anchor without positives, or a positive without negatives, gives no row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipreport.llm.common import kept, partitions

#: Points in a tile, points in a leaf, and children of an inner node.
TILE, LEAF, FAN = 4096, 64, 8
#: Bytes of anchors' vectors that one pass broadcasts.
PASS_BYTES = 8 << 20
#: Larger components could carry an inner product beyond 64 bits.
LIMIT = 1 << 27

_POINT = "dim int, vec_id bigint, label bigint, vector binary"
_ANCHOR = _POINT + ", least bigint"


def points(rows: DataFrame, vec_id: str = "vec_id", label: Column | str = "label", vector: Column | str = "vector") -> DataFrame:
    """The rows that take part, as (dim, vec_id, label, vector of little-endian 32-bit integers)."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    found = rows.select(F.col(vec_id).cast("long").alias("vec_id"), as_column(label).cast("long").alias("label"),
                        as_column(vector).cast("array<double>").alias("v"))
    fits = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= float(LIMIT)))
    found = found.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
                        & (F.size("v") > 0) & F.coalesce(fits, F.lit(False)))
    found = found.select("vec_id", "label", F.transform("v", lambda x: x.cast("int")).alias("v"))

    def run(batches):
        for batch in batches:
            v = batch.column("v")
            sizes, start = np.diff(v.offsets.to_numpy()), v.offsets[0].as_py()
            raw = v.values.to_numpy()[start:].astype("<i4").tobytes()
            ends = np.cumsum(sizes) * 4
            cut = [raw[e - 4 * s:e] for e, s in zip(ends.tolist(), sizes.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes, pa.int32()), batch.column("vec_id"), batch.column("label"), pa.array(cut, pa.binary())],
                names=["dim", "vec_id", "label", "vector"])

    return found.mapInArrow(run, _POINT)


def _matrix(raw: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<i4").reshape(len(raw), dim).astype(np.int64)


def _spreads(rows: DataFrame) -> DataFrame:
    """The coordinate that varies most, for each length of vector: (dim, lead)."""
    def run(batches):
        sums: dict[int, list] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            raw = batch.column("vector").to_pylist()
            for dim in np.unique(dims).tolist():
                m = _matrix([raw[i] for i in np.flatnonzero(dims == dim).tolist()], dim).astype(float)
                old = sums.setdefault(dim, [0, np.zeros(dim), np.zeros(dim)])
                old[0] += len(m)
                old[1] += m.sum(axis=0)
                old[2] += (m * m).sum(axis=0)
        for dim, (n, one, two) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([float(n)] * dim),
                 pa.array(one), pa.array(two)], names=["dim", "place", "n", "one", "two"])

    parts = rows.mapInArrow(run, "dim int, place int, n double, one double, two double")
    spread = parts.groupBy("dim", "place").agg(
        (F.sum("two") / F.sum("n") - F.pow(F.sum("one") / F.sum("n"), 2)).alias("spread"))
    return spread.groupBy("dim").agg(F.max_by("place", F.struct("spread", -F.col("place"))).alias("lead"))


def _tiled(v: np.ndarray, order: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """``order`` by sort-tile-recursive: sorted by the widest coordinate, cut into slabs, and on."""
    leaves = -(-len(order) // LEAF)
    if leaves <= 1 or not len(spread):
        return order
    slabs = max(int(np.ceil(leaves ** (1 / min(len(spread), 3)))), 2)
    order = order[np.argsort(v[order, spread[0]], kind="stable")]
    step = LEAF * -(-leaves // slabs)
    return np.concatenate([_tiled(v, order[i:i + step], spread[1:]) for i in range(0, len(order), step)])


def index(rows: DataFrame) -> DataFrame:
    """Packed tiles of ``points``: (dim, ids, labels, vectors), each binary, in the order of their leaves."""
    def leading(batches):
        for batch in batches:
            at = batch.column("lead").to_pylist()
            raw = batch.column("vector").to_pylist()
            x = [int(np.frombuffer(r, "<i4")[i]) for r, i in zip(raw, at)]
            yield batch.drop_columns(["lead"]).append_column("x", pa.array(x, pa.int32()))

    def pack(batches):
        held, n, last = [], 0, None
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(dims)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and dims[a] != last:
                    yield tile(held, last)
                    held, n = [], 0
                last = int(dims[a])
                while a < b:
                    part = batch.slice(a, min(b - a, TILE - n))
                    held.append(part)
                    n, a = n + part.num_rows, a + part.num_rows
                    if n == TILE:
                        yield tile(held, last)
                        held, n = [], 0
        if held:
            yield tile(held, last)

    def tile(held, dim):
        table = pa.Table.from_batches(held)
        v = _matrix(table.column("vector").to_pylist(), dim)
        spread = np.argsort(-v.var(axis=0), kind="stable")[:3]
        order = _tiled(v, np.arange(len(v)), spread)
        packed = [v[order].astype("<i4")] + [table.column(c).to_numpy()[order].astype("<i8") for c in ("vec_id", "label")]
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)],
            names=["dim", "vectors", "ids", "labels"])

    # One row for each length of vector: broadcast only if Catalyst finds it small.
    led = rows.join(_spreads(rows), "dim").mapInArrow(leading, _POINT + ", x int")
    keys = ["dim", "label", "x", "vec_id"]
    dealt = led.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    return kept(dealt.drop("x").mapInArrow(pack, "dim int, vectors binary, ids binary, labels binary"))


class Tree:
    """One tile's points and the boxes over them, leaves first, the root last."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.vectors, self.ids, self.labels = vectors, ids, labels
        starts = np.arange(0, len(ids), LEAF)
        low, high = np.minimum.reduceat(vectors, starts), np.maximum.reduceat(vectors, starts)
        first, last = np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts)
        levels, self.children, self.n_leaves = [(low, high, first, last)], [], len(starts)
        offset = 0
        while len(low) > 1:
            heads = np.arange(0, len(low), FAN)
            self.children += [(offset + int(h), offset + min(int(h) + FAN, len(low))) for h in heads]
            offset += len(low)
            low, high = np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)
            first, last = np.minimum.reduceat(first, heads), np.maximum.reduceat(last, heads)
            levels.append((low, high, first, last))
        self.low, self.high, self.first, self.last = (np.concatenate(x) for x in zip(*levels))
        # Products of large components are exact in 64-bit integers only.
        top = int(np.abs(vectors).max()) if len(ids) else 0
        self.top, self.dim = top, vectors.shape[1]
        self.floats = None

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor and node: the least and the greatest inner product the box allows."""
        exact = int(np.abs(anchors).max(initial=0)) * self.top * self.dim < 1 << 53
        kind = np.float64 if exact else np.int64
        up, down = np.maximum(anchors, 0).astype(kind), np.minimum(anchors, 0).astype(kind)
        low, high = self.low.T.astype(kind), self.high.T.astype(kind)
        return (up @ low + down @ high).astype(np.int64), (up @ high + down @ low).astype(np.int64)

    def leaf(self, node: int, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores, ids and labels of the points of a leaf."""
        a, b = node * LEAF, min(node * LEAF + LEAF, len(self.ids))
        return self.vectors[a:b] @ anchor, self.ids[a:b], self.labels[a:b]


class Best:
    """The ``k`` best distinct ids so far, by score and then the smaller id."""

    def __init__(self, k: int, least: int | None = None):
        self.k, self.found, self.least = k, [], least

    def bound(self) -> int | None:
        """Scores strictly below this are of no use."""
        if len(self.found) < self.k:
            return self.least
        kth = -self.found[-1][0]
        return kth if self.least is None else max(kth, self.least)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(ids):
            return
        out, seen = [], set()
        # Ties beyond the k-th place count, as does an id that comes twice, so all are sorted.
        for i in np.lexsort((ids, -scores)).tolist():
            item = (-int(scores[i]), int(ids[i]))
            if item[1] not in seen:
                seen.add(item[1])
                out.append(item)
                if len(out) == self.k:
                    break
        merged, seen = [], set()
        for item in heapq.merge(self.found, out):
            if item[1] not in seen:
                seen.add(item[1])
                merged.append(item)
                if len(merged) == self.k:
                    break
        self.found = merged


def search(tree: Tree, anchor: np.ndarray, own: int, label: int, same: bool, windows: list[tuple[int | None, int | None]],
           best: list[Best], low: np.ndarray, high: np.ndarray) -> None:
    """Take the tile's points into ``best``, one list for each window of scores, by a best-first queue.

    ``same`` asks for points of the anchor's label, otherwise of all others. ``low`` and
    ``high`` are the anchor's bounds for each node. A window (None, None) is open.
    """
    if same:
        possible = (tree.first <= label) & (tree.last >= label)
    else:
        possible = (tree.first != label) | (tree.last != label)
    root = len(tree.low) - 1
    highs, lows = high.tolist(), low.tolist()

    def useful(node):
        for (least, most), b in zip(windows, best):
            bound = b.bound()
            if ((least is None or highs[node] >= least) and (most is None or lows[node] <= most)
                    and (bound is None or highs[node] >= bound)):
                return True
        return False

    queue = [(-highs[root], root)] if possible[root] else []
    while queue:
        _, node = heapq.heappop(queue)
        if not useful(node):
            continue
        if node >= tree.n_leaves:
            a, b = tree.children[node - tree.n_leaves]
            for child in range(a, b):
                if possible[child] and useful(child):
                    heapq.heappush(queue, (-highs[child], child))
            continue
        scores, ids, labels = tree.leaf(node, anchor)
        fits = ((labels == label) if same else (labels != label)) & (ids != own)
        for (least, most), b in zip(windows, best):
            chosen, bound = fits, b.bound()
            floor = least if bound is None else bound if least is None else max(bound, least)
            if floor is not None:
                chosen = chosen & (scores >= floor)
            if most is not None:
                chosen = chosen & (scores <= most)
            at = np.flatnonzero(chosen)
            b.add(scores[at], ids[at])


def _trees(batches) -> Iterator[Tree]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
            yield Tree(np.frombuffer(row["vectors"], "<i4").reshape(len(ids), row["dim"]).astype(np.int64), ids, labels)


def _anchors(tiles: DataFrame, every: int, k: int) -> DataFrame:
    """Points whose id ``every`` divides, with the k-th best score of their label in their own tile."""
    def run(batches):
        for tree in _trees(batches):
            at = np.flatnonzero(tree.ids % every == 0)
            if not len(at):
                continue
            lows, highs = tree.bounds(tree.vectors[at])
            least = []
            for i, low, high in zip(at.tolist(), lows, highs):
                best = Best(k)
                search(tree, tree.vectors[i], tree.ids[i], tree.labels[i], True, [(None, None)], [best], low, high)
                least.append(best.bound())
            raw = [tree.vectors[i].astype("<i4").tobytes() for i in at.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree.dim] * len(at), pa.int32()), pa.array(tree.ids[at]), pa.array(tree.labels[at]),
                 pa.array(raw, pa.binary()), pa.array(least, pa.int64())],
                names=["dim", "vec_id", "label", "vector", "least"])

    found = tiles.mapInArrow(run, _ANCHOR)
    one = found.groupBy("vec_id").agg(F.min(F.struct("label", "dim", "vector", "least")).alias("one"))
    return kept(one.select("one.dim", "vec_id", "one.label", "one.vector", "one.least"))


def _in_passes(tiles: DataFrame, queries: DataFrame, find, schema: str) -> DataFrame:
    """``find(trees, anchors)`` over all tiles, for the anchors of one bounded pass after the other."""
    spark = tiles.sparkSession
    size = queries.agg(F.sum(F.col("dim") * 4 + 64)).first()[0] or 0
    n, out = -(-size // PASS_BYTES) or 1, None
    for number in range(n):
        mine = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == number)
        shared = spark.sparkContext.broadcast(mine.toArrow())

        def run(batches, shared=shared):
            yield from find(_trees(batches), shared.value)

        part = kept(tiles.mapInArrow(run, schema))
        shared.unpersist()
        out = part if out is None else out.unionByName(part)
    return out


def _by_dim(anchors: pa.Table) -> dict[int, tuple]:
    out = {}
    dims = anchors.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        part = anchors.take(pa.array(at))
        out[dim] = (part, _matrix(part.column("vector").to_pylist(), dim),
                    part.column("vec_id").to_pylist(), part.column("label").to_pylist())
    return out


def _found(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _ranked(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of each group. A group has at most k rows a task."""
    once = rows.groupBy(*keys, "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("id"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives(tiles: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """(anchor_id, id, score, rank): each anchor's best other points of its label."""
    def find(trees, table):
        groups = _by_dim(table)
        best = {dim: [Best(k, x) for x in part[0].column("least").to_pylist()] for dim, part in groups.items()}
        for tree in trees:
            if tree.dim not in groups:
                continue
            _, vectors, ids, labels = groups[tree.dim]
            lows, highs = tree.bounds(vectors)
            for i, own in enumerate(ids):
                search(tree, vectors[i], own, labels[i], True, [(None, None)], [best[tree.dim][i]], lows[i], highs[i])
        for dim, lists in best.items():
            yield _found([(own, i, -s) for own, b in zip(groups[dim][2], lists) for s, i in b.found],
                         ["anchor_id", "id", "score"])

    found = _in_passes(tiles, anchors, find, "anchor_id bigint, id bigint, score bigint")
    return _ranked(found, ["anchor_id"], k)


def negatives(tiles: DataFrame, anchors: DataFrame, chosen: DataFrame, k: int, low: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score, id, score, rank): the hard negatives of each chosen positive."""
    def find(trees, table):
        groups = _by_dim(table)
        state = {}
        for dim, (part, _, _, _) in groups.items():
            pos = [[p for p in x if p["score"] >= 0] for x in part.column("positives").to_pylist()]
            state[dim] = ([[(-(-low * p["score"] // 100), p["score"]) for p in x] for x in pos],
                          [[Best(k) for _ in x] for x in pos], pos)
        for tree in trees:
            if tree.dim not in groups:
                continue
            _, vectors, ids, labels = groups[tree.dim]
            windows, best, _ = state[tree.dim]
            lows, highs = tree.bounds(vectors)
            for i, own in enumerate(ids):
                if windows[i]:
                    search(tree, vectors[i], own, labels[i], False, windows[i], best[i], lows[i], highs[i])
        for dim, (_, best, pos) in state.items():
            yield _found([(own, p["id"], p["score"], i, -s) for own, x, y in zip(groups[dim][2], pos, best)
                          for p, b in zip(x, y) for s, i in b.found],
                         ["anchor_id", "positive_id", "positive_score", "id", "score"])

    lists = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("id", "score"))).alias("positives"))
    found = _in_passes(tiles, kept(anchors.drop("least").join(lists, "vec_id")), find,
                       "anchor_id bigint, positive_id bigint, positive_score bigint, id bigint, score bigint")
    return _ranked(found, ["anchor_id", "positive_id", "positive_score"], k)


def mined(rows: DataFrame, every: int = 100, n_positives: int = 5, n_negatives: int = 5, low: int = 80) -> DataFrame:
    """The hard negatives of all anchors, from ``points`` rows.

    anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score. A
    positive with a score below 0 has an empty window. ``low`` is the window's lower end, in
    hundredths of the positive's score.
    """
    tiles = index(rows)
    anchors = _anchors(tiles, every, n_positives)
    chosen = positives(tiles, anchors, n_positives)
    found = negatives(tiles, anchors, chosen, n_negatives, low)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                        "positive_score", F.col("score").alias("negative_score"))


def digest(embeddings: DataFrame) -> DataFrame:
    """The query: labels of every seventh id moved on by one, components in 256ths."""
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    vector = F.expr("transform(embedding, x -> floor(256 * CAST(x AS DOUBLE)))")
    fits = F.expr(f"forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(CAST(x AS DOUBLE)) <= {LIMIT // 256})")
    return mined(points(embeddings.where(F.coalesce(fits, F.lit(False))), "vec_id", label, vector))
