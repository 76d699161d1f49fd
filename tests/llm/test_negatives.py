"""Hard negatives against brute force: ties, copies, odd rows, several passes, and that boxes prune."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shipreport.llm import negatives

SCHEMA = "vec_id bigint, label bigint, vector array<double>, note string"


def brute(rows, every, n_pos, n_neg, low):
    """By id: the best score of each other id, as plain loops."""
    kept = [r for r in rows if None not in r[:3] and len(r[2]) and all(
        x is not None and np.isfinite(x) and abs(x) <= negatives.LIMIT for x in r[2])]
    out, anchors = set(), {}
    for i, label, v, *_ in kept:
        if i % every == 0:
            # Vectors are compared as their little-endian bytes.
            key = (label, len(v), np.array(v, "<i4").tobytes())
            if i not in anchors or key < anchors[i][0]:
                anchors[i] = (key, label, v)
    for a, (_, label, v) in anchors.items():
        score = [(sum(int(x) * int(y) for x, y in zip(v, w)), i, m) for i, m, w, *_ in kept if i != a and len(w) == len(v)]

        def best(fits, k):
            top = {}
            for s, i, m in score:
                if fits(s, m):
                    top[i] = max(s, top.get(i, s))
            return sorted(((-s, i) for i, s in top.items()))[:k]

        for minus, p in best(lambda s, m: m == label, n_pos):
            chosen = best(lambda s, m: m != label and low * -minus <= 100 * s <= 100 * -minus, n_neg)
            out |= {(a, p, rank + 1, i, -minus, -s) for rank, (s, i) in enumerate(chosen)}
    return out


def mined(spark, rows, partitions=None, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    if partitions:
        df = df.repartition(partitions)
    return {tuple(r) for r in negatives.mined(negatives.points(df), **options).collect()}


def points(n, dim, labels, seed, span=6):
    r = np.random.default_rng(seed)
    centres = r.integers(-span, span + 1, (labels, dim))
    rows = []
    for i in range(n):
        c = int(r.integers(labels))
        rows.append((i, int(r.integers(labels)) if i % 3 == 0 else c, (centres[c] + r.integers(-2, 3, dim)).astype(float).tolist(), "x"))
    return rows


@pytest.mark.parametrize("dim, tile, leaf, fan", [(1, 16, 2, 2), (3, 64, 4, 3), (8, 4096, 64, 8)])
def test_like_brute_force(spark, monkeypatch, dim, tile, leaf, fan):
    for name, value in (("TILE", tile), ("LEAF", leaf), ("FAN", fan)):
        monkeypatch.setattr(negatives, name, value)
    rows = points(700, dim, 4, dim)
    assert mined(spark, rows, every=20, n_positives=4, n_negatives=3, low=80) == brute(rows, 20, 4, 3, 80) != set()


def test_odd_rows(spark):
    rows = points(60, 2, 2, 1)
    rows += [(None, 1, [1.0, 2.0], ""), (100, None, [1.0, 2.0], ""), (101, 1, None, ""), (102, 1, [], ""), (103, 1, [1.0, None], ""),
             (104, 1, [float("nan"), 1.0], ""), (105, 0, [float("inf"), 1.0], ""), (106, 0, [1e300, 1.0], ""),
             (120, 1, [3.0, 4.0, 5.0], ""), (121, 1, [3.0, 4.0, 6.0], ""), (122, 0, [3.0, 4.0, 5.0], ""),  # another length
             (20, 1, [5.0, 5.0], ""), (20, 0, [4.0, 5.0], ""), (21, 1, [5.0, 5.0], "")]  # ids that come twice
    rows += rows[:10]  # repeated rows
    rows += [(200, 0, [2.0**26, -2.0**26], ""), (201, 1, [2.0**26, -2.0**26 + 1], ""), (202, 0, [2.0**26, -2.0**26 - 1], "")]
    assert mined(spark, rows, every=20, n_positives=3, n_negatives=4, low=80) == brute(rows, 20, 3, 4, 80) != set()
    assert mined(spark, []) == set()
    assert mined(spark, [(1, 1, [1.0], "")]) == set()


def test_hot_vector_and_passes(spark, monkeypatch):
    """A third of all rows are one vector of one label; anchors come in many passes."""
    monkeypatch.setattr(negatives, "PASS_BYTES", 256)
    monkeypatch.setattr(negatives, "TILE", 32)
    rows = points(300, 4, 3, 5) + [(1000 + i, 1, [3.0, 3.0, 3.0, 3.0], "") for i in range(150)]
    assert mined(spark, rows, 7, every=25, n_positives=5, n_negatives=5, low=80) == brute(rows, 25, 5, 5, 80)


def test_boxes_bound_and_prune():
    r = np.random.default_rng(2)
    v = np.concatenate([r.integers(-3, 4, (512, 6)) + 40 * r.integers(-1, 2, 6) for _ in range(8)]).astype(np.int64)
    order = negatives._tiled(v, np.arange(len(v)), np.argsort(-v.var(axis=0))[:3])
    assert sorted(order.tolist()) == list(range(len(v)))
    tree = negatives.Tree(v[order], np.arange(len(v)), np.zeros(len(v), np.int64))
    a = v[7]
    low, high = (x[0] for x in tree.bounds(a[None]))
    seen = []
    leaf = tree.leaf
    for node in range(tree.n_leaves):
        s = leaf(node, a)[0]
        assert low[node] <= s.min() and s.max() <= high[node]
    tree.leaf = lambda node, anchor: seen.append(node) or leaf(node, anchor)
    best = negatives.Best(5)
    negatives.search(tree, a, -1, 0, True, [(None, None)], [best], low, high)
    assert len(seen) < tree.n_leaves // 2
    want = sorted(zip((-(v[order] @ a)).tolist(), range(len(v))))[:5]
    assert best.found == want


def test_digest_moves_labels(spark):
    rows = [(0, [1.0, 0.5], 9, "a"), (7, [0.9, 0.5], 9, "b"), (1, [0.9, 0.4], 0, "c"), (2, [0.95, 0.4], 1, "d")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, score string")
    got = {tuple(r) for r in negatives.digest(df).collect()}
    q = {i: [int(np.floor(256 * np.float64(np.float32(x)))) for x in v] for i, v, _, _ in rows}
    dot = lambda a, b: sum(x * y for x, y in zip(q[a], q[b]))
    # 0 and 7 move on to label 0, where 1 is; 2 is the only one of another label.
    want = {(0, p, 1, 2, dot(0, p), dot(0, 2)) for p in (1, 7) if 80 * dot(0, p) <= 100 * dot(0, 2) <= 100 * dot(0, p)}
    assert got == want
    assert negatives.points(df.withColumn("v", F.lit(None).cast("array<double>")), vector="v").count() == 0
