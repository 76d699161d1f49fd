"""Near-duplicate vectors and components against brute force."""

import math
import random

import numpy as np
import pytest

from shipreport.llm import components as C
from shipreport.llm import embeddings as E


def brute(rows, threshold):
    def sound(r):
        v = r[1]
        return (r[0] is not None and r[2] is not None and v and all(x is not None and math.isfinite(x) for x in v)
                and any(x != 0 for x in v))

    links, parent = {}, {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(rows):
        links[i] = 0
        for j, b in enumerate(rows):
            if i == j or not sound(a) or not sound(b) or a[2] != b[2] or len(a[1]) != len(b[1]):
                continue
            x, y = np.array(a[1], np.float64), np.array(b[1], np.float64)
            if x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                links[i] += 1
                low, high = sorted((root(a[0]), root(b[0])))
                parent[high] = low
    return sorted(((r[0], links[i], None if r[0] is None else root(r[0]),
                    None if r[0] is None else root(r[0]) == r[0]) for i, r in enumerate(rows)), key=str)


def table(seed, n=120):
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for label in (1, 2, 3):
        centre = rng.standard_normal((6, 16))
        for i in range(n // 3):
            v = centre[i % 6] + rng.standard_normal(16) * (0.12 if i % 2 else 0.9)
            rows.append((at, [float(np.float32(x)) for x in v], label))
            at += 1
    rows += [(200 + i, rows[i][1], rows[i][2]) for i in range(4)] + [(300 + i, rows[0][1], 1) for i in range(5)]
    rows += [(400, rows[0][1], 2), (401, rows[0][1], None), (402, None, 1), (403, [0.0] * 16, 1), (404, [], 1),
             (405, [float("nan")] + [1.0] * 15, 1), (406, [float("inf")] + [1.0] * 15, 1), (407, [None] + [1.0] * 15, 1),
             (408, [1.0, 2.0], 1), (409, [2.0, 4.0], 1), (410, [-0.0, 1.0], 1), (411, [0.0, 1.0], 1), (None, rows[0][1], 1)]
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,width,block,side", [(1, 64, 2048, 512), (2, 40, 50, 3)])
def test_brute_force(spark, seed, width, block, side):
    rows = table(seed)
    df = spark.createDataFrame([(a, b, c, True) for a, b, c in rows],
                               "vec_id bigint, embedding array<float>, label int, kept boolean").repartition(4)
    got = E.near_duplicates(df, 0.93, width=width, block=block, side=side, miss=1e-5)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 0.93)


def test_recall_on_vectors_at_the_threshold(spark):
    """Isolated pairs just above the threshold, among many others, with windows that are short for them."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        a, b = rng.standard_normal((2, 32))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist(), 1), (2 * i + 1, (0.94 * a + math.sqrt(1 - 0.94 ** 2) * b).tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = E.near_duplicates(df, width=16).collect()
    assert all(r.n_links <= 1 for r in found) and sum(r.n_links for r in found) >= 0.98 * len(rows)


def off_centre(n, pairs, cosine, dims=32, seed=5):
    """Vectors with this mean cosine to each other, and isolated pairs at 0.935 among them."""
    rng = np.random.default_rng(seed)
    common = np.zeros(dims)
    common[0] = math.sqrt(cosine)

    def free():
        x = rng.standard_normal(dims)
        x[0] = 0
        return x / np.linalg.norm(x)

    out = [common + math.sqrt(1 - cosine) * free() for _ in range(n)]
    inner = (0.935 - cosine) / (1 - cosine)
    for _ in range(pairs):
        a, b = free(), free()
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        out += [common + math.sqrt(1 - cosine) * a, common + math.sqrt(1 - cosine) * (inner * a + math.sqrt(1 - inner ** 2) * b)]
    return np.array(out)


def links_of(found):
    return {(r.component_id, r.vec_id) for r in found if r.component_id != r.vec_id}


@pytest.mark.parametrize("most", [E.MOST, 4])
def test_recall_on_vectors_with_a_common_mean(spark, monkeypatch, most):
    """Far from the origin, with windows that are short for the group, and when the measured density may ask for little."""
    monkeypatch.setattr(E, "AT_ONCE", 24)
    n, pairs = 2000, 200
    v = off_centre(n, pairs, 0.7)
    df = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "vec_id bigint, embedding array<double>, label int")
    found = links_of(E.near_duplicates(df.repartition(4), width=16, most=most).collect())
    planted = {(n + 2 * i, n + 2 * i + 1) for i in range(pairs)}
    assert len(planted & found) >= 0.99 * pairs


def test_copies_of_a_mean(spark, monkeypatch):
    monkeypatch.setattr(E, "SERVED", 7)
    rows = table(3)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(4)
    assert sorted(map(tuple, E.near_duplicates(df, 0.93).collect()), key=str) == brute(rows, 0.93)


def test_more_rows_need_more_passes():
    assert E.passes_for(100, 0.93, 64, 0.003) < E.passes_for(10_000, 0.93, 64, 0.003) < E.passes_for(10**6, 0.93, 64, 0.003)


def test_empty_table(spark):
    assert E.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


@pytest.mark.parametrize("chunk", [500_000, 7])
def test_components(spark, monkeypatch, chunk):
    monkeypatch.setattr(C, "CHUNK", chunk)
    rng = random.Random(chunk)
    links = [(i, i + 1) for i in range(60)]  # a chain
    links += [(1000, 900 + i) for i in range(50)] + [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)]
    links += [(5, 5), (None, 3), (7, None), (1, 0), (0, 1)]
    rng.shuffle(links)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    got = C.components(spark.createDataFrame(links, "a bigint, b bigint").repartition(6)).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in parent if root(x) != x)


def test_components_of_nothing(spark):
    assert C.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
