"""The shingle join against brute force."""

import random

import pytest

from shipreport.llm import jaccard as J


def words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return out


def brute(docs, k, percent):
    """(doc_id, n_shingles, component_id) of each row, by comparing all pairs."""
    sets, parent = [], {}
    for d, t in docs:
        ws = words(t)
        sets.append({tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)} if len(ws) >= k else ({tuple(ws)} if ws else set()))
        parent.setdefault(d, d)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (d, _) in enumerate(docs):
        for j in range(i):
            e = docs[j][0]
            if d is None or e is None or not sets[i] or not sets[j]:
                continue
            common = len(sets[i] & sets[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return sorted(((d, len(s), None if d is None else root(d)) for (d, _), s in zip(docs, sets)), key=str)


def corpus(seed, families=8, copies=9, sizes=(5, 8, 12, 30, 60)):
    """Families of edited copies, texts that share passages only, and odd rows."""
    rng = random.Random(seed)
    say = lambda n: [f"W{rng.randrange(4000)}" for _ in range(n)]
    passage, docs = say(14), []
    for _ in range(families):
        base = say(rng.choice(sizes))
        for _ in range(rng.randrange(1, copies)):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            docs.append(" ".join(copy))
    docs += [" ".join(say(20) + passage + say(9)) for _ in range(12)]
    docs += [docs[0], docs[1].upper(), docs[2].replace(" ", "\n\t"), "", None, "  ", "one", "ONE", "one two", "one two three four",
             "One Two Three four", "a " * 300, "a " * 12]
    rows = list(enumerate(docs))
    rows += [(3, docs[20]), (None, docs[4]), (None, None), (5, docs[5])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,long,side,near,hot", [(1, 24, 2048, 8 << 20, 1 << 18), (2, 2, 3, 1, 10), (3, 3, 2, 500, 0)])
def test_brute_force(spark, monkeypatch, seed, long, side, near, hot):
    for name, value in (("LONG", long), ("SIDE", side), ("NEAR_BYTES", near), ("ROWS", 64)):
        monkeypatch.setattr(J, name, value)
    monkeypatch.setattr(J.frequent, "__defaults__", (hot,))
    rows = corpus(seed, families=14, copies=14)
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, n int").repartition(4)
    got = sorted(map(tuple, J.near_duplicates(df).collect()), key=str)
    want = brute(rows, 5, 80)
    assert got == want
    assert len({c for *_, c in want}) < len(want) - 20


@pytest.mark.parametrize("rows", [25, 64])
def test_a_list_longer_than_the_rows_of_a_task_loses_no_link(spark, monkeypatch, rows):
    """One key with 30 classes, of which any two are partners: all meet, wherever the list is cut."""
    monkeypatch.setattr(J, "ROWS", rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        for classes in (26, 30, 31, 130):
            listed = [(3, f1, 100) for f1 in range(1, classes + 1)] + [(9, f1, 100) for f1 in (1, 2)]
            found = J._candidates(spark.createDataFrame(listed, "key bigint, f1 bigint, n int"), 80, 4).collect()
            assert {r.a for r in found if r.b is None and r.key == 3} == set(range(1, classes + 1))
            assert [(r.a, r.b) for r in found if r.b is not None] == [(1, 2)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("ids", [0, 1 << 21])
def test_texts_are_fetched_alike_with_and_without_a_broadcast(spark, monkeypatch, ids):
    monkeypatch.setattr(J, "IDS", ids)
    rows = corpus(11, families=10, copies=8)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, J.near_duplicates(df).collect()), key=str) == brute(rows, 5, 80)


def test_very_long_texts(spark):
    rng = random.Random(3)
    say = [f"w{rng.randrange(10**6)}" for _ in range(300_000)]
    near = list(say)
    for i in range(0, len(near), 100):
        near[i] = "changed"
    rows = [(1, " ".join(say)), (2, " ".join(near)), (3, " ".join(say[:200_000])), (4, "short text of only seven words here")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, J.near_duplicates(df).collect()), key=str) == brute(rows, 5, 80)


def test_light_and_heavy_sets_meet_at_the_boundary(spark, monkeypatch):
    monkeypatch.setattr(J, "boundary", lambda *a: 30)
    rows = corpus(9, families=40, copies=6, sizes=(26, 30, 33, 35, 38, 42))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, J.near_duplicates(df).collect()), key=str) == brute(rows, 5, 80)


def test_one_of_each_keeps_columns_and_clean_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(2, text, "b"), (1, text, "a"), (3, "other words altogether", "c"), (None, text, "d"), (4, None, "e")],
                               "doc_id bigint, text string, component_id string")
    out = J.one_of_each(df)
    assert out.columns == df.columns and sorted((r.doc_id is None, r.doc_id, r.component_id) for r in out.collect() if r.doc_id) == [
        (False, 1, "a"), (False, 3, "c"), (False, 4, "e")]
    assert out.count() == 4


def test_empty_table(spark):
    assert J.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_boundary_follows_the_cost():
    few, many = J.boundary({n: 10 for n in range(5, 200)}, 0.5, 80), J.boundary({n: 10 for n in range(5, 200)}, 50.0, 80)
    assert 4 <= few < many <= 128


def test_a_square_gives_a_spanning_forest_of_its_candidates():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 120).astype(np.uint64)
    sets = []
    for i in range(40):
        s = base.copy() if i % 2 else base[::-1] + np.uint64(7)
        s[rng.integers(0, 120, 9)] = rng.integers(0, 2**63, 9)
        sets.append(np.unique(s))
    bits = []
    for s in sets:
        flips = np.bincount((J.mix(s, 60) & np.uint64(255)).astype(np.int64), minlength=256) & 1
        bits.append(np.packbits(flips.astype(np.uint8)).tobytes())
    for own in (np.zeros(40, int), np.repeat([0, 1], 20)):
        table = pa.table({"n": [len(s) for s in sets], "bits": pa.array(bits, pa.binary()), "root": list(range(40)),
                          "own": own, "i": [0] * 40, "j": [int(own.max())] * 40, "key": [0] * 40})
        square = J._Square(table, 80, 4)
        every, forest = square.apart(), square.forest()
        links = lambda pairs: _groups(40, [(x, y) for x, y, _ in pairs])
        assert links(every) == links(forest) and len(forest) == 40 - len(set(links(every)))


def _groups(n, pairs):
    at = list(range(n))
    for x, y in pairs:
        a, b = at[x], at[y]
        at = [min(a, b) if g in (a, b) else g for g in at]
    return at
