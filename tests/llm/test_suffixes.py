"""Substring dedup over bytes against brute force, with small blocks so that all boundaries are met."""

import hashlib
import random

import numpy as np
import pytest

from shipreport.llm import suffixes


def brute(rows, window):
    """rows of (doc_id, text); rows that repeat an id with another text are different documents."""
    of = {}
    for doc, text in {(d, t) for d, t in rows if d is not None and t is not None}:
        raw = text.encode()
        for p in range(len(raw) - window + 1):
            of.setdefault(raw[p:p + window], []).append((doc, text, p))
    late = set()
    for places in of.values():
        least = min(d for d, _, _ in places)
        late |= {(d, t, p) for d, t, p in places if d > least or any(x[:2] == (d, t) and x[2] < p for x in places)}
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        if doc is not None:
            for p in range(len(raw) - window + 1):
                if (doc, text, p) in late:
                    gone[p:p + window] = True
        spans = int((np.diff(gone.astype(int)) == 1).sum()) + int(gone[0])
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


def digest(spark, rows, window, partitions=3):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id bigint, text string, kept string").repartition(partitions)
    out = suffixes.parsed(df, window)
    assert out.columns == ["doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept", "spans"]
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in out.withColumn("sha", F.sha2("kept", 256)).collect()), key=repr)


def random_rows(seed, n, alphabet, pool_size):
    r = random.Random(seed)
    pool = ["".join(r.choice(alphabet) for _ in range(r.randrange(3, 60))) for _ in range(pool_size)]
    rows = [(r.randrange(n), "".join(r.choice(pool) for _ in range(r.randrange(0, 8)))) for _ in range(n)]
    return rows + [(None, rows[0][1]), (None, None), (5, None), (6, ""), rows[1], rows[1]]


@pytest.mark.parametrize("window, block", [(100, 1 << 20), (20, 1 << 20), (20, 300), (30, 3000), (5, 200)])
def test_like_brute_force(spark, monkeypatch, window, block):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", block)
    for seed, alphabet in ((1, "ab"), (2, "abcdefgh é漢")):
        rows = random_rows(seed, 50, alphabet, 30)
        assert digest(spark, rows, window) == brute(rows, window)


def test_texts_that_repeat_themselves(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "LONGEST", 16)
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 2000)
    rows = [(3, "a" * 700), (1, "ab" * 150), (2, "xyz" * 120 + "ab" * 90), (4, "-" * 99), (5, "-" * 100), (6, "-" * 101)]
    assert digest(spark, rows, 100) == brute(rows, 100)


def test_hot_passage(spark, monkeypatch):
    """A passage shorter than a window, one longer, and a copy, each in most documents."""
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 4000)
    r = random.Random(4)
    word = lambda n: "".join(r.choice("abcdefghij klmnop") for _ in range(n))
    line, passage, copy = word(80), word(180), word(300)
    rows = [(i, copy if i % 3 == 0 else word(90) + (line if i % 3 == 1 else passage) + word(90)) for i in range(150)]
    assert digest(spark, rows, 100, 8) == brute(rows, 100)


def test_long_text_spans_and_empty_table(spark):
    r = random.Random(5)
    long = "".join(r.choice("abcdefgh ") for _ in range(400_000))
    rows = [(1, long), (2, long[5000:250_000]), (3, "q" + long[300_000:300_150] + "é")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {x.doc_id: x for x in suffixes.parsed(df).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed == 245_000 and got[2].kept == b""
    assert [tuple(s) for s in got[3].spans] == [(1, 150)] and got[3].kept == "qé".encode()
    assert not suffixes.digest(df.limit(0)).collect()


def test_multikey():
    r = np.random.default_rng(1)
    data = bytes(r.integers(97, 99, 400, dtype=np.uint8))
    starts, lengths = r.integers(0, 370, 300), r.integers(1, 30, 300)
    order, of = suffixes.multikey(suffixes.characters(data), starts, lengths, np.zeros(300, np.int64))
    text = [data[a:a + n] for a, n in zip(starts.tolist(), lengths.tolist())]
    classes = {}
    for i, c in zip(order.tolist(), of.tolist()):
        classes.setdefault(c, set()).add(i)
    want = {}
    for i, t in enumerate(text):
        want.setdefault(t, set()).add(i)
    assert sorted(map(sorted, classes.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)
