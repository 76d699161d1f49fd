"""Substring dedup against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from shipreport.llm import substring

SCHEMA = "doc_id bigint, text string, kept string, n_chars int"


def brute(docs, window):
    """Kept words of each row, by comparing all windows."""
    words = [(d, (t or "").split() if t is not None else []) for d, t in docs]
    first = {}
    for d, ws in words:
        if d is not None:
            for p in range(len(ws) - window + 1):
                w = tuple(ws[p:p + window])
                first[w] = min(first.get(w, d), d)
    out = []
    for d, ws in words:
        gone = set()
        if d is not None:
            for p in range(len(ws) - window + 1):
                if first[tuple(ws[p:p + window])] < d:
                    gone.update(range(p, p + window))
        out.append((d, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(40)]
    say = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    shared = [say(k) for k in (6, 9, 12, 30, 5)]
    docs = []
    for i in range(n):
        ws = say(rng.randrange(0, 25))
        for _ in range(rng.randrange(3)):
            part = rng.choice(shared)
            a = rng.randrange(len(part))
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = part[a:]
        docs.append((i, " ".join(ws)))
    docs += [(100 + i, docs[i][1]) for i in range(5)]  # exact copies
    docs += [(7, docs[3][1]), (7, docs[7][1]), (None, docs[2][1]), (None, None), (200, None), (201, ""), (202, " \t\n"),
             (203, "a " * 400), (204, "a " * 30 + "b " * 40), (205, "a  a\ta\na a a a a a a x")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed,window,near", [(1, 5, 1), (2, 8, 1 << 20), (3, 20, 300), (4, 2, 1 << 20)])
def test_brute_force(spark, monkeypatch, seed, window, near):
    monkeypatch.setattr(substring, "_NEAR_BYTES", near)
    docs = corpus(seed)
    df = spark.createDataFrame([(d, t, "clash", 3) for d, t in docs], SCHEMA).repartition(5)
    got = substring.parsed(df, window).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, window)


def test_factors_hold_words_of_their_source(spark):
    docs = corpus(5)
    text = {}
    for d, t in docs:
        text.setdefault(d, []).append((t or "").split())
    rows = substring.parsed(spark.createDataFrame(docs, "doc_id bigint, text string"), 8).collect()
    seen = 0
    for r in rows:
        ws = (r.text or "").split()
        assert sum(f.n_words for f in r.factors) == r.n_removed
        for f in r.factors:
            seen += 1
            assert f.source < r.doc_id
            # A factor may go on where the one before it ended: its window began up to 7 words earlier.
            held = [" ".join(x) for x in text[f.source]]
            assert any(" ".join(ws[f.first_word:f.first_word + f.n_words]) in h for h in held)
    assert seen > 10


def test_documents_keep_their_columns(spark):
    long = " ".join(f"x{i}" for i in range(60))
    df = spark.createDataFrame([(1, long, "a", 5), (2, long + "  end", "b", 6), (3, "as  it is", "c", 7)], SCHEMA)
    got = {r.doc_id: r for r in substring.deduplicated(df).collect()}
    assert substring.deduplicated(df).columns == df.columns
    assert got[1].text == long and got[1].n_chars == 5 and got[1].kept == "a"
    assert got[2].text == "end" and got[2].n_chars == 3 and got[2].kept == "b"
    assert got[3].text == "as  it is" and got[3].n_chars == 7


def test_empty_table(spark):
    assert substring.parsed(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_texts_are_shuffled_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = substring.digest(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert "ReusedExchange" in plan
    assert substring.digest(docs).agg(F.sum("n_removed")).first()[0] > 0
