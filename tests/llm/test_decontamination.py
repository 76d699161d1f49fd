"""Decontamination against brute force."""

import random
import re

import pytest

from shipreport.llm import decontamination as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, window):
    runs = {}
    for name, text in items:
        ws = words(text)
        if not ws:
            continue
        m = min(window, len(ws))
        for p in range(len(ws) - m + 1):
            runs.setdefault(tuple(ws[p:p + m]), set()).update([] if name is None else [str(name)])
    out = []
    for d, text in docs:
        ws, hit, names = words(text), set(), set()
        for run, who in runs.items():
            for p in range(len(ws) - len(run) + 1):
                if tuple(ws[p:p + len(run)]) == run:
                    hit.update(range(p, p + len(run)))
                    names |= who
        out.append((d, len(ws), sorted(hit), sorted(names)))
    return sorted(out, key=str)


def tables(seed, letters=5):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice(["A", "b", "ç", "d9", "Ee", "f", "g", "h"][:letters]) for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 2, 3, 4, 6, 9, 12]) if seed % 2 else rng.choice([4, 6, 9, 12]))) for i in range(12)]
    items += [(3, items[5][1]), (None, say(6)), (77, None), (78, "--- !!"), (79, items[4][1])]
    docs = [(i, say(rng.randrange(40)) + "." + items[rng.randrange(12)][1].upper() + ", " + say(5)) for i in range(40)]
    docs += [(1, docs[1][1]), (None, docs[2][1]), (90, None), (91, ""), (92, "\t--"), (93, say(3000))]
    return docs, items


@pytest.mark.parametrize("seed,window,block,passes", [(1, 4, 10**6, 4), (2, 4, 12, 1), (3, 5, 20, 2), (4, 3, 10**6, 4), (6, 4, 1, 4)])
def test_brute_force(spark, seed, window, block, passes):
    docs, items = tables(seed, 3 if seed == 4 else 7)
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id bigint, text string, hit int").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = D.hits(df, bench, window, block, passes).collect()
    assert sorted(((r.doc_id, r.n_words, r.hit, r["items"]) for r in rows), key=str) == brute(docs, items, window)


def test_items_without_an_id_hit_and_have_no_name(spark):
    docs = spark.createDataFrame([(1, "x a b c y"), (2, "d e f"), (3, "a b d e")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(None, "A b C"), (None, "d e f"), (7, "D E F"), (None, None)], "item_id bigint, text string")
    rows = {r.doc_id: (r.hit, r["items"]) for r in D.hits(docs, bench, 3, 2, 1).collect()}
    assert rows == {1: ([1, 2, 3], []), 2: ([0, 1, 2], ["7"]), 3: ([], [])}
    assert {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in D.digest(docs, bench).collect()} == {
        1: (3, 0, True), 2: (3, 1, True), 3: (0, 0, False)}


def test_very_long_text(spark):
    long = "w " * 1_000_000 + "a b c d " + "w " * 1_000_000
    docs = spark.createDataFrame([(1, long)], "doc_id bigint, text string")
    row = D.hits(docs, spark.createDataFrame([(5, "a b c d")], "item_id bigint, text string"), 4).first()
    assert (row.n_words, row.hit, row["items"]) == (2_000_004, [1_000_000, 1_000_001, 1_000_002, 1_000_003], ["5"])


def test_cutting(spark):
    ten = " ".join(f"t{i}" for i in range(10))
    df = spark.createDataFrame(
        [(1, f"One, two. {ten.upper()}! three", 1, 9), (2, "clean  text", 2, 9), (3, ten, 3, 9), (4, None, 4, 9)],
        "doc_id bigint, text string, hit int, n_chars int")
    bench = spark.createDataFrame([(1, ten)], "item_id bigint, text string")
    got = {r.doc_id: r for r in D.decontaminated(df, bench, max_coverage=0.9).collect()}
    assert set(got) == {1, 2, 4} and got[1].text == "One, two. ! three" and got[1].hit == 1
    assert got[1].n_chars == len(got[1].text) and got[2].text == "clean  text" and got[2].n_chars == 9
    assert set(r.doc_id for r in D.decontaminated(df, bench, max_coverage=1.0).collect()) == {1, 2, 3, 4}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    row = D.digest(docs, none).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)
    assert D.digest(docs.limit(0), none).count() == 0
