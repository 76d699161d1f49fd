"""Many keywords in one pass, against one search a word."""

import random
import re

import pytest
from pyspark.sql import functions as F

from shipreport.functions.keywords import deciding, first_label, first_rule, trie_pattern, words_in
from shipreport.operators import documents
from shipreport.workload.queries import QUERIES
from test_plans import SF, plan

TEXTS = [None, "", "A", "INVOICE", "TAX INVOICE", "COMMERCIAL INVOICE AND PACKING LIST", "ACME INVOICE", "PACKINGLIST", "AAAAB",
         "é]^-[\\ $(x)|*+?.{2} \n tab\t&&~ #", "日本語 🙂🙃", "ABABABAC"]


def first(text, rules):
    return None if text is None else next((n for n, (w, _) in enumerate(rules) if w in text), None)


@pytest.fixture(scope="module")
def frame(spark):
    r = random.Random(1)
    texts = TEXTS + ["".join(r.choice("ABC ") for _ in range(r.randrange(0, 40))) for _ in range(300)]
    return texts, spark.createDataFrame(list(enumerate(texts)), "id int, text string").cache()


LISTS = [
    documents.for_forwarder(documents.CONTENT_RULES, "Acme"),
    [("INVOICE", "a"), ("TAX INVOICE", "b"), ("PACK", "c")],
    [("ABA", "1"), ("AB", "2"), ("B", "3"), ("ABABAC", "4"), ("A", "5")],
    [("AAB", "1"), ("AA", "2"), ("", "all"), ("C", "never")],
    [("é]", "1"), ("^-[\\", "2"), ("$(x)|*+?.", "3"), ("{2}", "4"), ("\n", "5"), ("&&~", "6"), ("🙂🙃", "7"), ("本", "8")],
    [("X", "same"), ("X", "twice")],
    [],
]


@pytest.mark.parametrize("rules", LISTS)
def test_first_rule(frame, rules):
    texts, df = frame
    got = {r["id"]: (r["n"], r["l"]) for r in df.select(
        "id", first_rule(F.col("text"), rules).alias("n"), first_label(F.col("text"), rules, "none").alias("l")).collect()}
    for i, text in enumerate(texts):
        n = first(text, rules)
        assert got[i] == (n, "none" if n is None else rules[n][1]), text


def test_thousand_random_words(frame):
    texts, df = frame
    r = random.Random(2)
    words = ["".join(r.choice("ABC") for _ in range(r.randrange(3, 9))) for _ in range(1000)]
    rules = [(w, f"t{i}") for i, w in enumerate(words)]
    got = df.select("id", first_rule(F.col("text"), rules).alias("n"), F.sort_array(words_in(F.col("text"), words)).alias("w")).collect()
    for row in got:
        text = texts[row["id"]]
        assert row["n"] == first(text, rules)
        assert row["w"] == (None if text is None else sorted({w for w in words if w in text}))
    assert deciding(rules) == [(n, w) for n, w in enumerate(words) if not any(v in w for v in words[:n])]


def test_pattern_is_a_trie():
    assert trie_pattern(["AB", "ABC", "AD"]) == "(?=[A])(?=(A(?:B(?:C)?|D)))"
    assert [m[1] for m in re.finditer(trie_pattern(["ABA", "BA", "AB"]), "ABABA")] == ["ABA", "BA", "ABA", "BA"]


def test_flags_of_many_words(spark):
    rows = [(1, "one two"), (1, "Three"), (2, None), (3, "straße")]
    words = {f"w{i}": w for i, w in enumerate(["one", "two", "three", "strasse", "on", "e t", *(f"x{i}" for i in range(30))])}
    df = spark.createDataFrame(rows, "k int, text string")
    got = {r["k"]: {words[c] for c in words if r[c]} for r in documents.keyword_flags(df, ["k"], "text", words).collect()}
    assert got == {1: {"one", "two", "three", "on", "e t"}, 2: set(), 3: {"strasse"}}
    with pytest.raises(ValueError):
        words_in(F.col("text"), ["a", ""])


def test_one_scan_and_one_search_in_the_plan(spark):
    text = plan(QUERIES["keyword_list"](spark, SF))
    assert text.count("documents.parquet") == 1 and "Contains" not in text
    spread = plan(QUERIES["keyword_spread"](spark, SF))
    assert spread.count("documents.parquet") == 1 and spread.count("regexp_extract_all") == 1 and "partial_count" in spread
