"""Document rules against their plain Python reading."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fixtures import at, frame
from shipreport.operators import documents as d
from shipreport.plans.sorting import doc_sort_counts, doc_sort_report

RULES = d.for_forwarder(d.CONTENT_RULES, "Acme")
WORDS = ["permit no", "Contract of Purchase and Sale", "declaration", "commercial", "invoice", "tax", "packing",
         "list", "slip", "packlist", "acme", "permit", "\n", "x"]


def doc_rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = rng.choice(["SINZQX123", "abcDef", "SHORT", "", None, "SINzqx9"])
        name = rng.choice([f" {key}.pdf", f"{key}.PDF.pdf ", "zqx99.jpg", "ZQX-1.pdf", "scan.pdf", "scan.PDF ", "x.png",
                           "", None, "def.pdf", "DEF.jpg"])
        text = rng.choice([None, "", " \n\t", " ".join(rng.choices(WORDS, k=rng.randrange(1, 7)))])
        rows.append(dict(doc_id=i, house_no=key, file_name=name, text=text, current_type=rng.choice(
            [None, "", "*HAWB", "hawb ", "Packing List", "*commercial invoice*", "Others"])))
    return rows


def expected_type(row):
    name, key = (row["file_name"] or "").strip().upper(), row["house_no"]
    if key and row["file_name"] is not None and name.replace(".PDF", "").strip() == key.upper():
        return "HAWB"
    if key and len(key) >= 6 and name[:3] == key[3:6]:
        return "Acme Invoice"
    if name.endswith(".PDF"):
        content = (row["text"] or "").upper().strip()
        return next((label for word, label in RULES if word in content), None)
    return None


def test_cascade_and_changes(spark):
    rows = doc_rows(1)
    typed = d.cascade(frame(spark, "document", rows), RULES, "Acme Invoice")
    want = {r["doc_id"]: expected_type(r) for r in rows}
    assert {r["doc_id"]: r["new_type"] for r in typed.collect()} == want
    assert set(want.values()) > {"HAWB", "Acme Invoice", "Packing List", "Commercial Invoice", None}
    changed = sorted(
        (str(r["house_no"]), "Done", (r["file_name"] or "").strip(), str(r["current_type"] and r["current_type"].strip()),
         want[r["doc_id"]])
        for r in rows if want[r["doc_id"]] is not None
        and want[r["doc_id"]].upper() != (r["current_type"] or "").replace("*", "").strip().upper())
    got = sorted((str(r[0]), r[1], r[2] or "", str(r[3]), r[4]) for r in d.type_changes(typed).collect())
    assert got == changed


def content_types(spark, texts, rules, default=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", d.content_type(F.upper("t"), rules, default)).collect()
    return [r[1] for r in sorted(got, key=lambda r: r[0])]


def test_first_rule_wins(spark):
    texts = ["Acme Invoice", "packing list and commercial invoice", "tax invoice declaration", "nothing", None]
    assert content_types(spark, texts, RULES) == [
        "Commercial Invoice", "Commercial Invoice", "Others", None, None]
    older = d.for_forwarder(d.OLDER_CONTENT_RULES, "Acme")
    assert content_types(spark, texts + ["a permit"], older, "Others") == [
        "Acme Invoice", "Commercial Invoice", "Commercial Invoice", "Others", "Others", "Export Permit"]


def test_rule_order_matters_only_where_two_rules_match(spark):
    texts = [r["text"] for r in doc_rows(2)]
    once = content_types(spark, texts, RULES)
    turned = content_types(spark, texts, RULES[::-1])
    for text, a, b in zip(texts, once, turned):
        matching = {label for word, label in RULES if word in (text or "").upper()}
        assert a == b or len(matching) > 1
    assert once != turned


def test_names(spark):
    df = spark.createDataFrame([("zqx1.pdf",), (" Me2.pdf",), ("in",), ("xx",), ("",), (None,), ("HAWB123x",),
                                ("hawb12",), ("HAWB12a",)], "n string")
    got = df.select(d.name_prefix_type(F.col("n"), "Zqx"), d.numbered_name(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [
        ("HAWB", False), ("Import Customs", False), ("Import Customs", False), (None, False), (None, False),
        (None, False), (None, True), (None, False), (None, False)]


def pages(seed, docs=12):
    rng = random.Random(seed)
    rows = []
    for doc in range(docs):
        numbers = list(range(300 if doc == 3 else rng.randrange(1, 9)))
        rng.shuffle(numbers)
        rows += [(doc, n, rng.choice([None, "", "straße", "packing", "list", "acme invoice", "PACKING LIST"]))
                 for n in numbers]
    return rows


@pytest.mark.parametrize("chunk", [1, 3, 64])
def test_page_concat(spark, chunk):
    rows = pages(3)
    df = spark.createDataFrame(rows, "doc bigint, page int, text string").repartition(5)
    by_doc = {}
    for doc, page, text in sorted(rows, key=lambda r: r[:2]):
        by_doc.setdefault(doc, []).append(text)
    want = {
        "lines": {k: "\n".join(t or "" for t in v) for k, v in by_doc.items()},
        "upper": {k: "".join(t.upper() + " " for t in v if t) for k, v in by_doc.items()},
        "plain": {k: "".join((t or "").upper() for t in v) for k, v in by_doc.items()}}
    for form, texts in want.items():
        got = d.page_concat(df, "doc", "page", "text", form, chunk)
        assert {r["doc"]: r["text"] for r in got.collect()} == texts
    with pytest.raises(ValueError):
        d.page_concat(df, "doc", "page", "text", "other")


def test_flags_over_pages_equal_flags_over_the_joined_text(spark):
    rows = pages(4, docs=40)
    df = spark.createDataFrame(rows, "doc bigint, page int, text string")
    words = {"own": "ACME INVOICE", "packing": "PACKING LIST", "invoice": "INVOICE"}
    flags = d.keyword_flags(df, ["doc"], "text", words)
    whole = d.page_concat(df, "doc", "page", "text", "lines").select(
        "doc", *[F.upper("text").contains(w).alias(n) for n, w in words.items()])
    assert sorted(map(tuple, flags.collect())) == sorted(map(tuple, whole.collect()))


def test_flag_type(spark):
    df = spark.createDataFrame([(a, b, c) for a in (True, False) for b in (True, False) for c in (True, False)],
                               "o boolean, p boolean, i boolean")
    got = df.select(d.flag_type(F.col("o"), F.col("p"), F.col("i"), "Acme Invoice")).collect()
    assert [r[0] for r in got] == ["Acme Invoice"] * 4 + ["Commercial Invoice", "Packing List", "Commercial Invoice",
                                                          None]


def sort_inputs(spark):
    docs = frame(spark, "document", doc_rows(5))
    shipments = spark.createDataFrame(
        [("SINZQX123", at("2024-01-14")), ("SINZQX123", at("2024-01-15")), ("abcDef", at("2024-01-20T23:00:00")),
         ("SHORT", at("2024-01-21")), ("LONELY", at("2024-01-16"))], "house_no string, etd timestamp_ntz")
    return shipments, docs, dt.date(2024, 1, 24), "Acme"


def test_doc_sort_report(spark, request):
    got = sorted(map(str, doc_sort_report(*sort_inputs(spark)).collect()))
    typed = d.cascade(sort_inputs(spark)[1], RULES, "Acme Invoice")
    want = d.type_changes(typed).where("house_no IN ('SINZQX123', 'abcDef')")
    assert got == sorted(map(str, want.collect())) and got
    request.getfixturevalue("shuffled")
    assert sorted(map(str, doc_sort_report(*sort_inputs(spark)).collect())) == got


def test_doc_sort_counts(spark):
    counts = doc_sort_counts(*sort_inputs(spark))
    rows = {r["house_no"]: (r["opened"], r["documents"], r["changed"]) for r in counts.collect()}
    report = doc_sort_report(*sort_inputs(spark)).collect()
    docs = doc_rows(5)
    assert rows == {
        h: (1, sum(r["house_no"] == h for r in docs), sum(r["house_no"] == h for r in report))
        for h in ("SINZQX123", "abcDef", "LONELY")}
    total = doc_sort_counts(*sort_inputs(spark), total="(all)").where("house_no = '(all)'").first()
    assert tuple(total)[1:] == (3, sum(v[1] for v in rows.values()), len(report))
