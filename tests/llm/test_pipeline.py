"""The pipeline's stages: columns, decisions that take effect, and clean rows that stay."""

import pytest

import corpus_pipeline as P
from shipreport.llm import quality
from test_jaccard import brute as jaccard_brute
from test_substring import brute as substring_brute

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    docs, place, out = spark.read.parquet(f"{SF}/documents.parquet"), tmp_path_factory.mktemp("stages"), []
    for number, (_, stage) in enumerate(P.STAGES):
        given = docs
        stage(spark, docs, SF).write.parquet(f"{place}/{number}")
        docs = spark.read.parquet(f"{place}/{number}")
        out.append((given.collect(), docs.collect(), docs.columns))
    return out


def test_columns(outputs):
    assert [name for name, _ in P.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "packing"]
    assert all(columns == COLUMNS for *_, columns in outputs[:4])


def test_quality_stage_only_drops_rejected_documents(outputs, spark):
    given, kept, _ = outputs[0]
    assert set(kept) <= set(given) and 0.7 * len(given) < len(kept) < len(given)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r.doc_id for r in given} - {r.doc_id for r in kept}
    # This table has a dozen bad documents to learn from; accuracy is tested on a larger one.
    assert sum(label.get(d) == 1 for d in gone) <= 1 and sum(label.get(d) == 0 for d in gone) >= 3
    scored = quality.scored(spark.createDataFrame(given), quality.learnt(
        spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))).collect()
    assert {r.doc_id for r in scored if r.score < 0.3} == gone


def test_jaccard_stage_keeps_one_of_each_group(outputs):
    given, kept, _ = outputs[1]
    want = {d for d, _, c in jaccard_brute([(r.doc_id, r.text) for r in given], 5, 80) if d == c}
    assert {r.doc_id for r in kept} == want and set(kept) <= set(given)


def test_substring_stage_cuts_what_earlier_documents_hold(outputs):
    given, kept, _ = outputs[2]
    want = {d: (gone, text) for d, _, gone, text in substring_brute([(r.doc_id, r.text) for r in given], 50)}
    text = {r.doc_id: r.text for r in given}
    for r in kept:
        gone, left = want[r.doc_id]
        assert r.text == (left if gone else text[r.doc_id]) and r.n_chars == len(r.text)


def test_decontamination_stage_leaves_no_window(outputs, spark):
    from test_decontamination import brute, words

    given, kept, _ = outputs[3]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {d: h for d, _, h, _ in brute([(r.doc_id, r.text) for r in given], items, 10)}
    text = {r.doc_id: r.text for r in given}
    kept = {r.doc_id: r for r in kept}
    for d, h in hit.items():
        ws = words(text[d])
        if len(h) <= 0.8 * len(ws):
            assert words(kept[d].text) == [w for i, w in enumerate(ws) if i not in set(h)]
            assert h or kept[d].text == text[d]
        else:
            assert d not in kept


def test_packing_stage_holds_every_document(outputs):
    given, pieces, _ = outputs[4]
    assert {p.doc_id for p in pieces} == {r.doc_id for r in given}
    for d in {p.doc_id for p in pieces}:
        own = sorted((p.start, p.length, p.doc_tokens) for p in pieces if p.doc_id == d)
        assert sum(n for _, n, _ in own) == own[0][2]


def test_run_gives_the_last_stage(outputs, spark):
    got = P.run(spark, SF)
    assert sum(r.length for r in got.collect()) == sum(p.length for p in outputs[4][1])
