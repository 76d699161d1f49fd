"""The trained operators: held-out accuracy, odd rows, and the parts of each method."""

import zlib

import numpy as np
import pytest

from shipreport.llm import language, quality, toxicity

SF = "/root/testdata/sf0.1"
ODD = [(None, None), (1, None), (2, ""), (3, "é"), (4, "12 34 !!"), (5, "word " * 60000), (5, "word"), (6, "\x00 \n")]


def accuracy(spark, found, label):
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet").withColumnRenamed(label, "y"), "doc_id").where(
        "held_out and y is not null").select("predicted", "y").collect()
    assert len(rows) > 500
    hits = {y: [r.predicted == y for r in rows if r.y == y] for y in (0, 1)}
    return {y: sum(h) / len(h) for y, h in hits.items()}


@pytest.mark.parametrize("module,label,least", [(quality, "quality", (0.95, 0.98)), (toxicity, "toxic", (0.98, 0.7))])
def test_held_out_accuracy(spark, module, label, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = module.digest(docs, labels).cache()
    right = accuracy(spark, found, label)
    assert right[0] >= least[0] and right[1] >= least[1]
    assert found.count() == docs.count() and found.where("score < 0 or score > 1 or score is null").count() == 0
    held = {r.doc_id: r.held_out for r in found.select("doc_id", "held_out").collect()}
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in held.items())


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_labels_of_the_held_out_fold_change_nothing(spark, module, label):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = labels.withColumn(label, labels[label] - 2 * labels[label] * 0).selectExpr(
        "doc_id", f"CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - {label} ELSE {label} END AS {label}")
    extra = flipped.unionByName(labels.selectExpr("CAST(NULL AS bigint) doc_id", f"1 AS {label}").limit(3)).unionByName(
        labels.selectExpr("doc_id", f"CAST(NULL AS int) {label}").limit(9))
    score = lambda x: {r.doc_id: r.score for r in module.digest(docs, x).collect()}
    assert score(labels) == score(extra)


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows_and_too_few_labels(spark, module, label):
    df = spark.createDataFrame([(a, b, "x") for a, b in ODD], "doc_id bigint, text string, score string")
    for given in ([], [(1, 1)], [(1, 0), (2, 0)], [(1, 0), (3, 1), (4, 1), (6, 0), (6, 1), (7, None)]):
        labels = spark.createDataFrame(given, f"doc_id bigint, {label} int")
        found = module.digest(df, labels).collect()
        assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
        assert next(r.score for r in found if r.doc_id == 1) == next(r.score for r in found if r.doc_id == 2)
        assert module.digest(df.limit(0), labels).count() == 0
    scored = module.scored(df, module.learnt(df, labels))
    assert set(scored.columns) == {"doc_id", "text", "score"} and dict(scored.dtypes)["score"] == "double"


def test_good_documents_keep_their_columns(spark):
    df = spark.createDataFrame([(1, "a fine text", 0.5, "x"), (2, None, 0.1, "y")], "doc_id bigint, text string, score double, row string")
    model = quality.Model(intercept=2.0)
    out = quality.good_documents(df, model)
    assert out.columns == df.columns and sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
    assert quality.good_documents(df, quality.Model(intercept=-2.0)).count() == 0


def test_additive_model_needs_pairs_for_an_exclusive_or():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    alone = quality.fit(x, y, pairs=0)
    both = quality.fit(x, y, pairs=1)
    assert ((alone.score(x) > 0.5) == y).mean() < 0.65 < 0.95 < ((both.score(x) > 0.5) == y).mean()
    assert both.pairs[0][:2] == (0, 1)
    by_hand = both.intercept + sum(t[both.binned(x[:1])[0, j]] for j, t in enumerate(both.single)) + sum(
        t[both.binned(x[:1])[0, i], both.binned(x[:1])[0, j]] for i, j, t in both.pairs)
    assert np.isclose(both.score(x[:1])[0], 1 / (1 + np.exp(-by_hand)))


def test_features_do_not_depend_on_the_batch():
    held = [b"One two, three!! | x", b"", "É né 12\nline".encode(), b"a b c d e " * 30]
    together = quality.features(held)
    assert np.array_equal(together, np.concatenate([quality.features([t]) for t in held]))
    model = toxicity.Model(-1.0, *map(np.array, (np.unique(toxicity.coordinates([b"one two"])[1]), [1.0, 2.0, 3.0])))
    assert np.allclose(model.score(held + [b"one two one two"]), [model.score([t])[0] for t in held + [b"one two one two"]])


def test_ftrl_weights_are_sparse():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 5000, 60)) for _ in range(600)]
    y = np.array([float(r[0] < 40) for r in rows])
    rows = [np.append(np.append(r, 6000 + int(v)), 2 ** toxicity.BITS) for r, v in zip(rows, y)]
    model = toxicity.fit(rows, y)
    assert len(model.places) < 100 and {6000, 6001} & set(model.places.tolist())


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) > 0.99 * len(found) and all(0 <= r.score <= 1 for r in found)


def test_spans_of_mixed_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learnt(docs)
    take = lambda lang, n: " ".join(docs.where(f"lang = '{lang}'").orderBy("n_chars", ascending=False).first().text.split()[:n])
    mixed = take("de", 30) + " " + take("fr", 25) + " " + take("en", 20)
    (name, score, spans), = model.predict([mixed.encode()], spans=True)
    assert [s[0] for s in spans] == ["de", "fr", "en"] and sum(s[2] for s in spans) == 75
    assert abs(spans[0][2] - 30) <= 2 and abs(spans[1][2] - 25) <= 2
    assert name in ("de", "fr") and score < 0.7


def test_scripts_narrow_the_candidates():
    greek, latin = "αβγδε ζηθ ικλ", "abcde fgh ijk"
    model = language.Model(["el", "en"], np.zeros((2 ** language.BITS, 2)), np.zeros((language.N_SCRIPTS, 2), bool))
    model.scripts[1, 1] = model.scripts[2, 0] = True
    assert [x[0] for x in model.predict([greek.encode(), latin.encode(), "мир".encode()])][:2] == ["el", "en"]


OTHERS = {"my": "မြန်မာ ဘာသာ စကား သည် ဖြစ်သည်", "km": "ភាសា ខ្មែរ គឺ ជា ភាសា", "am": "አማርኛ የኢትዮጵያ ቋንቋ ነው",
          "lo": "ພາສາ ລາວ ເປັນ ພາສາ", "bo": "བོད་སྐད་ ནི་ སྐད་ཡིག", "chr": "ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ ᏗᎧᏁᎢᏍᏗ", "mn": "ᠮᠣᠩᠭᠣᠯ ᠬᠡᠯᠡ",
          "dv": "ދިވެހި ބަސް އަކީ", "syr": "ܠܫܢܐ ܣܘܪܝܝܐ ܐܝܬ", "ar": "ﺍﻟﻌﺮﺑﻴﺔ ﻟﻐﺔ", "wide": "ｆｕｌｌ ｗｉｄｔｈ", "zh": "𠀀𠀁𠀂 𠀃𠀄", "en": "plain words of it"}


def test_language_of_scripts_that_are_not_listed(spark):
    rows = [(i, OTHERS[lang], lang) for i, lang in enumerate(sorted(OTHERS) * 12)]
    found = language.digest(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    assert {(rows[r.doc_id][2], r.lang_pred) for r in found} == {(x, x) for x in OTHERS} and all(r.score > 0.5 for r in found)


def test_marks_and_signs_without_a_letter_are_no_letters():
    assert language.letters_of(["\u0301 1\u0301 \u0966\u0967 \u0964 \u00d7".encode()]).letters.sum() == 0
    assert language.letters_of(["e\u0301\u0302 \u0301x".encode()]).letters.tolist() == [3, 1]


def test_language_of_odd_rows(spark):
    df = spark.createDataFrame([(a, b, "en" if a else None, 1) for a, b in ODD], "doc_id bigint, text string, lang string, spans int")
    found = language.digest(df).collect()
    assert len(found) == len(ODD)
    for r in found:
        assert (r.lang_pred == "und") == (r.doc_id in (None, 1, 2, 4, 6)) and (r.score == 0) == (r.lang_pred == "und")
    nothing = df.where("doc_id is null")
    assert [r.lang_pred for r in language.digest(nothing).collect()] == ["und"] and language.digest(df.limit(0)).count() == 0


def test_viterbi_is_the_best_path():
    from itertools import product

    rng = np.random.default_rng(3)
    model = language.Model(["a", "b", "c"], np.zeros((1, 3)), np.ones((1, 3), bool))
    sizes = [5, 1, 4, 6]
    scores = -6 * rng.random((sum(sizes), 3))
    text = np.repeat([0, 1, 3, 4], sizes)
    path = model.paths(scores, text, 5)
    for t in (0, 1, 3, 4):
        own = np.flatnonzero(text == t)
        value = lambda p: sum(scores[w, s] for w, s in zip(own, p)) - language.PENALTY * sum(a != b for a, b in zip(p, p[1:]))
        assert np.isclose(value(path[own]), max(map(value, product(range(3), repeat=len(own)))))


def test_a_share_does_not_vanish(spark):
    """Shares under a millionth keep rows, larger shares contain smaller ones, and whole millionths are as before."""
    from pyspark.sql import functions as F

    from shipreport.llm.samples import in_share

    ids = spark.range(4_000_000).withColumnRenamed("id", "doc_id")
    shares = (4e-7, 2.5e-6, 1e-5, 0.25, 0.2500004)
    row = ids.agg(*[F.count(F.when(in_share("doc_id", 17, s), 1)).alias(f"n{i}") for i, s in enumerate(shares)],
                  F.count(F.when(in_share("doc_id", 17, shares[1]) & ~in_share("doc_id", 17, shares[2]), 1)).alias("outside"),
                  F.count(F.when((F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1_000_000)) < 250_000) != in_share("doc_id", 17, 0.25), 1)).alias("other")
                  ).first()
    assert row.outside == row.other == 0 and row.n3 <= row.n4
    assert 1 <= row.n1 <= 40 and 10 <= row.n2 <= 90 and abs(row.n3 - 1_000_000) < 5_000


def test_a_language_without_sampled_letters_is_no_candidate(spark):
    rows = [(i, "the quick brown fox and the lazy dog " * 5, "en") for i in range(40)]
    rows += [(100 + i, "der schnelle braune Fuchs und der faule Hund " * 5, "de") for i in range(40)]
    rows += [(200 + i, "12 34 !!", "xx") for i in range(40)] + [(300, "สวัสดีชาวโลก", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.learnt(docs)
    assert model.languages == ["de", "en"] and model.table.shape[1] == model.scripts.shape[1] == 2
    found = {r.doc_id: r.lang_pred for r in language.digest(docs).collect()}
    assert found[300] in ("de", "en") and found[0] == "en" and found[100] == "de" and found[200] == "und"
    letterless = language.learnt(docs.where("lang = 'xx'"))
    assert letterless.languages == []
    assert {r.lang_pred for r in language.predicted(docs.where("lang = 'xx'"), letterless).collect()} == {"und"}


def three_languages():
    rng = np.random.default_rng(7)
    model = language.Model(["a", "b", "c"], rng.random((2 ** language.BITS, 3)) * -3, np.ones((language.N_SCRIPTS, 3), bool))
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(1, 9))) for _ in range(3000)]
    return model, (" ".join(words) + " 12 ").encode()


@pytest.mark.parametrize("cells", [3 << 10, 30_000])
def test_blocks_of_a_long_text_give_the_same_path(monkeypatch, cells):
    model, text = three_languages()
    whole, = model.predict([text], spans=True)
    monkeypatch.setattr(language, "CELLS", cells)
    assert model.batch_bytes < len(text)
    cut, empty = model.predict([text, b""], spans=True)
    assert cut[0] == whole[0] and abs(cut[1] - whole[1]) < 1e-9 and cut[2] == whole[2] and len(whole[2]) > 5
    assert empty == (language.UNKNOWN, 0.0, [])
    assert model.predict([b"1 2 " * 9000]) == [(language.UNKNOWN, 0.0, [])]


@pytest.mark.parametrize("text", ["é" * 5000, "ab " * 5000, " " * 9000, "x" * 2999 + " " + "語" * 3000])
def test_blocks_are_the_text(text):
    found = list(language.blocks(text.encode(), 1000))
    assert b"".join(found) == text.encode() and all(len(b) <= 2003 for b in found)
    assert "".join(b.decode() for b in found) == text


def test_memory_of_a_very_long_text():
    """1.4 MB in 200 languages, beside the model; of each further word 29 bytes are kept."""
    import tracemalloc

    rng = np.random.default_rng(1)
    model = language.Model([str(i) for i in range(200)], rng.random((2 ** language.BITS, 200)) * -3,
                           np.ones((language.N_SCRIPTS, 200), bool))
    text = b"some words of a long text and more " * 40_000
    tracemalloc.start()
    (name, score, _), = model.predict([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert name in model.languages and 0 <= score <= 1 and peak < 100 << 20


def test_rare_languages_are_learnt_and_none_is_left_out(spark):
    rows = [(i, f"the quick brown fox {i}", "en") for i in range(3000)]
    rows += [(10_000 + i, "zxq wvk jjq " * 3, "rare") for i in range(8)]
    rows += [(20_000 + i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}q" * 4, f"l{i // 4:03d}") for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.learnt(docs, sample=200, least=20)
    assert "rare" in model.languages and len(model.languages) > 250
    assert model.predict([b"zxq wvk"])[0][0] == "rare"
