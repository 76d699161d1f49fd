"""Packing: exact round trip, no padding but at powers of two, and the best fill."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shipreport.llm import packing
from shipreport.llm.queries import tokenizer_path


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 3), min_size=1, max_size=5), st.integers(1, 64))
@settings(max_examples=150, deadline=None)
def test_fullest_is_the_best_multiset(counts, capacity):
    used = packing.fullest(counts, capacity)
    assert all(used[k] <= counts[k] for k in used)
    sums = {sum(k * n for k, n in zip(counts, c)) for c in itertools.product(*(range(n + 1) for n in counts.values()))}
    assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= capacity)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path())
    found.encode_special_tokens = True
    return found


TEXTS = ["", None, " ", "a", "  two  spaces ", "tab\tand\nline \n  end", "l'été d ici    x", "  wide 　space",
         "don't we'll I'm <|endoftext|> 12 345", "x \x1fy \x85z", "ab " * 9000, "\U0001F600 \U0001F600!", "a  b éc"]


def test_units_give_the_tokenizers_ids(tokenizer):
    tokens = packing.Tokens(tokenizer_path())
    got = tokens.encode([(t or "").encode() for t in TEXTS])
    for text, ids in zip(TEXTS, got):
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.fixture(scope="module")
def tokens():
    return packing.Tokens(tokenizer_path())


@given(st.lists(st.text(alphabet=" \n\t\u00a0\u3000a\u00e9'sd1!.\x00\x1f\x85", max_size=20), min_size=1, max_size=4))
@settings(max_examples=600, deadline=None)
def test_units_on_any_white_space(tokenizer, tokens, many):
    got = tokens.encode([t.encode() for t in many])
    assert [g.tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in many]


def test_a_worker_may_forget(tokenizer, tokens, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 0)
    for _ in range(2):
        assert tokens.encode([b"one two", b""])[0].tolist() == tokenizer.encode("one two").ids + [1]


def check(rows, texts, tokenizer):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(docs) == set(texts)
    for doc, found in docs.items():
        found.sort(key=lambda r: r.start)
        ids = [i for r in found for i in r.ids]
        assert ids == tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [1]
        assert all(r.doc_tokens == len(ids) for r in found)
        assert [r.start for r in found] == list(itertools.accumulate([0] + [r.length for r in found]))[:-1]
    padding = 0
    for found in sequences.values():
        found.sort(key=lambda r: r.offset)
        size = sum(r.length for r in found)
        assert [r.offset for r in found] == list(itertools.accumulate([0] + [r.length for r in found]))[:-1]
        assert size <= packing.CAPACITY
        padding += 0 if size & (size - 1) == 0 else packing.CAPACITY - size
    assert padding == 0


def test_round_trip(spark, tokenizer):
    texts = {i: (t * (i % 3) if t else t) for i, t in enumerate(TEXTS * 3)}
    df = spark.createDataFrame([(k, v, "x") for k, v in texts.items()], "doc_id bigint, text string, start string")
    check(packing.packed(df.repartition(3), tokenizer_path(), pool=4).collect(), texts, tokenizer)


def test_whole_table(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.packed(docs, tokenizer_path()).collect()
    check(rows, texts, tokenizer)
    assert len(rows) < 2.2 * len(texts) + sum(r.length for r in rows) / packing.CAPACITY


def test_empty_null_and_repeated_rows(spark):
    schema = "doc_id bigint, text string"
    assert packing.packed(spark.createDataFrame([], schema), tokenizer_path()).count() == 0
    rows = packing.packed(spark.createDataFrame([(None, None), (1, "a"), (1, "a")], schema), tokenizer_path()).collect()
    assert sorted(r.length for r in rows) == [1, 2, 2] and sum(r.doc_id is None for r in rows) == 1


@pytest.fixture(scope="module")
def as_loaded():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


E = "<|endoftext|>"
ADDED = [*TEXTS, E, E + E, f"a  {E}  b", f"x\n{E}\ny", f"don{E}'t <|endoftext| {E[1:]} {E}", f"{E} a", f"a {E}", "<|endof" + E + "text|>"]


@given(st.lists(st.lists(st.sampled_from([E, E[:5], E[5:], " ", "  ", "\n", "a", "'s", "\u00a0", "1", "."]), max_size=10).map("".join),
                min_size=1, max_size=4))
@settings(max_examples=300, deadline=None)
def test_added_tokens_as_loaded(as_loaded, many):
    many = many + ADDED
    got = packing._tokens(tokenizer_path(), True).encode([(t or "").encode() for t in many])
    assert [g.tolist() for g in got] == [as_loaded.encode(t or "", add_special_tokens=False).ids + [1] for t in many]


def test_digest_uses_the_tokenizer_as_loaded(spark, as_loaded):
    texts = dict(enumerate(ADDED))
    rows = packing.digest(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), tokenizer_path()).collect()
    want = {k: as_loaded.encode(t or "", add_special_tokens=False).ids + [1] for k, t in texts.items()}
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id][r.start:r.start + r.length], "<u4").tobytes())


def test_a_window_chooses_from_all_waiting_lengths(spark):
    """Of 200 lengths only two in the middle add up to the window; they are found."""
    packer = packing.Packer(2048, 10**6, 0, False)
    for doc, n in enumerate([*range(1500, 1600), 1024 - 7, 1024 + 7]):
        packer.wait((doc, 0, np.zeros(n, np.uint32), n))
    packer.fill(2048)
    assert sorted(r[2] for r in packer.out) == [1017, 1031]


def test_other_splitting_patterns_are_refused(tmp_path):
    import json

    data = json.loads(open(tokenizer_path()).read())
    data["pre_tokenizer"] = {"type": "Whitespace"}
    path = tmp_path / "other.json"
    path.write_text(json.dumps(data))
    with pytest.raises(ValueError, match="splitting pattern"):
        packing.Tokens(str(path))
