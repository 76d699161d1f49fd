"""Alignment against both libraries and plain loops."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from shipreport.llm import alignment
from shipreport.llm.queries import piece_model_path, tokenizer_path

TEXTS = ["", None, "a", " ", "  lead and  two  spaces ", "tabs\tand\n\nlines \n x", "<|endoftext|> <s> </s> <0x41> <unk>", "naïve façade — “quotes” 日本語のテキスト",
         "x▁y", "▁", "é ﬁne 　wide space", "🙂🙃 emoji👩‍👩‍👧", "don't we'll I'm 3.14159 1,000,000", "a\0b", " ", "-" * 400, "ab " * 300,
         "def f(x):\n    return x  # comment\n\n\n", "ЖЖЖ привет мир", "end with space "]


def tokens():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(tokenizer_path())
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=piece_model_path())
    shift = {**{chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}}
    rest = [b for b in range(256) if b not in shift.values()]
    shift |= {chr(256 + i): b for i, b in enumerate(rest)}

    def spell(text):
        a = [(i, bytes(shift[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in second.encode(text, num_threads=1):
            p = second.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()))
        return a, b

    return spell


def brute(texts):
    spell, rows, corpus = tokens(), [], Counter()
    for text in texts:
        a, b = spell(text) if text else ([], [])
        whole = (" " + text).encode() if text else b""
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a, b = [], []
        ends = []
        for side in (a, b):
            at, of = 0, defaultdict(list)
            for i, x in side:
                at += len(x)
                of[at].append(i)
            ends.append(of)
        links = [(i, j) for e in ends[0] for i in ends[0][e] for j in ends[1].get(e, [])]
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups, sides = [], [sorted(of.items(), reverse=True) for of in ends]
        for e in shared:
            parts = []
            for side in sides:
                ids = []
                while side and side[-1][0] <= e:
                    ids += side.pop()[1]
                parts.append(",".join(map(str, ids)))
            groups.append("|".join(parts))
        corpus.update(links)
        rows.append((len(a), len(b), len(shared), links, ";".join(groups)))
    best = defaultdict(int)
    for (i, j), n in corpus.items():
        best[j] = max(best[j], n)
    return [(a, b, g, len(ls), sum(corpus[x] == best[x[1]] for x in ls), sum(corpus[x] for x in ls), t) for a, b, g, ls, t in rows]


def random_texts(n, seed):
    r = random.Random(seed)
    pool = "the of and Zürich tokenizer <|endoftext|> aligned, a.b c's 12 345 \n \t  é漢字 ▁ . - _ don't".split(" ")
    return [" ".join(r.choice(pool) for _ in range(r.randrange(1, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def frame(spark):
    texts = TEXTS + random_texts(80, 3) + ["very common text"] * 40
    df = spark.createDataFrame([(i if i % 7 else None, t, "x", i) for i, t in enumerate(texts)], "doc_id bigint, text string, n_a string, row int")
    return texts, df.repartition(5)


@pytest.mark.parametrize("block", [2_000_000, 100])
def test_like_brute_force(frame, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)  # one pass, and several
    texts, df = frame
    want = brute(texts)
    out = alignment.alignments(df, tokenizer_path(), piece_model_path())
    assert out.columns == ["doc_id", "text", "row", *alignment.COUNTS, "groups"]
    got = {r["row"]: (*(r[c] for c in alignment.COUNTS), r["groups"]) for r in out.collect()}
    for i, w in enumerate(want):
        assert got[i] == w, texts[i]
    assert {r["row"]: r["text"] for r in out.collect()} == dict(enumerate(texts))


def test_digest(frame):
    texts, df = frame
    want = Counter((i if i % 7 else None, *w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[0] else "") for i, w in enumerate(brute(texts)))
    got = alignment.digest(df.drop("row"), tokenizer_path(), piece_model_path())
    assert got.columns == ["doc_id", *alignment.COUNTS, "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == want


def test_long_text_and_empty_table(spark):
    long = " ".join(random_texts(1000, 9))
    df = spark.createDataFrame([(1, long.replace("▁", "")), (2, "x" * 30_000)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in alignment.digest(df, tokenizer_path(), piece_model_path()).collect()}
    want = brute([long.replace("▁", ""), "x" * 30_000])
    for i, w in zip((1, 2), want):
        assert tuple(got[i][c] for c in alignment.COUNTS) == w[:6]
    assert not alignment.digest(df.limit(0), tokenizer_path(), piece_model_path()).collect()


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        alignment.Pair(public_tokenizers.path("word_bpe_49k.json"), piece_model_path())
