"""Words and hashes against Python's own regular expressions."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shipreport.llm import words as W

ANY = st.lists(st.text(alphabet="ab \t\n\x0b\x1f éZ9-_~{", max_size=20), min_size=1, max_size=5)


@given(ANY)
@settings(max_examples=200, deadline=None)
def test_words(texts):
    for letters, pattern, fold in ((W.SPACED, r"[^\x20\x09-\x0D]+", False), (W.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)):
        held = [t.encode().lower() if fold else t.encode() for t in texts]
        found = W.words_of(held, letters)
        want = [re.findall(pattern, h.decode()) for h in held]
        assert found.counts.tolist() == [len(w) for w in want]
        assert [found.word(i).decode() for i in range(len(found.starts))] == [x for w in want for x in w]


@given(ANY, st.integers(1, 3))
@settings(max_examples=200, deadline=None)
def test_equal_windows_have_equal_hashes(texts, k):
    found = W.words_of([t.encode() for t in texts])
    starts, sums = W.window_starts(found, k), W.window_sums(found.hashes(), k)
    seen = {}
    for s in starts.tolist():
        window = tuple(found.word(s + j) for j in range(k))
        assert seen.setdefault(window, sums[s]) == sums[s]
    assert len(set(seen.values())) == len(seen)
    assert len(starts) == sum(max(0, c - k + 1) for c in found.counts.tolist())


def test_hashes_do_not_collide_on_many_short_words():
    many = [f"{a}{b}{c}" for a in "abcdefghij" for b in "abcdefghij" for c in range(300)]
    hashes = W.words_of([" ".join(many).encode()]).hashes()
    assert len(np.unique(hashes)) == len(many)
