"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items and documents become lower-cased words. The automaton holds every run of words of
every item. A document's words are streamed through it; the length of the longest run that
ends at a word tells whether a whole window of an item (``window`` words, or the whole of a
shorter item) ends there. Words inside such windows are *hit*.

Words that do not occur in any item, and neighbours that are not neighbours in any item,
end every match. They are found for whole batches with numpy, so that only stretches that
can hold a window are streamed.

Size: an automaton has at most twice as many states as its items have words. The items are
cut into blocks of at most ``block_words`` words by a running total; each block is one
bounded broadcast. The driver fetches, builds and sends one block before it fetches the next.
Documents meet all blocks one after the other in the same pass while there are at most
``blocks_per_pass``; further blocks take another pass, whose hits are united. Nothing is
dropped. 100,000 words of items are about 70 MB of automaton, so a full pass holds about
0.7 GB in a worker; an item of more than ``block_words`` words is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipreport.llm.common import texts
from shipreport.llm.words import ALNUM, pieces, words_of

WINDOW = 10
#: Words of items in one automaton, and automata met in one pass over the documents.
BLOCK_WORDS, BLOCKS_PER_PASS = 250_000, 4


class Automaton:
    """A suffix automaton of several sequences of word ids."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[set[str]] = [set()]
        self.whole: dict[int, dict[int, set[str]]] = {}
        self.shortest = window

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: int) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        state, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return state

    def build(self, items: list[tuple[str | None, list[int]]]) -> "Automaton":
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.items = [set() for _ in self.link]
        for name, words in items:
            if not words:
                continue
            if len(words) < self.window:
                state = 0
                for word in words:
                    state = self.next[state][word]
                self.whole.setdefault(state, {}).setdefault(len(words), set()).add(name)
                self.shortest = min(self.shortest, len(words))
                continue
            state = length = 0
            for word in words:
                state, length = self.next[state][word], length + 1
                holder = self.holder(state)
                if length >= self.window:
                    self.items[holder].add(name)
        return self

    def holder(self, state: int) -> int:
        """The state of the last ``window`` words of what ``state`` stands for."""
        while self.link[state] >= 0 and self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def stream(self, words: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """Place of the last word, length and items of each window found; -1 is a foreign word."""
        state = length = 0
        for place, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(word, 0)
            length = length + 1 if state else 0
            if length >= self.window:
                yield place, self.window, self.items[self.holder(state)]
            if self.whole:
                above = state
                while above > 0:
                    for size, names in self.whole.get(above, {}).items():
                        if size <= length:
                            yield place, size, names
                    above = self.link[above]


class Index:
    """An automaton with the tables that tell which words can take part in a match."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        words = words_of([text.lower() for _, text in items], ALNUM)
        hashes = words.hashes()
        self.vocabulary = np.unique(hashes)
        ids = np.searchsorted(self.vocabulary, hashes)
        parts = np.split(ids, words.first[1:-1])
        self.automaton = Automaton(window).build([(name, p.tolist()) for (name, _), p in zip(items, parts)])
        same = np.diff(words.text_of()) == 0 if len(hashes) else np.empty(0, bool)
        self.base = len(self.vocabulary) + 1
        self.pairs = np.unique((ids[:-1] * self.base + ids[1:])[same])

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Word ids, -1 for words of no item."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def stretches(self, ids: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of words of one text that can hold a window: from, to."""
        if not len(ids):
            return
        joined = np.zeros(len(ids), bool)
        if len(self.pairs):
            pair = ids[:-1] * self.base + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[1:] = (self.pairs[at] == pair) & (ids[:-1] >= 0) & (ids[1:] >= 0) & (text[1:] == text[:-1])
        starts = np.flatnonzero(~joined)
        ends = np.append(starts[1:], len(ids))
        long = (ends - starts >= self.automaton.shortest) & (ids[starts] >= 0)
        yield from zip(starts[long].tolist(), ends[long].tolist())


def item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items with a text, in blocks of bounded size; each is fetched when it is asked for.

    An item of more than ``block_words`` words is in a block with others of its bucket only.
    """
    size = F.size(F.split(F.coalesce("text", F.lit("")), r"[^0-9A-Za-z\u0080-\x{10FFFF}]+")).cast("long")
    items = benchmark.where("text is not null").select(
        F.col("item_id").cast("string").alias("name"), F.col("text").cast("binary").alias("text"), size.alias("size"))
    # A running total over ranges of the item's hash: sums per bucket are few, whatever the items are.
    bucketed = items.withColumn("bucket", F.pmod(F.xxhash64("name", "text"), F.lit(65536)))
    totals = sorted((r.bucket, r.size) for r in bucketed.groupBy("bucket").agg(F.sum("size").alias("size")).collect())
    groups, room = [[]], block_words
    for bucket, words in totals:
        if groups[-1] and words > room:
            groups.append([])
            room = block_words
        groups[-1].append(bucket)
        room -= words
    for group in filter(None, groups):
        rows = bucketed.where(F.col("bucket").between(group[0], group[-1])).select("name", "text").collect()
        yield sorted(((r.name, bytes(r.text)) for r in rows), key=lambda item: (item[0] is None, item[0] or "", item[1]))


def _found(indexes, letters):
    """Of each text of a batch: number of words, hit places, item names."""
    for low, high, held in pieces(letters):
        words = words_of([t.lower() for t in held], ALNUM)
        hashes, text = words.hashes(), words.text_of()
        hit = np.zeros(len(hashes), bool)
        names: dict[int, set[str]] = {}
        for index in indexes:
            ids = index.ids(hashes)
            for start, end in index.stretches(ids, text):
                for place, size, items in index.automaton.stream(ids[start:end].tolist()):
                    hit[start + place - size + 1:start + place + 1] = True
                    names.setdefault(int(text[start]), set()).update(items)
        for i in range(high - low):
            yield words, i, hit[words.first[i]:words.first[i + 1]], names.get(i, set()) - {None}


def hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         block_words: int = BLOCK_WORDS, blocks_per_pass: int = BLOCKS_PER_PASS) -> DataFrame:
    """``documents`` with n_words, hit (places of hit words, sorted) and items (names, sorted).

    A NULL or empty text has no words. Rows with equal or NULL ids are judged one by one.
    Items without text or words match nothing; an empty benchmark hits nothing. An item with a
    NULL id hits words like any other and has no name among ``items``. Columns of ``documents``
    named as the new ones are replaced.
    """
    context = documents.sparkSession.sparkContext
    blocks = [context.broadcast(Index(block, window)) for block in item_blocks(benchmark, block_words)]
    passes = [blocks[i:i + blocks_per_pass] for i in range(0, len(blocks), blocks_per_pass)] or [[]]
    own = [c for c in documents.columns if c not in ("n_words", "hit", "items")]
    out = documents.select(*own).withColumns({
        "n_words": F.lit(0).cast("long"), "hit": F.lit([]).cast("array<int>"), "items": F.lit([]).cast("array<string>")})
    for held in passes:
        def run(batches, held=held):
            indexes = [block.value for block in held]
            for batch in batches:
                counts, places, names = [], [], []
                old_places, old_names = batch.column("hit").to_pylist(), batch.column("items").to_pylist()
                for i, (_, _, hit, items) in enumerate(_found(indexes, texts(batch))):
                    counts.append(len(hit))
                    found = np.flatnonzero(hit).tolist()
                    places.append(sorted({*old_places[i], *found}) if old_places[i] else found)
                    names.append(sorted({*old_names[i], *items}))
                new = {"n_words": pa.array(counts, pa.int64()), "hit": pa.array(places, pa.list_(pa.int32())),
                       "items": pa.array(names, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays(
                    [new.get(n, c) for n, c in zip(batch.schema.names, batch.columns)], names=batch.schema.names)

        out = out.mapInArrow(run, out.schema)
    return out


def decontaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   max_span: int = 0, max_coverage: float = 0.8, **sizes) -> DataFrame:
    """``documents`` without the passages of test items.

    A run of more than ``max_span`` hit words is cut out; a document of which more than
    ``max_coverage`` of the words are hit goes. Untouched texts stay as they are, letter by
    letter; n_chars, where present, follows the text.
    """
    columns = documents.columns
    marked = hits(documents.select(F.struct(*[c for c in columns if c != "text"]).alias("whole"), "text"), benchmark, window, **sizes)
    marked = marked.where(F.size("hit") <= F.lit(max_coverage) * F.col("n_words"))

    def run(batches):
        for batch in batches:
            out = []
            for text, places in zip(texts(batch), batch.column("hit").to_pylist()):
                out.append(cut(text, places, max_span) if places else text)
            values = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [values if n == "text" else c for n, c in zip(batch.schema.names, batch.columns)],
                names=batch.schema.names)

    new = {"text": F.col("text")}
    if "n_chars" in columns:
        new["n_chars"] = F.when(F.size("hit") == 0, F.col("whole.n_chars")).otherwise(F.length("text")).cast(
            documents.schema["n_chars"].dataType)
    return marked.mapInArrow(run, marked.schema).select(
        *(new.get(c, F.col("whole").getField(c)).alias(c) for c in columns))


def cut(text: bytes, places: list[int], max_span: int) -> bytes:
    """``text`` without its runs of more than ``max_span`` hit words."""
    words = words_of([text.lower()], ALNUM)
    hit = np.asarray(places)
    breaks = np.flatnonzero(np.diff(hit) > 1) + 1
    out, at = [], 0
    for run in np.split(hit, breaks):
        if len(run) > max_span:
            out.append(text[at:words.starts[run[0]]])
            at = words.ends[run[-1]]
    out.append(text[at:])
    return b"".join(out)


def digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Of each document: n_words, n_hit, n_items, items_sha256, contaminated."""
    found = hits(documents.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id", "n_words", F.size("hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"))
