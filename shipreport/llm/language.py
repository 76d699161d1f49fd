"""Language identification of mixed texts: word scores, and Viterbi over the words of a text.

A language's model counts hashed letter trigrams of words. A word's score for a language is
the sum of its trigrams' log likelihoods. The script of a word's first letter narrows the
candidates to languages that were learnt with that script; if there are none, all stay, and
so they do for scripts that are not listed here. Letters are those of Unicode, with the marks
that follow them. The
Viterbi path through a text's words pays a penalty for each switch of language, which gives
the spans. The language with the most letters is that of the text; the score is its share of
the letters, weighed by how much better it explains them than the next candidate does.

Counts are summed by Spark over a bounded sample of labelled rows: ``sample`` rows, and of
each language at least ``least`` rows or all it has. The languages of the sample are the
candidates, however many there are; a model has 2**BITS numbers for each. All texts of a
batch take the Viterbi steps together. A text longer than a batch (``batch_bytes``) is read
in blocks that end at white space, and the state of the path is carried over; per word only
the best language and one bit for each language are kept. A word that is longer than a block
is cut there and counts as several. Rows that repeat an id are rows of their own.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipreport.llm.common import fold, texts
from shipreport.llm.samples import in_share, share_of
from shipreport.llm.words import CHUNK_BYTES, SPACED, pieces, words_of

SAMPLE = 20_000
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: Trigrams of letters are hashed to this many bits.
BITS = 16
#: Log likelihood that a switch of language costs.
PENALTY = 4.0
#: Scores of words differ by no more than this between languages.
CLIP = 6.0
#: Rows of a language that are learnt at least, if it has so many.
LEAST = 200
#: Bytes of text times languages that are scored together.
CELLS = 1 << 22

#: First code points of scripts, in order; letters where there is 0 are of OTHER.
SCRIPTS = ((0x00, 0), (0x41, 1), (0x5B, 0), (0x61, 1), (0x7B, 0), (0xAA, 1), (0xAB, 0), (0xB5, 1), (0xB6, 0),
           (0xBA, 1), (0xBB, 0), (0xC0, 1), (0xD7, 0), (0xD8, 1), (0xF7, 0), (0xF8, 1), (0x370, 2), (0x400, 3),
           (0x530, 4), (0x590, 5), (0x600, 6), (0x700, 0), (0x900, 7), (0xE00, 8), (0xE80, 0), (0x10A0, 9),
           (0x1100, 10), (0x1200, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 11), (0x3100, 0),
           (0x3400, 12), (0xA000, 0), (0xAC00, 10), (0xD7B0, 0))
#: The script of letters of all other scripts, which keeps all candidates.
OTHER = 13
N_SCRIPTS = 14
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _scripts() -> tuple[np.ndarray, np.ndarray]:
    """Per code point the script of letters and marks, 0 for all else; and whether it is a mark."""
    kind = np.array([unicodedata.category(chr(i))[0] for i in range(0x110000)])
    listed = np.array([s[1] for s in SCRIPTS])[
        np.searchsorted([s[0] for s in SCRIPTS], np.arange(0x110000), side="right") - 1]
    script = np.where(np.isin(kind, ["L", "M"]), np.where(listed > 0, listed, OTHER), 0)
    return script.astype(np.int8), kind == "M"


_SCRIPT, _MARK = _scripts()


@dataclass
class Letters:
    """Words of texts as code points, with what is known of each."""

    text: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    grams: np.ndarray
    first_gram: np.ndarray


def letters_of(held: list[bytes]) -> Letters:
    """Words with their letters folded to lower case; other characters count as blanks."""
    lowered = [t.lower() if t.isascii() else t.decode("utf-8", "replace").lower().encode() for t in held]
    words = words_of(lowered, SPACED)
    points = np.frombuffer(words.data.decode("utf-8", "replace").encode("utf-32-le"), "<u4").astype(np.int64)
    # Places of code points: a byte that is no continuation starts one.
    raw = np.frombuffer(words.data, np.uint8)
    place = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    starts, ends = place[words.starts], place[words.ends]
    script, mark = _SCRIPT[points], _MARK[points]
    is_letter = script > 0
    if mark.any():  # a mark belongs to the letter before it
        base = np.maximum.accumulate(np.where(mark, 0, np.arange(len(points))))
        is_letter &= ~mark | is_letter[base] & ~mark[base]
    folded = np.where(is_letter, points, 32)
    gram = np.zeros(len(points), np.int64)
    gram[1:-1] = ((folded[:-2] * 0x9E3779B1 + folded[1:-1] * 0x85EBCA6B + folded[2:] * 0xC2B2AE35) >> 7) & (2 ** BITS - 1)
    gram[~is_letter] = -1
    sums = np.concatenate([[0], np.cumsum(is_letter)])
    n_letters = sums[ends] - sums[starts]
    places = np.flatnonzero(is_letter)
    first = np.searchsorted(places, starts)
    has = n_letters > 0
    word_script = np.zeros(len(starts), np.int64)
    word_script[has] = script[places[first[has]]]
    return Letters(words.text_of(), n_letters, word_script, gram[places], np.append(first, len(places)))


@dataclass
class Model:
    languages: list[str]
    #: Log likelihood per gram and language, and whether a language is written in a script.
    table: np.ndarray
    scripts: np.ndarray

    def word_scores(self, found: Letters) -> np.ndarray:
        """Per word and language; the best language of a word has 0."""
        sums = np.zeros((len(found.grams) + 1, len(self.languages)), np.float64)
        np.cumsum(self.table[found.grams], axis=0, out=sums[1:])
        first = found.first_gram
        scores = sums[first[:-1] + found.letters] - sums[first[:-1]]
        del sums
        allowed = self.scripts[found.script] | (found.script == OTHER)[:, None]
        allowed = allowed | ~allowed.any(1)[:, None]
        scores = np.where(allowed, scores, -np.inf)
        scores -= scores.max(1, initial=-np.inf)[:, None] if len(scores) else 0
        return np.where(found.letters[:, None] > 0, np.maximum(scores, -CLIP), 0.0)

    def paths(self, scores: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        """The language of each word on its text's best path."""
        counts = np.bincount(text, minlength=n)
        first = np.concatenate([[0], np.cumsum(counts)])[:-1]
        order = np.argsort(-counts, kind="stable")
        first, counts = first[order], counts[order]
        steps, width = int(counts.max(initial=0)), len(self.languages)
        back = np.zeros(scores.shape, np.int32)
        active = np.searchsorted(-counts, -np.arange(steps), side="left")  # texts with more than t words
        best = np.zeros((n, width))
        own = np.arange(width, dtype=np.int32)
        for t in range(steps):
            k = active[t]
            at = first[:k] + t
            if t:
                top = best[:k].argmax(1)
                switched = best[np.arange(k), top] - PENALTY
                stay = best[:k] >= switched[:, None]
                back[at] = np.where(stay, own, top[:, None])
                best[:k] = np.where(stay, best[:k], switched[:, None]) + scores[at]
            else:
                best[:k] = scores[at]
        path = np.zeros(len(scores), np.int64)
        state = best.argmax(1)
        for t in range(steps - 1, -1, -1):
            k = active[t]
            at = first[:k] + t
            path[at] = state[:k]
            if t:
                state[:k] = back[at, state[:k]]
        return path

    @property
    def batch_bytes(self) -> int:
        """Bytes of text that are scored together."""
        return min(CHUNK_BYTES, max(CELLS // max(len(self.languages), 1), 1 << 10))

    def long_path(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of one text, block by block: the language of each word on the best path, letters of words, sums of scores."""
        best, width = None, len(self.languages)
        sums, steps = np.zeros(width), []
        for block in blocks(text, self.batch_bytes):
            found = letters_of([block])
            scores = self.word_scores(found)
            sums += scores.sum(0)
            tops = np.zeros(len(scores), np.int32)
            stays = np.zeros((len(scores), width), bool)
            for t, row in enumerate(scores):
                if best is None:
                    best = row.copy()
                    continue
                top = best.argmax()
                switched = best[top] - PENALTY
                np.greater_equal(best, switched, out=stays[t])
                tops[t] = top
                best = np.maximum(best, switched) + row
                best -= best[top]  # values stay small, their differences are the same
            steps.append((tops, np.packbits(stays, axis=1), found.letters.astype(np.int32)))
        n = sum(len(tops) for tops, _, _ in steps)
        path = np.zeros(n, np.int32)
        state, at = int(best.argmax()) if n else 0, n
        for tops, stays, _ in reversed(steps):
            for t in range(len(tops) - 1, -1, -1):
                at -= 1
                path[at] = state
                if at and not stays[t, state >> 3] >> (7 - (state & 7)) & 1:
                    state = int(tops[t])
        return path, np.concatenate([x[2] for x in steps] or [np.empty(0, np.int32)]), sums

    def predict(self, held: list[bytes], spans: bool = False):
        """Per text the language, the score and, if asked for, its spans (language, first word, words)."""
        if not self.languages:
            return [(UNKNOWN, 0.0, [])] * len(held)
        size, out, short = self.batch_bytes, [None] * len(held), []
        for i, text in enumerate(held):
            if len(text) > size:
                path, letters, sums = self.long_path(text)
                share = np.bincount(path, letters, len(self.languages))
                out[i] = self._named(share, sums, path, spans)
            else:
                short.append(i)
        for low, high, some in pieces([held[i] for i in short], size):
            for i, found in zip(short[low:high], self._predict_short(some, spans)):
                out[i] = found
        return out

    def _predict_short(self, held: list[bytes], spans: bool):
        n, width = len(held), len(self.languages)
        found = letters_of(held)
        scores = self.word_scores(found)
        path = self.paths(scores, found.text, n)
        share = np.bincount(found.text * width + path, found.letters, n * width).reshape(n, width)
        sums = np.column_stack([np.bincount(found.text, scores[:, j], n) for j in range(width)]).astype(float)
        ends = np.concatenate([[0], np.cumsum(np.bincount(found.text, minlength=n))])
        return [self._named(share[i], sums[i], path[ends[i]:ends[i + 1]], spans) for i in range(n)]

    def _named(self, share: np.ndarray, sums: np.ndarray, path: np.ndarray, spans: bool):
        """The result of one text, from letters a language, sums of scores and the path."""
        total = share.sum()
        if not total:
            return UNKNOWN, 0.0, []
        best = int(share.argmax())
        # How much better the language explains the text's words than the next one does.
        others = np.delete(sums, best)
        margin = float(np.clip(sums[best] - others.max(), -CLIP, CLIP)) if len(others) else CLIP
        part = []
        if spans:
            cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
            part = [(self.languages[path[a]], a, b - a) for a, b in zip(cuts, cuts[1:])]
        return self.languages[best], float(share[best] / total / (1 + np.exp(-margin))), part


def blocks(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes that end at white space or, within longer words, at a character."""
    low = 0
    while low < len(text):
        high = low + size
        if high < len(text):
            blank = _BLANK.search(text, high, high + size)
            high = blank.start() if blank else min(high + size, len(text))
            while not blank and high < len(text) and text[high] & 0xC0 == 0x80:
                high += 1
        yield text[low:high]
        low = high


def learnt(documents: DataFrame, sample: int = SAMPLE, least: int = LEAST) -> Model:
    """Counts of a bounded sample of rows with text and language outside the held-out fold."""
    rows = documents.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
                           & (fold("doc_id", FOLDS) != HELD_OUT)).select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    share = share_of(rows.count(), sample)
    if share < 1:
        counts = rows.groupBy("lang").agg(F.count("*").alias("rows_of_lang"))
        place = F.xxhash64(F.col("doc_id").cast("long"), F.lit(29)) / F.lit(2.0 ** 64) + 0.5
        rows = rows.join(counts, "lang").where(
            in_share("doc_id", 23, share) | (place * F.col("rows_of_lang") < least)).select("doc_id", "lang", "text")
    width = 2 ** BITS + N_SCRIPTS

    def run(batches):
        for batch in batches:
            langs, number = np.unique(batch.column("lang").to_numpy(zero_copy_only=False), return_inverse=True)
            for low, _, held in pieces(texts(batch)):
                for i, part in parts_of(held):
                    found = letters_of(part)
                    of_word = number[low + i:low + i + len(part)][found.text]
                    has = found.letters > 0
                    cells, n = np.unique(np.concatenate([
                        np.repeat(of_word, found.letters) * width + found.grams,
                        of_word[has] * width + 2 ** BITS + found.script[has]]), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(langs[cells // width], pa.string()), pa.array(cells % width, pa.int64()), pa.array(n, pa.int64())],
                        names=["lang", "cell", "n"])

    def parts_of(held):
        """Texts together or, if there is but one, its blocks: number of the first text, texts."""
        if len(held) > 1:
            yield 0, held
        else:
            yield from ((0, [block]) for block in blocks(held[0], CHUNK_BYTES))

    counted = rows.select("lang", "text").mapInArrow(run, "lang string, cell bigint, n bigint").groupBy("lang", "cell").agg(
        F.sum("n").alias("n")).toArrow()  # at most the letters and words of the sample
    names, of = np.unique(np.array(counted["lang"].to_pylist(), object), return_inverse=True)
    names = names.tolist()
    if not names:
        return Model([], np.zeros((2 ** BITS, 0)), np.zeros((N_SCRIPTS, 0), bool))
    total = np.zeros((len(names), width))
    total[of, counted["cell"].to_numpy()] = counted["n"].to_numpy()
    # A language that the sample has no letter of would take all that the others have not seen.
    trained = total[:, :2 ** BITS].any(1)
    names, total = [name for name, t in zip(names, trained) if t], total[trained]
    grams, scripts = total[:, :2 ** BITS], total[:, 2 ** BITS:]
    table = np.log((grams + 0.1) / (grams.sum(1, keepdims=True) + 0.1 * 2 ** BITS))
    return Model(names, np.ascontiguousarray(table.T), (scripts > 0.01 * scripts.sum(1, keepdims=True)).T.copy())


def predicted(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with lang_pred, score and spans (language, first word, number of words).

    A NULL text, and one without letters, is ``und`` with score 0 and no spans.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    new = ("lang_pred", "score", "spans")
    rows = documents.drop(*new).withColumns({
        "lang_pred": F.lit(""), "score": F.lit(0.0),
        "spans": F.lit(None).cast("array<struct<lang:string,first_word:int,n_words:int>>")})

    def run(batches):
        for batch in batches:
            found = [x for _, _, held in pieces(texts(batch)) for x in shared.value.predict(held, spans=True)]
            kinds = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32())]))
            values = {"lang_pred": pa.array([x[0] for x in found], pa.string()),
                      "score": pa.array([x[1] for x in found], pa.float64()),
                      "spans": pa.array([[dict(zip(("lang", "first_word", "n_words"), s)) for s in x[2]] for x in found], kinds)}
            yield pa.RecordBatch.from_arrays(
                [values.get(n, c) for n, c in zip(batch.schema.names, batch.columns)], names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def digest(documents: DataFrame) -> DataFrame:
    found = predicted(documents.select("doc_id", "text"), learnt(documents))
    return found.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
