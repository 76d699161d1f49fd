"""Text quality by a generalised additive model with pairwise interactions.

Each feature of a text is put into one of at most ``bins`` bins with equally many training
rows. Shallow trees are boosted in turn, one feature after the other and round after round,
on the gradient and curvature of the logistic loss; a tree over the bins of one feature only
changes that feature's lookup table. Then the pairs of features that explain most of what is
left get tables of their own in the same way, from trees that split each of both features
once. A text's score is the logistic function of the sum of the table cells it falls in.

The model is learnt on the driver from a bounded sample of labelled rows (``sample`` rows);
only their features are fetched. The tables are a few kilobytes and are sent to all tasks,
which score whole batches with one indexed addition per table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipreport.llm.common import fold, texts
from shipreport.llm.samples import labelled_sample
from shipreport.llm.words import mix, pieces, window_starts, window_sums, words_of

SAMPLE = 20_000
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0

FEATURES = ("log_words", "word_length", "upper", "digits", "stops", "symbols", "marks", "wide", "lines",
            "distinct_words", "repeated_windows", "short_words", "words_of_no_letter", "upper_words")


def _classes() -> dict[str, np.ndarray]:
    byte = np.arange(256)
    upper, lower = (byte >= 65) & (byte <= 90), (byte >= 97) & (byte <= 122)
    digit, wide = (byte >= 48) & (byte <= 57), byte >= 128
    stops = np.isin(byte, list(b".,;:?'\"-()"))
    graphic = (byte > 32) & (byte < 127)
    return {"letter": upper | lower | wide, "upper": upper, "digit": digit, "stop": stops,
            "mark": np.isin(byte, list(b"!|")), "symbol": graphic & ~upper & ~lower & ~digit & ~stops,
            "wide": wide, "line": byte == 10}


_CLASS = _classes()
_WINDOW = 5


def _distinct(text: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """The number of distinct hashes of each text."""
    keys = np.sort(mix(hashes ^ mix(text.astype(np.uint64), 5), 6))
    # Distinct keys are counted per text by a second look at which of them start a run.
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    order = np.argsort(mix(hashes ^ mix(text.astype(np.uint64), 5), 6), kind="stable")
    return np.bincount(text[order][first], minlength=n)


def features(held: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text; an empty text has zeros only."""
    n = len(held)
    words = words_of(held)
    raw = np.frombuffer(words.data, np.uint8)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in held), np.int64, n))
    size = np.maximum(np.diff(ends, prepend=0) - 1, 1)

    def per_text(mask):
        sums = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return np.diff(sums[ends], prepend=0), sums

    count = {name: per_text(table[raw]) for name, table in _CLASS.items()}
    n_words = words.counts
    some, hashes, text = np.maximum(n_words, 1), words.hashes(), words.text_of()
    lengths = words.ends - words.starts
    inside = lambda name: count[name][1][words.ends] - count[name][1][words.starts]
    letters = inside("letter")
    starts = window_starts(words, _WINDOW)
    windows = np.bincount(text[starts], minlength=n)
    different = _distinct(text[starts], window_sums(hashes, _WINDOW)[starts], n)
    of_words = lambda mask: np.bincount(text[mask], minlength=n) / some
    columns = (
        np.log1p(n_words), np.bincount(text, lengths, n) / some, count["upper"][0] / size, count["digit"][0] / size,
        count["stop"][0] / size, count["symbol"][0] / size, count["mark"][0] / size, count["wide"][0] / size,
        count["line"][0] / some, _distinct(text, hashes, n) / some,
        np.where(windows > 0, 1 - different / np.maximum(windows, 1), 0), of_words(lengths <= 3),
        of_words(letters == 0), of_words((inside("upper") > 1) & (inside("upper") == letters - inside("wide"))))
    return np.where(n_words[:, None] > 0, np.column_stack(columns), 0.0)


@dataclass
class Model:
    """Bin edges and lookup tables."""

    edges: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0
    single: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]) \
            if self.edges else np.zeros((len(x), 0), int)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins, total = self.binned(x), np.full(len(x), self.intercept)
        for j, cells in enumerate(self.single):
            total += cells[bins[:, j]]
        for i, j, cells in self.pairs:
            total += cells[bins[:, i], bins[:, j]]
        return 1 / (1 + np.exp(-total))


#: Curvature that a leaf is shrunk by, and the least a leaf must hold.
_SHRINK, _LEAST = 1.0, 2.0


def _gain(g, h):
    return g * g / (h + _SHRINK)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf values per bin, of a tree grown best split first over ordered bins."""
    cut = [0, len(g)]
    sums_g, sums_h = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(cut) <= leaves:
        best, where = 1e-9, None
        for a, b in zip(cut, cut[1:]):
            at = np.arange(a + 1, b)
            if not len(at):
                continue
            left_h, right_h = sums_h[at] - sums_h[a], sums_h[b] - sums_h[at]
            gains = _gain(sums_g[at] - sums_g[a], left_h) + _gain(sums_g[b] - sums_g[at], right_h) \
                - _gain(sums_g[b] - sums_g[a], sums_h[b] - sums_h[a])
            gains[(left_h < _LEAST) | (right_h < _LEAST)] = 0
            if gains.max() > best:
                best, where = gains.max(), at[gains.argmax()]
        if where is None:
            break
        cut = sorted([*cut, where])
    out = np.zeros(len(g))
    for a, b in zip(cut, cut[1:]):
        out[a:b] = -(sums_g[b] - sums_g[a]) / (sums_h[b] - sums_h[a] + _SHRINK)
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cells of the best tree that splits both features of a table once."""
    sg, sh = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    total_g, total_h = sg[-1, -1], sh[-1, -1]

    def quadrants(s, total):
        low, left, up = s[:-1, :-1], s[:-1, -1:], s[-1:, :-1]
        return low, left - low, up - low, total - left - up + low

    gs, hs = quadrants(sg, total_g), quadrants(sh, total_h)
    gains = sum(_gain(a, b) for a, b in zip(gs, hs)) - _gain(total_g, total_h)
    gains = np.where(np.minimum.reduce(hs) < _LEAST / 2, 0, gains)
    i, j = np.unravel_index(gains.argmax(), gains.shape)
    cells = np.empty_like(g)
    values = [-a[i, j] / (b[i, j] + _SHRINK) for a, b in zip(gs, hs)]
    cells[:i + 1, :j + 1], cells[:i + 1, j + 1:], cells[i + 1:, :j + 1], cells[i + 1:, j + 1:] = values
    return float(gains[i, j]), cells


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 120, leaves: int = 3, rate: float = 0.1,
        pairs: int = 6, pair_rounds: int = 40) -> Model:
    """The model of features ``x`` and labels ``y`` (0 or 1); a constant if one class is missing."""
    if not len(y) or y.min() == y.max():
        prior = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return Model(intercept=float(np.log(prior / (1 - prior))))
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    model = Model(edges=[np.unique(np.quantile(x[:, j], quantiles)) for j in range(x.shape[1])])
    model.intercept = float(np.log(y.mean() / (1 - y.mean())))
    cells = [len(e) + 1 for e in model.edges]
    model.single = [np.zeros(c) for c in cells]
    binned, total = model.binned(x), np.full(len(y), model.intercept)
    slope = lambda: 1 / (1 + np.exp(-total))
    for _ in range(rounds):
        for j, c in enumerate(cells):
            p = slope()
            step = rate * _tree(np.bincount(binned[:, j], p - y, c), np.bincount(binned[:, j], p * (1 - p), c), leaves)
            model.single[j] += step
            total += step[binned[:, j]]

    def table(i, j):
        p, at = slope(), binned[:, i] * cells[j] + binned[:, j]
        shape = cells[i], cells[j]
        g, h = np.bincount(at, p - y, shape[0] * shape[1]), np.bincount(at, p * (1 - p), shape[0] * shape[1])
        return _cross(g.reshape(shape), h.reshape(shape))

    wide = [j for j in range(len(cells)) if cells[j] > 1]
    ranked = sorted(((table(i, j)[0], i, j) for i, j in combinations(wide, 2)), reverse=True)
    model.pairs = [(i, j, np.zeros((cells[i], cells[j]))) for gain, i, j in ranked[:pairs] if gain > 0]
    for _ in range(pair_rounds):
        for i, j, held in model.pairs:
            gain, step = table(i, j)
            if gain > 0:
                held += rate * step
                total += rate * step[binned[:, i], binned[:, j]]
    return model


def learnt(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of a bounded sample of labelled documents outside the held-out fold."""
    ids = labelled_sample(labels, "quality", FOLDS, HELD_OUT, sample)
    rows = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "label", "text")

    def run(batches):
        for batch in batches:
            for low, high, held in pieces(texts(batch)):
                x = features(held)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), batch.column("label").slice(low, high - low),
                     pa.array(x.tolist(), pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    found = rows.mapInArrow(run, "doc_id bigint, label int, x array<double>").toPandas().sort_values(
        "doc_id", kind="stable")
    x = np.array(found["x"].tolist(), float).reshape(len(found), len(FEATURES))
    order = np.lexsort([*x.T, found["label"], found["doc_id"]])  # rows of repeated ids in one order
    return fit(x[order], found["label"].to_numpy(float)[order])


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with score, the likelihood of label 1; a NULL text counts as empty."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.drop("score").withColumn("score", F.lit(0.0))

    def run(batches):
        for batch in batches:
            score = [shared.value.score(features(held)) for _, _, held in pieces(texts(batch))]
            values = pa.array(np.concatenate(score) if score else [], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [values if n == "score" else c for n, c in zip(batch.schema.names, batch.columns)],
                names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def good_documents(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches ``threshold``, with their own columns only."""
    columns = documents.columns
    marked = documents.select(F.struct(*[c for c in columns if c != "text"]).alias("row"), "text")
    good = scored(marked, model).where(F.col("score") >= threshold)
    return good.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns])


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    found = scored(documents.select("doc_id", "text"), learnt(documents, labels))
    return found.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
