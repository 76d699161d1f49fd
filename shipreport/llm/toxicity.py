"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are lower-cased. A text's features are the distinct hashes of its words, of pairs of
neighbours and of pairs with one word between. FTRL-proximal keeps a rate per coordinate and
drives weights that are not needed to exactly zero by an L1 penalty, so what is left is a
short list of coordinates and weights that is sent to all tasks.

The weights are learnt on the driver, in one order of a bounded sample of labelled rows
(``sample`` rows), of which only the hashed coordinates are fetched. Scoring looks up all
coordinates of a batch at once and adds the weights of each text's distinct ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipreport.llm.common import fold, texts
from shipreport.llm.samples import labelled_sample
from shipreport.llm.words import ALNUM, mix, pieces, words_of

SAMPLE = 12_000
THRESHOLD = 0.5
FOLDS, HELD_OUT = 5, 0
#: Coordinates are this many bits of the hashes.
BITS = 22
#: Coordinates of fewer sample rows than this are left out.
LEAST_ROWS = 3


def coordinates(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The text and the coordinate of each feature, repeats included."""
    words = words_of([t.lower() for t in held], ALNUM)
    hashes, text = words.hashes(), words.text_of()
    texts_, found = [text], [mix(hashes, 20)]
    for gap in (1, 2):
        same = np.flatnonzero(text[gap:] == text[:-gap]) if len(text) > gap else np.empty(0, np.int64)
        texts_.append(text[same])
        found.append(mix(hashes[same] * np.uint64(2 * gap + 1) ^ mix(hashes[same + gap], 21), 22 + gap))
    return np.concatenate(texts_), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    """Weights of the coordinates that have one."""

    bias: float
    places: np.ndarray
    weights: np.ndarray

    def score(self, held: list[bytes]) -> np.ndarray:
        text, at = coordinates(held)
        total = np.full(len(held), self.bias)
        if len(self.places):
            near = np.minimum(np.searchsorted(self.places, at), len(self.places) - 1)
            known = self.places[near] == at
            distinct = np.unique(text[known] * np.int64(len(self.places)) + near[known])
            total += np.bincount(distinct // len(self.places), self.weights[distinct % len(self.places)], len(held))
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def fit(rows: list[np.ndarray], y: np.ndarray, alpha: float = 1.0, beta: float = 1.0, l1: float = 4.0,
        l2: float = 0.1, epochs: int = 5, seed: int = 7) -> Model:
    """FTRL-proximal over distinct coordinates per row, all of value 1, in a shuffled order.

    A coordinate that fewer than ``LEAST_ROWS`` rows have is left out. Coordinate 2**BITS is
    the bias, which bears no L1 penalty. With one class only, or no rows, the score is constant.
    """
    if not len(y) or y.min() == y.max():
        prior = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return Model(float(np.log(prior / (1 - prior))), np.empty(0, np.int64), np.empty(0))
    in_rows = np.zeros(2 ** BITS + 1, np.int32)
    for at in rows:
        in_rows[at] += 1
    rows = [at[(in_rows[at] >= LEAST_ROWS) | (at == 2 ** BITS)] for at in rows]
    z, n = np.zeros(2 ** BITS + 1), np.zeros(2 ** BITS + 1)
    penalty = np.full(2 ** BITS + 1, l1)
    penalty[-1] = 0

    def weights(at):
        held = z[at]
        return np.where(np.abs(held) <= penalty[at], 0, -(held - np.sign(held) * penalty[at]) / ((beta + np.sqrt(n[at])) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at = rows[i]
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -50, 50))) - y[i]
            before = n[at]
            n[at] = before + g * g
            z[at] += g - (np.sqrt(n[at]) - np.sqrt(before)) / alpha * w
    w = weights(np.arange(2 ** BITS + 1))
    places = np.flatnonzero(w[:-1])
    return Model(float(w[-1]), places, w[places])


def learnt(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    ids = labelled_sample(labels, "toxic", FOLDS, HELD_OUT, sample)
    rows = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "label", "text")

    def run(batches):
        for batch in batches:
            for low, high, held in pieces(texts(batch)):
                text, at = coordinates(held)
                distinct = np.unique(text * np.int64(2 ** BITS) + at)
                parts = np.split((distinct % 2 ** BITS).astype("<i4"), np.searchsorted(distinct >> BITS, np.arange(1, high - low)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), batch.column("label").slice(low, high - low),
                     pa.array([p.tobytes() for p in parts], pa.binary())], names=["doc_id", "label", "x"])

    found = rows.mapInArrow(run, "doc_id bigint, label int, x binary").toArrow().sort_by([("doc_id", "ascending")])
    keyed = sorted(zip(found["doc_id"].to_pylist(), found["label"].to_pylist(), found["x"].to_pylist()))
    bias = np.array([2 ** BITS], np.int32)
    return fit([np.concatenate([np.frombuffer(x, "<i4"), bias]) for _, _, x in keyed],
               np.array([y for _, y, _ in keyed], float))


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with score, the likelihood of label 1; a NULL text counts as empty."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.drop("score").withColumn("score", F.lit(0.0))

    def run(batches):
        for batch in batches:
            score = [shared.value.score(held) for _, _, held in pieces(texts(batch))]
            values = pa.array(np.concatenate(score) if score else [], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [values if n == "score" else c for n, c in zip(batch.schema.names, batch.columns)],
                names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    found = scored(documents.select("doc_id", "text"), learnt(documents, labels))
    return found.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
