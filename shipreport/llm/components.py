"""Connected components of a graph given by its links.

Each round every task first replaces the links it holds by a spanning forest (each node to
the least node it is joined with there), so that a node leaves a task with one link at most
and hubs shrink before the shuffle. Links are then brought together by their larger end,
joined up in the same way, and pointers are shortened by a join of the links with
themselves. Rounds end when the links no longer change; they are then stars around the
least node of each component. Nothing is collected but a count and a checksum.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipreport.llm.common import kept, partitions

#: Links a task joins up at a time.
CHUNK = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node it is joined with), one for each node that is not the least."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = np.arange(len(nodes))
    left, right = inverse[:len(a)], inverse[len(a):]
    while True:
        low, high = np.minimum(parent[left], parent[right]), np.maximum(parent[left], parent[right])
        open_ = low < high
        if not open_.any():
            break
        np.minimum.at(parent, high[open_], low[open_])
        while True:
            shorter = parent[parent]
            if np.array_equal(shorter, parent):
                break
            parent = shorter
    own = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[own], nodes[parent[own]]


def _joined_up(batches):
    """Forests of whole runs of ``node``; rows come sorted by it or in any order."""
    held_a, held_b, size = [], [], 0
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        while size + len(a) >= CHUNK:
            # Cut where the node changes, so that the links of a node stay together.
            change = np.flatnonzero(a[1:] != a[:-1]) + 1
            if not len(change):
                break
            at = change[min(np.searchsorted(change, max(CHUNK - size, 1)), len(change) - 1)]
            yield _batch([*held_a, a[:at]], [*held_b, b[:at]])
            held_a, held_b, size, a, b = [], [], 0, a[at:], b[at:]
        held_a.append(a)
        held_b.append(b)
        size += len(a)
    if size:
        yield _batch(held_a, held_b)


def _batch(a, b):
    node, root = forest(np.concatenate(a), np.concatenate(b))
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(root, pa.int64())], names=["node", "root"])


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, root) of each node that is not the least of its component, from links (a, b).

    Links may repeat, point either way or join a node to itself; NULL ends are ignored.
    """
    schema = "node bigint, root bigint"
    parts = partitions(links.sparkSession)
    now = links.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").cast("long").alias("node"), F.least("a", "b").cast("long").alias("root"))
    before = None
    for _ in range(rounds):
        met = now.mapInArrow(_joined_up, schema).repartition(parts, "node").sortWithinPartitions("node").mapInArrow(
            _joined_up, schema)
        if before is not None:
            # From the second round on, met is nearly flat and its roots' own links are few.
            met = kept(met)
            up = met.groupBy(F.col("node").alias("root")).agg(F.min("root").alias("above"))
            met = met.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
        now = kept(met)
        found = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)")).alias("s"),
                        F.count_distinct("node").alias("d")).first()
        if (found.n, found.s) == before and found.n == found.d:
            return now
        before = (found.n, found.s)
    raise RuntimeError("components did not settle")
