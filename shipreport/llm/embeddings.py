"""Near-duplicate vectors by sorted projection passes.

Only vectors of one label and one length are compared. Equal vectors are one class first.
Pairs with a cosine of at least ``threshold`` in double precision are links, and links are
united into components. The classes of a label and length are a group.

In each pass a vector's sides of random hyperplanes through the group's mean, concatenated,
are its key; classes are sorted by key, and each is compared with the ``width`` classes after
it. The sorted order is dealt out in blocks that overlap by one window, so nothing is lost
between tasks. A group of at most ``width + 1`` classes is compared whole by its first pass
and takes part in no other.

Passes: two vectors at the threshold, seen from the mean, fall on the same side of a
hyperplane with a probability p that follows from the vector's distance to the mean. A link
is surely in the window if the two share one side more than the vector shares with the class
``width`` places after it. These shared sides, c, are measured in the first passes, and
p**(c + 1) of the one class in a hundred where it is least is taken for the group; where the
class ``width`` places after is itself a link, links hold the whole stretch together. A group
takes part in as many passes as bring the chance of missing a link there,
(1 - p**(c + 1))**passes, under ``miss``, in at least those that evenly spread vectors need
and, at first, in no more than ``most``. Then all groups go on, in rounds of passes, until a round
unites no two components. So only a pair that is joined by no other links can be missed, and
it then counts as no link.

Every link of a vector lies inside its component. So the number of links is not taken from
the passes, whose windows are bounded, but counted over all pairs of a component, in square
blocks that are tasks of their own. A component that holds a third of all rows is spread
over as many blocks as it needs.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipreport.llm.common import groups, kept, partitions
from shipreport.llm.components import components, forest

THRESHOLD = 0.93
WIDTH = 64
MISS = 0.003
#: Passes that are sorted together; the others wait, so that they need no room on disk.
AT_ONCE = 8
#: Classes of a block in a pass, and of a side of a square of pairs.
BLOCK, SIDE = 2048, 512
#: Passes that a group's measured density can ask for; rounds that still unite something follow.
MOST = 128
#: Classes of a group that one copy of its mean serves.
SERVED = 65_536
#: Classes between two whose windows are measured, and the share of classes that may be denser.
EVERY, DENSEST = 16, 0.01
_BITS = 63
_GROUP = ["label", "dims"]


def _plain(vectors: DataFrame) -> Column:
    """The vector in its own precision, without negative zeros."""
    single = vectors.schema["embedding"].dataType.elementType.simpleString() == "float"
    return F.expr(f"transform(embedding, x -> {'x + 0F' if single else 'double(x) + 0D'})")


def _classes(vectors: DataFrame) -> DataFrame:
    """Equal usable vectors of one label: least id, number of rows, vector."""
    sound = ("vec_id is not null and label is not null and embedding is not null and size(embedding) > 0"
             " and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
             " and exists(embedding, x -> x <> 0)")
    rows = vectors.where(sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        _plain(vectors).alias("vector"))
    return rows.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow or underflow of squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _groups(classes: DataFrame) -> DataFrame:
    """Each group with its size n and the mean of its unit vectors; ``classes`` with dims."""
    def run(batches):
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            dims = batch.column("dims").to_numpy()
            for label, d in set(zip(labels.tolist(), dims.tolist())):
                at = np.flatnonzero((labels == label) & (dims == d))
                total = _unit(_matrix(batch.column("vector").take(pa.array(at)))).sum(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * d, pa.string()), pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)),
                     pa.array(total), pa.array(np.full(d, len(at), np.int64))], names=["label", "dims", "place", "total", "n"])

    rows = classes.select(*_GROUP, "vector").mapInArrow(run, "label string, dims int, place int, total double, n bigint")
    places = rows.groupBy(*_GROUP, "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return places.groupBy(*_GROUP).agg(
        F.max("n").alias("n"),
        F.transform(F.sort_array(F.collect_list(F.struct("place", (F.col("total") / F.col("n")).alias("mean")))),
                    lambda x: x["mean"]).alias("mean"))


def _met(classes: DataFrame, groups_: DataFrame) -> DataFrame:
    """``classes`` with the columns of their group, which is copied as often as its size asks for."""
    copies = groups_.withColumn("copy", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / SERVED).cast("int"))))
    counts = groups_.where(F.col("n") >= SERVED).select(*_GROUP, (F.floor(F.col("n") / SERVED) + 1).alias("copies"))
    # One row for each 65,536 classes at most, so Spark broadcasts it or not by its size.
    dealt = classes.join(counts, _GROUP, "left").withColumn(
        "copy", F.pmod(F.xxhash64("rep"), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
    return dealt.join(copies, [*_GROUP, "copy"])


def _keyed(met: DataFrame, numbers: range, threshold: float) -> DataFrame:
    """``met`` once for each pass under its ``wanted``, with its key and the chance to share a side with a link."""
    apart = math.sqrt(2 - 2 * threshold)

    def run(batches):
        for batch in batches:
            dims, wanted = batch.column("dims").to_numpy(), batch.column("wanted").to_numpy()
            seen, same = [], np.zeros(len(dims))
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                take = pa.array(at)
                x = _unit(_matrix(batch.column("vector").take(take))) - _matrix(batch.column("mean").take(take))
                seen.append((d, at, x))
                radius = np.maximum(np.sqrt((x * x).sum(1)), 1e-9)
                same[at] = 1 - 2 * np.arcsin(np.minimum(apart / 2 / radius, 1)) / math.pi
            for number in numbers:
                keys = np.zeros(len(dims), np.int64)
                for d, at, x in seen:
                    planes = np.random.default_rng([number, d]).standard_normal((d, _BITS))
                    keys[at] = (x @ planes > 0) @ (1 << np.arange(_BITS, dtype=np.int64)[::-1])
                of = pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(dims), number, np.int32)), batch.column("label"), batch.column("dims"),
                     pa.array(keys), batch.column("rep"), pa.array(same), batch.column("vector")],
                    names=["pass", "label", "dims", "key", "rep", "same", "vector"])
                yield of.filter(pa.array(wanted > number))

    kind = met.schema["vector"].dataType.simpleString()
    return met.select(*_GROUP, "rep", "vector", "mean", "wanted").mapInArrow(
        run, f"pass int, label string, dims int, key bigint, rep bigint, same double, vector {kind}")


def _blocks(ordered: DataFrame, width: int, block: int) -> DataFrame:
    """Rows of a sorted frame with their rank, dealt to blocks that overlap by ``width`` rows."""
    counts = {r.part: r["n"] for r in ordered.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect()}
    offset, total = {}, 0
    for part in sorted(counts):
        offset[part], total = total, total + counts[part]
    names = ordered.columns

    def run(batches):
        from pyspark import TaskContext

        rank = offset.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            ranks = np.arange(rank, rank + batch.num_rows)
            rank += batch.num_rows
            again = np.flatnonzero((ranks % block < width) & (ranks >= block))
            at = np.concatenate([np.arange(batch.num_rows), again])
            blocks = np.concatenate([ranks // block, ranks[again] // block - 1])
            part = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(ranks[at]), *part.columns],
                                             names=["block", "rank", *names])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema.fields)
    return ordered.mapInArrow(run, f"block bigint, rank bigint, {fields}")


def _pass_links(blocks: DataFrame, threshold: float, width: int) -> DataFrame:
    """A spanning forest (a, b) of the links found in each block, and rows with the measured reach.

    The reach of a class is the chance that a link at the threshold is surely in its window.
    """
    spread = blocks.repartition(partitions(blocks.sparkSession), "block").sortWithinPartitions("block", "rank")
    schema = "a bigint, b bigint, label string, dims int, reach double"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.float64()]

    def batch(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=["a", "b", "label", "dims", "reach"])

    def run(batches):
        for rows in groups(batches, ["block"]):
            labels = rows["label"].to_numpy(zero_copy_only=False)
            dims, reps, number = rows["dims"].to_numpy(), rows["rep"].to_numpy(), rows["pass"].to_numpy()
            keys, same = rows["key"].to_numpy(), rows["same"].to_numpy()
            vectors = rows["vector"].combine_chunks()
            change = np.flatnonzero((labels[1:] != labels[:-1]) | (dims[1:] != dims[:-1])
                                    | (number[1:] != number[:-1])) + 1
            left, right = [], []
            for a, b in zip([0, *change.tolist()], [*change.tolist(), len(reps)]):
                unit = _unit(_matrix(vectors.slice(a, b - a)))
                for low in range(0, b - a, width):
                    near = unit[low:low + width] @ unit[low:low + 2 * width].T
                    i, j = np.nonzero(near >= threshold)
                    ahead = (j > i) & (j <= i + width)
                    left.append(reps[a + low + i[ahead]])
                    right.append(reps[a + low + j[ahead]])
                at = np.arange(a, b - width, EVERY)
                if len(at):
                    shared = _BITS - np.frexp((keys[at] ^ keys[at + width]).astype(float))[1]
                    held = (unit[at - a] * unit[at + width - a]).sum(1) >= threshold
                    reach = np.where(held, 1.0, same[at] ** np.minimum(shared + 1, _BITS))
                    none = [None] * len(at)
                    yield batch(none, none, [labels[a]] * len(at), [dims[a]] * len(at), reach)
            if left:
                node, root = forest(np.concatenate(left), np.concatenate(right))
                none = [None] * len(node)
                yield batch(node, root, none, none, none)

    return spread.mapInArrow(run, schema)


def passes_for(rows: int, threshold: float, width: int, miss: float) -> int:
    """Passes for vectors that spread evenly over all sides: the least that are made."""
    if rows <= width + 1:
        return 1
    same = 1 - math.acos(threshold) / math.pi
    sides = max(0.0, math.log2(max(rows, 1) / width)) + 1
    return max(2, math.ceil(math.log(miss) / math.log1p(-same ** sides)))


def _least_passes(n: Column, threshold: float, width: int, miss: float) -> Column:
    """``passes_for`` of a column."""
    same = 1 - math.acos(threshold) / math.pi
    sides = F.greatest(F.lit(0.0), F.log2(n / width)) + 1
    passes = F.ceil(F.lit(math.log(miss)) / F.log1p(-F.pow(F.lit(same), sides)))
    return F.when(n <= width + 1, 1).otherwise(F.greatest(F.lit(2), passes)).cast("int")


def _roots(classes: DataFrame, threshold: float, width: int, miss: float, block: int, most: int) -> DataFrame:
    """(node, root) of each class that is not the least of its component."""
    session = classes.sparkSession
    sized = classes.select("rep", "label", "vector", F.size("vector").alias("dims"))
    groups_ = kept(_groups(sized).withColumn("wanted", _least_passes(F.col("n"), threshold, width, miss)))
    last = groups_.agg(F.max("wanted").alias("w")).first().w or 0
    order = ["pass", "label", "dims", "key", "rep"]
    waiting, joined, first = [], None, 0
    while True:
        if first >= last:  # the planned passes are made; more, for all groups that one window does not hold
            large = groups_.where(F.col("n") > width + 1).withColumn("wanted", F.lit(2 ** 31 - 1))
            met = _met(sized, large)
        else:
            met = _met(sized, groups_.where(F.col("wanted") > first))
        ordered = _keyed(met, range(first, first + AT_ONCE), threshold).repartitionByRange(partitions(session), *order)
        found = kept(_pass_links(_blocks(kept(ordered.sortWithinPartitions(*order)), width, block), threshold, width))
        links = found.where("a is not null").select("a", "b")
        if not first:
            reach = found.where("reach is not null").groupBy(*_GROUP).agg(F.percentile_approx("reach", DENSEST).alias("reach"))
            need = F.when(F.col("reach") >= 1, 0).when(F.col("reach") <= 0, most).otherwise(
                F.least(F.ceil(F.lit(math.log(miss)) / F.log1p(-F.col("reach"))), F.lit(most)))
            groups_ = kept(groups_.join(reach, _GROUP, "left").withColumn(
                "wanted", F.greatest("wanted", F.coalesce(need, F.lit(0))).cast("int")).drop("reach"))
            last = groups_.agg(F.max("wanted").alias("w")).first().w or 0
        first += AT_ONCE
        waiting.append(links)
        if first < last:
            continue
        roots = components(reduce(DataFrame.unionByName, waiting))
        waiting = [roots.select(F.col("node").alias("a"), F.col("root").alias("b"))]
        before, joined = joined, roots.count()
        # In one pass small groups are whole; otherwise a round over all large groups must bring nothing.
        if last <= 1 or joined == before:
            return roots


def _counts(members: DataFrame, threshold: float, side: int) -> DataFrame:
    """Links of each class with other classes of its component, weighed by their copies.

    ``members``: component, rep, copies, vector.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("n"))
    dealt = members.join(sizes, "component").withColumn("parts", F.ceil(F.col("n") / side).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    squares = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "copies", "vector")
    keys = ["component", "i", "j"]
    spread = squares.repartition(partitions(members.sparkSession), *keys).sortWithinPartitions(*keys, "own", "rep")

    def run(batches):
        for rows in groups(batches, keys):
            own, reps, copies = rows["own"].to_numpy(), rows["rep"].to_numpy(), rows["copies"].to_numpy()
            unit = _unit(_matrix(rows["vector"].combine_chunks()))
            i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
            a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
            found = np.zeros(len(reps), np.int64)
            for low in range(0, len(a), side):
                part = a[low:low + side]
                near = unit[part] @ unit[b].T >= threshold
                if i == j:
                    near &= part[:, None] != b[None, :]
                found[part] += near @ copies[b]
                if i != j:
                    found[b] += copies[part] @ near
            yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(found)], names=["rep", "links"])

    return spread.mapInArrow(run, "rep bigint, links bigint").groupBy("rep").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, miss: float = MISS,
                    block: int = BLOCK, side: int = SIDE, most: int = MOST) -> DataFrame:
    """Each row of ``vectors`` (vec_id only) with n_links, component_id and kept.

    Rows whose id, label or vector is NULL, and vectors of zeros or with NULL or non-finite
    components, link with nothing; a row without id has a NULL component. Equal vectors of a
    label are links of each other. Rows that repeat an id are rows of their own.
    """
    classes = kept(_classes(vectors))
    roots = _roots(classes, threshold, width, miss, block, most)
    of_class = classes.select("rep", "label", "vector", "copies").join(
        roots.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn("component", F.coalesce("root", "rep"))
    joined = roots.select(F.col("node").alias("rep"), F.col("root").alias("component")).unionByName(
        roots.select(F.col("root").alias("rep"), F.col("root").alias("component")).distinct())
    members = joined.join(classes.select("rep", "copies", "vector"), "rep")
    linked = of_class.select("rep", "component", "label", "vector", "copies").join(
        _counts(members, threshold, side), "rep", "left").select(
        "label", "vector", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          _plain(vectors).alias("vector"))
    out = rows.join(linked, ["label", "vector"], "left")
    component = F.coalesce("component", "vec_id")
    own = F.col("vec_id").isNotNull()
    return out.select(
        "vec_id", F.when(own, F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        F.when(own, component).alias("component_id"), F.when(own, F.col("vec_id") == component).alias("kept"))


def digest(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors)
