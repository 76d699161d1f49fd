"""Near-duplicate documents: a size-aware heavy-light join on word shingles.

A document's set is its distinct runs of ``shingle`` lower-cased words; two sets link when
their Jaccard similarity reaches ``percent`` / 100. All steps are exact:

1. **Classes.** Equal sets are one class, whatever their number.
2. **Order.** All tokens have one global order: those that repeat least first. Repeats are
   looked for within runs of ``NEAR_BYTES`` of every text and added up over all runs; the
   ``HOT`` most frequent are kept as a bounded list, the others count as rare. The order
   decides the cost only, not the result. Of a set of n tokens every partner
   holds at least ``need(n)``, so among the first n - need(n) + c tokens of both sets at
   least c are common.
3. **Light sets** (few tokens) list all pairs of their first n - need(n) + 2 tokens, subsets
   of fixed size 2, and meet under a common pair.
4. **Heavy sets** list their first n - need(n) + 1 tokens singly, and so do the light sets
   that are large enough to be partners of heavy ones; they meet in the inverted lists. The
   size at which sets become heavy is chosen by the cost of both ways, from the histogram of
   sizes and the number of partners a token brings.
5. **Bound.** Each set has a bitmap of at least two bits per token, made where the set is first
   read, in which every token flips one bit. The bits in which two bitmaps differ are no more than the tokens that
   only one set holds, so too many of them rule a pair out, exactly and without the texts.
   Pairs of lists of up to ``LONG`` classes are listed and ruled out by a join; longer lists
   are compared in squares of ``SIDE`` by ``SIDE`` bitmaps, which are tasks of their own and
   give out only what they keep.
6. **Check.** What is left is checked on whole texts in two rounds: first each class with the
   candidate whose bitmap is nearest, and of each square a spanning forest of the nearest
   candidates, which joins up groups of copies; then all candidates that are still in
   different components. So texts are fetched only of classes that bitmaps leave a candidate,
   about once per class however large a group of near copies is, and no candidate is dropped.
   Up to ``IDS`` wanted ids are broadcast, so that no other text is shuffled; more are joined
   by a shuffle.

Shingles are told apart by 64-bit hashes, equal sets by 128 bits and their size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipreport.llm.common import gathered, groups, kept, partitions, texts
from shipreport.llm.components import components
from shipreport.llm.words import SPACED, mix, pieces, window_starts, window_sums, words_of

SHINGLE, PERCENT = 5, 80
#: Tokens whose frequency orders them; the others come first, by their hash.
HOT = 1 << 18
#: Classes in a list from which on its pairs are taken in two rounds.
LONG = 24
#: Bytes of text in which equal sets and repeated tokens are found without a shuffle.
NEAR_BYTES = 8 << 20
#: Rows of inverted lists a task looks at together; all classes of a longer list meet in squares.
ROWS = 1 << 20
#: Ids (8 bytes each) that are broadcast to fetch their texts.
IDS = 1 << 21
#: Classes of a long list that are compared with as many others by one task.
SIDE = 1024


def shingles(held: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The text and hash of each distinct shingle, sorted by both."""
    words = words_of([t.lower() for t in held], SPACED)
    hashes, counts = words.hashes(), words.counts
    starts = window_starts(words, k)
    text, found = [words.text_of()[starts]], [window_sums(hashes, k)[starts]]
    for short in range(1, k):
        of = np.flatnonzero(counts == short)
        if len(of):
            text.append(of)
            found.append(mix(window_sums(hashes, short)[words.first[of]], 30 + short))
    text, found = np.concatenate(text), np.concatenate(found)
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
    return text[new], found[new]


def _fingerprints(text: np.ndarray, found: np.ndarray, n: int):
    """Size of each set and two sums over it."""
    size = np.bincount(text, minlength=n)
    ends = np.cumsum(size)
    out = [size]
    for seed in (40, 41):
        sums = np.zeros(len(found) + 1, np.uint64)
        np.cumsum(mix(found, seed), out=sums[1:])
        out.append((sums[ends] - sums[ends - size]).view(np.int64))
    return out


def need(n, percent: int):
    """The tokens that a set of ``n`` and any partner have in common at least."""
    return -(-percent * n // 100)


def _bitmap(tokens: np.ndarray) -> bytes:
    """A set's bitmap: each token flips one of at least two bits per token."""
    size = max(256, 1 << (2 * len(tokens) - 1).bit_length()) if len(tokens) else 256
    flips = np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def _sized(documents: DataFrame, k: int) -> DataFrame:
    """Size, two sums and the bitmap of each row's set; no bitmap where the set is empty."""
    def run(batches):
        for batch in batches:
            for low, high, held in pieces(texts(batch)):
                text, found = shingles(held, k)
                n, f1, f2 = _fingerprints(text, found, high - low)
                bits = [_bitmap(part) if len(part) else None for part in np.split(mix(found, 60), np.cumsum(n)[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(n, pa.int64()), pa.array(f1), pa.array(f2),
                     pa.array(bits, pa.binary())], names=["doc_id", "n", "f1", "f2", "bits"])

    return documents.mapInArrow(run, "doc_id bigint, n bigint, f1 bigint, f2 bigint, bits binary")


def _distinct_sets(batch: pa.RecordBatch, k: int):
    """Tokens of the sets of a batch without repeats: set number, token, size and f1 of each set."""
    text, found, sizes, f1s, f2s, base = [], [], [], [], [], 0
    for low, high, held in pieces(texts(batch)):
        t, h = shingles(held, k)
        n, f1, f2 = _fingerprints(t, h, high - low)
        text.append(t + base)
        found.append(h)
        sizes.append(n)
        f1s.append(f1)
        f2s.append(f2)
        base += high - low
    text, found, n, f1, f2 = map(np.concatenate, (text, found, sizes, f1s, f2s))
    _, first = np.unique(np.stack([f1, f2, n]), axis=1, return_index=True)
    own = np.zeros(len(n), bool)
    own[first] = True
    own &= n > 0
    number = np.cumsum(own) - 1
    tokens = own[text]
    return number[text[tokens]], found[tokens], n[own], f1[own]


def _repeats(documents: DataFrame, k: int) -> DataFrame:
    """Tokens that several sets nearby hold, with the number of sets."""
    def run(batches):
        for batch in gathered(batches, NEAR_BYTES):
            _, found, _, _ = _distinct_sets(batch, k)
            token, count = np.unique(found, return_counts=True)
            more = count > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[more].view(np.int64)), pa.array(count[more], pa.int64())], names=["token", "n"])

    return documents.mapInArrow(run, "token bigint, n bigint")


def frequent(documents: DataFrame, k: int, limit: int = HOT) -> tuple[np.ndarray, np.ndarray]:
    """At most ``limit`` of the tokens that repeat most, sorted, and their counts."""
    counted = kept(_repeats(documents, k).groupBy("token").agg(F.sum("n").alias("n")))
    size = F.least("n", F.lit(100_000))
    histogram = sorted(((r.size, r.tokens) for r in counted.groupBy(size.alias("size")).agg(
        F.count("*").alias("tokens")).collect()), reverse=True)
    total, least = 0, None
    for size_, tokens in histogram:
        total += tokens
        if total > limit:
            break
        least = size_
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    rows = counted.where(F.col("n") >= least).toArrow()
    token, n = rows["token"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(token)
    return token[order], n[order]


def boundary(sizes: dict[int, int], partners: float, percent: int) -> int:
    """The largest size of light sets, by the cost of pairs of tokens and of single tokens.

    ``sizes``: sets of each size. A listed row costs 1, a partner it brings 1 more; under a
    pair of tokens the partners of a single token are as good as gone.
    """
    def cost(b):
        pairs = singles = 0
        for n, many in sizes.items():
            p = n - need(n, percent) + 2
            if n <= b:
                pairs += many * p * (p - 1) // 2
            if n >= need(b + 1, percent):
                singles += many * (p - 1)
        return pairs + singles * (1 + partners)

    return min(range(4, 129), key=cost)


def _postings(documents: DataFrame, k: int, percent: int, light: int, hot) -> DataFrame:
    """Rows (key, f1, n) of inverted lists; keys of pairs of tokens are even, of tokens odd."""
    shared = documents.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        hot_token, hot_count = shared.value
        for batch in gathered(batches, NEAR_BYTES):
            number, found, n, f1 = _distinct_sets(batch, k)
            if not len(n):
                continue
            rank = np.zeros(len(found), np.int64)
            if len(hot_token):
                at = np.minimum(np.searchsorted(hot_token, found), len(hot_token) - 1)
                rank = np.where(hot_token[at] == found, hot_count[at], 0)
            order = np.lexsort((found, rank, number))
            number, found = number[order], found[order]
            first = np.cumsum(n) - n
            place = np.arange(len(found)) - first[number]
            prefix = n - need(n, percent)
            single = (place < prefix[number] + 1) & (n[number] >= need(light + 1, percent))
            keys, owners = [found[single] | np.uint64(1)], [number[single]]
            lights = (n <= light) & (n >= 4)
            for p in np.unique(prefix[lights] + 2).tolist():
                of = np.flatnonzero(lights & (prefix + 2 == p))
                tokens = found[first[of][:, None] + np.arange(p)]
                i, j = np.triu_indices(p, 1)
                key = mix(tokens[:, i] * np.uint64(3) ^ mix(tokens[:, j], 50), 51) & ~np.uint64(1)
                keys.append(key.ravel())
                owners.append(np.repeat(of, len(i)))
            key, owner = np.concatenate(keys), np.concatenate(owners)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(f1[owner]), pa.array(n[owner], pa.int32())], names=["key", "f1", "n"])

    return documents.mapInArrow(run, "key bigint, f1 bigint, n int")


def _fits(n1, n2, percent):
    return np.minimum(n1, n2) * 100 >= np.maximum(n1, n2) * percent


def _candidates(postings: DataFrame, percent: int, light: int) -> DataFrame:
    """Pairs (a, b) of classes under a common key, and members (key, a, n) of long lists."""
    spread = postings.repartition(partitions(postings.sparkSession), "key").sortWithinPartitions("key", "n", "f1")

    def batch_of(key, a, b, n):
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int32())],
            names=["key", "a", "b", "n"])

    def pairs_of(key, f1, n, i, j):
        right = _fits(n[i], n[j], percent) & ((key[i] & 1 == 0) | (np.maximum(n[i], n[j]) > light)) & (f1[i] != f1[j])
        i, j = i[right], j[right]
        both = np.unique(np.stack([np.minimum(f1[i], f1[j]), np.maximum(f1[i], f1[j])]), axis=1)
        return both[0], both[1]

    def lists(key, f1, n, cut):
        """Pairs of the short lists, members of the long ones and of the list ``cut``, which goes on elsewhere."""
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (f1[1:] != f1[:-1]) | (n[1:] != n[:-1])
        key, f1, n = key[new], f1[new], n[new]
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(heads, len(key)))
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        whole = (sizes <= LONG) if cut is None else (sizes <= LONG) & (key[heads] != cut)
        for size in np.unique(sizes[(sizes > 1) & whole]).tolist():
            of = heads[(sizes == size) & whole]
            i, j = np.triu_indices(size, 1)
            left.append((of[:, None] + i).ravel())
            right.append((of[:, None] + j).ravel())
        a, b = pairs_of(key, f1, n, np.concatenate(left), np.concatenate(right))
        yield batch_of(np.zeros(len(a), np.int64), a, b, np.zeros(len(a), np.int32))
        long = np.repeat(~whole, sizes)
        if long.any():
            yield batch_of(key[long], f1[long], [None] * int(long.sum()), n[long])

    def run(batches):
        held, size, cut = [], 0, None
        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            size += batch.num_rows
            if size >= ROWS:
                key, f1, n = map(np.concatenate, zip(*held))
                last = int(np.searchsorted(key, key[-1]))
                if last == 0:  # one list fills the rows: all its parts are given out as members
                    last, cut = len(key), key[-1]
                yield from lists(key[:last], f1[:last], n[:last], cut)
                held, size = [[key[last:], f1[last:], n[last:]]], len(key) - last
        if size:
            yield from lists(*map(np.concatenate, zip(*held)), cut)

    return spread.mapInArrow(run, "key bigint, a bigint, b bigint, n int")


def _texts_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``documents`` that ``wanted`` (a) names, without repeats."""
    ids = kept(wanted.withColumnRenamed("a", "doc_id"))
    ids = F.broadcast(ids) if ids.count() <= IDS else ids
    return documents.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])


def _checked(pairs: DataFrame, documents: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ``documents`` that link, by whole texts."""
    found = kept(_texts_of(documents, pairs.select("a").union(pairs.select("b")).distinct()))
    one = pairs.join(found.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    two = one.join(found.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches):
        for batch in batches:
            step = 128
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                sets = []
                for name in ("text_a", "text_b"):
                    text, token = [], []
                    for at, _, held in pieces(texts(part, name)):
                        t, h = shingles(held, k)
                        text.append(t + at)
                        token.append(h)
                    sets.append((np.concatenate(text), np.concatenate(token)))
                text, token = (np.concatenate(x) for x in zip(*sets))
                order = np.lexsort((token, text))
                text, token = text[order], token[order]
                same = (text[1:] == text[:-1]) & (token[1:] == token[:-1])
                common = np.bincount(text[1:][same], minlength=part.num_rows)
                union = np.bincount(text, minlength=part.num_rows) - common
                links = pa.array(100 * common >= percent * union)
                yield pa.RecordBatch.from_arrays([part.column("a").filter(links), part.column("b").filter(links)], names=["a", "b"])

    return two.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def _to_documents(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of f1 as pairs of the least documents of their classes."""
    a = classes.select(F.col("f1").alias("a"), F.col("rep").alias("doc_a"))
    b = classes.select(F.col("f1").alias("b"), F.col("rep").alias("doc_b"))
    return pairs.join(a, "a").join(b, "b").where("doc_a <> doc_b").select(
        F.least("doc_a", "doc_b").alias("a"), F.greatest("doc_a", "doc_b").alias("b"))


def _bitmaps(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, n and bitmap of the sets of the ids that ``wanted`` (a) names."""
    rows = sized.where("n > 0").select("doc_id", F.col("n").cast("int").alias("n"), "bits")
    return rows.join(wanted.withColumnRenamed("a", "doc_id"), "doc_id", "left_semi").dropDuplicates()


def _matrix(bits: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, all folded to the length of the shortest."""
    width = min(map(len, bits))
    out = np.empty((len(bits), width // 8), np.uint64)
    for i, one in enumerate(bits):
        row = np.frombuffer(one, np.uint64)
        while len(row) > width // 8:
            row = row[:len(row) // 2] ^ row[len(row) // 2:]
        out[i] = row
    return out


def _within(differ, n1, n2, percent):
    """Sets of these sizes may still link if they differ in so many bits."""
    return differ * (100 + percent) <= (n1 + n2) * (100 - percent)


def _bounded(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their bitmaps do not rule out, with the bits they differ in."""
    one = pairs.join(bitmaps.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a")), "a")
    two = one.join(bitmaps.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b")), "b")

    def run(batches):
        for batch in batches:
            differ = np.empty(batch.num_rows, np.int64)
            bits_a, bits_b = batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist()
            for i, pair in enumerate(zip(bits_a, bits_b)):
                x, y = _matrix(pair)
                differ[i] = int(np.bitwise_count(x ^ y).sum())
            near = pa.array(_within(differ, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), percent))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(near), batch.column("b").filter(near), pa.array(differ).filter(near)],
                names=["a", "b", "differ"])

    return two.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a bigint, b bigint, differ bigint")


class _Square:
    """Bitmaps of one square: those of its first side against those of its second."""

    def __init__(self, rows: pa.Table, percent: int, light: int):
        self.n = rows["n"].to_numpy().astype(np.int64)
        self.bits = _matrix(rows["bits"].to_pylist())
        self.root = rows["root"].to_numpy()
        own, i, j = rows["own"].to_numpy(), rows["i"][0].as_py(), rows["j"][0].as_py()
        self.first, self.second, self.same = own == i, own == j, i == j
        # Under single tokens, pairs of light sets are not needed.
        self.least = light if rows["key"][0].as_py() & 1 else 0
        self.percent = percent

    def partners(self, x: int) -> tuple[np.ndarray, np.ndarray]:
        """The candidates of ``x`` that bitmaps do not rule out, and the bits they differ in."""
        other = np.flatnonzero(self.second if self.first[x] else self.first)
        other = other[(other != x) & _fits(self.n[x], self.n[other], self.percent)
                      & (np.maximum(self.n[x], self.n[other]) > self.least)]
        differ = np.bitwise_count(self.bits[other] ^ self.bits[x]).sum(1, dtype=np.int64)
        near = _within(differ, self.n[x], self.n[other], self.percent)
        return other[near], differ[near]

    def forest(self) -> list[tuple[int, int, int]]:
        """A spanning forest of nearest candidates, grown one class at a time."""
        size, out = len(self.n), []
        best, link, open_ = np.full(size, 1 << 60), np.full(size, -1), np.ones(size, bool)
        for _ in range(size):
            x = int(np.where(open_, best, 1 << 61).argmin())
            open_[x] = False
            if link[x] >= 0:
                out.append((x, int(link[x]), int(best[x])))
            other, differ = self.partners(x)
            closer = open_[other] & (differ < best[other])
            best[other[closer]], link[other[closer]] = differ[closer], x
        return out

    def apart(self) -> list[tuple[int, int, int]]:
        """All pairs of candidates with different roots."""
        out = []
        for x in np.flatnonzero(self.first).tolist():
            other, differ = self.partners(x)
            new = (self.root[other] != self.root[x]) & ((other > x) | (not self.same))
            out += [(x, y, d) for y, d in zip(other[new].tolist(), differ[new].tolist())]
        return out


def _squares(members: DataFrame, bitmaps: DataFrame, percent: int, light: int, spanning: bool) -> DataFrame:
    """Pairs (a, b, differ) of long lists that bitmaps do not rule out, from (key, a, root).

    ``spanning``: a forest of each square. Else all pairs of different roots; lists of one
    root are left out before anything is compared.
    """
    if not spanning:
        mixed = members.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
        members = members.join(mixed, "key")
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / SIDE).cast("int").alias("parts"))
    rows = members.join(bitmaps.withColumnRenamed("doc_id", "a"), "a").join(sizes, "key")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "a", "root", "n", "bits")
    keys = ["key", "i", "j"]
    spread = rows.repartition(partitions(members.sparkSession), *keys).sortWithinPartitions(*keys, "own", "a")

    def run(batches):
        for part in groups(batches, keys):
            square, doc = _Square(part, percent, light), part["a"].to_numpy()
            out = square.forest() if spanning else square.apart()
            if out:
                x, y, d = map(np.array, zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(doc[x], doc[y])), pa.array(np.maximum(doc[x], doc[y])), pa.array(d, pa.int64())],
                    names=["a", "b", "differ"])

    return spread.mapInArrow(run, "a bigint, b bigint, differ bigint")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``pairs`` whose ends are in different components."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return joined.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``documents``.

    A document of fewer words than a shingle has one, all its words; without words or text
    it has none and links with nothing. Rows with a NULL id have no component and link with
    nothing. Rows with equal ids are one document with the links of all of them.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    sized = kept(_sized(rows, shingle))
    classes = kept(sized.where("doc_id is not null and n > 0").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep")))
    own = rows.where("doc_id is not null and text is not null")
    hot = frequent(own, shingle)
    sizes = {r.n: r["count"] for r in classes.groupBy("n").count().collect()}
    tokens = max(sum(n * many for n, many in sizes.items()), 1)
    light = boundary(sizes, float(hot[1].sum()) / tokens, percent)
    found = kept(_candidates(_postings(own, shingle, percent, light, hot), percent, light))
    pairs = kept(_to_documents(found.where("b is not null").select("a", "b").distinct(), classes).distinct())
    members = kept(found.where("b is null").select("key", F.col("a").alias("f1")).join(
        classes.select("f1", "rep"), "f1").select("key", F.col("rep").alias("a")))
    wanted = pairs.select("a").union(pairs.select("b")).union(members.select("a")).distinct()
    bitmaps = kept(_bitmaps(sized, wanted))
    near = kept(_bounded(pairs, bitmaps, percent))
    # First round: each class with the nearest of its candidates.
    rooted = members.withColumn("root", F.col("a"))
    spanning = kept(_squares(rooted, bitmaps, percent, light, spanning=True).where("a <> b").distinct())
    ends = near.union(near.select("b", "a", "differ"))
    chosen = ends.groupBy("a").agg(F.min_by("b", F.struct("differ", "b")).alias("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    chosen = kept(chosen.union(spanning.select("a", "b")).distinct())
    links = kept(_checked(chosen, own, shingle, percent))
    roots = components(links)
    # Second round: whatever is still apart.
    rooted = members.join(roots.withColumnRenamed("node", "a"), "a", "left").select(
        "key", "a", F.coalesce("root", "a").alias("root"))
    rest = _apart(near, roots).union(_squares(rooted, bitmaps, percent, light, spanning=False).select("a", "b"))
    rest = kept(rest.distinct().join(chosen, ["a", "b"], "left_anti"))
    links = links.union(kept(_checked(rest, own, shingle, percent)))
    # Ids that stand for several sets join their classes.
    placed = sized.join(classes, ["f1", "f2", "n"], "left").select("doc_id", "n", "rep")
    twice = placed.where("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x <> y")
    links = links.union(placed.join(twice, "doc_id", "left_semi").where("rep is not null").select("doc_id", "rep"))
    roots = components(links).select(F.col("node").alias("rep"), "root")
    out = placed.withColumn("rep", F.coalesce("rep", "doc_id")).join(roots, "rep", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "rep")).alias("component_id"))


def one_of_each(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``documents`` without those that are not the least id of their component.

    Rows with a NULL id stay. Of rows that repeat an id, all stay or all go.
    """
    found = near_duplicates(documents.select("doc_id", "text"), shingle, percent)
    gone = found.where("component_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return documents.join(gone, documents["doc_id"] == gone["_gone"], "left_anti")


def digest(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents)
