"""Substring dedup over bytes by a sampled suffix array, sorted in buckets.

A window is ``window`` consecutive bytes of one document. It is a repeat if the same bytes start
earlier: in a document with a smaller id, or earlier in the same document. Every byte that a
repeat covers is removed; windows are judged on the input.

1. **Sampled suffixes.** Of the ``_GRAM``-byte strings inside a window the one with the least
   hash is its anchor. Equal windows have equal anchors at equal places, and neighbouring
   windows share theirs, so a text has about one run of windows with one anchor in 40 bytes. A
   run is the suffix that starts at its first window, as long as its windows reach. Only
   anchors that occur twice matter: they are range-partitioned and neighbours compared.
2. **Buckets.** Runs are range-partitioned by their anchor's leading bytes, then its hash, the
   document and the place, with splitters that Spark samples. Document and place are part of
   the key, so an anchor that a third of all rows share is dealt over many buckets.
3. **Local sort.** A bucket is sorted and read in blocks of bounded size. In a block equal runs
   are found by multikey quicksort on characters of 8 bytes: rows are sorted by one character,
   and only ties go on to the next. Of equal runs the first stays; the windows of those that
   stay are sorted in the same way, and neighbours in that order are compared.
4. **Across boundaries.** An anchor that lies in one block alone is settled there. Windows of
   anchors that begin or end a block, or fill more than one, may have their first occurrence in
   another: those not yet found to be repeats become suffixes of their own, range-partitioned by
   all their bytes, document and place. A bucket then compares neighbours again, and its first
   windows are compared with the last window of each other bucket, one row a bucket.

Texts are shuffled once, by row, and read from there for steps 2 and 4. A NULL text is empty. Rows
with a NULL id neither lose bytes nor take any. Rows that repeat an id are different documents
of which neither is earlier, but equal rows are treated alike. Hashes only choose places; what
counts as equal is compared byte by byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipreport.llm.common import partitions, texts
from shipreport.llm.words import mix, pieces

WINDOW = 100
#: Bytes of the strings that anchors are.
_GRAM = 24
#: Bytes of runs that are sorted together.
BLOCK_BYTES = 1 << 20
#: Bytes of text whose anchors are looked for together.
_TEXT_BYTES = 1 << 19

#: Windows of a run.
LONGEST = 4096
_PLACE = np.uint64(0xFFFF)

_FOUND = "doc_id bigint, variant int, first int, last int"
_BYTE = mix(np.arange(256, dtype=np.uint64), 23)
_BASE = 0xD1342543DE82EF95 | 3


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as asked for."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                steps = np.full(max(n, 2 * len(cls.up)), base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` consecutive values."""
    width, out = 1, values
    while 2 * width <= span:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = span - width
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


class Runs:
    """The runs of windows of some texts.

    ``data`` holds all bytes, ``heads`` where each text begins. Of run i, ``text[i]`` is its
    text, ``first[i]`` and ``last[i]`` its first and last window as places in ``data``,
    ``anchor[i]`` its anchor's hash, ``at[i]`` a place of the anchor, and ``inner[i]`` whether
    the anchor occurs in it twice, so that its own windows may be equal.
    """

    def __init__(self, held: list[bytes], window: int):
        self.data = b"".join(held)
        self.heads = np.cumsum([0, *map(len, held)])
        n, gram = len(self.data), min(_GRAM, window)
        self.text = self.first = self.last = self.anchor = self.at = np.empty(0, np.int64)
        self.inner = np.empty(0, bool)
        if n < window:
            return
        raw = np.frombuffer(self.data, np.uint8)
        up, down = _Powers.to(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[raw] * up[:n], out=sums[1:])
        grams = mix((sums[gram:] - sums[:-gram]) * down[:n - gram + 1], 29)
        # 48 bits of the hash, and 16 of the place, by which the leftmost of equal ones is least.
        grams = (grams & ~_PLACE) | (np.arange(len(grams), dtype=np.uint64) & _PLACE)
        least = _least(grams, window - gram + 1)
        text = np.repeat(np.arange(len(held), dtype=np.int32), np.diff(self.heads))
        at = np.flatnonzero(text[:n - window + 1] == text[window - 1:])
        if not len(at):
            return
        least, text = least[at], text[at]
        moved = np.ones(len(at), bool)
        moved[1:] = least[1:] != least[:-1]
        anchor = (least >> np.uint64(16)).view(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        head = np.flatnonzero(new)
        inner = np.add.reduceat((moved & ~new).astype(np.int64), head) > 0
        last = np.append(head[1:], len(at)) - 1
        place = at[last] + (((least[last] & _PLACE).astype(np.int64) - at[last]) & 0xFFFF)
        # A text that repeats itself gives long runs: these are cut.
        parts = -(-(last - head + 1) // LONGEST)
        of = np.repeat(np.arange(len(head)), parts)
        step = (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * LONGEST
        self.first = at[head][of] + step
        self.last = np.minimum(self.first + LONGEST - 1, at[last][of])
        self.text, self.anchor, self.at, self.inner = text[head][of].astype(np.int64), anchor[head][of], place[of], inner[of]


def characters(data: bytes) -> np.ndarray:
    """At each place of ``data`` the 8 bytes that start there, as one big-endian number."""
    raw = np.frombuffer(data + bytes(8), np.uint8)
    out = np.zeros(len(data), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | raw[i:i + len(data)]
    return out


def multikey(chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of strings, for those that are not alone.

    String i is the ``lengths[i]`` bytes from ``starts[i]`` on; strings with different ``apart``
    (a hash, which only saves work) or lengths are different. Returns the numbers of the strings
    that equal another, equal ones together, and the class of each.
    """
    order = np.argsort(apart, kind="stable")
    order, of = _many(order, _classes(apart[order]))
    by = np.lexsort((lengths[order], of))
    order, of = order[by], of[by]
    order, of = _many(order, _classes(of, lengths[order]))
    done_order, done_of, depth, shift = [], [], 0, 0
    while len(order):
        # The last character overlaps the one before it, so no byte beyond the string is read.
        left = lengths[order] - depth
        ended = left <= 0
        if ended.any():
            done_order.append(order[ended])
            done_of.append(of[ended] + shift)
            shift += int(of.max()) + 1
            order, of, left = order[~ended], of[~ended], left[~ended]
            if not len(order):
                break
        place = starts[order] + depth - np.where(lengths[order] >= 8, np.maximum(8 - left, 0), 0)
        key = chars[place]
        short = lengths[order] < 8
        if short.any():
            key = np.where(short, key >> ((8 - np.minimum(lengths[order], 8)) * 8).astype(np.uint64), key)
        by = np.lexsort((key, of))
        order, key, of = order[by], key[by], of[by]
        order, of = _many(order, _classes(of, key))
        depth += 8
    if not done_order:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(done_order), np.concatenate(done_of)


def _classes(*columns: np.ndarray) -> np.ndarray:
    """Numbers of the groups of equal neighbours."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def _many(order: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without those that are alone in their class."""
    many = np.bincount(of)[of] > 1 if len(of) else np.empty(0, bool)
    return order[many], of[many]


def _late(of: np.ndarray, doc: np.ndarray, variant: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by class, document and place, and which strings then have an earlier equal one."""
    by = np.lexsort((place, variant, doc, of))
    of, doc, variant, place = of[by], doc[by], variant[by], place[by]
    new = np.ones(len(of), bool)
    new[1:] = of[1:] != of[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(of)), 0))
    new[1:] |= (doc[1:] != doc[:-1]) | (variant[1:] != variant[:-1])
    own = np.maximum.accumulate(np.where(new, np.arange(len(of)), 0))
    return by, (doc > doc[head]) | (place > place[own])  # equal rows have equal places


def _anchors(rows: DataFrame, window: int) -> DataFrame:
    """The distinct anchors of each row, with whether the row has them more than once."""
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for low, _, held in pieces(texts(batch), _TEXT_BYTES):
                found = Runs(held, window)
                by = np.lexsort((found.anchor, found.text))
                text, anchor, inner = found.text[by], found.anchor[by], found.inner[by]
                new = np.ones(len(text), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
                at = np.flatnonzero(new)
                twice = np.logical_or.reduceat(inner, at) if len(at) else inner
                twice |= np.diff(np.append(at, len(text))) > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[text[at] + low], pa.int64()), pa.array(anchor[at]), pa.array(twice)],
                    names=["doc_id", "anchor", "twice"])

    return rows.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, "doc_id bigint, anchor bigint, twice boolean")


def _shared(anchors: DataFrame) -> DataFrame:
    """Of anchors in order, those that occur twice, or may: a bucket's first and last could go on in others."""
    def run(batches):
        held, before = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, anchor, twice = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "anchor", "twice"))
            if held:
                doc, anchor, twice = (np.concatenate([x, y]) for x, y in zip(held, (doc, anchor, twice)))
            same = anchor[1:] == anchor[:-1]
            found = twice[:-1] | same
            found[1:] |= same[:-1]
            if len(found):
                found[0] |= before is None or before == anchor[0]
                before = anchor[-2]
            yield rows(doc[:-1][found], anchor[:-1][found])
            held = (doc[-1:], anchor[-1:], twice[-1:])
        if held:
            yield rows(held[0], held[1])

    def rows(doc, anchor):
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(anchor, pa.int64())], names=["doc_id", "anchor"])

    return anchors.mapInArrow(run, "doc_id bigint, anchor bigint")


def _suffixes(probes: DataFrame, window: int) -> DataFrame:
    """The runs with an anchor that occurs elsewhere: where they are, and their bytes."""
    def run(batches):
        for batch in batches:
            # Rows without an id have a key that may be another's id, but no anchors of their own.
            ids, variants = batch.column("doc_id").to_pylist(), batch.column("variant").to_numpy()
            named = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            ids = np.array([0 if i is None else i for i in ids], np.int64)
            shared = batch.column("anchors")
            bounds, values = shared.offsets.to_numpy(), shared.values.to_numpy()
            bounds, values = bounds - bounds[0], values[bounds[0]:bounds[-1]]
            for low, high, held in pieces(texts(batch), _TEXT_BYTES):
                own = np.diff(bounds[low:high + 1])
                known = own * named[low:high]
                found = Runs([t if k else b"" for t, k in zip(held, known)], window)
                if not len(found.text):
                    continue
                every, inverse = np.unique(values[bounds[low]:bounds[high]], return_inverse=True)
                pairs = np.unique(np.repeat(np.arange(high - low), own) * np.int64(len(every)) + inverse)
                at = np.minimum(np.searchsorted(every, found.anchor), len(every) - 1)
                pair = found.text * np.int64(len(every)) + at
                near = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
                known = np.flatnonzero((every[at] == found.anchor) & (pairs[near] == pair))
                if not len(known):
                    continue
                text, first, last = found.text[known], found.first[known], found.last[known]
                lead = (characters(found.data)[found.at[known]] >> np.uint64(1)).view(np.int64)
                cut = [found.data[a:b + window] for a, b in zip(first.tolist(), last.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lead), pa.array(found.anchor[known]), pa.array(ids[text + low], pa.int64()),
                     pa.array(variants[text + low]), pa.array((first - found.heads[text]).astype(np.int32)),
                     pa.array(found.inner[known]), pa.array(cut, pa.binary())],
                    names=["lead", "anchor", "doc_id", "variant", "place", "inner", "bytes"])

    return probes.mapInArrow(
        run, "lead bigint, anchor bigint, doc_id bigint, variant int, place int, inner boolean, bytes binary")


def _ranges(doc, variant, first, last) -> pa.RecordBatch:
    """Windows ``first`` to ``last`` of rows, with neighbouring ranges made one."""
    by = np.lexsort((first, variant, doc))
    doc, variant, first, last = doc[by], variant[by], first[by], last[by]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (variant[1:] != variant[:-1]) | (first[1:] > last[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.maximum.reduceat(last, at) if len(at) else last
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[at], pa.int64()), pa.array(variant[at], pa.int32()), pa.array(first[at], pa.int32()),
         pa.array(last, pa.int32())], names=["doc_id", "variant", "first", "last"])


def _block(rows: pa.Table, window: int, open_anchors: set[int]):
    """Of the runs of a block: ranges of windows that are repeats, and the open windows of ``open_anchors``."""
    raw = rows.column("bytes").to_pylist()
    data, lengths = b"".join(raw), np.fromiter(map(len, raw), np.int64, len(raw))
    starts = np.cumsum(lengths) - lengths
    column = lambda c: rows.column(c).to_numpy()
    anchor, doc, variant, place = column("anchor"), column("doc_id"), column("variant").astype(np.int64), column("place").astype(np.int64)
    chars = characters(data)
    up, down = _Powers.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[np.frombuffer(data, np.uint8)] * up[:-1], out=sums[1:])
    hashes = lambda a, b: mix((sums[b] - sums[a]) * down[a], 31)
    gone = np.zeros(len(anchor), bool)
    order, of = multikey(chars, starts, lengths, hashes(starts, starts + lengths))
    if len(order):
        by, late = _late(of, doc[order], variant[order], place[order])
        gone[order[by[late]]] = True
    ranges = [(doc[gone], variant[gone], place[gone], place[gone] + lengths[gone] - window)]
    # The windows of the runs that stay. Runs whose anchor is theirs alone share none here.
    stay = np.flatnonzero(~gone)
    is_open = np.isin(anchor[stay], np.fromiter(open_anchors, np.int64, len(open_anchors)))
    _, inverse, count = np.unique(anchor[stay], return_inverse=True, return_counts=True)
    chosen = is_open | (count[inverse] > 1) | rows.column("inner").to_numpy()[stay]
    stay, is_open = stay[chosen], is_open[chosen]
    sizes = lengths[stay] - window + 1
    of_run = np.repeat(np.arange(len(stay)), sizes)
    step = np.arange(len(of_run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    run = stay[of_run]
    begin = starts[run] + step
    order, of = multikey(chars, begin, np.full(len(begin), window, np.int64), hashes(begin, begin + window))
    repeat = np.zeros(len(begin), bool)
    if len(order):
        by, late = _late(of, doc[run[order]], variant[run[order]], place[run[order]] + step[order])
        repeat[order[by[late]]] = True
    where = place[run] + step
    ranges.append((doc[run[repeat]], variant[run[repeat]], where[repeat], where[repeat]))
    left = np.flatnonzero(~repeat & is_open[of_run])
    opened = (doc[run[left]], variant[run[left]], where[left], [data[a:a + window] for a in begin[left].tolist()])
    return _ranges(*(np.concatenate(x) for x in zip(*ranges))), opened


def _bucket(suffixes: DataFrame, window: int) -> DataFrame:
    """Step 3: repeats found in blocks (last is set), and open windows (bytes are set)."""
    def blocks(batches):
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                if held and size + part.column("bytes").nbytes > BLOCK_BYTES:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
                held.append(part)
                size += part.column("bytes").nbytes
        if held:
            yield pa.Table.from_batches(held)

    def run(batches):
        for block in blocks(batches):
            # An anchor at either end of a block may lie in the next one, or in another bucket, too.
            anchor = block.column("anchor")
            ranges, (doc, variant, first, raw) = _block(block, window, {anchor[0].as_py(), anchor[-1].as_py()})
            yield ranges.append_column("bytes", pa.nulls(ranges.num_rows, pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(variant, pa.int32()), pa.array(first, pa.int32()),
                 pa.nulls(len(raw), pa.int32()), pa.array(raw, pa.binary())],
                names=["doc_id", "variant", "first", "last", "bytes"])

    return suffixes.mapInArrow(run, _FOUND + ", bytes binary")


def _across(found: DataFrame) -> DataFrame:
    """Step 4: of ranges and single windows in order, the ranges that are repeats, and what other
    buckets must know.

    Rows with bytes and no ``head`` are windows of the bucket's first class that no window before
    them in the bucket settles. The row with bytes and ``head`` is the bucket's last window,
    with the first document of its class in the bucket and the first place of its own row.
    """
    names = ["doc_id", "variant", "first", "last", "bytes", "head"]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64())

    def batch(rows):
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def run(batches):
        text = head = row = place = None
        n_classes = 0
        for rows in batches:
            out, single = [], rows.column("bytes").is_valid()
            ranges = rows.filter(pc.invert(single))
            if ranges.num_rows:
                yield ranges.select(names[:5]).append_column("head", pa.nulls(ranges.num_rows, pa.int64()))
            rows = rows.filter(single)
            for raw, doc, variant, at in zip(*(rows.column(c).to_pylist() for c in ("bytes", "doc_id", "variant", "first"))):
                if raw != text:
                    text, head, row = raw, doc, None
                    n_classes += 1
                if row != (doc, variant):
                    row, place = (doc, variant), at
                if doc > head or at > place:
                    out.append((doc, variant, at, at, None, None))
                elif n_classes == 1:
                    out.append((doc, variant, at, at, raw, None))
            yield batch(out)
        if text is not None:
            yield batch([(*row, place, place, text, head)])

    return found.mapInArrow(run, _FOUND + ", bytes binary, head bigint")


def repeats(rows: DataFrame, window: int) -> DataFrame:
    """Windows that are repeats, by document: (key, found), a list of (variant, first, last).

    ``rows`` has key, doc_id, variant, and text; what else it has is not looked at. The key is the
    document's id where there is one.
    """
    n = partitions(rows.sparkSession)
    in_order = lambda df, *keys: df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    of_row = _shared(in_order(_anchors(rows, window), "anchor", "doc_id")).groupBy(F.col("doc_id").alias("key")).agg(
        F.collect_set("anchor").alias("anchors"))
    # The caller joins the same rows by the same column, so that Spark shuffles texts once.
    probes = rows.join(of_row, "key", "left").withColumn("anchors", F.coalesce("anchors", F.array().cast("array<bigint>")))
    found = _bucket(in_order(_suffixes(probes, window), "lead", "anchor", "doc_id", "place"), window)
    lines = _across(in_order(found, "bytes", "doc_id", "variant", "first"))
    # Ranges are gathered by document, and what buckets must know of each other by window: at
    # most a line for each bucket and row of the first document.
    key = F.coalesce("bytes", F.concat(F.lit("doc"), F.col("doc_id").cast("string")).cast("binary"))
    group = lines.groupBy(F.col("bytes").isNull().alias("settled"), key.alias("key")).agg(
        F.min("head").alias("earliest"),
        F.collect_list(F.expr("CASE WHEN head IS NULL THEN struct(doc_id, variant, first, last) END")).alias("rows"),
        F.collect_list(F.expr("CASE WHEN head IS NOT NULL THEN struct(doc_id, variant, first) END")).alias("ends"))
    late = F.expr("CASE WHEN settled THEN rows ELSE filter(rows, r -> earliest < r.doc_id OR exists(ends, "
                  "e -> e.doc_id = r.doc_id AND e.variant = r.variant AND e.first < r.first)) END")
    return group.select(F.inline(late)).groupBy(F.col("doc_id").alias("key")).agg(F.collect_list(F.struct("variant", "first", "last")).alias("found"))


def _finished(joined: DataFrame, window: int) -> DataFrame:
    schema = joined.select("text", "rest").selectExpr(
        "*", "0L AS n_bytes", "0L AS n_removed", "0L AS n_spans", "CAST('' AS BINARY) AS kept",
        "CAST(NULL AS array<struct<start:int,length:int>>) AS spans").schema

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
        for batch in batches:
            held = [t or b"" for t in texts(batch)]
            sizes, removed, left, spans = [], [], [], []
            for text, found, variant, doc in zip(held, batch.column("found"), *(batch.column(c).to_pylist() for c in ("variant", "doc_id"))):
                own = [] if doc is None else _spans(found, variant, window)
                parts, at = [], 0
                for start, end in own:
                    parts.append(text[at:start])
                    at = end
                sizes.append(len(text))
                removed.append(sum(b - a for a, b in own))
                left.append(b"".join([*parts, text[at:]]))
                spans.append([{"start": a, "length": b - a} for a, b in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column("text"), batch.column("rest"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array([len(s) for s in spans], pa.int64()), pa.array(left, pa.binary()), pa.array(spans, kind)],
                names=schema.names)

    return joined.mapInArrow(run, schema)


def _spans(found: pa.Scalar, variant: int, window: int) -> list[tuple[int, int]]:
    """The maximal stretches of bytes that a row's windows cover."""
    if not found.is_valid:
        return []
    of, first, last = (found.values.field(c).to_numpy() for c in ("variant", "first", "last"))
    own = of == variant
    if not own.any():
        return []
    first, end = first[own].astype(np.int64), last[own].astype(np.int64) + window
    by = np.argsort(first, kind="stable")
    first, end = first[by], np.maximum.accumulate(end[by])
    new = np.flatnonzero(np.append(True, first[1:] > end[:-1]))
    return list(zip(first[new].tolist(), end[np.append(new[1:], len(end)) - 1].tolist()))


def parsed(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``documents`` with n_bytes, n_removed, n_spans, kept (the bytes left) and spans (start and
    length of what goes, in bytes). Columns of these names are replaced."""
    new = ("n_bytes", "n_removed", "n_spans", "kept", "spans")
    own = [c for c in documents.columns if c not in new]
    # A row is known by its id and a hash of its text, which tells rows that repeat an id apart.
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.hash("text").alias("variant"), F.col("text").alias("text"),
        F.struct(*[c for c in own if c != "text"]).alias("rest"))
    # Rows without an id are dealt by their text, so that they are not one group.
    rows = rows.withColumn("key", F.coalesce("doc_id", F.xxhash64("text")))
    done = _finished(rows.join(repeats(rows, window), "key", "left"), window)
    return done.select(*[F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in own], *new)


def digest(documents: DataFrame) -> DataFrame:
    found = parsed(documents.select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
