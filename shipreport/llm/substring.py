"""Substring deduplication by relative Lempel-Ziv parsing against an index of all documents.

A window is ``window`` consecutive words of one document; it is a duplicate if a document
with a smaller id holds the same words. Each document is factored against every indexed
block of the others: a factor is a maximal run of words that earlier documents hold, at
least one window long, and all words of factors are removed.

1. **Index.** Every window has an anchor: the least hash of its runs of ``_GRAM`` words.
   Neighbouring windows share their anchor, so a document has some 18 times fewer anchors
   than windows. Anchors that two documents hold stand for the indexed blocks in which a
   match can lie; a window whose anchor is in one document only is new text.
2. **Probe.** Of the other windows, each distinct one of a document is looked up by 96 bits
   of its hash. Within a few megabytes of text all but the first document of a window are
   settled at once, so a passage that a third of all documents share leaves a task as one
   row and no key is hot.
3. **Factors.** Windows found in an earlier document become runs. A run may take its words
   from several sources; where the source changes, the windows across that boundary have
   been looked up like all others, so nothing is lost at factor boundaries.

Texts are shuffled once, by row, and read from there in steps 2 and 3. Whether a document is
touched depends on the input only, never on what is left of others.

NULL texts have no words. Rows with a NULL id neither lose words nor take any. Rows with
equal ids never remove from each other. Hash collisions (96 bits) are not checked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipreport.llm.common import kept, partitions, texts
from shipreport.llm.words import SPACED, mix, pieces, window_starts, window_sums, words_of

WINDOW = 50
#: Words in the runs that anchors are taken from.
_GRAM = 12
_HIGH = np.uint64(0xFFFFFFFF00000000)
#: Bytes of text among which repeats are settled without a shuffle.
_NEAR_BYTES = 2 << 20


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` consecutive values."""
    width, out = 1, values
    while 2 * width <= span:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = span - width
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def _windows(held: list[bytes], window: int):
    """Of all windows of some texts: text, place within it, anchor, and the words' hashes."""
    words = words_of(held, SPACED)
    hashes = words.hashes()
    starts = window_starts(words, window)
    gram = min(_GRAM, window)
    if not len(starts):
        return words, hashes, starts, starts, np.empty(0, np.uint64)
    anchors = _least(window_sums(hashes, gram), window - gram + 1)[starts]
    return words, hashes, starts, words.text_of()[starts], anchors


def _anchors(rows: DataFrame, window: int) -> DataFrame:
    """The distinct anchors of each row."""
    def run(batches):
        for batch in batches:
            ids, variants = batch.column("doc_id").to_numpy(), batch.column("variant").to_numpy()
            for low, _, held in pieces(texts(batch)):
                _, _, _, text, anchors = _windows(held, window)
                new = np.ones(len(text), bool)
                new[1:] = (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])
                text, anchors = text[new] + low, anchors[new].view(np.int64)
                order = np.lexsort((anchors, text))
                text, anchors = text[order], anchors[order]
                new = np.ones(len(text), bool)
                new[1:] = (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[text[new]], pa.int64()), pa.array(variants[text[new]]), pa.array(anchors[new])],
                    names=["doc_id", "variant", "anchor"])

    return rows.where("doc_id is not null and text is not null").select("doc_id", "variant", "text").mapInArrow(
        run, "doc_id bigint, variant int, anchor bigint")


def _candidates(joined: DataFrame, window: int) -> DataFrame:
    """Windows with a shared anchor: one row for each distinct one of a document.

    ``h2_pos`` is 32 bits of the second hash and the place plus 1, in one value, as narrow
    rows shuffle better. ``more`` holds further places of the same window in its document.
    Rows with a ``source`` are settled: they say, for places in ``more``, that this document
    nearby, of a smaller id, has the window.
    """
    schema = "h1 bigint, h2_pos bigint, doc_id bigint, variant int, more binary, source bigint"

    def run(batches):
        for batch in batches:
            ids, variants = batch.column("doc_id").to_pylist(), batch.column("variant").to_numpy()
            shared = batch.column("anchors")
            bounds, values = shared.offsets.to_numpy(), shared.values.to_numpy()
            bounds, values = bounds - bounds[0], values[bounds[0]:bounds[-1]]
            for low, high, held in pieces(texts(batch), _NEAR_BYTES):
                known = [values[bounds[i]:bounds[i + 1]] for i in range(low, high)]
                held = [t if len(k) else b"" for t, k in zip(held, known)]
                words, hashes, starts, text, anchors = _windows(held, window)
                if not len(starts):
                    continue
                # A text's shared anchors and those of its windows, as pairs in one sorted list.
                every, inverse = np.unique(np.concatenate(known).view(np.uint64), return_inverse=True)
                of_text = np.repeat(np.arange(high - low), [len(k) for k in known])
                pairs = np.unique(of_text * np.int64(len(every)) + inverse)
                at = np.minimum(np.searchsorted(every, anchors), len(every) - 1)
                pair = text * np.int64(len(every)) + at
                near = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
                found = np.flatnonzero((every[at] == anchors) & (pairs[near] == pair))
                if not len(found):
                    continue
                starts, text = starts[found], text[found]
                h1 = window_sums(hashes, window, 0)[starts]
                h2 = window_sums(hashes, window, 1)[starts] & _HIGH
                pos = starts - words.first[text]
                doc = np.array([-1 if i is None else i for i in ids[low:high]], np.int64)[text]
                yield from _settled_and_open(h1, h2, doc, variants[text + low], pos)

    return joined.mapInArrow(run, schema)


def _settled_and_open(h1, h2, doc, variant, pos):
    order = np.lexsort((pos, variant, doc, h2, h1))
    h1, h2, doc, variant, pos = h1[order], h2[order], doc[order], variant[order], pos[order]
    new_window = np.ones(len(h1), bool)
    new_window[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    first = np.maximum.accumulate(np.where(new_window, np.arange(len(h1)), 0))
    late = doc > doc[first]
    # Open windows: one row per window and row, with the places of its repeats.
    at = np.flatnonzero(~late)
    group = np.ones(len(at), bool)
    group[1:] = new_window[at][1:] | (variant[at][1:] != variant[at][:-1])
    heads = np.flatnonzero(group)
    sizes = np.diff(np.append(heads, len(at)))
    more = [None] * len(heads)
    for i in np.flatnonzero(sizes > 1).tolist():
        more[i] = pos[at[heads[i] + 1:heads[i] + sizes[i]]].astype("<i4").tobytes()
    lead = at[heads]
    names = ["h1", "h2_pos", "doc_id", "variant", "more", "source"]
    yield pa.RecordBatch.from_arrays(
        [pa.array(h1[lead].view(np.int64)), pa.array((h2[lead] | (pos[lead] + 1).astype(np.uint64)).view(np.int64)),
         pa.array(doc[lead]), pa.array(variant[lead]), pa.array(more, pa.binary()), pa.nulls(len(lead), pa.int64())],
        names=names)
    # Settled windows: one row per row and source, under keys of their own.
    gone = np.flatnonzero(late)
    if len(gone):
        source = doc[first[gone]]
        order = np.lexsort((pos[gone], source, variant[gone], doc[gone]))
        gone, source = gone[order], source[order]
        group = np.ones(len(gone), bool)
        group[1:] = ((doc[gone][1:] != doc[gone][:-1]) | (variant[gone][1:] != variant[gone][:-1])
                     | (source[1:] != source[:-1]))
        heads = np.flatnonzero(group)
        ends = np.append(heads[1:], len(gone))
        lead = gone[heads]
        yield pa.RecordBatch.from_arrays(
            [pa.array(mix(doc[lead].view(np.uint64), 70).view(np.int64)), pa.array(pos[lead].astype(np.int64) << 32),
             pa.array(doc[lead]), pa.array(variant[lead]),
             pa.array([pos[gone[a:b]].astype("<i4").tobytes() for a, b in zip(heads.tolist(), ends.tolist())], pa.binary()),
             pa.array(source[heads])], names=names)


def _factors(places: np.ndarray, sources: np.ndarray, n_words: int, window: int):
    """Greedy factors (first word, words, source) of the windows found, and the words covered."""
    if not len(places):
        return [], np.zeros(n_words, bool)
    order = np.lexsort((sources, places))
    places, sources = places[order], sources[order]
    cover = np.zeros(n_words + 1, np.int64)
    np.add.at(cover, places, 1)
    np.add.at(cover, np.minimum(places + window, n_words), -1)
    covered = np.cumsum(cover)[:-1] > 0
    first = np.ones(len(places), bool)
    first[1:] = places[1:] != places[:-1]
    places, sources = places[first], sources[first]
    cut = np.flatnonzero((np.diff(places) != 1) | (np.diff(sources) != 0)) + 1
    heads, tails = np.concatenate([[0], cut]), np.concatenate([cut, [len(places)]]) - 1
    out, end = [], 0
    for a, b, s in zip(places[heads].tolist(), (places[tails] + window).tolist(), sources[heads].tolist()):
        start = max(a, end)
        if b > start:
            out.append((start, b - start, s))
        end = max(end, b)
    return out, covered


def parsed(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``documents`` with n_words, n_removed, kept (the words left, joined by one space) and
    factors (first_word, n_words, source). Columns of these names are replaced."""
    new = ("n_words", "n_removed", "kept", "factors")
    own = [c for c in documents.columns if c not in new]
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
        F.hash("text").alias("variant"),
        F.struct(*[c for c in own if c != "text"]).alias("rest"))
    # A row is known by its id and a hash of its text, which tells rows that repeat an id apart.
    row = ["doc_id", "variant"]
    anchors = _anchors(rows, window)
    shared = kept(anchors.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                  .where("a < b").select("anchor"))
    of_row = anchors.join(shared, "anchor").groupBy(*row).agg(F.collect_set("anchor").alias("anchors"))
    # Both joins shuffle the same columns of the same rows, so Spark shuffles them once.
    probes = rows.join(of_row, row, "left").withColumn("anchors", F.coalesce("anchors", F.array().cast("array<bigint>")))
    windows = _candidates(probes, window)
    # Dealt by the first hash alone, so that the second is taken apart after the shuffle only.
    windows = windows.repartition(partitions(documents.sparkSession), "h1").selectExpr(
        "h1", "shiftright(h2_pos, 32) AS h2", "doc_id", "variant", "cast(h2_pos & 4294967295L AS int) - 1 AS pos", "more",
        "coalesce(source, doc_id) AS source")
    earliest = F.min("source").over(Window.partitionBy("h1", "h2"))
    found = windows.withColumn("source", earliest).where("source < doc_id")
    # Rows of equal id and text are one row here: their places are the same.
    of_row = found.groupBy(*row).agg(F.collect_list(F.struct("pos", "more", "source")).alias("found"))
    schema = rows.select("text", "rest").withColumns({
        "n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "kept": F.lit(""),
        "factors": F.lit(None).cast("array<struct<first_word:int,n_words:int,source:bigint>>")}).schema
    done = _finished(rows.join(of_row, row, "left"), schema, window)
    return done.select(*[F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in own], *new)


def _finished(joined: DataFrame, schema, window: int) -> DataFrame:
    def run(batches):
        kinds = pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("source", pa.int64())]))
        for batch in batches:
            found = batch.column("found")
            counts, removed, left, factors = [], [], [], []
            for low, high, held in pieces(texts(batch)):
                words = words_of(held, SPACED)
                for i in range(high - low):
                    a, b = int(words.first[i]), int(words.first[i + 1])
                    places, sources = _places(found[low + i])
                    parts, covered = _factors(places, sources, b - a, window)
                    starts, ends = words.starts[a:b], words.ends[a:b]
                    if len(parts):
                        starts, ends = starts[~covered], ends[~covered]
                    counts.append(b - a)
                    removed.append(int(covered.sum()))
                    left.append(b" ".join([words.data[x:y] for x, y in zip(starts.tolist(), ends.tolist())]))
                    factors.append([dict(zip(("first_word", "n_words", "source"), f)) for f in parts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("text"), batch.column("rest"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(left, pa.binary()).cast(pa.string()), pa.array(factors, kinds)],
                names=["text", "rest", "n_words", "n_removed", "kept", "factors"])

    return joined.mapInArrow(run, schema)


def _places(found: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    if not found.is_valid:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    values = found.values
    pos, source = values.field("pos").to_numpy(), values.field("source").to_numpy()
    own = pos >= 0
    places, sources = [pos[own].astype(np.int64)], [source[own]]
    more = values.field("more")
    if more.null_count < len(more):
        for i in np.flatnonzero(more.is_valid().to_numpy(zero_copy_only=False)).tolist():
            part = np.frombuffer(more[i].as_py(), "<i4").astype(np.int64)
            places.append(part)
            sources.append(np.full(len(part), source[i], np.int64))
    return np.concatenate(places), np.concatenate(sources)


def deduplicated(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``documents`` without the words of factors; untouched texts stay letter by letter.

    n_chars, where present, follows the text. Documents that lose all words stay, empty.
    """
    columns = documents.columns
    whole = F.struct(*[c for c in columns if c != "text"])
    found = parsed(documents.select(whole.alias("whole"), "doc_id", "text"), window)
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in columns:
        new["n_chars"] = F.when(changed, F.length("kept")).otherwise(F.col("whole.n_chars")).cast(
            documents.schema["n_chars"].dataType)
    return found.select(*(new.get(c, F.col("whole").getField(c)).alias(c) for c in columns))


def digest(documents: DataFrame) -> DataFrame:
    found = parsed(documents.select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
