"""Alignment of two tokenizers' tokens of the same texts, as Arrow kernels inside tasks.

Both tokenizers cut the bytes of ``" " + text``. An offset at which tokens of both end closes a
group; a link is a pair of tokens whose byte ranges end together.

1. **Tokens.** Texts are cut into units at places where both tokenizers always end a token:
   before a space that neither a space precedes nor white space follows. Arrow's
   ``dictionary_encode`` finds a batch's distinct units, each of which a worker tokenises once.
   ``take``, ``list_flatten`` and ``list_parent_indices`` give every document's tokens.
2. **Offsets.** A cumulative sum of the tokens' bytes, less its value where the document
   begins, gives the offset at which each token ends.
3. **Links.** An Acero hash join of both token tables on (document, end). ``Table.group_by``
   counts the id pairs of each document; these counts are written once, with the row.
4. **Counts.** ``Table.group_by`` counts pairs over each batch of written rows and Spark adds up
   these partial counts, so a pair that every document holds is shuffled once a batch.
5. **Scores.** Each document's pairs are looked up in the counts, which Arrow joins in a task.
   Counts come in passes of at most about ``BLOCK`` pairs, each broadcast on its own, so what
   is broadcast does not grow with the data.

A text that is NULL or empty, or whose tokens of either kind do not spell ``" " + text``, has
no tokens: its figures are 0 and its groups ''. Every row counts for itself, whatever its id;
columns named like new ones are replaced, others stay. ``first`` must be a byte-level BPE whose
splitting pattern is the usual one (letters, digits, marks, white space), ``second`` a piece
model without a normaliser; others are refused.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipreport.llm.common import gathered, kept

#: Id pairs whose counts are broadcast at once.
BLOCK = 2_000_000
#: Bytes of text that are aligned together; a longer text is aligned alone.
TOGETHER = 1 << 20
#: Distinct units that a worker remembers.
REMEMBERED = 500_000
#: Bits of a pair's key that hold the second id.
_SECOND = 24

#: Fixed value: the splitting pattern under which the cuts into units are right.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as they are, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Pair:
    """Both tokenizers, the bytes of their tokens, and the units a worker has met."""

    #: Bytes that begin white space, or could: no unit begins before a space that one follows.
    SPACE = np.isin(np.arange(256), [0x00, *range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3])

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        parts = json.loads(self.first.to_str())
        step = parts["pre_tokenizer"] or {}
        if (parts["normalizer"] is not None or step.get("type") != "ByteLevel" or step.get("add_prefix_space")
                or not step.get("use_regex", True)):
            raise ValueError(f"{first}: not a byte-level vocabulary with the usual splitting pattern")
        letters = _byte_of_letter()
        spelt = sorted(self.first.get_vocab().items(), key=lambda x: x[1])
        added = {t.content for t in self.first.get_added_tokens_decoder().values()}
        self.first_bytes = self._table({i: t.encode() if t in added else bytes(letters[c] for c in t) for t, i in spelt})
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        model = sentencepiece_model_pb2.ModelProto()
        with open(second, "rb") as f:
            model.ParseFromString(f.read())
        spec, n = model.normalizer_spec, self.second.get_piece_size()
        pieces = [self.second.id_to_piece(i) for i in range(n)]
        if (spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or n >= 1 << _SECOND
                or any("▁" in p.lstrip("▁") for p in pieces)):
            raise ValueError(f"{second}: a model with a normaliser, or with pieces of several words")
        self.second_bytes = self._table({
            i: bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)})
        self.numbers = pa.array([str(i) for i in range(max(len(self.first_bytes), n))])
        self.forget()

    @staticmethod
    def _table(of_id: dict[int, bytes]) -> pa.Array:
        return pa.array([of_id.get(i, b"") for i in range(max(of_id) + 1)], pa.binary())

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids: tuple[list, list] = ([], [])
        self.good: list[bool] = []

    def learn(self, units: list[bytes]) -> None:
        """Tokenise new units, which all begin with a space."""
        held = [u.decode() for u in units]
        a = [x.ids for x in self.first.encode_batch_fast(held, add_special_tokens=False)]
        b = self.second.encode([t[1:] for t in held], num_threads=1)
        spelt = []
        for ids, table in ((a, self.first_bytes), (b, self.second_bytes)):
            lists = pa.array(ids, pa.list_(pa.int32()))
            parts = pa.ListArray.from_arrays(lists.offsets, table.take(lists.values))
            spelt.append(pc.equal(pc.binary_join(parts, b""), pa.array(units, pa.binary())).to_pylist())
        for unit, x, y, one, two in zip(units, a, b, *spelt):
            self.known[unit] = len(self.good)
            self.ids[0].append(np.array(x, np.int32))
            self.ids[1].append(np.array(y, np.int32))
            self.good.append(bool(one and two))

    def units(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """The units of ``" " + text`` of each text, one after the other, and the text each is in."""
        data = b"".join(b" " + t for t in texts)
        raw = np.frombuffer(data + b" ", np.uint8)
        cut = np.zeros(len(data), bool)
        cut[1:] = (raw[1:-1] == 0x20) & (raw[:-2] != 0x20) & ~self.SPACE[raw[2:]]
        heads = np.cumsum([0, *(len(t) + 1 for t in texts)])
        cut[heads[:-1]] = True
        starts = np.flatnonzero(cut)
        offsets = np.append(starts, len(data)).astype(np.int32)
        array = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return array, np.searchsorted(heads, starts, side="right") - 1

    def tokens(self, texts: list[bytes]) -> tuple[list[pa.Table], np.ndarray]:
        """Two tables (doc, id) in order, and which texts both tokenizers spell."""
        if len(self.known) > REMEMBERED:
            self.forget()
        units, owner = self.units(texts)
        found = units.dictionary_encode()
        distinct = found.dictionary.to_pylist()
        fresh = [u for u in distinct if u not in self.known]
        for start in range(0, len(fresh), 4096):
            self.learn(fresh[start:start + 4096])
        places = [self.known[u] for u in distinct]
        good = np.ones(len(texts), bool)
        bad = ~np.fromiter((self.good[p] for p in places), bool, len(places))
        good[owner[bad[found.indices.to_numpy()]]] = False
        of_doc, keep = pa.array(owner, pa.int64()), pa.array(good[owner])
        indices, of_doc = found.indices.filter(keep), of_doc.filter(keep)
        tables = []
        for ids in self.ids:
            own = [ids[p] for p in places]
            offsets = np.cumsum([0, *map(len, own)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(own) if own else [], pa.int32()))
            lists = lists.take(indices)
            tables.append(pa.table({"doc": of_doc.take(pc.list_parent_indices(lists)), "id": pc.list_flatten(lists)}))
        return tables, good


@lru_cache(maxsize=1)
def _pair(first: str, second: str) -> Pair:
    """One pair for all tasks of a worker process; what it remembers changes no result."""
    return Pair(first, second)


def ends(tokens: pa.Table, table: pa.Array) -> np.ndarray:
    """The byte offset in its document at which each token ends: a cumulative sum in segments."""
    sizes = pc.binary_length(table.take(tokens.column("id").combine_chunks())).cast(pa.int64())
    total = pc.cumulative_sum(sizes).to_numpy(zero_copy_only=False)
    doc = tokens.column("doc").to_numpy()
    new = np.ones(len(doc), bool)
    new[1:] = doc[1:] != doc[:-1]
    heads = np.flatnonzero(new)
    before = (total - sizes.to_numpy(zero_copy_only=False))[heads]
    return total - np.repeat(before, np.diff(np.append(heads, len(doc))))


def aligned(many: list[bytes], pair: Pair) -> tuple[dict[str, np.ndarray], pa.Table, pa.Array]:
    """Of some texts: their counts, their id pairs (doc, key, n), and their groups as text."""
    (a, b), _ = pair.tokens(many)
    n = len(many)
    a = a.append_column("end", pa.array(ends(a, pair.first_bytes)))
    b = b.append_column("end", pa.array(ends(b, pair.second_bytes)))
    keys = ["doc", "end"]
    links = a.rename_columns(["doc", "a", "end"]).join(b.rename_columns(["doc", "b", "end"]), keys, join_type="inner",
                                                       use_threads=False)
    key = pc.add(pc.shift_left(links.column("a").cast(pa.int64()), _SECOND), links.column("b").cast(pa.int64()))
    pairs = pa.table({"doc": links.column("doc"), "key": key}).group_by(["doc", "key"], use_threads=False).aggregate(
        [([], "count_all")]).rename_columns(["doc", "key", "n"])
    count = lambda column: np.bincount(column.to_numpy(), minlength=n).astype(np.int64)
    shared = links.select(keys).group_by(keys, use_threads=False).aggregate([])
    counts = {"n_a": count(a.column("doc")), "n_b": count(b.column("doc")), "n_groups": count(shared.column("doc")),
              "n_links": count(links.column("doc"))}
    return counts, pairs, _groups(a, b, shared, pair, n)


def _groups(a: pa.Table, b: pa.Table, shared: pa.Table, pair: Pair, n: int) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` for each document."""
    if not len(shared):
        return pa.array([""] * n)
    width = np.int64(max(int(t.column("end").to_numpy().max()) for t in (a, b))) + 1
    place = lambda t: t.column("doc").to_numpy() * width + t.column("end").to_numpy()
    closing = np.sort(place(shared))
    sides, ids, docs = [], [], []
    for side, t in enumerate((a, b)):
        # The group of a token is closed by the first shared offset at or after its end.
        sides.append(2 * np.searchsorted(closing, place(t)) + side)
        ids.append(t.column("id").to_numpy())
        docs.append(t.column("doc").to_numpy())
    side, ids, docs = np.concatenate(sides), np.concatenate(ids), np.concatenate(docs)
    order = np.argsort(side, kind="stable")
    side, ids, docs = side[order], ids[order], docs[order]
    mark = np.full(len(side), 3, np.int8)  # the last token of a document
    same = docs[1:] == docs[:-1]
    mark[:-1][same] = np.where(side[1:] == side[:-1], 0, np.where(side[1:] // 2 == side[:-1] // 2, 1, 2))[same]
    written = pc.binary_join_element_wise(pair.numbers.take(pa.array(ids)), pa.array([",", "|", ";", ""]).take(pa.array(mark)), "")
    offsets = np.searchsorted(docs, np.arange(n + 1)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), written), "")


def _linked(rows: DataFrame, first: str, second: str, as_text: bool) -> DataFrame:
    """``rows`` (rest, text) with counts, groups (or their SHA-256) and pairs; texts are left out unless ``as_text``."""
    text = ", text string" if as_text else ""
    rest = rows.schema["rest"].dataType.simpleString()
    out = (f"rest {rest}{text}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
           "pair_keys array<bigint>, pair_counts array<int>")

    def run(batches) -> Iterator[pa.RecordBatch]:
        pair = _pair(first, second)
        for batch in gathered(batches, TOGETHER):
            held = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            # An empty text has no tokens: it is left out rather than read as one space.
            own = [i for i, t in enumerate(held) if t]
            counts, pairs, groups = aligned([held[i] for i in own], pair)
            place = np.array(own, np.int64)
            columns = []
            for name in COUNTS[:4]:
                whole = np.zeros(len(held), np.int64)
                whole[place] = counts[name]
                columns.append(pa.array(whole))
            texts = [""] * len(held)
            for i, g, tokens in zip(own, groups.to_pylist(), counts["n_a"].tolist()):
                if tokens:
                    texts[i] = g if as_text else hashlib.sha256(g.encode()).hexdigest()
            doc = place[pairs.column("doc").to_numpy()] if own else np.empty(0, np.int64)
            order = np.argsort(doc, kind="stable")
            offsets = pa.array(np.searchsorted(doc[order], np.arange(len(held) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pairs.column(c).combine_chunks().take(pa.array(order)).cast(k))
                     for c, k in (("key", pa.int64()), ("n", pa.int32()))]
            kept_text = [batch.column("text")] if as_text else []
            names = ["rest", *(["text"] if as_text else []), *COUNTS[:4], "groups", "pair_keys", "pair_counts"]
            yield pa.RecordBatch.from_arrays([batch.column("rest"), *kept_text, *columns, pa.array(texts), *lists], names=names)

    return rows.mapInArrow(run, out)


def _flat(batch: pa.RecordBatch) -> pa.Table:
    """The pairs of a batch of rows: (row, key, n)."""
    keys, counts = batch.column("pair_keys"), batch.column("pair_counts")
    return pa.table({"row": pc.list_parent_indices(keys).cast(pa.int64()), "key": pc.list_flatten(keys),
                     "n": pc.list_flatten(counts).cast(pa.int64())})


def pair_counts(linked: DataFrame) -> DataFrame:
    """How often each id pair is linked in all documents: (key, n, best), best where no other first id has more."""
    def run(batches):
        for batch in batches:
            part = _flat(batch).group_by("key", use_threads=False).aggregate([("n", "sum")]).rename_columns(["key", "n"])
            yield from part.combine_chunks().to_batches()

    parts = linked.select("pair_keys", "pair_counts").mapInArrow(run, "key bigint, n bigint")
    counts = parts.groupBy("key").agg(F.sum("n").alias("n"))
    second = F.col("key").bitwiseAND(F.lit((1 << _SECOND) - 1))
    most = counts.groupBy(second.alias("b")).agg(F.max("n").alias("most"))
    return counts.withColumn("b", second).join(most, "b").select("key", "n", (F.col("n") == F.col("most")).alias("best"))


def _scored(linked: DataFrame, counts: DataFrame) -> DataFrame:
    """``linked`` with n_best and count_sum in place of its pairs."""
    spark = linked.sparkSession
    counts = kept(counts)
    n = -(-counts.count() // BLOCK) or 1
    done = linked.withColumns({c: F.lit(0).cast("long") for c in COUNTS[4:]})
    for number in range(n):
        block = counts.where(F.pmod(F.xxhash64("key"), F.lit(n)) == number)
        shared, last, schema = spark.sparkContext.broadcast(block.toArrow()), number == n - 1, done.schema

        def run(batches, shared=shared):
            known = shared.value
            for batch in batches:
                found = _flat(batch).join(known, "key", join_type="inner", right_suffix="_all", use_threads=False)
                found = found.append_column("links", pc.multiply(found.column("n"), found.column("n_all")))
                best = found.filter(found.column("best"))
                sums = {}
                for name, rows, column in (("n_best", best, "n"), ("count_sum", found, "links")):
                    sums[name] = np.zeros(batch.num_rows, np.int64)
                    part = rows.group_by("row", use_threads=False).aggregate([(column, "sum")])
                    sums[name][part.column("row").to_numpy()] = part.column(f"{column}_sum").to_numpy()
                for name, added in sums.items():
                    i = batch.schema.get_field_index(name)
                    batch = batch.set_column(i, name, pa.array(batch.column(name).to_numpy() + added))
                yield batch

        done = done.mapInArrow(run, schema)
        if not last:
            done = kept(done)
            shared.unpersist()
    return done.drop("pair_keys", "pair_counts")


def alignments(documents: DataFrame, first: str, second: str) -> DataFrame:
    """``documents`` with n_a, n_b, n_groups, n_links, n_best, count_sum and groups, as text."""
    new = {*COUNTS, "groups"}
    own = [c for c in documents.columns if c not in new]
    rows = documents.select(F.struct(F.lit(0).alias("_"), *[c for c in own if c != "text"]).alias("rest"), "text")
    linked = kept(_linked(rows, first, second, True))
    done = _scored(linked, pair_counts(linked))
    return done.select(*[F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in own], *COUNTS, "groups")


def digest(documents: DataFrame, first: str, second: str) -> DataFrame:
    rows = documents.select(F.struct(F.col("doc_id").cast("long").alias("doc_id")).alias("rest"), "text")
    linked = kept(_linked(rows, first, second, False))
    done = _scored(linked, pair_counts(linked))
    return done.select("rest.doc_id", *COUNTS, F.col("groups").alias("groups_sha256"))
