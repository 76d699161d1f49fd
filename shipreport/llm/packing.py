"""Packing token sequences into fixed windows by minimum bin slack.

Each task tokenises its documents in one pass. A document longer than the window gives whole
windows and a remainder. Remainders wait in a pool; a window is filled with the multiset of
waiting lengths, of all that wait, whose sum comes closest to its capacity. It is found by dynamic
programming over bits: bit s of a Python integer says that the sum s can be reached, counts
are taken in by binary parts, and the counts used are backtracked from the layers. A window
that no multiset fills exactly is filled with the closest sum and topped up by cutting one
more remainder. What is left when a task ends is packed into windows whose lengths are
powers of two, so that nothing is padded.

A task's documents are those of one input split, so a task that is run again packs them in
the same way. Windows never span tasks; ids of sequences are unique over all tasks. The
pool holds at most ``pool`` remainders, or as many as fill one window.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipreport.llm.common import texts
from shipreport.llm.words import byte_hashes, pieces

CAPACITY = 2048
#: Remainders that wait at once; windows are filled while half of them are there.
POOL = 1024
#: The id that ends a document.
END_ID = 1
#: Distinct units whose ids a worker remembers.
REMEMBERED = 1_000_000

PIECE_SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                "sequence_id bigint, offset bigint, ids array<int>")


def fullest(counts: dict[int, int], capacity: int) -> Counter:
    """The multiset of lengths, within ``counts``, with the largest sum up to ``capacity``.

    Of equal sums the one that takes long lengths first. Empty if nothing fits.
    """
    parts, layers, reach, mask = [], [], 1, (1 << (capacity + 1)) - 1
    for length in sorted(counts, reverse=True):
        left, power = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(power, left)
            layers.append(reach)
            parts.append((length, take))
            reach |= (reach << (length * take)) & mask
            left -= take
            power *= 2
        if reach >> capacity:
            break
    total, used = reach.bit_length() - 1, Counter()
    for (length, take), before in zip(reversed(parts), reversed(layers)):
        if not total:
            break
        if not before >> total & 1:
            used[length] += take
            total -= length * take
    return used


class Tokens:
    """Ids of texts by a public tokenizer, one distinct unit of text at a time.

    A unit ends where the tokenizer's splitting pattern ends a token in every case: before a
    space that no white space follows; between an ASCII letter and an ASCII mark other than
    an apostrophe; around a single line feed between an ASCII character that is no white
    space and an ASCII letter. Equal units have equal ids, so only new ones are tokenised.
    Units are told apart by 64-bit hashes of their bytes. This holds for byte-level tokenizers
    with the usual splitting pattern; any other is refused.

    With ``added``, the strings of the tokenizer's added tokens have those tokens' ids, as they
    have when it is loaded and not changed; without, they are ordinary text.
    """

    #: First bytes of white space outside ASCII; no cut is made before them.
    WIDE = b"\xc2\xe1\xe2\xe3"

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self._refuse_other_patterns(path)
        tokens = self.tokenizer.get_added_tokens_decoder() if added else {}
        self.added = {t.content.encode(): i for i, t in tokens.items()}
        self.alone = not any(t.lstrip or t.rstrip or t.single_word for t in tokens.values())
        longest_first = sorted(self.added, key=len, reverse=True)
        self.pattern = re.compile(b"(" + b"|".join(map(re.escape, longest_first)) + b")") if longest_first else None
        byte = np.arange(256)
        self.goes_on = ~np.isin(byte, [0x00, *range(0x09, 0x0E), *range(0x1C, 0x21), *self.WIDE])
        self.letter = ((byte >= 65) & (byte <= 90)) | ((byte >= 97) & (byte <= 122))
        self.graphic = (byte >= 33) & (byte <= 126)
        self.mark = self.graphic & ~self.letter & ~((byte >= 48) & (byte <= 57)) & (byte != ord("'"))
        self.forget()

    def _refuse_other_patterns(self, path: str) -> None:
        loaded = json.loads(self.tokenizer.to_str())
        split = loaded.get("pre_tokenizer") or {}
        usual = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if loaded.get("normalizer") is not None or not usual:
            raise ValueError(f"{path}: only byte-level tokenizers with the usual splitting pattern can be used")

    def forget(self) -> None:
        self.hashes, self.places = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.uint32)

    def cuts(self, raw: np.ndarray) -> np.ndarray:
        """The places in ``raw`` before which a unit begins, but for the first."""
        cut = np.zeros(len(raw), bool)
        before, here = raw[:-1], raw[1:]
        cut[:-1] = (before == 0x20) & self.goes_on[here]
        cut[1:] |= self.letter[before] & self.mark[here]
        if len(raw) > 2:
            line = np.flatnonzero((raw[1:-1] == 0x0A) & self.graphic[raw[:-2]] & self.letter[raw[2:]]) + 1
            cut[line] = cut[line + 1] = True
        return cut

    def learn(self, units: list[bytes], hashes: np.ndarray) -> None:
        """Tokenise new units and take them into the sorted table of hashes."""
        ids, sizes = [], []
        for start in range(0, len(units), 8192):
            for found in self.tokenizer.encode_batch_fast([u.decode() for u in units[start:start + 8192]],
                                                          add_special_tokens=False):
                part = found.ids
                ids.extend(part)
                sizes.append(len(part))
        sizes = np.array(sizes, np.int64)
        places = len(self.ids) + np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)
        self.ids = np.concatenate([self.ids, np.array(ids, np.uint32)])
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.places, self.sizes = (
            np.insert(old, at, new) for old, new in
            ((self.hashes, hashes), (self.places, places), (self.sizes, sizes)))

    def encode(self, many: list[bytes]) -> list[np.ndarray]:
        """The ids of each text, with the id that ends it."""
        if self.pattern is None or not any(map(self.pattern.search, many)):
            return self.encode_plain(many)
        if not self.alone:  # tokens that depend on what is around them: their texts as a whole
            return [np.array([*self.tokenizer.encode(t.decode(), add_special_tokens=False).ids, END_ID], np.uint32)
                    if self.pattern.search(t) else self.encode_plain([t])[0] for t in many]
        split = [self.pattern.split(t) for t in many]
        between = iter(self.encode_plain([part for parts in split for part in parts[::2]]))
        out = []
        for parts in split:  # text, token, text, ...; only the last text keeps its end
            ids = [np.array([self.added[part]], np.uint32) if i % 2 else
                   next(between)[:None if i == len(parts) - 1 else -1] for i, part in enumerate(parts)]
            out.append(np.concatenate(ids))
        return out

    def encode_plain(self, many: list[bytes]) -> list[np.ndarray]:
        """``encode`` for texts without added tokens."""
        if len(self.hashes) > REMEMBERED:
            self.forget()
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in many), np.int64, len(many)))
        data = b"\0".join(many) + b"\0"  # no rule cuts next to this byte, so none looks into the next text
        raw = np.frombuffer(data, np.uint8)
        cut = self.cuts(raw)
        between = np.zeros(len(raw), bool)
        between[ends - 1] = True
        cut |= between
        cut[np.concatenate([[0], ends[:-1]])] = True
        starts = np.flatnonzero(cut)
        stops = np.append(starts[1:], len(raw))
        own = ~between[starts]
        starts, stops = starts[own], stops[own]
        distinct, first, inverse = np.unique(byte_hashes(raw, starts, stops), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, distinct), max(len(self.hashes) - 1, 0))
        new = np.ones(len(distinct), bool) if not len(self.hashes) else self.hashes[at] != distinct
        if new.any():
            chosen = first[new]
            self.learn([data[a:b] for a, b in zip(starts[chosen].tolist(), stops[chosen].tolist())], distinct[new])
            at = np.searchsorted(self.hashes, distinct)
        sizes, sources = self.sizes[at][inverse], self.places[at][inverse]
        owner = np.searchsorted(ends, starts, side="right")
        total = np.bincount(owner, sizes, len(many)).astype(np.int64)
        shift = sources - (np.cumsum(sizes) - sizes)
        flat = self.ids[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]
        stops = np.cumsum(total)
        end = np.array([END_ID], np.uint32)
        return [np.concatenate([flat[b - n:b], end]) for b, n in zip(stops.tolist(), total.tolist())]


@lru_cache(maxsize=1)
def _tokens(path: str, added: bool) -> Tokens:
    """One tokenizer for all tasks of a worker process; what it remembers changes no result."""
    return Tokens(path, added)


class Packer:
    """Pieces of one task."""

    def __init__(self, capacity: int, pool: int, first_id: int, with_ids: bool):
        self.capacity, self.pool, self.sequence, self.with_ids = capacity, pool, first_id, with_ids
        self.waiting: dict[int, list[tuple]] = defaultdict(list)
        self.n = self.total = 0
        self.out: list[tuple] = []

    def piece(self, doc, start, ids, total, offset):
        crc = zlib.crc32(ids.astype("<u4").tobytes())
        self.out.append((doc, start, len(ids), crc, total, self.sequence, offset, ids if self.with_ids else None))

    def add(self, doc, ids):
        total, start = len(ids), 0
        while total - start >= self.capacity:
            self.piece(doc, start, ids[start:start + self.capacity], total, 0)
            self.sequence += 1
            start += self.capacity
        if start < total:
            self.wait((doc, start, ids[start:].copy() if start else ids, total))
            while self.n > self.pool and self.total >= self.capacity:
                self.fill(self.capacity)

    def wait(self, item):
        self.waiting[len(item[2])].append(item)
        self.n += 1
        self.total += len(item[2])

    def take(self, length):
        bucket = self.waiting[length]
        item = bucket.pop(0)
        if not bucket:
            del self.waiting[length]
        self.n -= 1
        self.total -= length
        return item

    def fill(self, capacity: int) -> None:
        """One window of exactly ``capacity``, which the pool can surely fill."""
        used = fullest({k: len(items) for k, items in self.waiting.items() if k <= capacity}, capacity)
        offset = 0
        for length in sorted(used, reverse=True):
            for _ in range(used[length]):
                doc, start, ids, total = self.take(length)
                self.piece(doc, start, ids, total, offset)
                offset += length
        while offset < capacity:  # no multiset fits exactly: cut one more
            room = capacity - offset
            over = [k for k in self.waiting if k > room]
            doc, start, ids, total = self.take(max(over) if over else max(self.waiting))
            cut = min(room, len(ids))
            self.piece(doc, start, ids[:cut], total, offset)
            offset += cut
            if cut < len(ids):
                self.wait((doc, start + cut, ids[cut:], total))
        self.sequence += 1

    def finish(self) -> None:
        while self.total:
            self.fill(self.capacity if self.total >= self.capacity else 1 << (self.total.bit_length() - 1))


def packed(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, pool: int = POOL,
           with_ids: bool = True, added: bool = False) -> DataFrame:
    """One row per piece: where it comes from, where it lies, and its ids.

    Every row of ``documents`` is packed; a NULL text is empty and gives only the end id.
    Rows with equal or NULL ids are packed one by one. Sequences are full, but for the
    powers of two that end each task. ``capacity`` must be a power of two. ``tokenizer`` is
    a file that every executor can open. With ``added`` it is used as it was loaded, so that
    the string of an added token in a text has that token's id.
    """
    def run(batches):
        from pyspark import TaskContext

        tokens = _tokens(tokenizer, added)
        packer = Packer(capacity, pool, TaskContext.get().partitionId() << 36, with_ids)

        def batch():
            columns = list(zip(*packer.out)) or [[]] * 8
            packer.out = []
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())]
            names = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]
            columns[7] = [None if x is None else x.astype(np.int32) for x in columns[7]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for rows in batches:
            doc_ids = rows.column("doc_id").to_pylist()
            held = texts(rows)
            for low, high, some in pieces(held):
                for doc, ids in zip(doc_ids[low:high], tokens.encode(some)):
                    packer.add(doc, ids)
                if len(packer.out) >= 4096:
                    yield batch()
        packer.finish()
        if packer.out:
            yield batch()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, PIECE_SCHEMA)


def digest(documents: DataFrame, tokenizer: str) -> DataFrame:
    """Pieces without their ids, by the tokenizer as it was loaded."""
    return packed(documents, tokenizer, with_ids=False, added=True).drop("ids")
