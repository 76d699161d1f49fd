"""Words of many texts at once, and hashes of words and word windows, as numpy arrays.

Texts are UTF-8 bytes. A class of words is given by the bytes that belong to words; both
classes used here keep or drop all bytes of a character outside ASCII, so no character is
cut. Hashes are sums modulo 2**64 with an odd base, each finished by a mixing step, so
that every window of k words costs a few vector operations whatever k is.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
#: Bytes of text handled at a time; a longer text is handled alone.
CHUNK_BYTES = 1 << 19

_ALL = np.arange(256)
#: Words between white space: ``[^\\x20\\x09-\\x0D]+``.
SPACED = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: Words of letters, digits and characters outside ASCII, of lower-cased text.
ALNUM = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that leaves no structure."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64), 11)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_LETTERS = _Powers(0xD1342543DE82EF95 | 3)
_WINDOWS = (_Powers(0xAF251AF3B0F025B5 | 3), _Powers(0x2545F4914F6CDD1D | 3))


def byte_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes."""
    up, down = _LETTERS.to(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts], 1)


@dataclass
class Words:
    """The words of some texts: ``first[i]`` to ``first[i + 1]`` are those of text ``i``."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return byte_hashes(np.frombuffer(self.data, np.uint8), self.starts, self.ends)

    def text_of(self) -> np.ndarray:
        """The number of the text each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]]


def words_of(texts: list[bytes], letters: np.ndarray = SPACED) -> Words:
    data = b" ".join(texts) + b" "
    inside = np.empty(len(data) + 1, bool)
    inside[0] = False
    inside[1:] = letters[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return Words(data, starts, ends, np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)])))


def window_sums(hashes: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """Hashes of the windows of ``k`` words that start at each word but the last ``k - 1``."""
    n = len(hashes)
    if n < k:
        return np.empty(0, np.uint64)
    up, down = _WINDOWS[which].to(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[:n - k + 1], 2 + which)


def window_starts(words: Words, k: int) -> np.ndarray:
    """The words at which a window of ``k`` words of one text starts."""
    n = len(words.starts)
    if n < k:
        return np.empty(0, np.int64)
    text = words.text_of()
    return np.flatnonzero(text[:n - k + 1] == text[k - 1:])


def pieces(texts: list[bytes | None], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """Consecutive texts of about ``size`` bytes together: from, to, and the texts (NULL: empty)."""
    low, held, total = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text or b"")
        total += len(held[-1]) + 1
        if total >= size:
            yield low, i + 1, held
            low, held, total = i + 1, [], 0
    if held:
        yield low, len(texts), held
    _give_back()


def _give_back() -> None:
    """Memory that is free goes back to the system: a worker process lives on after its task."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)
