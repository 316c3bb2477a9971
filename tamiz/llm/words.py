"""Words and shingles of whole texts as 64-bit hashes, computed on Arrow buffers without a Python loop over words.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. All functions work on one Arrow batch at a
time; a batch is cut into pieces of a few MB (never inside a text) so that memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once; a longer text is one piece of its own.
PIECE = 1 << 21

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
#: One odd multiplier for each place in a shingle.
_PLACES = np.array([pow(0xD1342543DE82EF95, i + 1, 1 << 64) | 1 for i in range(64)], dtype=np.uint64)

_is_word = np.ones(256, dtype=bool)
_is_word[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Bytes of words without ASCII punctuation.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_same = np.arange(1, 257, dtype=np.uint64)
_lower = np.arange(1, 257, dtype=np.uint64)
_lower[65:91] += np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sequence_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of 64-bit values, by value and order."""
    power, inverse = _powers(max(PIECE, 1 << max(len(values), 1).bit_length()))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[np.minimum(starts, len(inverse) - 1)] + (ends - starts).astype(np.uint64))


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.full(size, _BASE, dtype=np.uint64)
    inverse = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    base[0] = inverse[0] = 1
    return np.cumprod(base), np.cumprod(inverse)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """A hash of the bytes of each span; ``values`` maps a byte to what is hashed (default: itself)."""
    power, inverse = _powers(max(PIECE, 1 << max(len(data), 1).bit_length()))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_same if values is None else values)[data] * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts])


_EIGHTS = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)


def _words_of_kinds(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of some texts begin and end, and a hash of each by eight bytes at a time; byte 0 is in no word."""
    lower = np.where(kinds, _lower - np.uint64(1), 0).astype(np.uint8).tobytes()
    n = len(data)
    folded = np.frombuffer(b"".join((b"\0", data.tobytes().translate(lower), bytes(9))), dtype=np.uint8)  # other bytes are 0
    kind = folded != 0
    edges = np.flatnonzero(kind[1:] != kind[:-1])
    inner = offsets[(offsets > 0) & (offsets < n)]
    split = np.unique(inner[kind[inner] & kind[inner + 1]])
    if len(split):
        edges = np.sort(np.concatenate([edges, split, split]), kind="stable")
    starts, ends = np.ascontiguousarray(edges[::2]), np.ascontiguousarray(edges[1::2])
    sizes = ends - starts
    eight = np.ndarray(n + 2, dtype="<u8", buffer=folded, offset=1, strides=(1,))  # the eight bytes from each byte on
    hashes = mix(eight[starts] & _EIGHTS[np.minimum(sizes, 8)])
    more, k = np.flatnonzero(sizes > 8), 8
    while len(more):
        hashes[more] = mix(hashes[more] * _PLACES[0] + (eight[starts[more] + k] & _EIGHTS[np.minimum(sizes[more] - k, 8)]))
        k += 8
        more = more[sizes[more] > k]
    return starts, ends, hashes


class Words:
    """The words of some texts: ``hashes``, byte spans in the piece, and ``bounds``: text i has words bounds[i]:bounds[i+1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray | None = None, by_bytes: bool = False):
        """``kinds``: for each byte, whether it belongs to a word (default: all but white space); their words have hashes of their own.

        ``by_bytes``: words of ``kinds`` have the hashes of the default too.
        """
        if kinds is not None and not by_bytes:
            self.starts, self.ends, self.hashes = _words_of_kinds(data, offsets, kinds)
            self.bounds = np.searchsorted(self.starts, offsets)
            return
        kind = (_is_word if kinds is None else kinds)[data]
        before, after = np.empty_like(kind), np.empty_like(kind)
        before[1:], after[:-1] = kind[:-1], kind[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        if len(data):
            before[0] = after[-1] = False
            before[inner], after[inner - 1] = False, False
        self.starts = np.flatnonzero(kind & ~before)
        self.ends = np.flatnonzero(kind & ~after) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.hashes = span_hashes(data, self.starts, self.ends, _lower)

    def shingles(self, k: int) -> np.ndarray:
        """The hash of the k words from each word on; only those that end in the same text mean anything."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        total = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            total += self.hashes[j : j + n] * _PLACES[j]
        return mix(total)

    def shingle_lists(self, k: int) -> Iterator[np.ndarray]:
        """For each text the hashes of its k-word shingles in order; with fewer words, the whole sequence as one."""
        rows = self.shingles(k)
        for a, b in zip(self.bounds[:-1], self.bounds[1:], strict=True):
            m = int(b - a)
            if m >= k:
                yield rows[a : b - k + 1]
            elif m:
                own = np.sum(self.hashes[a:b] * _PLACES[:m], keepdims=True)
                yield mix(own + np.array([0xA0761D6478BD642F * m & _MASK], dtype=np.uint64))
            else:
                yield rows[:0]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the offsets of its texts; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def pieces(column: pa.Array, size: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of runs of texts of about ``size`` bytes (default: PIECE)."""
    data, offsets = utf8(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + (size or PIECE), side="right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words_of(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    for i, j, data, offsets in pieces(column):
        yield i, j, Words(data, offsets)
