"""Word arrays over Arrow text buffers.

A batch of texts is one UTF-8 byte buffer with row offsets. Words are located
with byte-class tables, so the whole batch is handled by numpy without a
Python loop over words. Every separator is ASCII, hence byte positions are
safe in UTF-8. Hashes are 64-bit polynomials (mod 2**64) with a finaliser.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
U64 = np.uint64


def _byte_table(codes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(codes)] = True
    return table


#: Bytes of the words [^\x20\x09-\x0D]+
SPACED = ~_byte_table([0x20, *range(0x09, 0x0E)])
#: Bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of A-Z lower-cased text
ALNUM = _byte_table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse mod 2**64 for i in 0..n-1 (kept between calls)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=U64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = (both[0], both[1])
        if size <= 2 * CHUNK_BYTES:
            _POWERS[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash of several hash columns, order kept."""
    out = mix(parts[0] + U64(len(parts)))
    for p in parts[1:]:
        out = mix(out * U64(_WORD_BASE) + p)
    return out


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    if len(column) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    o = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    o = o.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[o[0] : o[-1]] if data is not None and o[-1] > o[0] else np.zeros(0, np.uint8)
    return raw, o - o[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold at most `limit` bytes, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each row's first word index (rows + 1)."""
    if len(data) == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    w = table[data]
    before = np.empty(len(w) + 1, dtype=bool)
    before[0] = False
    before[1:] = w
    after = before[1:].copy()
    after[:-1] = w[1:]
    after[-1] = False
    before = before[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(w))]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(w & ~before)
    ends = np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, in blocks of bounded size."""
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(int(np.searchsorted(ends, base + CHUNK_BYTES, side="right")), i + 1)
        s, e = starts[i:j] - base, ends[i:j] - base
        up, down = powers(_BYTE_BASE, int(e[-1]) + 1)
        total = np.zeros(int(e[-1]) + 1, dtype=U64)
        np.cumsum((data[base : base + int(e[-1])].astype(U64) + U64(1)) * up[1:], out=total[1:])
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U64))
        i = j
    return out


class Grams:
    """Hashes of any run of consecutive words, from one prefix sum."""

    def __init__(self, words: np.ndarray):
        up, self.down = powers(_WORD_BASE, len(words) + 1)
        self.total = np.zeros(len(words) + 1, dtype=U64)
        if len(words):
            np.cumsum(words * up[1:], out=self.total[1:])

    def span(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the words first .. last-1 for arrays of positions."""
        return mix((self.total[last] - self.total[first]) * self.down[first] + (last - first).astype(U64))

    def every(self, n: int) -> np.ndarray:
        """Hash of each run of n words, by first word."""
        if len(self.total) <= n:
            return np.zeros(0, dtype=U64)
        return mix((self.total[n:] - self.total[:-n]) * self.down[: len(self.total) - n] + U64(n))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
