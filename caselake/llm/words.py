"""Vectorised word splitting and hashing over Arrow string columns.

A word is a maximal run of bytes other than space and TAB..CR.  Those
separators are ASCII, so UTF-8 text can be split and hashed byte by byte
without decoding it.  Everything here works on one Arrow batch, cut into
slices of bounded text size, and holds no state between batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
#: Bytes whose hash terms are held at a time, however long a text is.
CHUNK_BYTES = 1 << 18

#: Byte classes; 0 separates words, and a word ends where the class changes.
SPACED = np.ones(256, dtype=np.uint8)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
LETTERS = np.zeros(256, dtype=np.uint8)
LETTERS[48:58] = LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = 1
#: letters and digits, or runs of other signs
RUNS = np.where(SPACED == 0, 0, 2 - LETTERS).astype(np.uint8)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x + np.uint64((seed * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of ``column`` that hold at most ``limit`` bytes (or a single row)."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(size):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += int(n)
    if start < len(size):
        yield start, len(size)


class Words:
    """Words of the rows of one slice: byte ranges, and each row's word range.

    ``data`` bytes, ``start``/``end`` byte range of each word, ``first`` the
    number of words before each row (length rows + 1).
    """

    def __init__(self, column: pa.Array, lower: bool = False, classes: np.ndarray = SPACED) -> None:
        """``lower`` folds A-Z; with ``LETTERS`` or ``RUNS`` it folds the capitals of Latin-1 too."""
        data, row_start, row_end = self.bounds(column)
        self.text = data
        self.data = _LOWER[data] if lower else data
        if lower and classes is not SPACED and len(data):
            fold = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
            self.data[fold] += 32
        kind = classes[data]
        self.outside = kind == 0
        begins = ~self.outside
        ends = begins.copy()
        same = kind[1:] == kind[:-1]
        begins[1:] &= ~same
        ends[:-1] &= ~same
        full = row_start < row_end
        begins[row_start[full]] = ~self.outside[row_start[full]]
        ends[row_end[full] - 1] = ~self.outside[row_end[full] - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.rows = len(column)
        self.row_start = row_start
        self.first = np.searchsorted(self.start, np.append(row_start, len(data)))

    @staticmethod
    def bounds(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all rows, and where each row starts and ends in them."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        buffer = column.buffers()[2]
        data = np.frombuffer(buffer, dtype=np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
        return data, offsets[:-1] - offsets[0], offsets[1:] - offsets[0]

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts())

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes, its length included."""
        total = np.zeros(len(self.start), np.uint64)
        base = (_BASE + 2 * seed) & _MASK
        low = _powers(1 << 16, base)
        high = _powers((len(self.data) >> 16) + 1, pow(base, 1 << 16, 1 << 64))
        for x in range(0, len(self.data) if len(total) else 0, CHUNK_BYTES):
            y = min(x + CHUNK_BYTES, len(self.data))
            k, n = np.searchsorted(self.start, x, "right") - 1, np.searchsorted(self.start, y)
            begins = np.concatenate(([x], self.start[k + 1 : n]))
            origin = begins if k < 0 else self.start[k:n]
            at = np.arange(x, y) - np.repeat(origin, np.diff(np.append(begins, y)))
            value = (self.data[x:y].astype(np.uint64) + np.uint64(1)) * low[at & 0xFFFF]
            if at.max() >> 16:
                value *= high[at >> 16]
            value[self.outside[x:y]] = 0
            sums = np.add.reduceat(value, begins - x)
            total[max(k, 0) : n] += sums[1:] if k < 0 else sums
        return mix(total + (self.end - self.start).astype(np.uint64), seed)

    def prefix_hashes(self, lengths: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length in characters: the words that are longer, and the hash of their first characters."""
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {k: [(np.zeros(0, np.int64), np.zeros(0, np.uint64))] for k in lengths}
        live, most = np.arange(len(self.start)), max(lengths)
        value, chars = np.zeros(len(live), np.uint64), np.zeros(len(live), np.int64)
        for j, power in enumerate(_powers(4 * most + 1, _BASE)):
            going = (self.start[live] + j < self.end[live]) & (chars <= most)
            live, value, chars = live[going], value[going], chars[going]
            if not len(live):
                break
            byte = self.data[self.start[live] + j]
            head = (byte & 0xC0) != 0x80
            chars = chars + head
            for k in lengths:
                longer = np.flatnonzero(head & (chars == k + 1))
                found[k].append((live[longer], mix(value[longer], k)))
            value = value + (byte.astype(np.uint64) + np.uint64(1)) * power
        out = []
        for k in lengths:
            words, hashes = (np.concatenate(x) for x in zip(*found[k]))
            order = np.argsort(words)
            out.append((words[order], hashes[order]))
        return out


def grams(word_hash: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``n`` words from each position; the last n-1 run over the end and mean nothing."""
    out = np.zeros(len(word_hash), np.uint64)
    base = np.uint64(0xC2B2AE3D27D4EB4F)
    for j in range(n):
        out *= base
        if j < len(out):
            out[: len(out) - j] += word_hash[j:]
    return mix(out, seed + n)
