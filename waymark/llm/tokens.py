"""Words and word shingles of Arrow text columns, as flat numpy arrays.

Texts are read as UTF-8 bytes. The blanks that part words are ASCII, so splitting bytes
splits code points rightly. Words are hashed to 64 bits (a polynomial hash, then a
finalizer); equal words have equal hashes in every task and session.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32

#: Texts are worked on in groups of about so many bytes; a longer text is a group of its own.
GROUP_BYTES = 1 << 19
#: Words are found and hashed in pieces of about so many bytes.
PIECE_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15 | 1


def finalize(x: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), BASE, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Texts:
    """Several texts end to end: text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def sum_per_text(self, per_byte: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(per_byte, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def groups(column: pa.Array, size: int = GROUP_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, row after the last, texts) of runs of rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    ends = ends.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        yield at, to, Texts(raw[ends[at] : ends[to]], ends[at : to + 1] - ends[at])
        at = to


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, code point, bytes) of the characters of two bytes or more."""
    lead = np.flatnonzero(data >= 0xC2)
    first = data[lead].astype(np.int32)
    rest = [data[np.minimum(lead + j, len(data) - 1)].astype(np.int32) & 63 for j in (1, 2, 3)]
    two = ((first & 31) << 6) | rest[0]
    three = ((first & 15) << 12) | (rest[0] << 6) | rest[1]
    four = ((first & 7) << 18) | (rest[0] << 12) | (rest[1] << 6) | rest[2]
    return lead, np.where(first < 0xE0, two, np.where(first < 0xF0, three, four)), 2 + (first >= 0xE0) + (first >= 0xF0)


def among(points: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """Mask of the points inside one of the ranges (first, last), which are in rising order."""
    at = np.searchsorted(ranges[:, 0], points, "right") - 1
    return (at >= 0) & (points <= ranges[np.maximum(at, 0), 1])


def character_cuts(data: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """(begin, end) of pieces of about ``size`` bytes that part no character."""
    at = 0
    while at < len(data):
        to = min(at + size, len(data))
        while to < len(data) and data[to] & 0xC0 == 0x80:
            to += 1
        yield at, to
        at = to


@dataclass
class Words:
    """Words of some texts: bytes start[j]:end[j], hashes, and text i has words bounds[i]:bounds[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def piece_ends(texts: Texts) -> Iterator[int]:
    """Ends of pieces that part no word: ends of texts, or blanks inside a long text. A word longer than a piece has its own."""
    n, at = len(texts.data), 0
    while at < n:
        to = int(texts.offsets[np.searchsorted(texts.offsets, at + PIECE_BYTES, "right") - 1])
        if to <= at:
            stop = int(texts.offsets[np.searchsorted(texts.offsets, at, "right")])
            to = min(at + PIECE_BYTES, stop)
            if to < stop and not IS_BLANK[texts.data[to]]:
                before = np.flatnonzero(IS_BLANK[texts.data[at + 1 : to]])
                if len(before):
                    to = at + 1 + int(before[-1])
            while to < stop and not IS_BLANK[texts.data[to]]:
                more = np.flatnonzero(IS_BLANK[texts.data[to : min(stop, to + 4096)]])
                to = to + int(more[0]) if len(more) else min(stop, to + 4096)
        yield to
        at = to


def sums_of(data: np.ndarray, s: np.ndarray, e: np.ndarray, word: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The polynomial sum over each word data[s:e]; ``word`` marks their bytes."""
    if len(s) == 1:  # a long word, perhaps: in parts
        total, scale = 0, 1
        for at in range(int(s[0]), int(e[0]), PIECE_BYTES):
            part = table[data[at : min(at + PIECE_BYTES, int(e[0]))]].astype(U64) + U64(1)
            total += scale * int(np.sum(part * powers(len(part))))
            scale = scale * pow(BASE, PIECE_BYTES, 1 << 64) % (1 << 64)
        return np.array([total % (1 << 64)], U64)
    length = e - s
    place = np.flatnonzero(word)
    value = (table[data[place]].astype(U64) + U64(1)) * powers(int(length.max()))[place - np.repeat(s, length)]
    return np.add.reduceat(value, np.concatenate(([0], np.cumsum(length)[:-1])))


def words_of(texts: Texts, lower: bool = True) -> Words:
    starts, ends, hashes, at = [], [], [], 0
    table = LOWER if lower else SAME
    for to in piece_ends(texts):
        piece = texts.data[at:to]
        word = ~IS_BLANK[piece]
        inner = texts.offsets[(texts.offsets > at) & (texts.offsets < to)] - at
        before = np.concatenate(([False], word[:-1]))
        before[inner] = False
        after = np.concatenate((word[1:], [False]))
        after[inner - 1] = False
        s = np.flatnonzero(word & ~before)
        e = np.flatnonzero(word & ~after) + 1
        if len(s):
            hashes.append(finalize(sums_of(piece, s, e, word, table) ^ ((e - s).astype(U64) << U64(48))))
            starts.append(s + at)
            ends.append(e + at)
        at = to
    none = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else none
    return Words(
        start,
        np.concatenate(ends) if ends else none,
        np.concatenate(hashes) if hashes else np.zeros(0, U64),
        np.searchsorted(start, texts.offsets, "left"),
    )


def fold(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several, in order."""
    out = parts[0].copy()
    for part in parts[1:]:
        out = finalize(out * U64(0xD6E8FEB86659FD93) + part)
    return out


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every run of ``size`` words that lies in one text."""
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    whole = fold([words.hash[j : n + j] for j in range(size)])
    last = np.repeat(words.bounds[1:], words.counts)[:n]
    inside = np.flatnonzero(np.arange(n) + size <= last)
    return whole[inside], inside


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct shingle hashes; a shorter text is one shingle, an empty one none."""
    hashes, first = shingles_of(words, size)
    cuts = np.searchsorted(first, words.bounds)
    out = []
    for i, count in enumerate(words.counts):
        if count >= size:
            out.append(np.unique(hashes[cuts[i] : cuts[i + 1]]))
        elif count:
            own = words.hash[words.bounds[i] : words.bounds[i + 1]]
            out.append(finalize(fold([own[j : j + 1] for j in range(count)]) + U64(count)))
        else:
            out.append(np.zeros(0, U64))
    return out
