"""Hashed word shingles of many texts at once, with numpy over Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
CHUNK = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of BASE and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK + 1)
            ones = np.ones(size, np.uint64)
            ones[1:] = BASE
            self.up = np.multiply.accumulate(ones)
            ones[1:] = INVERSE
            self.down = np.multiply.accumulate(ones)
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def word_places(text: np.ndarray, ends: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word (run without bytes of gaps) of texts laid end to end, and the byte behind it."""
    solid = ~gaps[text]
    before, after = np.zeros_like(solid), np.zeros_like(solid)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    starts_of = np.concatenate(([0], ends[:-1]))
    before[starts_of[starts_of < len(text)]] = False
    after[ends[ends > 0] - 1] = False
    return np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1


def word_hashes(text: np.ndarray, ends: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lowered, of texts laid end to end; number of words of each text."""
    first, last = word_places(text, ends, gaps)
    up, down = POWERS.upto(len(text))
    sums = np.concatenate(([np.uint64(0)], np.cumsum((LOWER[text].astype(np.uint64) + np.uint64(1)) * up)))
    hashes = mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) if len(first) else np.zeros(0, np.uint64)
    return hashes, np.diff(np.searchsorted(first, np.concatenate(([0], ends)), "left"))


WEIGHTS = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def sets_of(words: np.ndarray, counts: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text; with fewer words than width the whole sequence as one; none without words."""
    with np.errstate(over="ignore"):
        wide = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for j in range(width):
            wide += words[j : len(words) - width + 1 + j] * WEIGHTS[j]
        wide = mixed(wide)
        at = 0
        for n in counts.tolist():
            if n >= width:
                yield np.unique(wide[at : at + n - width + 1])
            elif n:
                yield mixed((words[at : at + n] * WEIGHTS[8 : 8 + n]).sum(keepdims=True) + np.uint64(n))
            else:
                yield np.zeros(0, np.uint64)
            at += n


def text_chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts of an Arrow string column (null: empty) as chunks of bytes, of about CHUNK bytes or one text, with their ends."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = min(max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1), len(column))
        yield data[offsets[at] : offsets[to]], offsets[at + 1 : to + 1] - offsets[at]
        at = to


def text_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The shingle set of each text of an Arrow string column."""
    with np.errstate(over="ignore"):
        for text, ends in text_chunks(column):
            words, counts = word_hashes(text, ends)
            yield from sets_of(words, counts, width)
