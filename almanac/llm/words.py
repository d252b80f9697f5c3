"""Words and their 64-bit hashes from Arrow text columns, a whole block of texts at a time.

A block is the UTF-8 bytes of many texts laid end to end. Words are found by byte class, and every
word gets a polynomial hash from one running sum over the block, so no Python code runs per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 1_000
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
MARKS = np.zeros(256, dtype=bool)
MARKS[0:0x30] = MARKS[0x3A:0x61] = MARKS[0x7B:0x80] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def release() -> None:
    """Give memory that a task has freed back to the system; a worker outlives its tasks beside the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not this C library


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0], have = 1, 1
    while have < n:
        step = np.uint64(pow(base, have, 1 << 64))
        more = min(have, n - have)
        out[have : have + more] = out[:more] * step
        have += more
    return out


_LETTERS = mix(FOLD.astype(np.uint64) + np.uint64(1))
_EXACT = mix(np.arange(1, 257, dtype=np.uint64))
_table: dict[str, np.ndarray] = {"up": _powers(_BASE, 1), "down": _powers(_INVERSE, 1)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n-1 of the hash base and of its inverse."""
    if len(_table["up"]) < n:
        size = max(n, BLOCK_BYTES + (1 << 17))
        _table["up"], _table["down"] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _table["up"][:n], _table["down"][:n]


@dataclass
class Words:
    """Words of a block: byte bounds and hash of each, and how many words each text has."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # words of text i are bounds[i]:bounds[i + 1]

    def word(self, i: int) -> bytes:
        return FOLD[self.data[self.starts[i] : self.ends[i]]].tobytes()


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of runs of rows with at most `limit` bytes, or one longer row."""
    for start in range(0, len(column), BLOCK_ROWS):
        # Rows are copied a few at a time: a whole batch of long texts would be copied twice.
        part = column.slice(start, BLOCK_ROWS).fill_null("").cast(pa.large_binary())
        offsets = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset : part.offset + len(part) + 1]
        raw = part.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
        at = 0
        while at < len(part):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            to = min(to, len(part))
            yield start + at, start + to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to
    release()


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words between separator bytes; a word never crosses two texts."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = ~separators[data]
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    heads = offsets[:-1]
    before[heads[heads < n]] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    tails = offsets[1:]
    after[tails[tails > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def find_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> Words:
    """Words between separator bytes; A-Z are folded in the hash, a word never crosses two texts."""
    starts, ends = word_bounds(data, offsets, separators)
    if not len(data):
        return Words(data, starts, ends, starts.astype(np.uint64), np.zeros(len(offsets), np.int64))
    return Words(data, starts, ends, span_hashes(data, starts, ends, _LETTERS), np.searchsorted(starts, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _EXACT) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def runs_hash(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` consecutive values."""
    n = len(hashes) - size + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(_BASE) + hashes[i : i + n])
    return out
