"""CRC-32 of many byte spans side by side."""

from __future__ import annotations

import zlib

import numpy as np

# Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
LONG = 64
ALL = np.uint32(0xFFFFFFFF)


def _steps() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(POLYNOMIAL), out >> 1)
    return out


STEPS = _steps()


def extend(sums: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What each checksum becomes when the bytes of its span follow; 0 stands for no bytes before."""
    sizes = ends - starts
    order = np.argsort(np.minimum(sizes, LONG + 1).astype(np.uint8), kind="stable")[::-1]
    sizes, at = sizes[order], starts[order]
    state = sums.astype(np.uint32)[order] ^ ALL
    long = int(np.count_nonzero(sizes > LONG))
    for i in range(long):
        rest = data[at[i] : at[i] + sizes[i]].tobytes()
        state[i] = np.uint32(zlib.crc32(rest, int(state[i] ^ ALL))) ^ ALL
    short, at, sizes = state[long:], at[long:], sizes[long:]
    for i in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -i, "left"))
        part = short[:live]
        short[:live] = STEPS[(part ^ data[at[:live] + i]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ ALL
    return out


def followed_by(sums: np.ndarray, byte: int) -> np.ndarray:
    """What each checksum becomes when one byte follows."""
    state = sums ^ ALL
    return STEPS[(state ^ np.uint32(byte)) & np.uint32(0xFF)] ^ (state >> np.uint32(8)) ^ ALL
