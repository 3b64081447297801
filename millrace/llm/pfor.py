"""Patched frame-of-reference blocks of unsigned 32-bit integers.

A block holds ``BLOCK`` integers. Its smallest is subtracted; what remains is
packed at the width that ``PERCENTILE`` percent of the block need; positions and
full values of the others, the exceptions, follow. Each block begins with
``minimum u32, width u8, 0 u8, exceptions u16``, then come ``BLOCK / 8`` bytes per
bit of width, exception positions (u8) and exception values (u32), all
little-endian. The last block is filled up with its last integer.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128
PERCENTILE = 90
HEADER = 8


def _widths(values: np.ndarray) -> np.ndarray:
    return np.where(values, np.floor(np.log2(np.maximum(values, 1).astype(np.float64))) + 1, 0).astype(np.int64)


def _spread(begin: np.ndarray, each: int) -> np.ndarray:
    return begin[:, None] + np.arange(each)


def _flat(begin: np.ndarray, times: np.ndarray) -> np.ndarray:
    """begin[i], begin[i] + 1, ... for each i, ``times[i]`` of them."""
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(begin, times) + nth


def encode(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Blocks of all ids, and where each block begins."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    fill = -len(ids) % BLOCK
    blocks = np.concatenate([ids, np.repeat(ids[-1:], fill)]).astype("<u4").reshape(-1, BLOCK)
    least = blocks.min(axis=1)
    delta = blocks - least[:, None]
    nth = min(BLOCK - 1, BLOCK * PERCENTILE // 100)
    width = _widths(np.partition(delta, nth, axis=1)[:, nth])
    outside = delta.astype(np.uint64) >> width[:, None].astype(np.uint64) > 0
    exceptions = outside.sum(axis=1)
    size = HEADER + width * (BLOCK // 8) + exceptions * 5
    begin = np.cumsum(size) - size
    out = np.zeros(size.sum(), np.uint8)
    head = np.zeros((len(blocks), HEADER), np.uint8)
    head[:, :4] = least.astype("<u4").view(np.uint8).reshape(-1, 4)
    head[:, 4] = width
    head[:, 6:8] = exceptions.astype("<u2").view(np.uint8).reshape(-1, 2)
    out[_spread(begin, HEADER)] = head
    for w in np.unique(width).tolist():
        if w:
            own = np.flatnonzero(width == w)
            inside = np.where(outside[own], 0, delta[own]).astype(">u4").view(np.uint8)
            bits = np.unpackbits(inside.reshape(-1, 4)[:, (32 - w) // 8 :], axis=1)[:, -w:]
            packed = np.packbits(bits.reshape(len(own), -1), axis=1)
            out[_spread(begin[own] + HEADER, w * (BLOCK // 8))] = packed
    row, position = np.nonzero(outside)
    at = begin + HEADER + width * (BLOCK // 8)
    out[_flat(at, exceptions)] = position
    raw = blocks[row, position].astype("<u4").view(np.uint8)
    out[_flat(at + exceptions, exceptions * 4)] = raw
    return out.tobytes(), begin


def _unpacked(packed: np.ndarray, width: int) -> np.ndarray:
    """The ``BLOCK`` integers of each row of packed bytes."""
    bit = np.arange(BLOCK) * width
    first, past = bit >> 3, (bit & 7) + width
    touched = int((past.max() + 7) >> 3)  # bytes that an integer may lie in, at most 5
    kind = np.uint32 if touched <= 4 else np.uint64
    padded = np.pad(packed, ((0, 0), (0, touched)))
    found = np.zeros((len(packed), BLOCK), kind)
    for k in range(touched):
        found = found << kind(8) | padded[:, first + k]
    return (found >> (8 * touched - past).astype(kind)) & kind((1 << width) - 1)


def decode(raw: np.ndarray, begin: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` ids of the blocks that begin at ``begin`` in ``raw``."""
    if not len(begin):
        return np.zeros(0, "<u4")
    head = raw[_spread(begin, HEADER)]
    least = head[:, :4].copy().view("<u4").ravel()
    width = head[:, 4].astype(np.int64)
    exceptions = head[:, 6:8].copy().view("<u2").ravel().astype(np.int64)
    ids = np.zeros((len(begin), BLOCK), np.uint32)
    for w in np.unique(width).tolist():
        if w:
            own = np.flatnonzero(width == w)
            packed = raw[_spread(begin[own] + HEADER, w * (BLOCK // 8))]
            ids[own] = _unpacked(packed, w)
    ids += least[:, None]
    at = begin + HEADER + width * (BLOCK // 8)
    position = raw[_flat(at, exceptions)]
    values = raw[_flat(at + exceptions, exceptions * 4)].copy().view("<u4")
    ids[np.repeat(np.arange(len(begin)), exceptions), position] = values
    return ids.ravel()[:count].astype("<u4")
