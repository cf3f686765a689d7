"""Hashed word shingles of Arrow text batches: numpy over the UTF-8 bytes, no loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WIDTH = 5
#: Texts are hashed in pieces of so many bytes: bounded memory for any length of text and word.
PIECE = 1 << 20

_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = _BYTES[_LOWER]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = np.random.default_rng(11).integers(1, 1 << 63, WIDTH, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE to the 0..n and its inverse in the ring of 64-bit numbers."""
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = (np.full(n, b, dtype=np.uint64) for b in (_BASE, inverse))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_UP, _DOWN = _powers(PIECE + 1)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word in UTF-8 bytes; A-Z counts as a-z, words end at ASCII white space.

    A word's hash is a sum over its bytes, so one that goes on beyond a piece is carried to the next one.
    """
    starts, hashes = [], []
    open_at, open_sum, open_size = -1, 0, 0
    for at in range(0, len(data), PIECE):
        part = data[at : at + PIECE]
        solid = np.concatenate(([False], ~_SPACE[part], [False]))
        edge = np.flatnonzero(solid[1:] != solid[:-1])
        first, last = edge[::2], edge[1::2]
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[part] * _UP[: len(part)], out=total[1:], dtype=np.uint64)
        start, size, sums = first + at, last - first, (total[last] - total[first]) * _DOWN[first]
        if open_at >= 0 and len(first) and first[0] == 0:  # the open word goes on
            start[0], size[0] = open_at, size[0] + open_size
            sums[0] = (open_sum + int(sums[0]) * pow(_BASE, open_size, 1 << 64)) % (1 << 64)
        elif open_at >= 0:  # it ended with the piece before
            start, size = np.append(open_at, start), np.append(open_size, size)
            sums = np.append(np.array([open_sum], np.uint64), sums)
        open_at = -1
        if len(last) and last[-1] == len(part) and at + PIECE < len(data):
            open_at, open_sum, open_size = int(start[-1]), int(sums[-1]), int(size[-1])
            start, size, sums = start[:-1], size[:-1], sums[:-1]
        starts.append(start)
        hashes.append(mix(sums + size.astype(np.uint64)))
    return (np.concatenate(starts), np.concatenate(hashes)) if starts else (np.zeros(0, int), np.zeros(0, np.uint64))


def windows(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hash of every run of ``width`` words; a shorter, not empty sequence is one run."""
    n = len(words)
    if not n:
        return words
    width = min(width, n)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out += mix(words[k : n - width + 1 + k] * _PLACE[k])
    return mix(out)


def text_batches(column: pa.Array, limit: int = 2 * PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """UTF-8 bytes and row borders of slices of about ``limit`` bytes, in order.

    Each text is followed by a line end, so no word runs over a border; null counts as empty.
    """
    column = column.cast(pa.large_string())
    empty = pa.scalar("", pa.large_string())
    column = pc.binary_join_element_wise(
        column, empty, pa.scalar("\n", pa.large_string()), null_handling="replace", null_replacement=""
    )
    if not len(column):
        return
    borders = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(borders, borders[row] + limit, "right")) - 1)
        yield data[borders[row] : borders[stop]], borders[row : stop + 1] - borders[row]
        row = stop


def shingle_sets(column: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for data, borders in text_batches(column):
        starts, words = word_hashes(data)
        edges = np.searchsorted(starts, borders)
        whole = windows(words, width) if len(words) >= width else words[:0]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield np.unique(whole[a : b - width + 1] if b - a >= width else windows(words[a:b], width))
