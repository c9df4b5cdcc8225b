"""Hashes of words and of runs of words, over whole arrays of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 2 << 20
_BASE = 0xD6E8FEB86659FD93  # odd, so powers never vanish
_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 on unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(data: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Stretches of about `size` bytes that end behind white space (or at the end)."""
    at = 0
    while at < len(data):
        to = at + size
        while to < len(data):
            white = np.flatnonzero(_WHITE[data[to : to + 4096]])
            if len(white):
                to += int(white[0]) + 1
                break
            to += 4096
        to = min(to, len(data))
        yield at, to
        at = to


def stretches(texts: pa.Array, size: int, rows: int = 1 << 30) -> Iterator[tuple[int, list[str | None]]]:
    """First row and texts of stretches of about `size` bytes and at most `rows` rows. Only one is
    made into Python objects at a time, however large the batch is."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        to = min(int(np.searchsorted(ends, before + size)) + 1, at + rows, len(texts))
        yield at, texts.slice(at, to - at).to_pylist()
        at = to


def powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and 64-bit hashes of the words (runs of bytes other than white space)."""
    white = _WHITE[data]
    edge = np.diff(np.concatenate([[True], white, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    lengths = ends - starts
    table = powers(int(lengths.max()))
    inside = np.flatnonzero(~white)
    place = inside - np.repeat(starts, lengths)
    terms = (data[inside].astype(np.uint64) + np.uint64(1)) * table[place]
    sums = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
    return starts, mixed(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
