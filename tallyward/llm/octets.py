"""Whole texts of an Arrow batch as one run of bytes, for work on all of them at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

# A-Z become a-z; all other bytes, those of multi-byte letters too, stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_SEED = np.uint64(0x9E3779B97F4A7C15)


def runs(texts: pa.Array, limit: int = 2_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the first text, UTF-8 bytes of some texts in a row, their bounds).

    NULL counts as empty. A text longer than `limit` comes alone, and whole.
    """
    values = texts.cast(pa.binary()).fill_null(b"").to_pylist()
    at, size = 0, 0
    for k in range(len(values) + 1):
        if k == len(values) or (size + len(values[k]) > limit and k > at):
            if k > at:
                some = values[at:k]
                bounds = np.cumsum([0, *map(len, some)])
                yield at, np.frombuffer(b"".join(some), dtype=np.uint8), bounds
            at, size = k, 0
        if k < len(values):
            size += len(values[k])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = np.ones(1, dtype=np.uint64)
_INVERSES = np.ones(1, dtype=np.uint64)
_BASE = 0xD6E8FEB86659FD93


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2 ** 64."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        size = max(n, 1 << 21)
        _POWERS = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE, dtype=np.uint64)])
        _INVERSES = np.cumprod(np.r_[np.uint64(1), np.full(size, inverse, dtype=np.uint64)])
    return _POWERS[:n], _INVERSES[:n]


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and how many words each text has.

    Words are runs of bytes other than ASCII white space within a text, A-Z as a-z.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(bounds) - 1, dtype=np.int64)
    low = LOWER[data]
    word = ~SPACE[low]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edges = bounds[1:-1]
    edges = edges[(edges < n)]
    first[edges] = word[edges]
    last = word.copy()
    last[:-1] &= ~word[1:]
    inner = edges[edges > 0] - 1
    last[inner] = word[inner]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _powers(n + 1)
    run = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mixed(low.astype(np.uint64) + _SEED) * power[:n], out=run[1:])
    hashes = mixed((run[end] - run[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    counts = np.diff(np.searchsorted(begin, bounds))
    return hashes, counts


def shingle_hashes(
    hashes: np.ndarray, counts: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and how many it has.

    A shingle is `width` words in a row; a text with fewer words, but some, is one
    shingle as a whole.
    """
    starts = np.cumsum(counts) - counts
    number = np.where(counts == 0, 0, np.maximum(counts - width + 1, 1))
    owner = np.repeat(np.arange(len(counts)), number)
    first = np.repeat(starts, number) + (
        np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    )
    held = np.repeat(np.minimum(counts, width), number)
    value = held.astype(np.uint64) * _SEED
    padded = np.r_[hashes, np.zeros(width, dtype=np.uint64)]
    for k in range(width):
        here = np.where(k < held, padded[first + k], np.uint64(0))
        value = mixed(value * np.uint64(_BASE) + here + np.uint64(k))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.bincount(owner, minlength=len(counts))


def lists(values: np.ndarray, counts: Iterable[int], kind: pa.DataType) -> pa.Array:
    """Values in a row as an Arrow list per count."""
    offsets = np.cumsum([0, *counts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
