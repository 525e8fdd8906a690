"""Hashed word shingles of Arrow text columns, computed by numpy over whole batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallyforge.llm.common import text_batches

WIDTH = 5

_rng = np.random.default_rng(20240229)
BYTE_VALUES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUES[65:91] = BYTE_VALUES[97:123]  # A-Z count as a-z
PLACES = _rng.integers(0, 1 << 63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int, held: dict = {}) -> np.ndarray:  # noqa: B006
    have = held.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 20), base, np.uint64)
        have[0] = 1
        held[base] = have = np.cumprod(have)
        if n > 1 << 22:
            del held[base]  # don't keep what one very long text needed
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sets_of(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (uint64) of each binary text.

    A text of one to four words has one shingle, the whole; one without words has none.
    """
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    size = int(bounds[-1] - bounds[0])
    if size == 0:
        return [np.zeros(0, np.uint64)] * len(texts)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    bounds -= bounds[0]
    word = ~BLANK[data]
    first = np.zeros(size + 1, bool)
    first[bounds[(bounds < size)]] = True
    starts = np.flatnonzero(word & (first[:size] | np.r_[True, ~word[:-1]]))
    last = np.r_[~word[1:], True] | first[1:]
    last[-1] = True
    ends = np.flatnonzero(word & last) + 1
    total = np.zeros(size + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(BASE, size), out=total[1:])
    hashes = (total[ends] - total[starts]) * powers(BASE_INVERSE, size)[starts]
    hashes = mixed(hashes + (ends - starts).astype(np.uint64))
    if len(hashes) >= WIDTH:
        runs = np.zeros(len(hashes) - WIDTH + 1, np.uint64)
        for k in range(WIDTH):
            runs += hashes[k : len(hashes) - WIDTH + 1 + k] * PLACES[k]
        runs = mixed(runs)
    low = np.searchsorted(starts, bounds)
    out = []
    for a, b in zip(low[:-1], low[1:]):
        if b - a >= WIDTH:
            out.append(np.unique(runs[a : b - WIDTH + 1]))
        elif b > a:
            tag = np.uint64(b - a)
            out.append(mixed((hashes[a:b] * PLACES[: b - a]).sum(dtype=np.uint64, keepdims=True) ^ tag))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(hashes: np.ndarray) -> int | None:
    """A signed 64-bit key of the set; none for the empty set."""
    if not len(hashes):
        return None
    whole = mixed(mixed(hashes ^ np.uint64(BASE)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(hashes)))
    return int(whole.view(np.int64)[0])


def batches_of_sets(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in text_batches(batches, column):
        texts = batch.column(column)
        if texts.null_count:
            texts = texts.fill_null(b"")
        yield batch, sets_of(texts)
