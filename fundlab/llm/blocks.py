"""Vectorised views of whole UTF-8 texts inside Arrow batches.

A batch's texts lie in one buffer. The helpers find words and hash spans of that
buffer with numpy, so no Python object is made per text or per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: The word separators of every contract here: space and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
RANDOM = np.random.default_rng(20240).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = (h ^ (h >> U64(31))) * U64(0x7FB5D329728EA185)
    h = (h ^ (h >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return h ^ (h >> U64(33))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE), np.full(n, INVERSE)
    up[0] = down[0] = U64(1)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class SpanHash:
    """Polynomial hashes of any spans of a buffer, from one prefix sum."""

    def __init__(self, data: np.ndarray) -> None:
        size = 1 << max(16, int(len(data)).bit_length())
        self.up, self.down = _powers(size)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(RANDOM[data] * self.up[: len(data)], out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start] + (end - start).astype(np.uint64))


def blocks(texts: pa.Array, limit: int = 1 << 20, tail: str = "\n") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past the last row, bytes, row offsets) with at most ``limit`` bytes or one row.

    A null text counts as empty. Each text is followed by ``tail``; a row's
    offsets include it.
    """
    if not len(texts):
        return
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes + len(tail.encode()), dtype=np.int64)
    wide = pa.large_string()
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + limit, "right")))
        part = pc.fill_null(texts.slice(first, last - first).cast(wide), "")  # one block at a time, not a copy of the batch
        _, where, raw = (part := pc.binary_join_element_wise(part, pa.scalar("", wide), pa.scalar(tail, wide))).buffers()
        where = np.frombuffer(where, np.int64)[part.offset : part.offset + len(part) + 1]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        yield first, last, data[where[0] : where[-1]], where - where[0]
        first = last


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without separators."""
    edge = np.flatnonzero(np.diff(SPACE[data], prepend=True, append=True))
    return edge[::2], edge[1::2]


def row_of(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The row of the block that holds each byte position."""
    return np.searchsorted(offsets, at, "right") - 1


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum counts by key over (keys, counts) pairs."""
    keys = np.concatenate([k for k, _ in parts])
    n = np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(keys) else n


def grouped(batches: Iterator[pa.RecordBatch], column: str, least: int = 1) -> Iterator[pa.Table]:
    """Rows that are sorted by a column, as tables of ``least`` rows or more that never split its values."""
    held, n, wait = [], 0, least
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= wait and batch.num_rows:
            table = pa.Table.from_batches(held)
            key = table.column(column).to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield table.slice(0, cut).combine_chunks()
                held, n = table.slice(cut).to_batches(), table.num_rows - cut
            wait = max(least, 2 * n if not cut else 0)
    if n:
        yield pa.Table.from_batches(held).combine_chunks()
