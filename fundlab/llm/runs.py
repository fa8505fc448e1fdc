"""Periodic runs of words, and texts without their repetitions.

A run is a longest stretch of words with smallest period q: words q apart are equal, and
no neighbouring word continues that. Runs of at least LEAST words and TIMES periods are
found. The words of a block of texts are named level by level: level k names
the 2**k words from a place on by the pair of names of their halves, ranked by sorting, so
equal names mean equal words of one text. How far two places agree, forwards or backwards,
follows from one comparison on each level, from the highest down.

Candidates: a run of TIMES periods q holds a multiple of 2q (counted from its text's start)
after which q words equal those q further on. So for each q these places alone are
compared, first on the level of q (texts that repeat nothing end there), then extended both
ways. That is about half of n ln(n) places for n words. A stretch found for several q keeps the least.

A text is never cut, and is handled by the task that reads it: names take four bytes a word
for each level, and only levels on which a text of its block repeats something exist.

Edge cases: null texts and texts without words have no runs and collapse to the empty text;
rows are handled one by one, so repeated rows and null ids give a row each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fundlab.llm.blocks import SPACE, blocks, row_of, words

LEAST, TIMES = 6, 4
#: Places compared at once.
PLACES = 1 << 20
SCHEMA = "runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def word_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each word of a buffer; equal words have equal numbers."""
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[~SPACE[data]]))])
    return packed.dictionary_encode().indices.to_numpy().astype(np.int64)


def _named(at: np.ndarray, key: np.ndarray, n: int) -> np.ndarray | None:
    """Names of n places: equal for the places ``at`` with equal keys, negative for those that equal no other. None: no two are equal."""
    _, rank, count = np.unique(key, return_inverse=True, return_counts=True)
    again = count[rank] > 1
    if not again.any():
        return None
    out = -1 - np.arange(n, dtype=np.int32)
    out[at[again]] = rank[again]
    return out


def levels(word: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    """Names of the 2**k words of one text from each place on, for k = 0, 1, ... as long as any two are equal."""
    n = len(word)
    out = []
    name = _named(np.arange(n), row * (int(word.max(initial=0)) + 1) + word, n)
    while name is not None:
        out.append(name)
        half = 1 << (len(out) - 1)
        at = np.flatnonzero((name[:-half] >= 0) & (name[half:] >= 0)) if half < n else np.zeros(0, np.int64)
        name = _named(at, name[at].astype(np.int64) * n + name[at + half], n)
    return out


def forwards(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from the places a on equal those from b > a on."""
    far, n = np.zeros(len(a), np.int64), len(names[0])
    for k in reversed(range(len(names))):
        there = b + far
        far += ((there < n) & (names[k][np.minimum(a + far, n - 1)] == names[k][np.minimum(there, n - 1)])).astype(np.int64) << k
    return far


def backwards(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words before the places a equal those before b > a."""
    far = np.zeros(len(a), np.int64)
    for k in reversed(range(len(names))):
        here = a - far - (1 << k)
        far += ((here >= 0) & (names[k][np.maximum(here, 0)] == names[k][np.maximum(b - far - (1 << k), 0)])).astype(np.int64) << k
    return far


def _counted(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group its number n times, and 0, 1, ... within the group."""
    group = np.repeat(np.arange(len(n)), n)
    return group, np.arange(len(group)) - (np.cumsum(n) - n)[group]


def candidates(first: np.ndarray, size: np.ndarray, names: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) where as many words as the period's highest power of two equal those one period on; texts start at ``first``."""
    text, q = _counted(np.minimum(size // TIMES, (1 << len(names)) - 1))
    q = q + 1
    places = np.maximum((size[text] - q - 1) // (2 * q) + 1, 0)
    upto = np.cumsum(places)
    at = 0
    while at < len(q):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PLACES, "right")))
        pair, within = _counted(places[at:end])
        period = q[at:end][pair]
        place = first[text[at:end][pair]] + within * 2 * period
        level = np.frexp(period.astype(float))[1] - 1
        for k in range(int(level.min(initial=0)), int(level.max(initial=-1)) + 1):
            on = np.flatnonzero(level == k)
            on = on[names[k][place[on]] == names[k][place[on] + period[on]]]
            if len(on):
                yield place[on], period[on]
        at = end


def find(word: np.ndarray, row: np.ndarray, n_rows: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length, period) of the runs of all texts, by row, start and period; starts count from the text's first word."""
    none = np.zeros(0, np.int64)
    names = levels(word, row) if len(word) else []
    if not names:
        return none, none, none, none
    size = np.bincount(row, minlength=n_rows)
    first = np.cumsum(size) - size
    found = []
    for place, period in candidates(first, size, names):
        back = backwards(names, place, place + period)
        length = back + forwards(names, place, place + period) + period
        on = length >= np.maximum(least, TIMES * period)
        found.append(np.stack([place[on] - back[on], length[on], period[on]]))
    if not found:
        return none, none, none, none
    start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])]) if len(start) else none.astype(bool)
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    of = row[start]
    return of, start - first[of], length, period


def _collapsed(raw: bytes, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words of a text, without those that a run holds after its first period, joined by spaces."""
    split = raw.split()  # bytes split at exactly the separators of a word
    if not len(start):
        return b" ".join(split)
    step = np.zeros(len(split) + 1, np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, start + length, -1)
    return b" ".join([split[k] for k in np.flatnonzero(np.cumsum(step[:-1]) == 0)])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in blocks(batch.column("text")):
            begin, end = words(data)
            row = row_of(offsets, begin)
            of, start, length, period = find(word_ids(data, begin, end), row, last - first)
            cut = np.searchsorted(of, np.arange(last - first + 1))
            raw = data.tobytes()
            texts = [_collapsed(raw[offsets[k] : offsets[k + 1]], *(x[cut[k] : cut[k + 1]] for x in (start, length, period))) for k in range(last - first)]
            each = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), each), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period) and the collapsed text of each row of docs (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scan, f"doc_id {kind}, {SCHEMA}")
