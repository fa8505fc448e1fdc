"""Concatenate and cut: documents become fixed windows of tokens without padding between them.

Pass one tokenises each document once and writes its ids with their place in the
partition; a prefix sum over the partitions' totals gives global offsets; pass two
cuts the windows and emits one record for each piece, with flags where a
document begins and ends.

Edge cases: a null text is empty and yields its end token alone; a document longer
than a window spans several; repeated rows are packed each; an empty table gives
no pieces; columns besides the id and the text are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab.llm.blocks import LOWER, SPACE, SpanHash, blocks, row_of, words
from fundlab.storage import materialize

WINDOW = 4096
#: Distinct spans whose ids a Python worker remembers; beyond it it forgets those not met again. This bounds memory only.
REMEMBERED = 1 << 20
#: Bytes of texts that are encoded at once, and spans that the tokenizer is given at once.
AT_ONCE, GIVEN = 1 << 21, 1 << 13
#: What the tokenizer takes as one part, in lower-case words of letters, ASCII digits and ASCII marks.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|[!-/:-@\[-`{-~]+")
_NOT_LETTERS = {c: None for c in range(33, 127) if not chr(c).isalpha()}
#: Bytes as the tokenizer splits words at: letters are those of ASCII and both bytes of U+00C0 to U+00FF.
SEPARATOR, DIGIT, MARK, LETTER, OTHER = range(5)
_KIND = np.array([SEPARATOR if SPACE[c] else OTHER if c < 33 or c in (39, 127) else DIGIT if chr(c).isdigit() else LETTER if chr(c).isalpha() else MARK for c in range(128)] + [LETTER] * 64 + [LETTER if c == 0xC3 else OTHER for c in range(192, 256)], np.uint8)

_encoders: dict[str, WordEncoder] = {}


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of what is encoded apart, whether it is a whole word, and the bytes that tell one from another.

    Words of ASCII and letters up to U+00FF are split into the tokenizer's parts, whose case does not count;
    those with an apostrophe, ``<|``, a control character, U+00D7, U+00F7 or any other character are whole.
    The data ends with a separator.
    """
    kind, lower = _KIND[data], LOWER[data]
    bad = kind == OTHER
    bad[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7)) | (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    if (at := np.flatnonzero(bad)).size:
        start, end = words(data)
        whole = np.unique(np.searchsorted(start, at, "right") - 1)
        step = np.zeros(len(data), np.int8)
        step[start[whole]], step[end[whole]] = 1, -1
        inside = np.cumsum(step, dtype=np.int8).view(bool)
        kind[inside] = OTHER
        lower = np.where(inside, data, lower)
    edge = np.append((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT), True)
    begin = np.flatnonzero(np.append(True, edge[:-1]) & (kind != SEPARATOR))
    return begin, np.flatnonzero(edge & (kind != SEPARATOR)) + 1, kind[begin] == OTHER, lower


class WordEncoder:
    """Ids of texts under a tokenizer that never joins across spaces.

    Spans are told apart by 64-bit hashes over a whole block at a time (two of a
    million distinct spans agree with a probability of about 3e-8). Each
    distinct span is given to the tokenizers library once, many in one call.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are what runs in parallel
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.hashes, self.first, self.count, self.again = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)
        self.flat = np.zeros(0, self.dtype)

    def _make_room(self) -> None:
        """Forget the spans that were not met again, or all if those that were are many."""
        kept = np.flatnonzero(self.again)
        n = self.count[kept]
        if 2 * max(len(kept), int(n.sum()) // 8) > REMEMBERED:
            return self.forget()
        self.flat = _gather(self.flat, self.first[kept], n)
        self.hashes, self.first, self.count, self.again = self.hashes[kept], np.cumsum(n, dtype=np.int64) - n, n, np.zeros(len(kept), bool)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _parts(self, word: str) -> list[str] | None:
        """The word's parts in lower case; None where only the tokenizer knows them."""
        low = word.lower()
        if "<|" in word or not word.isprintable() or not (word.isascii() or ("Σ" not in word and low.translate(_NOT_LETTERS).isalpha() and unicodedata.is_normalized("NFC", low))):
            return None
        return _PARTS.findall(low)

    def _learn(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of parts and the number of each; the last id of each says that it ends there."""
        ids = np.array(self._ids(" ".join(parts)), self.dtype)
        ends = np.flatnonzero(self.ends[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(parts) else self._joined([np.array(self._ids(p), self.dtype) for p in parts])

    def _joined(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([self.flat[:0], *ids]), np.fromiter(map(len, ids), np.int64, len(ids))

    def _learn_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [self._parts(w) for w in words]
        parts = list(set(chain.from_iterable(p for p in split if p is not None)))
        ids, n = self._learn(parts)
        known = dict(zip(parts, np.split(ids, np.cumsum(n)[:-1]), strict=True)) if parts else {}
        return self._joined([np.array(self._ids(w), self.dtype) if p is None else known[p[0]] if len(p) == 1 else np.concatenate([known[x] for x in p]) for w, p in zip(words, split, strict=True)])

    def __call__(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, with end_id last, and all ids."""
        start, end, whole, lower = spans(data)
        hashes = SpanHash(lower)(start, end)
        order = np.argsort(hashes)
        distinct = hashes[order]
        new = np.append(True, distinct[1:] != distinct[:-1])[: len(distinct)]
        distinct, at = distinct[new], order[new]
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(new) - 1
        if len(self.hashes) + len(distinct) > REMEMBERED or len(self.flat) > 8 * REMEMBERED:
            self._make_room()
        place = np.searchsorted(self.hashes, distinct)
        missing = np.append(self.hashes, np.uint64(0))[place] != distinct if len(self.hashes) else np.ones(len(distinct), bool)
        missing[place == len(self.hashes)] = True
        self.again[place[~missing]] = True
        if missing.any():
            self._add(distinct[missing], place[missing], at[missing], start, end, whole, lower)
            place = np.searchsorted(self.hashes, distinct)
        n, first = self.count[place][inverse], self.first[place][inverse]
        per_text = np.bincount(row_of(offsets, start), n, minlength=len(offsets) - 1).astype(np.int64)
        return per_text + 1, np.insert(_gather(self.flat, first, n), np.cumsum(per_text), np.array(end_id, self.dtype))

    def _add(self, hashes: np.ndarray, place: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray, whole: np.ndarray, lower: np.ndarray) -> None:
        """Learn the spans ``at`` with these sorted hashes, which come in before ``place``."""
        raw = lower.tobytes()
        first, count, learned = np.zeros(len(at), np.int64), np.zeros(len(at), np.int32), [self.flat]
        done = len(self.flat)
        for those, learn in ((np.flatnonzero(~whole[at]), self._learn), (np.flatnonzero(whole[at]), self._learn_words)):
            for k in range(0, len(those), GIVEN):
                few = those[k : k + GIVEN]
                ids, n = learn([raw[a:b].decode() for a, b in zip(start[at[few]].tolist(), end[at[few]].tolist(), strict=True)])
                first[few], count[few] = done + np.cumsum(n) - n, n
                learned.append(ids)
                done += len(ids)
        self.flat = np.concatenate(learned)
        self.hashes, self.first, self.count, self.again = (np.insert(old, place, new) for old, new in ((self.hashes, hashes), (self.first, first), (self.count, count), (self.again, False)))


def _gather(flat: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The n values from each place on, one after another."""
    done = np.cumsum(n, dtype=np.int64)
    return flat[np.repeat(first - (done - n), n) + np.arange(int(done[-1]) if len(done) else 0)]


def _tokenized(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoders.get(path) or _encoders.setdefault(path, WordEncoder(path))
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, last, data, offsets in blocks(batch.column("text"), AT_ONCE):
                n, ids = encode(data, offsets, end_id)
                before = done + np.cumsum(n) - n
                done += int(n.sum())
                where = np.concatenate([[0], np.cumsum(n) * ids.itemsize]).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(where), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(last - first, part, np.int64)), batch.column("doc_id").slice(first, last - first), pa.array(before), pa.array(n), packed], names=["part", "doc_id", "before", "n", "ids"])

    return run


def tokenize(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """part, doc_id, before (tokens earlier in the partition), n, ids (packed little-endian), written once."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return materialize(docs.select("doc_id", "text").mapInArrow(_tokenized(path, end_id), f"part long, doc_id {kind}, before long, n long, ids binary"))


def _cut(window: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = batch.column("start").to_numpy()
            n = batch.column("n").to_numpy()
            first, last = start // window, (start + n - 1) // window
            many = last - first + 1
            row = np.repeat(np.arange(len(start)), many)
            sequence = np.repeat(first, many) + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            begin = np.maximum(sequence * window, start[row])
            stop = np.minimum((sequence + 1) * window, (start + n)[row])
            ids = batch.column("ids")
            pieces, crc, held, at = [], [], -1, None
            for r, a, b in zip(row.tolist(), (begin - start[row]).tolist(), (stop - start[row]).tolist(), strict=True):
                if r != held:
                    held, at = r, np.frombuffer(ids[r].as_buffer(), f"<u{width}")
                piece = at[a:b].astype("<u4").tobytes()
                pieces.append(piece)
                crc.append(zlib.crc32(piece))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), *map(pa.array, (begin - start[row], stop - begin)), pa.array(pieces, pa.binary()), pa.array(crc, pa.int64()), *map(pa.array, (n[row], sequence, begin - sequence * window))], names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces of tokenize()'s documents: doc_id, start, length, ids (little-endian unsigned 32-bit),
    ids_crc32, doc_tokens, sequence_id, offset, starts_doc, ends_doc.

    All windows but the last are full.
    """
    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total"))
    earlier = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row for each partition
    bases = totals.select("part", F.coalesce(earlier, F.lit(0)).alias("base"))
    placed = tokens.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n", "ids")
    kind = tokens.schema["doc_id"].dataType.simpleString()
    width = F.max(F.length("ids") / F.col("n"))
    width = int(tokens.agg(width).first()[0] or 4)
    pieces = placed.mapInArrow(_cut(window, width), f"doc_id {kind}, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return pieces.withColumns({"starts_doc": F.col("start") == 0, "ends_doc": F.col("start") + F.col("length") == F.col("doc_tokens")})
