"""Substring dedup by content-defined chunks.

A gear hash rolls over a text's bytes; where it falls under a limit a chunk
ends, so chunks resist shifts from insertions. From each chunk's start the fewest
chunks that hold SPAN_WORDS words are its window. A window with the digest of one
in another row is a passage that the other row holds whole; windows that overlap
or touch form one span, so every SPAN_WORDS words of a span stand together in some
other row (up to chunk borders).

Edge cases: a null or empty text has no chunks; a text of fewer than SPAN_WORDS
words has no window; repeated rows repeat each other's spans; a window's first
occurrence is the one in the row of the least id (null last; of equal ids the least hash of the text), so
nothing depends on how rows lie in files; an empty table gives an empty result; columns besides the id and the text are ignored. Windows are told
apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab.llm.blocks import SpanHash, blocks, row_of, words
from fundlab.skew import join_unique
from fundlab.storage import materialize

#: Bytes: mean distance of boundaries, least distance kept, longest chunk.
MEAN, LEAST, MOST = 24, 12, 256
#: Words of a window. A passage of 50 words loses what lies before its first and after its last boundary.
SPAN_WORDS = 16
_GEAR = np.random.default_rng(77).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The 32-bit gear hash after each byte: each earlier byte's number shifted by its distance, by doubling."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        h[step:] += h[:-step] << np.uint32(step)
    return h


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of a block of texts (each followed by one tail byte)."""
    h = gear(data)
    starts, ends = offsets[1:-1], offsets[2:]
    before = h[starts - 1]
    for k in range(min(31, int((ends - starts).max(initial=0)))):  # a text's hashes hold none of the bytes of the text before it
        inside = starts + k < ends
        h[starts[inside] + k] -= before[inside] << np.uint32(k + 1)
    at = np.flatnonzero(h < np.uint32((1 << 32) // MEAN)) + 1
    at = at[(data[np.minimum(at, len(data) - 1)] & 0xC0) != 0x80]  # never inside a character
    row = row_of(offsets, at - 1)
    at = at[(at - offsets[row] >= 32) & (at < offsets[row + 1])]
    at = at[np.diff(at, prepend=-LEAST) >= LEAST]
    points = np.unique(np.concatenate([offsets[:-1], offsets[1:] - 1, at]))
    ends = np.append(points[1:], len(data))
    text_ends = np.zeros(len(data) + 1, bool)
    text_ends[offsets[1:] - 1] = True
    inside = ~text_ends[points]
    start, end = points[inside], ends[inside]
    long = np.flatnonzero(end - start > MOST)
    if len(long):
        more = [p for k in long for p in _further(h, data, int(start[k]), int(end[k]))]
        start = np.sort(np.concatenate([start, more]))
        end = np.sort(np.concatenate([end, more]))
    return start, end


def _further(h: np.ndarray, data: np.ndarray, start: int, end: int) -> Iterator[int]:
    """Boundaries inside a chunk that is too long: where the hash is least, the last of equals.

    In a run of one repeated word they fall on one place in the word, wherever the run starts.
    """
    while end - start > MOST:
        at = np.arange(start + LEAST, start + MOST)
        at = at[(data[at] & 0xC0) != 0x80]
        at = at[len(at) - 1 - int(np.argmin(h[at - 1][::-1]))]
        yield int(at)
        start = int(at)


def _windows(words_: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_number = TaskContext.get().partitionId() << 36
        for batch in batches:
            for first, last, data, offsets in blocks(batch.column("text")):
                start, end = cut(data, offsets)
                whole_text = SpanHash(data)(offsets[:-1], offsets[1:]).view(np.int64)
                begun = np.zeros(len(data) + 1, np.int64)
                begun[words(data)[0] + 1] = 1
                begun = np.cumsum(begun)
                until = np.searchsorted(begun[end], begun[start] + words_)
                row = row_of(offsets, start)
                whole = until < len(end)
                whole[whole] = row[until[whole]] == row[whole]
                start, end, row = start[whole], end[until[whole]], row[whole]
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                place = lambda counted, at, row=row, offsets=offsets: pa.array((counted[at] - counted[offsets[row]]).astype(np.int32))
                ids = batch.column("doc_id").slice(first, last - first).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(row_number + row), ids, pa.array(whole_text[row]), place(points, start), place(points, end), place(begun, start), place(begun, end), pa.array(SpanHash(data)(start, end).view(np.int64))], names=["row", "doc_id", "text_hash", "start", "stop", "word", "last_word", "digest"])
                row_number += last - first

    return run


def windows(docs: DataFrame, span_words: int = SPAN_WORDS) -> DataFrame:
    """row, doc_id, text_hash, start, stop (code points), word, last_word (their numbers), digest of each window."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_windows(span_words), f"row long, doc_id {kind}, text_hash long, start int, stop int, word int, last_word int, digest long")


def repeats(docs: DataFrame, span_words: int = SPAN_WORDS) -> DataFrame:
    """Spans that also stand in other rows: row, doc_id, start, length (code points), n_words, n_windows,
    n_copies (of its commonest window), is_first (no window of it stands in an earlier row), first_doc_id.
    Rows are in the order of their ids (null last), then of their texts' hashes, so the result does not depend on how they lie
    in files; of rows equal in both any one is the first.

    Digests are counted with partial sums before the shuffle; the windows of a
    digest that very many rows share are dealt to several tasks.
    """
    found = materialize(windows(docs, span_words))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "row")
    counts = found.groupBy("digest").agg(F.count("*").alias("n"), F.min("row").alias("least"), F.max("row").alias("most"), F.min(place).alias("first"))
    shared = materialize(counts.filter(F.col("least") < F.col("most")).select("digest", "n", F.col("first.row").alias("first_row"), F.col("first.doc_id").alias("first_doc_id")))
    hits = join_unique(found, shared, ["digest"], counts=shared)
    by_place = Window.partitionBy("row").orderBy("start", "stop")
    before = F.max("stop").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    placed = hits.withColumn("new", (F.coalesce(before, F.lit(-1)) < F.col("start")).cast("int"))
    placed = placed.withColumn("span", F.sum("new").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    return placed.groupBy("row", "span").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), (F.max("stop") - F.min("start")).alias("length"), (F.max("last_word") - F.min("word")).cast("long").alias("n_words"),
        F.count("*").alias("n_windows"), F.max("n").alias("n_copies"), F.min(F.col("first_row") == F.col("row")).alias("is_first"), F.min_by("first_doc_id", "start").alias("first_doc_id"),
    ).drop("span")


def without_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs, whose ids are unique, with every span that is not a first occurrence cut out of the text."""
    gone = spans.filter(~F.col("is_first")).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_gone"))
    edge = lambda k: F.when(k < 0, 0).otherwise(F.get("_gone", k)["start"] + F.get("_gone", k)["length"])
    kept = F.transform(F.sequence(F.lit(0), F.size("_gone")), lambda k: F.substring("text", edge(k - 1) + 1, F.coalesce(F.get("_gone", k)["start"], F.length("text")) - edge(k - 1)))
    return docs.join(gone, "doc_id", "left").withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, ""))).drop("_gone")
