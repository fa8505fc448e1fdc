"""Document quality by supervised subword embeddings.

Words, pairs of words, the fact that a word repeats the one before, and runs of
three to five bytes within a word are hashed to buckets, each with a learned vector. A document is the mean of its features'
vectors; a softmax layer gives its class. Stochastic gradient descent in numpy
trains both on a bounded sample of the labelled rows. For two classes the trained
layers reduce to one number for each bucket, which scoring averages.

Edge cases: a null or empty text has no features and gets the score of the bias
alone; with no labels that is 0.5; a document with several labels teaches each;
repeated rows are each scored and teach once; at most 2 * TRAIN_DOCS examples are learned; columns not named here are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlab.llm.blocks import SPACE, SpanHash, blocks, row_of, words

BITS, DIM, EPOCHS, RATE, SEED = 20, 12, 6, 1.0, 3
#: Most labelled documents that training reads, drawn by a hash of their ids.
TRAIN_DOCS = 5000
#: Features without effect that every text has, so that a few cannot decide a short text.
IDLE = 30
#: The bucket of a word that repeats the one before.
_AGAIN = 1
_ODD = {3: 0x9E3779B97F4A7C15, 4: 0xC2B2AE3D27D4EB4F, 5: 0xD6E8FEB86659FD93, "word": 0xA0761D6478BD642F, "pair": 0xE7037ED1A0B428DB}


def _bucket(codes: np.ndarray, kind) -> np.ndarray:
    return ((codes * np.uint64(_ODD[kind])) >> np.uint64(64 - BITS)).astype(np.int32)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of every feature of a block of texts."""
    data = np.where(SPACE[data], np.uint8(32), data)
    gaps = np.concatenate([[0], np.cumsum(data == 32)])
    code, size = np.zeros(max(0, len(data)), np.uint64), len(data)
    for k in range(5):
        if size <= k:
            return
        code = code[: size - k] | (data[k:].astype(np.uint64) << np.uint64(8 * k))
        if k >= 2:  # n = k + 1 bytes; only the first and the last may be a space
            n = k + 1
            inner = gaps[n - 1 : size] - gaps[1 : size - n + 2]
            at = np.flatnonzero(inner == 0)
            row = row_of(offsets, at)
            inside = at + n < offsets[row + 1] + 1
            yield _bucket(code[at[inside]], n), row[inside]
    start, end = words(data)
    h, row = SpanHash(data)(start, end), row_of(offsets, start)
    yield _bucket(h, "word"), row
    both = row[1:] == row[:-1]
    yield _bucket((h[:-1] + (h[1:] << np.uint64(1)))[both], "pair"), row[1:][both]
    again = both & (h[1:] == h[:-1])
    yield np.full(int(again.sum()), _AGAIN, np.int32), row[1:][again]


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each labelled text as its distinct buckets and their shares."""
    for batch in batches:
        ids, shares = [], []
        for first, last, data, offsets in blocks(batch.column("text")):
            found = list(features(data, offsets))
            bucket, row = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int32),) * 2
            order = np.argsort(row, kind="stable")
            bucket, cut = bucket[order], np.searchsorted(row[order], np.arange(last - first + 1))
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                own, n = np.unique(bucket[a:b], return_counts=True)
                ids.append(own.astype(np.int32).tobytes())
                shares.append((n / (IDLE + b - a)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("label"), pa.array(ids, pa.binary()), pa.array(shares, pa.binary())], names=["doc_id", "label", "ids", "shares"])


def train(examples: pd.DataFrame) -> pd.DataFrame:
    """One row: each bucket's number and the bias, from stochastic gradient descent over the examples."""
    rng = np.random.default_rng(SEED)
    examples = examples.sort_values(["doc_id", "label"], na_position="first")
    labels = examples["label"].to_numpy().astype(int)
    ids = [np.frombuffer(x, np.int32) for x in examples["ids"]]
    shares = [np.frombuffer(x, np.float32)[:, None] for x in examples["shares"]]
    vectors = ((rng.random((1 << BITS, DIM), np.float32) - 0.5) * (2.0 / DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    steps, step = EPOCHS * len(labels), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(labels)):
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            own = vectors[ids[k]]
            hidden = (own * shares[k]).sum(0)
            logits = hidden @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = layer @ p
            layer -= rate * np.outer(hidden, p)
            bias -= rate * np.float32(0.1) * p
            vectors[ids[k]] = own - (rate * shares[k] * len(ids[k]) ** 0.5) * back
    return pd.DataFrame({"numbers": [(vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32).tobytes()], "bias": [float(bias[1] - bias[0])]})


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> tuple[np.ndarray, float]:
    """The trained numbers by bucket and the bias, from docs (doc_id, text) and labels (doc_id, label 0 or 1)."""
    labels = labels.filter(F.col("label").isin(0, 1)).select("doc_id", F.col("label").cast("int").alias("label"))
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 20))
    chosen = labels.filter(draw < int((1 << 20) * min(1.0, most / max(1, labels.count()))))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # about ``most`` short rows
    # Rows that repeat an example teach nothing new, and an id may stand in many rows: the bound is on examples.
    texts = texts.withColumn("digest", F.md5(F.coalesce("text", F.lit("")))).dropDuplicates(["doc_id", "label", "digest"])
    texts = texts.orderBy(F.xxhash64(F.lit(SEED), "doc_id", "digest"), "doc_id", "digest", "label").limit(2 * most).drop("digest")
    examples = texts.mapInArrow(_examples, "doc_id string, label int, ids binary, shares binary")
    model = examples.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(train, "numbers binary, bias double").first()
    return (np.frombuffer(model.numbers, np.float32), model.bias) if model else (np.zeros(1 << BITS, np.float32), 0.0)


def _scorer(model):
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        numbers, bias = model.value
        for series in texts:
            out = []
            for first, last, data, offsets in blocks(pa.array(series, pa.string(), from_pandas=True)):
                total, n = np.zeros(last - first), np.zeros(last - first)
                for bucket, row in features(data, offsets):
                    total += np.bincount(row, numbers[bucket], minlength=last - first)
                    n += np.bincount(row, minlength=last - first)
                out.append(1 / (1 + np.exp(-np.clip(total / (n + IDLE) + bias, -30, 30))))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return run


def scores(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """docs with ``score``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    run = _scorer(shared)

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return run(texts)

    return docs.withColumn("score", F.pandas_udf(score, "double")("text"))
