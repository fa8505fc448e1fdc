"""Importance resampling against the definition in plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from fundlab.llm import queries, resample
from tests.llm.helpers import documents, odd_documents, save

UPPER = {c: c + 32 for c in range(65, 91)}


def features(text):
    ws = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER)) if w]
    return len(ws), [zlib.crc32(f.encode()) % 10000 for f in ws + [f"{a} {b}" for a, b in zip(ws, ws[1:], strict=False)]]


def brute(docs, target):
    s, t = Counter(), Counter()
    for _, text, *_ in docs:
        s.update(features(text)[1])
    for _, text in target:
        t.update(features(text)[1])
    every, aims = s.total(), t.total()
    gain = {b: math.floor(1000.0 * math.log(((t[b] + 1.0) * (every + 10000.0)) / ((n + 1.0) * (aims + 10000.0)))) for b, n in s.items()}
    rows = []
    for i, text, *_ in docs:
        n, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    drawn = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    out = [(*r[:4], None) for r in rows if r[4] < 20]
    return out + [(*r[:4], k if k <= 25 * len(drawn) // 100 else None) for k, r in enumerate(drawn, 1)]


def key(row):
    return [(x is None, x or 0) for x in row]


def check(spark, rows, target, folder, extra=False):
    save(spark, documents(spark, rows, extra), folder)
    save(spark, spark.createDataFrame(target, "item_id long, text string"), folder, "benchmark")
    got = [tuple(r) for r in queries.op11_resample(spark, str(folder)).select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert sorted(got, key=key) == sorted(brute(rows, target), key=key)


def test_resample_of_odd_documents(spark, tmp_path):
    many = [(100 + k, f"Words {k % 7} of a text Number {k} " * (k % 9 + 1), "en", "s") for k in range(60)]
    target = [(1, "words of a TEXT"), (2, None), (3, ""), (4, "number 12 of ß")]
    check(spark, odd_documents() + many, target, tmp_path, extra=True)


def test_resample_without_target_or_documents(spark, tmp_path):
    check(spark, odd_documents(), [], tmp_path / "a")
    check(spark, [], [(1, "words")], tmp_path / "b")


def test_ranks_of_a_hot_tie(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.lit(None)).otherwise(F.col("id")).alias("doc_id"), F.lit(5).alias("score"), F.col("id").alias("row"))
    placed, n = resample.ranked(rows.repartition(7), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")])
    got = sorted(placed.collect(), key=lambda r: r["rank"])
    assert n == 3000 and [r["rank"] for r in got] == list(range(1, 3001))
    assert [r.doc_id for r in got[:1000]] == list(range(0, 3000, 3)) and [r.row for r in got[1000:]] == [k for k in range(3000) if k % 3]
