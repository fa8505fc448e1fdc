"""Near duplicates by improved consistent weighted sampling.

A text is the multiset of its five-word shingles, weighted by (1 + ln tf) times an
inverse document frequency that only lowers shingles found in a large part of the
corpus (so the shared text of a big group of copies keeps its weight). Each of a
number of samples picks one (shingle, level) pair of a text such that two texts
pick the same with the probability of their weighted Jaccard similarity. Texts
that agree on all samples of a band are candidates, and the exact weighted
Jaccard similarity confirms them. Groups are the connected components.

Equal texts are one node from the start. In a band's bucket of few texts all
pairs are candidates. In a larger one each text is compared with the text most
central by bucket sizes; then, in ROUNDS rounds, texts of other components with the
central texts of large components. These rounds only save work: the texts of all
buckets that still hold several components go through an exact similarity join,
which compares every two texts of different components that can reach the threshold.

Edge cases: a text of one to four words is one shingle; null texts and texts
without words are never grouped; repeated rows (also with one id) are copies of
each other; an empty table gives an empty result; columns besides the id and the
text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlab.llm.blocks import LOWER, SpanHash, blocks, mix, row_of, words
from fundlab.llm.graph import components
from fundlab.skew import join_unique, key_counts
from fundlab.storage import materialize, release

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 12, 4
#: Buckets of up to so many texts give all their pairs.
SMALL_BUCKET = 16
ROUNDS = 1
#: Texts from which the order of shingles is estimated (any order gives the same links), and texts of one block of the join.
ORDER_TEXTS, JOIN_BLOCK = 1 << 12, 1 << 11
#: Texts whose shingles a task keeps while it compares pairs.
KEPT = 1 << 10
#: Allowance for the rounding of weights when pairs are ruled out.
SLACK = 1e-4
#: Document frequencies are kept in so many hashed cells: texts per cell by chance stay far below the
#: share of texts from which a shingle is weighted down.
CELLS = 1 << 18
SHARE = 3.0
_ODD = np.random.default_rng(11).integers(1, 1 << 62, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_U64 = np.uint64


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(13)
    r = rng.gamma(2.0, 1.0, 1 << 16)
    return r.astype(np.float32), np.log(rng.gamma(2.0, 1.0, 1 << 16)).astype(np.float32), rng.random(1 << 16).astype(np.float32)


_R, _LOG_C, _BETA = _tables()


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, tf) of each text's distinct shingles, by row. Letters A to Z count as lower case."""
    lower = LOWER[data]
    start, end = words(lower)
    h, row = SpanHash(lower)(start, end), row_of(offsets, start)
    n = len(h)
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):  # a shorter text hashes what it has
        at = np.minimum(np.arange(n) + k, max(n - 1, 0))
        same = (np.arange(n) + k < n) & (row[at] == row) if n else np.zeros(0, bool)
        total = total * _U64(0x9E3779B97F4A7C15) + np.where(same, h[at], _U64(k + 1))
    last = np.searchsorted(row, np.arange(len(offsets) - 1), "right")
    first = np.searchsorted(row, np.arange(len(offsets) - 1), "left")
    place = np.arange(n) - first[row] if n else np.zeros(0, np.int64)
    whole = place < np.maximum(1, (last - first)[row] - SHINGLE + 1) if n else np.zeros(0, bool)
    key, row = mix(total[whole]), row[whole]
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])])) if len(key) else np.zeros(0, np.int64)
    return key[new], row[new], np.diff(np.append(new, len(key)))


def idf(n_texts: int, df: np.ndarray) -> np.ndarray:
    """1 for shingles in up to about a third of the texts, less beyond, at least 0.05."""
    return np.clip(np.log((n_texts + 100.0) / np.maximum(df, 1)) / np.log(SHARE), 0.05, 1.0).astype(np.float32)


def weights(key: np.ndarray, tf: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (1 + np.log(tf)).astype(np.float32) * cells[(key >> _U64(40)) & _U64(CELLS - 1)]


def sample(key: np.ndarray, row: np.ndarray, weight: np.ndarray, n: int, odds: np.ndarray = _ODD) -> np.ndarray:
    """n texts x samples: what each sample picks. Every text has at least one shingle."""
    out = np.zeros((n, len(odds)), np.uint64)
    log_weight = np.log(weight)
    cuts = np.searchsorted(row, np.arange(n))
    for j, odd in enumerate(odds):
        h = mix(key ^ odd)
        r, log_c, beta = _R[(h >> _U64(48)).astype(np.int32)], _LOG_C[((h >> _U64(32)) & _U64(0xFFFF)).astype(np.int32)], _BETA[((h >> _U64(16)) & _U64(0xFFFF)).astype(np.int32)]
        t = np.floor(log_weight / r + beta)
        a = (log_c - r * (t - beta + np.float32(1))).view(np.int32)
        rising = (a ^ ((a >> 31) & np.int32(0x7FFFFFFF))).astype(np.int64) + (1 << 31)  # in the order of the floats
        pair = (h ^ (t.astype(np.int64).view(np.uint64) * _U64(0x9E3779B1))) & _U64(0xFFFFFFFF)
        out[:, j] = np.minimum.reduceat((rising.view(np.uint64) << _U64(32)) | pair, cuts)
    return out


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells, texts, part = np.zeros(CELLS, np.int64), 0, 1 << 13
    for batch in batches:
        texts += batch.num_rows
        for _, _, data, offsets in blocks(batch.column("text")):
            key, _, _ = shingles(data, offsets)
            cells += np.bincount(((key >> _U64(40)) & _U64(CELLS - 1)).astype(np.int64), minlength=CELLS)
    slices = [cells[a : a + part].astype(np.int64) for a in range(0, CELLS, part)]
    yield pa.RecordBatch.from_arrays([pa.array(range(len(slices) + 1), pa.int32()), pa.array([*slices, np.array([texts])], pa.list_(pa.int64()))], names=["slice", "n"])


def cell_counts(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of texts, and of texts by hashed cell. The driver gets CELLS numbers whatever the corpus."""
    by_part = docs.select("text").mapInArrow(_frequencies, "slice int, n array<long>")
    rows = by_part.select("slice", F.posexplode("n").alias("place", "n")).groupBy("slice", "place").agg(F.sum("n").alias("n"))
    rows = rows.groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("place", "n"))).alias("all")).select("slice", "all.n").orderBy("slice").collect()
    if not rows:
        return 0, np.zeros(CELLS)
    return rows[-1].n[0], np.concatenate([r.n for r in rows[:-1]]).astype(float)


def frequency_cells(docs: DataFrame) -> np.ndarray:
    """The inverse document frequency of each hashed cell, from all texts."""
    return idf(*cell_counts(docs))


def _bands(shared, odds: np.ndarray, rows: int):
    many = len(odds) // rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for batch in batches:
            for first, last, data, offsets in blocks(batch.column("text"), 1 << 18):
                key, row, tf = shingles(data, offsets)
                filled, row = np.unique(row, return_inverse=True)
                if not len(filled):
                    continue
                picked = sample(key, row, weights(key, tf, cells), len(filled), odds).reshape(len(filled), many, rows)
                band = np.arange(many, dtype=np.uint64)[None, :] * _U64(0xD6E8FEB86659FD93)
                for k in range(rows):
                    band = mix(band ^ picked[:, :, k])
                at = pa.array(first + filled)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("digest").take(at), pa.FixedSizeListArray.from_arrays(pa.array(band.reshape(-1).view(np.int64)), many).cast(pa.list_(pa.int64()))], names=["doc_id", "digest", "bands"])

    return run


def signatures(docs: DataFrame, cells: np.ndarray, odds: np.ndarray = _ODD, rows: int = ROWS) -> DataFrame:
    """doc_id, digest (of the text) and band keys of each text that has words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(cells)
    return docs.select("doc_id", "text", F.md5("text").alias("digest")).mapInArrow(_bands(shared, odds, rows), f"doc_id {kind}, digest string, bands array<long>")


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts' (sorted shingles, weights)."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][left], b[1][right]).sum(dtype=float)
    return float(low / (a[1].sum(dtype=float) + b[1].sum(dtype=float) - low))


def _similar(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value

        def weighed(text: str) -> tuple[np.ndarray, np.ndarray]:
            data = np.frombuffer(text.encode() + b"\n", np.uint8)
            key, _, tf = shingles(data, np.array([0, len(data)]))
            return key, weights(key, tf, cells)

        for batch in batches:
            keep, score, held = [], [], {}
            for k, (x, y) in enumerate(zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True)):
                if len(held) > KEPT:
                    held.clear()
                for text in (x, y):
                    if text not in held:
                        held[text] = weighed(text)
                if (s := jaccard(held[x], held[y])) >= threshold:
                    keep.append(k)
                    score.append(s)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at), pa.array(score, pa.float64())], names=["a", "b", "similarity"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, cells: np.ndarray, threshold: float) -> DataFrame:
    """The pairs (a, b) of digests at least ``threshold`` similar. texts: digest, text.

    Texts travel, not their shingles: a text's sorted shingles and weights take about twice its bytes.
    """
    shared = pairs.sparkSession.sparkContext.broadcast(cells)
    left = texts.select(F.col("digest").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("digest").alias("b"), F.col("text").alias("text_b"))
    counts = key_counts(pairs, ["b"])
    return join_unique(join_unique(pairs, left, ["a"], wide=True), right, ["b"], wide=True, counts=counts).mapInArrow(_similar(shared, threshold), "a string, b string, similarity double")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _centre() -> Column:
    return F.max(F.struct("weight", "digest"))["digest"]


def _members(signed: DataFrame) -> DataFrame:
    """bucket, digest, n of the buckets of two or more different texts."""
    members = signed.select("digest", "bands").dropDuplicates(["digest"]).select("digest", F.explode("bands").alias("bucket"))
    members = materialize(members)
    sizes = key_counts(members, ["bucket"])
    out = materialize(join_unique(members, sizes.filter("n > 1"), ["bucket"], counts=sizes))
    release(members)
    return out


def _first_pairs(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) to compare first, and the large buckets' texts (bucket, digest, weight)."""
    small, large = members.filter(F.col("n") <= SMALL_BUCKET), members.filter(F.col("n") > SMALL_BUCKET)
    one, two = small.select("bucket", F.col("digest").alias("x")), small.select("bucket", F.col("digest").alias("y"))
    pairs = one.join(two, "bucket").filter(F.col("x") < F.col("y")).select(F.col("x").alias("a"), F.col("y").alias("b"))
    central = large.groupBy("digest").agg(F.sum("n").alias("weight"))
    large = materialize(large.select("bucket", "digest").join(central, "digest"), n=F.count(F.lit(1)))
    hubs = large.groupBy("bucket").agg(_centre().alias("hub"))
    stars = join_unique(large, hubs, ["bucket"]).filter(F.col("digest") != F.col("hub")).select(*_ordered("digest", "hub"))
    return pairs.union(stars).distinct(), large


def _mixed(large: DataFrame, group: DataFrame) -> DataFrame:
    """The texts of the buckets that hold several components, each with its component."""
    placed = materialize(large.join(group, F.col("digest") == F.col("node"), "left").select("bucket", "digest", "weight", F.coalesce("component", "digest").alias("component")))
    several = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter(F.col("low") != F.col("high"))
    several = materialize(several.select("bucket"), n=F.count(F.lit(1)))
    out = materialize(join_unique(placed, several, ["bucket"], "left_semi", rows=several.seen["n"]), n=F.count(F.lit(1)))
    release(placed)
    return out


def _linked(docs: DataFrame, signed: DataFrame, cells: np.ndarray, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Confirmed pairs (a, b, similarity) of digests, enough of them to connect every group, and the groups (node, component)."""
    written = lambda df: materialize(df, n=F.count(F.lit(1)))
    members = _members(signed)
    texts = docs.select(F.md5("text").alias("digest"), "text").groupBy("digest").agg(F.first("text").alias("text"))
    texts = materialize(texts.join(members.select("digest").distinct(), "digest", "left_semi"))
    first, large = _first_pairs(members)
    tried = materialize(first)
    found = materialize(verified(tried, texts, cells, threshold))
    group = components(found.select("a", "b"))
    for _ in range(ROUNDS if large.seen["n"] else 0):
        placed = _mixed(large, group)
        if not placed.seen["n"]:
            break
        parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"), _centre().alias("hub"))
        main = parts.groupBy("bucket").agg(F.max(F.struct("n", "component", "hub")).alias("m")).select("bucket", F.col("m.component").alias("main"), F.col("m.hub").alias("main_hub"))
        main = written(main)
        other = join_unique(parts, main, ["bucket"], rows=main.seen["n"]).filter(F.col("component") != F.col("main")).groupBy("bucket").agg(F.max(F.struct("n", "hub", "component")).alias("o"))
        other = written(other)
        new = join_unique(placed, other, ["bucket"], rows=other.seen["n"]).filter(F.col("component") != F.col("o.component")).select(*_ordered("digest", "o.hub"))
        new = new.union(join_unique(placed, main, ["bucket"], rows=main.seen["n"]).filter(F.col("component") != F.col("main")).select(*_ordered("digest", "main_hub"))).distinct()
        new = written(new.join(tried, ["a", "b"], "left_anti"))
        if not new.seen["n"]:
            break
        fresh = written(verified(new, texts, cells, threshold))
        tried, found = tried.union(new), found.union(fresh)
        if not fresh.seen["n"]:
            break
        group = components(found.select("a", "b"))
    if large.seen["n"] and (placed := _mixed(large, group)).seen["n"]:
        mixed = written(texts.join(placed.select("digest", "component").distinct(), "digest"))
        new = materialize(possible_pairs(mixed, cells, threshold).join(tried, ["a", "b"], "left_anti"))
        fresh = written(verified(new, texts, cells, threshold))
        if fresh.seen["n"]:
            found = found.union(fresh)
            group = components(found.select("a", "b"))
        release(mixed)
    for used in (members, large, texts):
        release(used)
    return found, group


def links(docs: DataFrame, signed: DataFrame, cells: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """Confirmed pairs (a, b, similarity) of digests, enough of them to connect every group."""
    return _linked(docs, signed, cells, threshold)[0]


def _prefixes(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, counts = shared.value
        for batch in batches:
            for first, last, data, offsets in blocks(batch.column("text"), 1 << 18):
                key, row, tf = shingles(data, offsets)
                order = np.lexsort((key, counts[(key >> _U64(40)) & _U64(CELLS - 1)], row))
                key, row = key[order], row[order]
                weight = weights(key, tf[order], cells).astype(float)
                whole = np.bincount(row, weight, minlength=last - first)
                rest = np.cumsum(whole)[row] - np.cumsum(weight) + weight
                at = np.flatnonzero(rest >= (threshold - SLACK) * whole[row])
                source = pa.array(first + row[at])
                yield pa.RecordBatch.from_arrays([pa.array(key[at].view(np.int64)), batch.column("digest").take(source), batch.column("component").take(source), pa.array(whole[row[at]]), pa.array(rest[at])], names=["key", "digest", "component", "whole", "rest"])

    return run


def possible_pairs(texts: DataFrame, cells: np.ndarray, threshold: float) -> DataFrame:
    """All pairs (a, b) of texts (digest, text, component) of different components that can be as similar as the threshold.

    In any fixed order of shingles, the texts' common weight is at most what either has from
    their first common shingle on. So that shingle stands where a text still has ``threshold``
    of its weight left, and both texts have enough left there for the pair. Rare shingles go first.
    """
    cut = texts.select("digest").orderBy("digest").limit(ORDER_TEXTS).agg(F.max("digest")).first()[0]
    _, counts = cell_counts(texts.filter(F.col("digest") <= F.lit(cut)).coalesce(4))
    shared = texts.sparkSession.sparkContext.broadcast((cells, counts.astype(np.int32)))
    entries = materialize(texts.select("digest", "component", "text").mapInArrow(_prefixes(shared, threshold), "key long, digest string, component string, whole double, rest double"))
    parts = entries.groupBy("key", "component").agg(F.count("*").alias("n"))
    shares = parts.groupBy("key").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.sum("n").alias("n"), F.count("*").alias("kinds"))
    shares = shares.filter("kinds > 1").select("key", "main", F.ceil(F.col("n") / JOIN_BLOCK).cast("int").alias("n_blocks"))
    placed = materialize(join_unique(entries, materialize(shares), ["key"]))
    release(entries)
    one = placed.filter(F.col("component") != F.col("main")).select("key", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"), F.col("digest").alias("x"), F.col("component").alias("of_x"), F.col("whole").alias("whole_x"), F.col("rest").alias("rest_x"))
    two = placed.select("key", F.pmod(F.hash("digest"), F.col("n_blocks")).alias("block"), F.col("digest").alias("y"), "component", "main", "whole", "rest")
    once = (F.col("component") == F.col("main")) | (F.col("x") < F.col("y"))
    enough = F.least("rest", "rest_x") >= (threshold / (1 + threshold) - SLACK) * (F.col("whole") + F.col("whole_x"))
    return one.join(two, ["key", "block"]).filter((F.col("of_x") != F.col("component")) & once & enough).select(*_ordered("x", "y")).distinct()


def groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, digest, group (its least digest), n_links of each row of docs (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    cells = frequency_cells(docs)
    signed = materialize(signatures(docs, cells))
    found, group = _linked(docs, signed, cells, threshold)
    ends = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    nodes = group.join(ends, "node")
    nodes = materialize(nodes.withColumnRenamed("node", "digest"))
    return join_unique(signed.select("doc_id", "digest"), nodes, ["digest"], "left").select("doc_id", "digest", F.coalesce("component", "digest").alias("group"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of docs: doc_id, class_id (the least id of its group), class_size, n_links
    (confirmed links of its text to different texts), is_copy (its id is not the class's)."""
    grouped = materialize(groups(docs, threshold))
    sizes = grouped.groupBy("group").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    held = join_unique(grouped, materialize(sizes), ["group"]).select("doc_id", "class_id", "class_size", "n_links")
    wordless = docs.filter(~F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(0).cast("long").alias("n_links"))
    return held.unionByName(wordless).withColumn("is_copy", ~F.col("doc_id").eqNullSafe(F.col("class_id")))
