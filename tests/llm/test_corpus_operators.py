"""Neighbours, substring dedup, the classifier, near duplicates and LM scores against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fundlab.llm import chunks, classifier, graph, near_dup, neighbours, ppm, queries
from fundlab.llm.blocks import SpanHash, blocks, words
from tests.llm.helpers import crc_mod, documents, odd_documents, save
from tests.llm.helpers import words as split


def text(rng, n, syllables=("ba", "do", "ki", "lu", "me", "no", "pra", "ste")):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(2, 5))) for _ in range(n))


def test_blocks_find_words_and_hash_spans():
    rows = ["a b\tç", None, "", " x\n", "y" * 5000]
    seen = []
    for first, last, data, offsets in blocks(pa.array(rows), 16):
        start, end = words(data)
        h = SpanHash(data)(start, end)
        seen += [(first + int(np.searchsorted(offsets, a, "right") - 1), data[a:b].tobytes().decode(), int(v)) for a, b, v in zip(start, end, h, strict=True)]
        assert last > first
    assert [(r, w) for r, w, _ in seen] == [(0, "a"), (0, "b"), (0, "ç"), (3, "x"), (4, "y" * 5000)]
    assert len({v for *_, v in seen}) == 5


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_neighbours_recall_and_ties(spark, tmp_path):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(700, 16))
    points[300:500] = points[rng.integers(0, 5, 200)] + 0.05 * rng.normal(size=(200, 16))
    points[500:560] = points[0]  # a third of a list's worth of equal vectors
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(points)]
    odd = [(1000, None, 0), (1050, [0.0] * 16, 0), (1051, [float("nan")] + [1.0] * 15, 0), (1052, [None] + [1.0] * 15, 0), (1053, [1.0] * 3, 0), (None, [1.0] * 16, 0)]
    out = queries.op1_neighbours(spark, save(spark, vectors(spark, rows + odd), tmp_path, "embeddings")).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: r["rank"]):
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(range(0, 700, 50))
    single = np.array(points, np.float32).astype(float)
    unit = single / np.linalg.norm(single, axis=1)[:, None]
    hit = 0
    for q, found in got.items():
        cosine = unit @ unit[q]
        cosine[q] = -2
        best = np.lexsort((np.arange(700), -np.round(cosine, 12)))[:5]
        hit += len(set(best) & {v for _, v, _ in found})
        assert [k for k, *_ in found] == [1, 2, 3, 4, 5] and all(abs(s - cosine[v]) < 1e-9 for _, v, s in found)
    assert hit / (5 * len(got)) >= 0.95
    assert [v for _, v, _ in got[0]] == [500, 501, 502, 503, 504]


def brute_neighbours(rows, k=5):
    """The contract by all pairs of rows: cosine in double precision, ties to the smaller id."""
    import itertools

    def cosine(a, b):
        dot = lambda x, y: sum(p * q for p, q in zip(x, y, strict=True))
        return dot(a, b) / (math.sqrt(dot(a, a)) * math.sqrt(dot(b, b)))

    rows = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v, *_ in rows]
    out = []
    for n, (i, v) in enumerate(rows):
        if i % 50 == 0:
            near = sorted((-cosine(v, w), j) for m, (j, w) in enumerate(rows) if m != n)
            out += [(i, r, j, round(-s, 12)) for r, (s, j) in zip(itertools.count(1), near[:k])]
    return sorted(out)


def test_neighbours_of_few_vectors(spark, tmp_path):
    rng = np.random.default_rng(5)
    direction = rng.normal(size=8)
    cases = {
        "repeated": [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (50, [0.0, 1.0], 0), (7, [1.0, 1.0], 0)],
        "one id twice": [(0, [1.0, 0.0], 0), (1, [1.0, 0.1], 0), (1, [0.0, 1.0], 0), (50, [0.0, 2.0], 0), (50, [3.0, 3.0], 0)],
        "collinear": [(k, [float(np.float32(x)) for x in direction * (1 + k)], 0) for k in range(60)] + [(100, [float(x) for x in -direction], 0)],
        "one row": [(0, [1.0, 2.0], 0)],
        "none": [],
    }
    for name, rows in cases.items():
        df = vectors(spark, rows).selectExpr("*", "'x' as node", "'x' as row", "'x' as v", "'x' as norm")
        out = queries.op1_neighbours(spark, save(spark, df, tmp_path / name, "embeddings")).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in out) == brute_neighbours(rows), name


def test_chunks_resist_insertions():
    rng = random.Random(1)
    body = text(rng, 4000)
    pieces = lambda t: {t.encode()[a:b] for _, _, d, o in blocks(pa.array([t])) for a, b in zip(*chunks.cut(d, o), strict=True)}
    one, two = pieces(body), pieces(body[:700] + "inserted words " + body[700:])
    assert len(one & two) / len(one) > 0.97
    for t in ("", "x", "ab " * 900, body, "漢字" * 300):
        for _, _, d, o in blocks(pa.array([t, t])):
            start, end = chunks.cut(d, o)
            rows = [b"".join(d[a:b].tobytes() for a, b in zip(start, end, strict=True) if o[k] <= a < o[k + 1]) for k in (0, 1)]
            assert rows == [t.encode()] * 2 and all((end - start > 0) & (end - start <= chunks.MOST))


def test_repeated_passages(spark, tmp_path):
    rng = random.Random(2)
    clean = [(k, text(rng, 300), "en", "s1") for k in range(60)]
    passage = text(rng, 60)
    planted = [(100 + k, text(rng, 90 + k) + " " + passage + "\n" + text(rng, 80), "en", "s1") for k in range(15)]
    rows = [*clean, *planted, *[(i and i + 2000, *rest) for i, *rest in odd_documents()]]
    folder = save(spark, documents(spark, rows, extra=True), tmp_path)
    out = queries.op2_substring_dedup(spark, folder).collect()
    found = {r.doc_id for r in out}
    assert {100 + k for k in range(15)} <= found and not found & set(range(60, 100)) and not found & set(range(60))
    assert {2006, 2007} <= found and not {2001, 2002, 2003} & found
    source = dict((r[0], r[1]) for r in rows)
    for r in out:
        if r.doc_id is not None and 100 <= r.doc_id < 115:
            held = source[r.doc_id][r.start : r.start + r.length].split()[1:-1]  # an end may also agree by chance with one other text
            assert len(" ".join(held)) > 150 and " ".join(held) in passage and r.n_copies == 15 and r.n_words >= chunks.SPAN_WORDS
    assert sum(r.is_first for r in out if r.doc_id is not None and 100 <= r.doc_id < 115) == 1
    docs = documents(spark, planted)
    cut = {r.doc_id: r.text for r in chunks.without_repeats(docs, chunks.repeats(docs)).collect()}
    assert sum(passage[60:200] in t for t in cut.values()) == 1 and all(len(cut[r[0]]) <= len(r[1]) for r in planted)


def test_spans_against_all_word_windows(spark):
    """Brute force over every window of words: passages of 50 words are found, and no part of a span is held by no other row."""
    rng = random.Random(12)
    common = [text(rng, 12) for _ in range(40)]  # phrases below a window
    passages = [text(rng, rng.randint(50, 90)) for _ in range(25)] + ["again " * 120, "tik tok " * 90]
    rows = []
    for k in range(120):
        parts = [text(rng, rng.randint(5, 60)) for _ in range(4)]
        parts.insert(2, passages[k % len(passages)] if k < 80 else rng.choice(common))
        rows.append((k, " ".join(parts), "en", "s1"))
    got = chunks.repeats(documents(spark, rows)).collect()
    holders = defaultdict(set)
    for i, t, *_ in rows:
        w = t.split(" ")
        for n in range(len(w) - 49):
            holders[tuple(w[n : n + 50])].add(i)
    want = {i for ids in holders.values() if len(ids) > 1 for i in ids}
    found = {r.doc_id for r in got}
    assert len(want) == 80 and len(want - found) <= 2 and not found - want
    inner = defaultdict(set)
    for i, t, *_ in rows:
        w = t.split()
        for n in range(len(w) - chunks.SPAN_WORDS + 3):
            inner[tuple(w[n : n + chunks.SPAN_WORDS - 2])].add(i)
    for r in got:
        w = rows[r.doc_id][1][r.start : r.start + r.length].split()[1:-1]  # chunk borders cut words
        assert len(w) >= chunks.SPAN_WORDS - 3
        assert all(len(inner[tuple(w[n : n + chunks.SPAN_WORDS - 2])]) > 1 for n in range(len(w) - chunks.SPAN_WORDS + 3))


def plain_features(t):
    """The classifier's features of a text as strings, with their multiplicity."""
    w, out = split(t), Counter()
    flat = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t).encode()
    for n in (3, 4, 5):
        out.update((n, flat[k : k + n]) for k in range(len(flat) - n + 1) if b" " not in flat[k + 1 : k + n - 1])
    out.update(("word", x) for x in w)
    out.update(("pair", a, b) for a, b in zip(w, w[1:], strict=False))
    out.update(["again" for a, b in zip(w, w[1:], strict=False) if a == b])
    return out


def test_classifier_features_equal_plain_python():
    texts = ["one two two three", "", "x", "été  ñu\tab", "no no no no", "a b " * 40]
    for _, _, data, offsets in blocks(pa.array(texts)):
        found = list(classifier.features(data, offsets))
        row = np.concatenate([r for _, r in found])
        bucket = np.concatenate([b for b, _ in found])
        for k, t in enumerate(texts):
            want = plain_features(t + "\n")
            got = Counter(bucket[row == k].tolist())
            assert got.total() == want.total() and len(got) == len(want), t
            assert sorted(got.values()) == sorted(want.values())


def test_classifier_step_equals_the_gradient(monkeypatch):
    """One step from the same start moves the layers against a numerical gradient of the loss."""
    import pandas as pd

    monkeypatch.setattr(classifier, "BITS", 4)
    monkeypatch.setattr(classifier, "EPOCHS", 2)
    rows = [(np.array([1, 3, 7], np.int32), np.array([0.5, 0.25, 0.125], np.float32), 1), (np.array([2, 3], np.int32), np.array([0.25, 0.5], np.float32), 0)]
    out = classifier.train(pd.DataFrame({"doc_id": ["a", "b"], "label": [y for *_, y in rows], "ids": [i.tobytes() for i, *_ in rows], "shares": [s.tobytes() for _, s, _ in rows]}))
    rng = np.random.default_rng(classifier.SEED)
    vectors = ((rng.random((16, classifier.DIM), np.float32) - 0.5) * (2.0 / classifier.DIM)).astype(float)
    layer, bias, step = np.zeros((classifier.DIM, 2)), np.zeros(2), 0

    def loss(v, w, b, row):
        z = (v[row[0]] * row[1][:, None]).sum(0) @ w + b
        return math.log(np.exp(z).sum()) - z[row[2]]

    def gradient(x, of):
        g = np.zeros_like(x)
        for at in np.ndindex(*x.shape):
            kept, x[at] = x[at], x[at] + 1e-6
            up = of()
            x[at] = kept - 1e-6
            g[at], x[at] = (up - of()) / 2e-6, kept
        return g

    for _ in range(2):
        for k in rng.permutation(2):
            rate, row = classifier.RATE * (1 - step / 4), rows[k]
            of = lambda row=row: loss(vectors, layer, bias, row)
            dv, dw, db = gradient(vectors, of), gradient(layer, of), gradient(bias, of)
            layer -= rate * dw
            bias -= 0.1 * rate * db
            vectors -= rate * len(row[0]) ** 0.5 * dv
            step += 1
    got = np.frombuffer(out["numbers"][0], np.float32)
    assert np.allclose(got, vectors @ (layer[:, 1] - layer[:, 0]), atol=1e-4) and abs(out["bias"][0] - (bias[1] - bias[0])) < 1e-4


def test_classifier_learns_nothing_from_shuffled_labels(spark):
    rng = random.Random(14)
    docs = documents(spark, [(k, text(rng, 60), "en", "s") for k in range(400)])
    model = classifier.fit(docs, spark.createDataFrame([(k, rng.randint(0, 1)) for k in range(300)], "doc_id long, label int"))
    score = {r.doc_id: r.score for r in classifier.scores(docs, model).collect()}
    truth = {k: rng.randint(0, 1) for k in range(300, 400)}
    ones, zeros = [score[k] for k in truth if truth[k]], [score[k] for k in truth if not truth[k]]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])
    assert 0.35 < auc < 0.65


def test_classifier_separates_held_out_documents(spark, tmp_path):
    rng = random.Random(4)
    rows = [(k, text(rng, 60) if k % 3 else " | ".join(text(rng, 2).upper() for _ in range(30)), "en", "s1") for k in range(300)]
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(300)] + [(5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    save(spark, labels, tmp_path, "labels")
    odd = [(1000 + (i or 0), *rest) for i, *rest in odd_documents()]
    out = queries.op3_quality_classifier(spark, save(spark, documents(spark, rows + odd, extra=True), tmp_path)).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert all(r.held_out == (crc_mod(r.doc_id, 5) == 0) for r in out)
    assert all(r.predicted == (r.doc_id % 3 > 0) for r in out if r.held_out and r.doc_id < 300)


def test_classifier_without_labels(spark, tmp_path):
    save(spark, spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    out = queries.op3_quality_classifier(spark, save(spark, documents(spark, odd_documents()), tmp_path)).collect()
    assert {r.score for r in out} == {0.5}


def test_training_is_bounded_and_repeatable(spark):
    rng = random.Random(4)
    docs = documents(spark, [(k, text(rng, 20), "en", "s") for k in range(200)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, label int")
    one, two = classifier.fit(docs, labels, 40), classifier.fit(docs, labels, 40)
    assert (one[0] == two[0]).all() and one[1] == two[1]


def components(pairs):
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    return {x: top(x) for x in parent}


def test_components(spark):
    rng = random.Random(6)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(200, 200 + k) for k in range(1, 50)] + [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: v for k, v in components([p for p in pairs if p[0] != p[1]]).items()}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_corpus():
    rng = random.Random(7)
    rows = [(k, text(rng, rng.randint(60, 200)), "en", "s1") for k in range(80)]
    for k in range(20):  # near copies: a few words changed
        w = rows[k][1].split()
        w[rng.randrange(len(w))] = "changed"
        rows.append((200 + k, " ".join(w) + " more", "en", "s2"))
    base = text(rng, 150).split()
    for k in range(60):  # a group larger than a small bucket, around one text
        w = list(base)
        for _ in range(2 if k else 0):
            w[rng.randrange(len(w))] = f"x{k}"
        rows.append((300 + k, " ".join(w), "en", "s1"))
    rows += [(400 + k, rows[3][1], "en", "s1") for k in range(30)]  # exact copies
    passage = text(rng, 40)
    rows += [(500 + k, text(rng, 60) + " " + passage, "en", "s1") for k in range(40)]  # only a passage in common
    return rows


def want_links(rows):
    """Exact weighted Jaccard similarity of all pairs of different texts with the operator's weights."""
    cells = np.ones(near_dup.CELLS, np.float32)
    df = np.zeros(near_dup.CELLS)
    shingled = {}
    for _, t, *_ in rows:
        data = np.frombuffer((t or "").encode() + b"\n", np.uint8)
        key, _, tf = near_dup.shingles(data, np.array([0, len(data)]))
        df += np.bincount(((key >> np.uint64(40)) & np.uint64(near_dup.CELLS - 1)).astype(int), minlength=near_dup.CELLS)
        if len(key):
            shingled[t] = (key, tf)
    cells = near_dup.idf(len(rows), df)
    weighed = {t: (k, near_dup.weights(k, tf, cells)) for t, (k, tf) in shingled.items()}
    keys = list(weighed)
    return [(a, b) for n, a in enumerate(keys) for b in keys[:n] if near_dup.jaccard(weighed[a], weighed[b]) >= near_dup.THRESHOLD], keys


def test_near_duplicates_equal_brute_force(spark, tmp_path):
    rows = near_corpus() + [(i and i + 2000, *rest) for i, *rest in odd_documents()]
    out = queries.op6_minhash(spark, save(spark, documents(spark, rows, extra=True), tmp_path)).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    pairs, keys = want_links(rows)
    group = components([*pairs, *((k, k) for k in keys)])
    class_of = {r.doc_id: r.class_id for r in out}
    members = defaultdict(list)
    for i, t, *_ in rows:
        members[group.get(t, (t, i))].append(i)
    for ids in members.values():
        known = [i for i in ids if i is not None]
        assert {class_of[i] for i in ids} == {min(known) if known else None}
    sizes = {r.doc_id: r.class_size for r in out}
    assert sizes[300] == 60 and sizes[3] == 31 + any(group[rows[3][1]] == group[r[1]] for r in rows[80:100]) and sizes[500] == 1


def test_large_buckets_with_many_components(spark):
    """Many pairs of near copies that all share most of one passage: buckets are large and hold many groups."""
    rng = random.Random(17)
    shared, rows = text(rng, 260), []
    for k in range(40):
        own = text(rng, 60).split()
        rows += [(2 * k, f"{shared} {' '.join(own)}", "en", "s1"), (2 * k + 1, f"{shared} {' '.join(own[:-1])} other{k}", "en", "s1")]
    docs = documents(spark, rows).select("doc_id", "text")
    cells = np.ones(near_dup.CELLS, np.float32)
    found = near_dup.links(docs, near_dup.signatures(docs, cells), cells, 0.95)
    digest = {hashlib.md5(r[1].encode()).hexdigest(): r[0] for r in rows}
    pairs = {tuple(sorted((digest[r.a], digest[r.b]))) for r in found.collect()}
    assert pairs == {(2 * k, 2 * k + 1) for k in range(40)}


def test_all_pairs_of_one_large_bucket(spark):
    """Every text is a candidate of every other one; each is like one other only, and no centre is like both."""
    rng, rows = random.Random(23), []
    for k in range(40):
        own = text(rng, 60).split()
        rows += [(2 * k, " ".join(own), "en", "s1"), (2 * k + 1, " ".join([*own[:45], *text(rng, 15).split()]), "en", "s1")]
    docs = documents(spark, rows).select("doc_id", "text")
    signed = docs.select("doc_id", F.md5("text").alias("digest"), F.array(F.lit(1).cast("long")).alias("bands"))
    found = near_dup.links(docs, signed, np.ones(near_dup.CELLS, np.float32), 0.5)
    digest = {hashlib.md5(r[1].encode()).hexdigest(): r[0] for r in rows}
    assert {tuple(sorted((digest[r.a], digest[r.b]))) for r in found.collect()} == {(2 * k, 2 * k + 1) for k in range(40)}


def test_possible_pairs_hold_all_similar_ones(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "JOIN_BLOCK", 8)
    rows = near_corpus()
    pairs, keys = want_links(rows)
    docs = documents(spark, rows).select(F.md5("text").alias("digest"), "text").dropDuplicates(["digest"]).withColumn("component", F.col("digest"))
    cells = near_dup.frequency_cells(documents(spark, rows))
    got = {(r.a, r.b) for r in near_dup.possible_pairs(docs, cells, near_dup.THRESHOLD).collect()}
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert {tuple(sorted((md5(a), md5(b)))) for a, b in pairs} <= got
    assert len(got) < len(keys) * (len(keys) - 1) / 4


def test_weighted_samples_agree_as_often_as_similar():
    rng = np.random.default_rng(8)
    key = np.sort(rng.integers(0, 1 << 62, 400, dtype=np.uint64))
    a, b = np.arange(300), np.concatenate([np.arange(60, 300), np.arange(300, 360)])
    weight = rng.choice([1.0, 1.7, 0.3], 400).astype(np.float32)
    agree = []
    for shift in range(40):
        moved = near_dup.mix(key + np.uint64(shift))
        one, two = (near_dup.sample(np.sort(moved[x]), np.zeros(len(x), int), weight[x][np.argsort(moved[x])], 1)[0] for x in (a, b))
        agree.append((one == two).mean())
    both = weight[60:300].sum()
    assert np.mean(agree) == pytest.approx(both / (weight[a].sum() + weight[b].sum() - both), abs=0.04)


def brute_model(texts):
    """log10 probability of a byte string by the definition: counts by context, method C, symbol exclusion."""
    counts = defaultdict(Counter)
    for t in texts:
        stream = bytes([ppm.END] * ppm.ORDER) + t + bytes([ppm.END])
        for k in range(ppm.ORDER, len(stream)):
            for d in range(ppm.ORDER + 1):
                counts[stream[k - d : k]][stream[k]] += 1

    def symbol(context, s):
        p, excluded = 1.0, set()
        for d in range(ppm.ORDER, -1, -1):
            seen = {x: c for x, c in counts[context[len(context) - d :]].items() if x not in excluded} if context[len(context) - d :] in counts else {}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if s in seen:
                return p * seen[s] / whole
            p *= len(seen) / whole
            excluded |= set(seen)
        return p / (256 - len(excluded))

    def score(t):
        stream = bytes([ppm.END] * ppm.ORDER) + t + bytes([ppm.END])
        return sum(math.log10(symbol(stream[k - ppm.ORDER : k], stream[k])) for k in range(ppm.ORDER, len(stream)))

    return symbol, score


@pytest.mark.parametrize("frequent", [64, 1 << 20])
def test_lm_base_and_model_scores(spark, tmp_path, monkeypatch, frequent):
    monkeypatch.setattr(ppm, "FREQUENT_WORDS", frequent)
    monkeypatch.setattr(ppm, "FREQUENT_GRAMS", frequent)
    monkeypatch.setattr(ppm, "AT_ONCE", frequent)
    rng = random.Random(9)
    rows = [(k, text(rng, 40) + (" The END" if k % 2 else ""), "en", "s1") for k in range(60)] + [(i and i + 2000, t and t[:9000], *rest) for i, t, *rest in odd_documents()]
    out = queries.op9_lm_scoring(spark, save(spark, documents(spark, rows, extra=True), tmp_path)).collect()
    held = lambda i: i is not None and crc_mod(i, 7) == 2
    lower = lambda t: [w.encode().lower().decode() if w.isascii() else "".join(c.lower() if c < "\x80" else c for c in w) for w in split(t)]
    count, texts = Counter(), 0
    for i, t, *_ in rows:
        if not held(i):
            count.update(lower(t))
            texts += 1
    total, kinds = sum(count.values()) + texts, len(count) + 1
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    assert any(r.held_out for r in out)
    by_id = {r.doc_id: r for r in out}
    _, model = brute_model([(t or "").encode() for i, t, *_ in rows if not held(i)])
    for i, t, *_ in rows:
        w, r = lower(t), by_id[i]
        base = sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in w) + math.log10((texts + 1) / (total + kinds + 1))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w) + 1, sum(x in count for x in w) + 1, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(model((t or "").encode()), rel=1e-9)


def test_ppm_probabilities():
    rng = random.Random(10)
    data = bytes([*rng.choices(b"abc", k=400), *rng.choices(b"abd", k=100)])
    keys, n = np.unique(ppm.grams(np.frombuffer(bytes([ppm.END] * ppm.ORDER) + data + bytes([ppm.END]), np.uint8)), return_counts=True)
    levels = []
    for d in range(ppm.ORDER + 1):
        levels.append(ppm.level(d, *ppm._summed(keys, n, d), levels[-1] if levels else None))
    symbol, _ = brute_model([data])
    for context in (b"abcab", b"zzzab", b"zzzzz", b"ddddd", bytes([255] * 5)):
        got = 10 ** ppm.costs(ppm.grams(np.array([x for s in range(256) for x in (*context, s)], np.uint8))[:: ppm.ORDER + 1], levels)
        assert got.sum() == pytest.approx(1)
        assert got.tolist() == pytest.approx([symbol(context, s) for s in range(256)])
    none = [ppm.level(d, np.zeros(0, np.uint64), np.zeros(0), None) for d in range(ppm.ORDER + 1)]
    assert ppm.costs(np.array([7], np.uint64), none)[0] == pytest.approx(-math.log10(256))


def test_empty_tables(spark, tmp_path):
    folder = save(spark, documents(spark, []), tmp_path)
    save(spark, spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    for name in ("op2_substring_dedup", "op3_quality_classifier", "op6_minhash", "op9_lm_scoring"):
        assert queries.queries()[name](spark, folder).count() == 0


def test_scoring_takes_bounded_memory_beside_its_tables(monkeypatch):
    """With a megabyte of text looked up at once, as before, it took 150 MB here."""
    import tracemalloc
    from types import SimpleNamespace

    monkeypatch.setattr(ppm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    text = " ".join(f"w{k}" for k in range(700))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1000)), "text": [text] * 1000, "held_out": [False] * 1000})
    rows = pa.table({"key": pa.array([1], pa.int64()), "value": [0.5]})
    run = ppm._score(SimpleNamespace(value=(ppm.Table(rows), ppm.Table(rows))), pa.int64())
    tracemalloc.start()
    try:
        n = sum(b.column("n_tokens").drop_null().sum().as_py() or 0 for b in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 701 * 1000 and peak < 64 << 20
