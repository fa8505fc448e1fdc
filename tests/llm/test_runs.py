"""Periodic runs against the definition in plain Python."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from fundlab.llm import queries, runs
from tests.llm.helpers import documents, odd_documents, save, words


def brute(ws):
    """(start, length, period) by extending every pair of equal words that are a possible period apart: quadratic."""
    best = {}
    for q in range(1, len(ws) // 4 + 1):
        i = 0
        while i + q < len(ws):
            end = i
            while end + q < len(ws) and ws[end] == ws[end + q]:
                end += 1
            if (length := end - i + q) >= max(6, 4 * q):
                best.setdefault((i, length), q)  # periods rise
            i = max(end, i) + 1
    return sorted((s, n, q) for (s, n), q in best.items())


def collapsed(ws, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(ws) if k not in gone)


def found_in(texts):
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    known = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}))}
    word = np.array([known[w] for t in texts for w in t], np.int64)
    of, start, length, period = runs.find(word, row, len(texts))
    return [[(int(s), int(n), int(q)) for r, s, n, q in zip(of, start, length, period, strict=True) if r == k] for k in range(len(texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), max_size=5))
def test_runs_of_few_words(texts):
    assert found_in(texts) == [brute(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcd"), min_size=1, max_size=9), st.integers(1, 12)), max_size=5))
def test_runs_of_repeated_parts(parts):
    text = [w for unit, n in parts for w in unit * n]
    assert found_in([text, [], text[::-1]]) == [brute(text), [], brute(text[::-1])]


def test_candidates_in_small_pieces(monkeypatch):
    rng = random.Random(4)
    texts = [[rng.choice("ab") for _ in range(5)] * rng.randint(1, 40) + [rng.choice("abc") for _ in range(30)] for _ in range(40)] + [["x"] * 3000]
    monkeypatch.setattr(runs, "PLACES", 7)
    assert found_in(texts) == [brute(t) for t in texts]


def planted(i, ws):
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(ws)
    if i is None or h % 10 or not n:
        return ws
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [ws[k] if k < a else ws[a + (k - a) % p] for k in range(n)]


def test_query_on_odd_documents(spark, tmp_path):
    rng = random.Random(5)
    unit = lambda n: " ".join(rng.choice(["la", "lo", "lu é", "\tx\n"]) for _ in range(n))
    rows = [(i, text and text[:12_000], *rest) for i, text, *rest in odd_documents()] + [(100 + k, (unit(k % 7 + 1) + " ") * (k % 9 + 1) + unit(5), "en", "s") for k in range(120)]
    got = queries.op13_runs(spark, save(spark, documents(spark, rows, extra=True), tmp_path)).collect()
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, text, *_ in rows:
        ws = planted(i, words(text))
        found = brute(ws)
        s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        want.append((i, len(found), s, n, q, n and 1000 * n // q, digest("".join(f"{a},{b},{c}\n" for a, b, c in found)), digest(collapsed(ws, found))))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_no_documents(spark, tmp_path):
    assert queries.op13_runs(spark, save(spark, documents(spark, []), tmp_path)).count() == 0
