"""The Jaccard join against all pairs in plain Python."""

import random

import pytest

from fundlab.llm import jaccard_join, queries
from fundlab.llm.graph import components
from tests.llm.helpers import documents, odd_documents, save, words

UPPER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text):
    ws = words((text or "").translate(UPPER))
    return frozenset(tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))) if ws else frozenset()


def brute(rows, percent=80):
    sets = [shingle_set(text) for _, text, *_ in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k)) if s else i) for k, ((i, *_), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def got(spark, rows, folder, extra=False):
    return sorted(map(tuple, queries.op12_jaccard_join(spark, save(spark, documents(spark, rows, extra), folder)).collect()), key=repr)


def edited(rng, ws, n):
    ws = list(ws)
    for _ in range(n):
        ws[rng.randrange(len(ws))] = f"edit{rng.randrange(10_000)}"
    return " ".join(ws)


def corpus(seed, groups=12, size=8):
    """Families of texts around the threshold, with passages that many of them share."""
    rng = random.Random(seed)
    passage = [f"common{k}" for k in range(40)]
    rows = []
    for g in range(groups):
        n = rng.choice([3, 8, 25, 60, 140])
        ws = [f"w{rng.randrange(400)}" for _ in range(n)] + (passage if g % 3 == 0 else [])
        rows += [(1000 * g + k, edited(rng, ws, rng.randrange(5)), "en", "s") for k in range(size)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(spark, tmp_path, seed):
    rows = corpus(seed) + odd_documents()
    assert got(spark, rows, tmp_path, extra=True) == brute(rows)


def test_large_lists_rounds_and_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL_LIST", 3)
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", 4)
    rows = corpus(3, groups=6, size=25)
    assert got(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("shared", [1, 3, 8])
def test_join_alone_leaves_no_link_out(spark, shared, monkeypatch):
    """Without the first comparisons every link comes from the join; one prefix length for all must give the same."""
    monkeypatch.setattr(jaccard_join, "SMALL_LIST", 1 << 30)
    if shared != 3:
        monkeypatch.setattr(jaccard_join, "COMPARE", 0.0 if shared == 1 else 1e9)  # shortest or longest prefixes
    rows = corpus(4, groups=10, size=10)
    docs = documents(spark, rows)
    out = jaccard_join.joined(docs)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows)


def test_chain_of_links_is_one_component(spark, tmp_path):
    """Each text links with its neighbours only; the ends share nothing."""
    chain = [f"c{k}" for k in range(400)]
    rows = [(500 - k, " ".join(chain[k * 5 : k * 5 + 80]), "en", "s") for k in range(60)]
    out = got(spark, rows, tmp_path)
    assert out == brute(rows) and {c for *_, c in out} == {441}


def test_other_thresholds(spark):
    rows = corpus(6, groups=6)
    for percent in (50, 95):
        assert sorted(map(tuple, jaccard_join.joined(documents(spark, rows), percent).collect()), key=repr) == brute(rows, percent)


def test_no_documents(spark, tmp_path):
    assert got(spark, [], tmp_path) == []


def test_components_of_many_edges(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    assert {r.component for r in components(edges).collect()} == {0}
