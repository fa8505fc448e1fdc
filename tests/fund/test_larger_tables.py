"""What showed on larger tables only."""

import datetime as dt
import random

import pytest

from fundlab import registry
from fundlab.functions import matching
from fundlab.operators import windows
from tests.fund.test_rank_and_holdings import matched


@pytest.mark.parametrize("name", ["expense_files", "expense_ratio_last"])
def test_of_lines_with_one_key_the_first_of_the_table_counts(spark, tmp_path, name):
    day = dt.datetime(1996, 3, 5)
    rows = [(3, 7, 1, 0.01, day), (9, 7, 2, 0.05, day), (9, 7, 2, 0.03, day), (9, 7, 2, 0.08, day), (5, 7, 4, 0.02, day)]
    rows += [(k, 8, 1, 0.04, day) for k in range(40)] + [(39, 8, 1, 0.06, day)]
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_linenumber int, l_tax double, l_shipdate timestamp").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.scheme_code: r.ter_pct for r in registry.queries()[name](spark, str(tmp_path)).collect()}
    assert got == {"7": 0.05, "8": 0.04}


def test_a_tile_without_the_best_candidate_scores_few(monkeypatch):
    """Every candidate is within the threshold of a name, but what the name reached elsewhere rules them out."""
    names, candidates = [f"CUSTOMR {k:09} ESG FUND" for k in range(40)], [f"CUSTOMER {k:09} ESG FUND" for k in range(1000, 2000)]
    scored, exact = [], matching.token_set_ratio
    monkeypatch.setattr(matching, "token_set_ratio", lambda a, b: scored.append((a, b)) or exact(a, b))
    assert list(matching.shortlists(names, candidates, [exact(n, n.replace("MR", "MER")) - matching.NEAR_BEST for n in names])) == []
    assert len(scored) < 40 * 50


def test_what_a_name_reaches_is_the_score_of_a_candidate(spark):
    asked = spark.createDataFrame([("x", "CUSTOMR 1 FUND"), ("x", "CUSTOMR 7 FUND"), ("y", "CUSTOMR 2 FUND")], "block string, name string")
    pool = spark.createDataFrame([("x", f"CUSTOMER {k} FUND") for k in range(40) if k != 7] + [("y", "OTHER 1 FUND")], "block string, name string")
    got = {(r.block, r.name): r.reached for r in matching._reached(asked, pool).collect()}
    assert got == {("x", "CUSTOMR 1 FUND"): matching.token_set_ratio("CUSTOMR 1 FUND", "CUSTOMER 1 FUND"), ("y", "CUSTOMR 2 FUND"): matching.token_set_ratio("CUSTOMR 2 FUND", "OTHER 1 FUND")}


def test_tiles_are_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(matching, "NAMES", 5)
    monkeypatch.setattr(matching, "CANDIDATES", 10)
    names = spark.createDataFrame([("x", f"N {k}", None, None) for k in range(20)] + [("x", f"C {k}", "s", None) for k in range(20)], "block string, name string, scheme_code string, reached double")
    tiles = matching._tiles(names)
    assert tiles.count() == 20 * 2 + 20 * 4 and tiles.rdd.getNumPartitions() == 8


def test_names_with_numbers_meet_few_candidates(spark, monkeypatch):
    """Before, every printed name met every candidate of its block in a tile."""
    monkeypatch.setattr(matching, "NAMES", 20)
    monkeypatch.setattr(matching, "CANDIDATES", 20)
    tiles, dealt = [], matching._tiles
    monkeypatch.setattr(matching, "_tiles", lambda names: tiles.append(dealt(names).select("block", "i", "j").distinct().count()) or dealt(names))
    names = [f"CUSTOMER {k:09} {fund}" for k in range(400) for fund in ("ESG INTEGRATION FUND", "HEALTH CARE FUND DIVIDEND YIELD GROWTH")[: 1 + k % 2]]
    printed = [n.replace("CUSTOMER", "CUSTOMR") for n in names]
    got = matching.match_names(spark.createDataFrame([("x", n) for n in printed], "block string, name string"), spark.createDataFrame([("x", n, n) for n in names], "block string, scheme_code string, name string"))
    assert {r.name: r.scheme_code for r in got.collect()} == dict(zip(printed, names, strict=True))
    assert sum(tiles) < 10  # of 30 times 30 tiles


def test_a_close_number_counts_where_the_words_are_in_order(spark):
    fund = "ESG INTEGRATION FUND WITH DIVIDEND YIELD AND GROWTH OPTION"
    (row,) = matched(spark, [f"{fund} 000123"], [f"000123 {' '.join(fund.split()[::-1])}", f"{fund} 000132", f"{fund} 000456"])
    assert row.scheme_code == "00001"


def test_a_candidate_of_a_tile_counts_once(spark):
    """Six candidates of one number and one set of words, of which five are on the short list; the best of these is the fourth."""
    words = {k: k * 20 for k in "ABCDEF"}  # so long that any other number is near the best, too
    names = [" ".join([*map(words.get, order), "7"]) for order in ("ABCDEF", "BACDEF", "CABDEF", "DCBAFE", "EABCDF", "FABCDE")]
    (row,) = matched(spark, [names[3]], [*names, names[0].replace("7", "8")])
    assert row.scheme_code == "00003"


def test_names_with_close_numbers_against_all_pairs(spark):
    """Names so long that other numbers are near the best, short ones, slips in numbers and letters, names without and with more numbers."""
    rng = random.Random(11)
    funds = ["ESG INTEGRATION FUND WITH DIVIDEND YIELD AND GROWTH OPTION", "ESG INTEGRATIN FUND WITH DIVIDEND YIELD AND GROWTH OPTIONS", "HEALTH CARE", "FMP SERIES", "FUND A", "A"]

    def shuffled(words, often, more):
        numbers = [str(rng.choice([7, rng.randint(0, 99), rng.randint(1000, 1300)]))] * (rng.random() < often) + ["2"] * (rng.random() < more)
        return " ".join(rng.sample(words + numbers, len(words) + len(numbers)))

    names = sorted({shuffled(rng.choice(funds).split(), 0.9, 0.1) if k % 3 else f"{rng.choice(funds)} {rng.randint(0, 3000):06}" for k in range(300)})
    printed = sorted({n[:at] + n[at + 1 :] if k % 5 == 0 else n.replace("INTEGRATION", "INTEGRATON").replace("CARE", "CARES").replace("SERIES", "SERES") for k, n in enumerate(rng.sample(names, 150)) for at in [rng.randrange(len(n))]} - {""})
    rows = matched(spark, [" ".join(n.split()) for n in printed], names)
    assert sum(r.score is not None for r in rows) > 100


def test_numbers_differ_no_more_than_shapes_allow():
    rng = random.Random(12)
    words, shape = ["A", "AB", "ABC", "BCA", "FUND", "FUNDS", "GROWTH"], lambda n: " ".join(sorted({"0" * len(w) if w.isdigit() else w for w in n.split()}))
    make = lambda: " ".join(sorted([*rng.sample(words, rng.randint(0, 5)), str(rng.randint(0, 10 ** rng.randint(1, 5)))], key=lambda w: rng.random()))
    number = lambda n: next(w for w in n.split() if w.isdigit())
    without = lambda w, d: {w} if not d else {w[:k] + w[k + 1 :] for k in range(len(w))}
    kinds = {"apart": 0, "near": 0, "all": 0}
    for _ in range(4000):
        a, b = make(), make()
        if rng.random() < 0.5:
            b = a.replace(number(a), str(int(number(a)) + rng.choice([1, 10, 990])))
        score = matching.token_set_ratio(a, b)
        if number(a) != number(b):
            (found,) = list(matching.apart([shape(a)], [shape(b)], [floor := score - rng.choice([0, 0.5])])) or [None]
            assert found and (found[1] == -1 or without(number(a), found[2]) & without(number(b), found[3])), (a, b, floor)
            higher = list(matching.apart([shape(a)], [shape(b)], [min(100.0, score + rng.choice([1, 4]))]))
            kinds["apart" if not higher else "all" if higher[0][1] == -1 else "near"] += 1
    assert min(kinds.values()) > 20, kinds


@pytest.mark.parametrize("head", [0, 3])
def test_a_window_of_weeks_is_the_difference_of_running_sums(spark, head):
    weeks, rows = 3, [("a", w, 1, 10.0**-w, 1, 10.0**-w / 2) for w in (0, 1, 4, 5, 6, 9)] + [("b", 2, 1, 7.0, 0, None)]
    found = windows.week_windows(spark.createDataFrame(rows, "scheme_code string, week int, n long, v double, head_n long, head_v double"), ["n", "v"], weeks, head, [])
    assert found.count() <= 10 + 1  # a row for a week, not for each window that holds it
    got = {(r.scheme_code, r.k): (r.n, r.v) for r in found.collect()}
    for k in range(7):
        whole, part = [r for r in rows if r[0] == "a" and k <= r[1] < k + weeks], [r for r in rows if r[0] == "a" and r[1] == k + weeks and head]
        assert got["a", k] == (len(whole) + len(part), pytest.approx(sum(r[3] for r in whole) + sum(r[5] for r in part), abs=1e-15))


def test_active_share_deals_large_tables_to_more_tasks(spark, monkeypatch):
    """Before, every step ran in spark.sql.shuffle.partitions tasks, whatever the rows."""
    from fundlab import registry
    from fundlab.plans import relations

    sf = "/root/testdata/sf0.001"
    few = registry.active_share_month(spark, sf)
    monkeypatch.setattr(relations, "ROWS_A_TASK", 500)
    n = relations.tasks(spark, sf)
    many = registry.active_share_month(spark, sf)
    assert n > 4 and many._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") >= 4
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, few.collect()))
