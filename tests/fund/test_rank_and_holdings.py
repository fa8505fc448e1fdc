"""Filters, scores, stages, holdings measures and matching on hand-made rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fundlab.functions import matching, text
from fundlab.operators import holdings as h
from fundlab.operators import ranking as r

M = "scheme_code string, canonical_category string, data_quality_flag string, ret_3y_median double, ret_3y_p25 double, ret_5y_median double, ret_5y_p25 double, alpha_3y_annualized double, sortino_3y double, info_ratio_3y double, capture_efficiency double, r_squared_3y double, beta_3y double, active_share_median_1y double, style_drift_3y double, ptr_latest double, aum_impact_cost_days double, aum_crore double"
BASE = {"canonical_category": "Large Cap", "data_quality_flag": "GOOD", "ret_3y_median": 0.18, "ret_3y_p25": 0.12, "ret_5y_median": 0.16, "ret_5y_p25": 0.10, "alpha_3y_annualized": 0.03, "sortino_3y": 1.2, "info_ratio_3y": 0.7, "capture_efficiency": 1.235, "r_squared_3y": 0.82, "beta_3y": 0.95, "active_share_median_1y": 0.5, "style_drift_3y": 0.1, "ptr_latest": 0.5, "aum_impact_cost_days": 1.0, "aum_crore": 10.0}


def metrics(spark, *rows):
    names = [c.split()[0] for c in M.split(", ")]
    return spark.createDataFrame([tuple((BASE | {"scheme_code": f"S{k}"} | row).get(n) for n in names) for k, row in enumerate(rows)], M)


@pytest.mark.parametrize("change, kept", [({}, True), ({"data_quality_flag": "POOR"}, False), ({"data_quality_flag": "INSUFFICIENT_HISTORY"}, False), ({"capture_efficiency": 0.3}, False), ({"info_ratio_3y": -1.5}, False), ({"r_squared_3y": 0.2}, False), ({"beta_3y": 2.1}, False), ({"beta_3y": 0.1}, False), ({"beta_3y": None, "r_squared_3y": None, "info_ratio_3y": None}, True), ({"info_ratio_3y": -0.3, "r_squared_3y": 0.99}, True)])
def test_hard_filters(spark, change, kept):
    assert r.hard_filters(metrics(spark, change)).count() == kept


def test_scores(spark):
    rows = metrics(spark, {"ret_3y_median": 0.30, "alpha_3y_annualized": 0.09}, {"ret_5y_median": None}, {"alpha_3y_annualized": None, "ret_3y_median": 0.1})
    z = {x.scheme_code: x for x in r.zscores(rows).collect()}
    assert z["S2"].z_alpha_3y_annualized is None and z["S0"].z_sortino_3y == 0.0
    s = {x.scheme_code: x.composite_score for x in r.composite(r.zscores(rows), r.STAGE_1).collect()}
    assert max(s, key=s.get) == "S0" and all(v == v for v in s.values())
    alone = r.zscores(metrics(spark, {"alpha_3y_annualized": None})).first()
    assert alone.z_alpha_3y_annualized == 0.0  # a group of one has no spread


@pytest.mark.parametrize("value, want", [(1.0, 0), (1.5, 0), (2.25, 0.05), (10.0, 0.1), (None, 0)])
def test_soft_penalty(spark, value, want):
    assert spark.createDataFrame([(value,)], "v double").select(r.soft_penalty(F.col("v"), 1.5, 0.1)).first()[0] == pytest.approx(want)


def test_stages(spark):
    rows = metrics(spark, *[{"ret_3y_median": 0.1 + k / 100} for k in range(30)], {"canonical_category": "Mid Cap", "ptr_latest": None, "active_share_median_1y": None}, {"canonical_category": "Mid Cap"})
    survivors, dropped, coverage = r.stage_two(r.stage_one(rows))
    got = {x.canonical_category: x for x in coverage.collect()}
    assert (got["Large Cap"].n_considered, got["Large Cap"].n_survived, got["Large Cap"].n_dropped) == (20, 5, 0)
    assert (got["Mid Cap"].n_considered, got["Mid Cap"].n_survived, got["Mid Cap"].n_dropped) == (2, 1, 1)
    assert dropped.first().missing_metrics == "active_share_median_1y;ptr_latest"
    flags = {x.canonical_category: x.partial_coverage_flag for x in survivors.collect()}
    assert flags == {"Large Cap": False, "Mid Cap": True}


def test_one_row_stands_for_a_fund(spark):
    rows = metrics(spark, {}, {}, {}).withColumn("composite_score", F.lit(1.0)).withColumn("base_fund_id", F.when(F.col("scheme_code") == "S0", "x_bonus").when(F.col("scheme_code") == "S1", "x"))
    assert {x.scheme_code: x.unit_rank for x in r.one_per_unit(rows).collect()} == {"S0": 2, "S1": 1, "S2": 1}


def greedy(ranked, pairs, most=30.0):
    """One pair after another, from the largest overlap down."""
    rank = {c: (10**9 if k is None else k, c) for c, k in ranked}
    left = set(rank)
    for a, b, o in sorted(pairs, key=lambda p: (-p[2], rank[p[0]], rank[p[1]])):
        if o > most and a in left and b in left:
            left.discard(max(a, b, key=rank.get))
    return left


def test_greedy_drop(spark):
    rng = random.Random(3)
    many = [(f"F{k}", rng.choice([None, 1, 2, 3, 4, 5])) for k in range(16)]
    cases = [
        ([("A", 1), ("B", 2), ("C", 3)], [("A", "B", 100.0), ("A", "C", 100.0), ("B", "C", 100.0)], {"A"}),
        ([("A", 1), ("B", 2)], [("A", "B", 30.0)], {"A", "B"}),
        ([("A", 1), ("B", 2), ("C", 3)], [("A", "B", 40.0), ("B", "C", 50.0)], {"A"}),  # C goes against B, then B against A
        ([("A", None), ("B", 2)], [("A", "B", 40.0)], {"B"}),
        (many, [(a, b, float(rng.choice([20, 35, 50, 50, 70]))) for n, (a, _) in enumerate(many) for b, _ in many[n + 1 :] if rng.random() < 0.4], None),
    ]
    for ranked, pairs, want in cases:
        survivors = spark.createDataFrame(ranked, "scheme_code string, stage2_rank int")
        table = spark.createDataFrame(pairs, "scheme_a string, scheme_b string, overlap_pct double")
        got = {x.scheme_code for x in r.stage_three(survivors, table).collect()}
        assert got == greedy(ranked, pairs) and want in (None, got)


def textbook_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(old[j - 1] + 1 if x == y else max(old[j], row[-1]))
    return row[-1]


def matched(spark, printed, names):
    """match_names in one block against all pairs; codes are the places in names."""
    got = matching.match_names(spark.createDataFrame([("x", n) for n in printed], "block string, name string"), spark.createDataFrame([("x", f"{k:05}", n) for k, n in enumerate(names)], "block string, scheme_code string, name string"))
    rows = got.collect()
    assert sorted(r.name for r in rows) == sorted(printed)
    for row in rows:
        scored = sorted((-matching.token_set_ratio(row.name, c), c) for c in names)[: matching.SHORTLIST]
        near = [(s, c) for s, c in scored if -s >= matching.THRESHOLD and -s >= -scored[0][0] - matching.NEAR_BEST]
        want = min(((-matching.ratio(row.name, c), s, c) for s, c in near), default=None)
        assert (row.scheme_code, row.score) == ((f"{names.index(want[2]):05}", pytest.approx(-want[1])) if want else (None, None)), row
    return rows


def test_matching_against_all_pairs(spark, monkeypatch):
    rng = random.Random(8)
    vocabulary = ["ALPHA", "BETA", "GAMMA", "FUND", "MID", "CAP", "INDIA", "VALUE", "GROWTH", "TAX", "A"]
    names = sorted({" ".join(rng.sample(vocabulary, rng.randint(2, 5))) for _ in range(60)} | {"BLUECHIPS", "Ωmega ñandú"})
    printed = sorted({n.replace("GROWTH", "GROWHT").replace("ALPHA", "ALPA") for n in names[::2]} | {"NOTHING", "BLUECHIP", "Ωmega nandú", "A"})
    assert all(matching.common(a, b) == textbook_common(a, b) for a in printed[:12] for b in names)
    assert {r.name: r.score for r in matched(spark, printed, names)}["BLUECHIP"] > 94  # no word in common
    monkeypatch.setattr(matching, "NAMES", 7)
    monkeypatch.setattr(matching, "CANDIDATES", 9)
    matched(spark, printed, names)


def test_matching_of_a_large_block_of_common_words(spark):
    """Every word stands in more than 50 of over 2,000 candidates."""
    rng = random.Random(9)
    vocabulary = [a + b for a in ("BLUE", "MID", "SMALL", "TAX", "DIVI", "GLO") for b in ("CHIP", "CAP", "SAVER", "DEND", "BAL")]
    names = sorted({" ".join(rng.sample(vocabulary, rng.randint(3, 6))) for _ in range(2100)})
    assert len(names) > 2000 and all(sum(w in n.split() for n in names) > 50 for w in vocabulary)
    printed = sorted({"".join(rng.sample(n, len(n))) if k % 9 == 0 else n[: k % 20] + n[k % 20 + 1 :] for k, n in enumerate(rng.sample(names, 60))})
    matched(spark, printed, names)


@pytest.mark.parametrize("many", [40, 60, 600])
def test_a_match_does_not_depend_on_the_number_of_candidates(spark, many):
    names = [f"BLUECHIP EQUITY SERIES {k:03}" for k in range(many)]
    (row,) = matched(spark, ["BLUECHIP EQUITY SERIES OTHER"], names)
    assert row.score == pytest.approx(91.666667)


def test_bounds_hold_for_any_names():
    rng = random.Random(10)
    names = [" ".join("".join(rng.choice("ABC") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 5))) for _ in range(120)]
    bounds = matching.upper_bounds(names, names)
    assert all(matching.token_set_ratio(a, b) <= bounds[i, j] + 1e-3 for i, a in enumerate(names) for j, b in enumerate(names))


def test_names_without_a_partner(spark):
    printed = spark.createDataFrame([("a", None), (None, "X"), ("a", ""), ("a", " "), ("b", "ONE FUND"), ("c", "ONE FUND")], "block string, name string")
    pool = spark.createDataFrame([("b", "1", None), ("b", "2", ""), ("c", None, "ONE FUND"), (None, "4", "X")], "block string, scheme_code string, name string")
    got = matching.match_names(printed, pool).collect()
    assert sorted((r.block or "", r.name or "") for r in got) == sorted((b or "", n or "") for b, n in ((r.block, r.name) for r in printed.collect()))
    assert {r.block: r.score for r in got if r.score is not None} == {"c": 100.0}


def test_candidates_of_a_company(spark):
    rows = [("1", "hdfc", "HDFC Flexi Cap Fund - Direct Plan - Growth Option", "DIRECT", "GROWTH", True), ("0", "hdfc", "HDFC Flexi Cap Fund - Direct Plan - Growth", "DIRECT", "GROWTH", True), ("2", "hdfc", "HDFC Flexi Cap Fund - Regular Plan - Growth", "REGULAR", "GROWTH", True),
            ("3", "hdfc", "HDFC Old Fund - Direct Plan - Growth", "DIRECT", "GROWTH", False), ("4", "hdfc", "HDFC Tax Fund - Direct Plan - Bonus Growth", "DIRECT", "GROWTH", True), ("5", "aditya_birla_sun_life", " - Growth", "DIRECT", "GROWTH", True), ("6", "x", None, "DIRECT", "GROWTH", True)]
    schemes = spark.createDataFrame(rows, "scheme_code string, amc_code string, scheme_name string, plan_type string, option_type string, is_active boolean")
    assert [tuple(r) for r in matching.candidate_index(schemes).collect()] == [("hdfc", "HDFC FLEXI CAP FUND", "0")]
    codes = spark.createDataFrame([("absl",), ("hdfc",), (None,)], "c string").select(matching.company_code(F.col("c")).alias("c")).collect()
    assert [r.c for r in codes] == ["aditya_birla_sun_life", "hdfc", None]


def test_canonical_schemes(spark):
    cases = {
        "HDFC Dividend Yield Fund - Regular Plan - IDCW Payout": "HDFC DIVIDEND YIELD FUND", "Axis Growth Opportunities Fund—Growth": "AXIS GROWTH OPPORTUNITIES FUND",
        "Nippon India Small Cap Fund Direct Plan Growth Plan Growth Option": "NIPPON INDIA SMALL CAP FUND", "quant Mid Cap Fund Growth Plan Growth Option": "QUANT MID CAP FUND", "quant Mid Cap Fund Growth Plan - Growth Option": "QUANT MID CAP FUND GROWTH PLAN",
        "SBI Multi-Asset Fund - Direct Plan": "SBI MULTI ASSET FUND", "Kotak FMP Series 12 Plan A": "KOTAK FMP SERIES 12 PLAN A", "": "", "Fund - Bonus": "FUND BONUS",
    }
    rows = spark.createDataFrame([(k,) for k in cases], "v string").select("v", text.canonical_scheme(F.col("v")).alias("c")).collect()
    assert {x.v: x.c for x in rows} == cases


H = "scheme_code string, ticker string, as_of_month date, security_name string, weight_pct double, instrument_type string, isin string"
JAN = dt.date(2024, 1, 1)


def held(spark, *rows):
    return spark.createDataFrame([(s, "X", JAN, n, float(w), k, i) for s, n, w, k, i in rows], H)


def test_active_share(spark):
    index = spark.createDataFrame([("X", JAN, n, w) for n, w in (("A", 50.0), ("B Inc", 30.0), ("C", 20.0))], "ticker string, as_of_month date, security_name string, weight_pct double")
    assert h.active_share(held(spark, ("F", "A Ltd.", 80, "Equity", None), ("F", "B", 20, "Equity", None)), index).first().active_share == pytest.approx(30)
    assert h.active_share(held(spark, ("F", "A", 80, "Debt", None)), index).count() == 0
    months = spark.createDataFrame([("F", dt.date(2024, m, 1), float(v)) for m, v in ((1, 5), (2, 10), (3, 15), (4, 20), (5, 25))], "scheme_code string, as_of_month date, v double")
    assert h.trailing_median(months, "v", "2024-06-10").first()["median"] == 15
    assert h.trailing_median(months, "v", "2024-03-10").count() == 0


def test_impact_days(spark):
    rows = held(spark, *[("F", f"n{k}", 10, "Equity", f"I{k}") for k in range(5)], ("F", "d", 50, "Debt", "I0"))
    adv = spark.createDataFrame([(f"I{k}", v) for k, v in enumerate((5e6, 1e7, 2.5e7, 5e7, 1e8))], "isin string, adv double")
    aum = spark.createDataFrame([("F", 50.0)], "scheme_code string, aum_crore double")
    assert h.impact_days(rows, adv, aum).first().aum_impact_days == pytest.approx(10)
    assert h.impact_days(rows, adv.limit(2), aum).count() == 0
    days = spark.createDataFrame([("I", dt.date(2024, 3, 1), 10.0), ("I", dt.date(2024, 2, 1), 30.0), ("I", dt.date(2023, 12, 1), 999.0)], "isin string, date date, total_traded_value double")
    assert h.median_turnover(days).first().adv == 20


def test_overlaps(spark):
    rows = held(spark, *[("A", n, w, "Equity", None) for n, w in (("p", 40), ("q", 20), ("r", 40))], *[("B", n, w, "Equity", None) for n, w in (("p", 30), ("q", 30), ("s", 40))], ("C", "p", 9, "Debt", None), ("D", "p", 100, "Equity", "ISIN"))
    funds = spark.createDataFrame([(x,) for x in "ABCD"], "scheme_code string")
    got = {(x.scheme_a, x.scheme_b): x for x in h.overlaps(rows, funds).collect()}
    assert (got["A", "B"].overlap_pct, got["A", "B"].n_shared, got["A", "B"].top_shared) == (50.0, 2, "p (30.0%), q (20.0%)")
    assert got["A", "C"].overlap_pct is None and got["A", "C"].reason == "missing_holdings" and got["A", "D"].overlap_pct == 0 and len(got) == 6


def test_names_and_matching(spark):
    one = lambda c, v: spark.createDataFrame([(v,)], "v string").select(c(F.col("v"))).first()[0]
    assert one(text.normalize_name, "HDFC Bank Ltd.") == one(text.normalize_name, "HDFC Bank Limited") == "hdfc bank"
    assert one(text.sector, "Nippon India Power & Infra Fund") == "Energy" and one(text.sector, "") == "Thematic"
    assert one(text.canonical_scheme, "Nippon India Growth Mid Cap Fund - Direct Plan - Growth") == "NIPPON INDIA GROWTH MID CAP FUND"
    assert one(text.tolerant_number, "29,476.18") == 29476.18 and one(text.tolerant_number, "N.A.") is None
    assert one(text.plan_type, "X Direct Plan") == "DIRECT" and one(text.option_type, "X Dividend Yield - Growth") == "IDCW"
    assert matching.token_set_ratio("A B", "B A C") == 100 and matching.ratio("abcd", "abxd") == 75
    pool = spark.createDataFrame([("a", "1", "BANK OF INDIA MID CAP FUND"), ("a", "2", "BANK OF INDIA LARGE AND MID CAP FUND"), ("b", "3", "OTHER")], "block string, scheme_code string, name string")
    printed = spark.createDataFrame([("a", "BANK OF INDIA MID CAP FUND"), ("b", "NOTHING LIKE IT")], "block string, name string")
    got = {x.name: x.scheme_code for x in matching.match_names(printed, pool).collect()}
    assert got == {"BANK OF INDIA MID CAP FUND": "1", "NOTHING LIKE IT": None}


def test_unfiltered_stage_one_and_the_company_of_most_dropped(spark):
    rows = metrics(spark, {"data_quality_flag": "POOR", "ptr_latest": None}, {"ptr_latest": None}, {"style_drift_3y": None}, {"aum_crore": 30.0}, {"canonical_category": "Mid Cap"}, {"canonical_category": None})
    assert r.stage_one(rows, skip_filters=True).count() == 5 and r.stage_one(rows, categories=["Mid Cap"]).count() == 1
    rows = rows.withColumn("source_amc", F.when(F.col("scheme_code") == "S2", "A").otherwise("B"))
    got = {x.canonical_category: x for x in r.stage_two(r.stage_one(rows, skip_filters=True))[2].collect()}
    assert (got["Large Cap"].top_dropped_amc, got["Large Cap"].pct_aum_survived) == ("B", 50.0)
    assert (got["Mid Cap"].top_dropped_amc, got["Mid Cap"].pct_aum_survived) == (None, 100.0)
