"""Turnover from factsheet texts and from the places of words."""

import random
import re

import pytest

from fundlab.sources import factsheets

BOX = "company string, page_no int, word_no int, text string, x0 double, x1 double, top double, bottom double"


def box(company, page, word_no, text, x0, bottom, width=20.0):
    return company, page, word_no, text, float(x0), float(x0) + width, float(bottom) - 8, float(bottom)


@pytest.mark.parametrize("company, text, want", [
    ("absl", "x Portfolio\n Turnover 0.49 y", ("value", 0.49)), ("absl", "Portfolio Turnover 0.0", ("value", 0.0)), ("kotak", "Portfolio Turnover 0.0%", ("missing", None)),
    ("bandhan", "Equity 9.31 Portfolio Turnover Ratio Equity Total 66.87% Equity 0.67 Aggregate 0.69", ("value", 0.67)), ("bandhan", "Portfolio Turnover Ratio" + " x" * 300 + " Equity 0.67", ("missing", None)),
    ("canara_robeco", "Portfolio Turnover Ratio 3.1 times Portfolio Turnover Ratio (Equity) 0.4 times", ("value", 0.4)), ("canara_robeco", "Portfolio Turnover Ratio 3.1 times", ("value", 3.1)),
    ("franklin", "Total Portfolio Turnover $ 959.18%\nPortfolio Turnover (Equity) ** 1273.27%", ("value", 12.7327)), ("franklin", "Portfolio Turnover 26.58%", ("value", 0.2658)),
    ("iti", "Portfolio Turnover Ratio NA", ("none", None)), ("iti", "portfolio turnover ratio 1.08", ("value", 1.08)), ("motilal_oswal", "Portfolio Turnover Ratio -1.2", ("missing", None)),
    ("nippon", "Portfolio Turnover (Times) --", ("none", None)), ("lic", "Annual Portfolio Turnover Ratio: 0.50 times", ("value", 0.5)), ("uti", "Portfolio Turnover\n0.50", ("missing", None)), ("hdfc", None, ("missing", None)), ("hdfc", "", ("missing", None)),
])
def test_text_rules(spark, company, text, want):
    pages = spark.createDataFrame([(company, 1, text), ("other", 2, text)], "company string, page_no int, page_text string")
    (row,) = factsheets.turnover_by_text(pages).collect()
    assert (row.outcome, row.ptr if row.ptr is None else round(row.ptr, 9)) == want


def test_positions(spark):
    rows = [
        box("hdfc", 1, 1, "Equity", 20, 100), box("hdfc", 1, 2, "Turnover", 45, 101), box("hdfc", 1, 3, "12.50%", 90, 104), box("hdfc", 1, 4, "9.99%", 150, 100), box("hdfc", 1, 5, "3.33%", 80, 120),
        box("hdfc", 2, 1, "Equity", 250, 100), box("hdfc", 2, 2, "Turnover", 280, 100), box("hdfc", 2, 3, "12.50", 310, 100),  # right of the column
        box("axis", 1, 1, "PORTFOLIOTURNOVER", 30, 50), box("axis", 1, 2, "0.31", 40, 70), box("axis", 1, 3, "0.99", 200, 70), box("axis", 1, 4, "0.77", 40, 54),
        box("tata", 1, 1, "Portfolio", 30, 50), box("tata", 1, 2, "Turnover", 55, 51), box("tata", 1, 3, "49.5%", 140, 60), box("tata", 1, 4, "1.5", 140, 52),
        box("invesco", 1, 1, "Portfolio", 30, 50), box("invesco", 1, 2, "Turnover", 55, 51), box("invesco", 1, 3, "1.1", 100, 51), box("invesco", 1, 4, "0.42", 170, 49), box("invesco", 1, 5, "7.7", 210, 50),
        box("dsp", 1, 1, "Portfolio", 30, 50), box("dsp", 1, 2, "Turnover", 55, 50), box("dsp", 1, 3, "0.9", 31, 90), box("dsp", 1, 4, "0.8", 29, 70),
        box("nippon", 1, 1, "Portfolio", 30, 50), box("nippon", 1, 2, "Turnover", 55, 50), box("nippon", 1, 3, "0.00", 80, 50), box("nope", 1, 1, "Portfolio", 1, 1), ("hdfc", 3, 1, "Equity", None, None, None, None),
    ]
    got = {(r.company, r.page_no): round(r.ptr, 9) for r in factsheets.turnover_by_position(spark.createDataFrame(rows, BOX)).collect()}
    assert got == {("hdfc", 1): 0.125, ("axis", 1): 0.31, ("tata", 1): 0.495, ("invesco", 1): 0.42, ("dsp", 1): 0.8}
    assert factsheets.turnover_by_position(spark.createDataFrame(rows, BOX), limit=0.3).count() == 1


def test_positions_against_all_pairs_of_a_page(spark):
    rng = random.Random(12)
    rows = []
    for page in range(40):
        for k in range(60):
            text = rng.choice(["Portfolio", "Turnover", "turnovers", "0.25", f"{rng.randrange(9)}.{rng.randrange(100):02},", "x", "1.2345"])
            rows.append(box("nippon", page, k, text, rng.randrange(300), rng.randrange(120)))
    want = {}
    for page in range(40):
        words = [r for r in rows if r[1] == page]
        for w in words:
            if w[3] != "Portfolio" or w[4] >= 250 or page in want:
                continue
            beside = [v for v in words if w[2] < v[2] <= w[2] + 7 and v[3].lower().startswith("turnover") and abs(v[7] - w[7]) <= 3 and v[4] > w[5]]
            if beside:
                numbers = [(n[4], n[2], re.sub("[,;.]+$", "", n[3])) for n in words if abs(n[7] - w[7]) <= 5 and n[4] > beside[0][5]]
                hits = sorted(n for n in numbers if re.fullmatch(r"\d+\.\d{1,3}", n[2]) and float(n[2]) > 0)
                if hits:
                    want[page] = float(hits[0][2])
    got = {r.page_no: r.ptr for r in factsheets.turnover_by_position(spark.createDataFrame(rows, BOX)).collect()}
    assert got == want and len(want) > 3


def test_position_decides_where_no_text_rule_does(spark):
    pages = spark.createDataFrame([("nippon", 1, "torn"), ("nippon", 2, "Portfolio Turnover (Times) --"), ("nippon", 3, "Portfolio Turnover (Times) 0.5")], "company string, page_no int, page_text string")
    boxes = spark.createDataFrame([r for page in (1, 2, 3, 4) for r in (box("nippon", page, 1, "Portfolio", 30, 50), box("nippon", page, 2, "Turnover", 55, 50), box("nippon", page, 3, f"{page}.5", 80, 50))], BOX)
    got = {r.page_no: (r.ptr, r.source) for r in factsheets.turnover(pages, boxes).collect()}
    assert got == {1: (1.5, "position"), 3: (0.5, "text"), 4: (4.5, "position")}
