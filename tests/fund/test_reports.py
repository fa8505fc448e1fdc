"""The stages' outputs and small pieces of the ranking."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fundlab.functions import text
from fundlab.operators import ranking as r
from fundlab.operators import quality, store
from fundlab.plans import reports
from fundlab.sources import landing
from tests.fund.test_rank_and_holdings import metrics

PAIR = "scheme_a string, scheme_b string, overlap_pct double"


def survivors(spark, n):
    return spark.createDataFrame([("Mid Cap", f"S{k:03}", k + 1) for k in range(n)], "canonical_category string, scheme_code string, stage2_rank int")


def greedy(pairs, ranks, most=30.0):
    gone = {}
    for o, a, b in sorted(((-o, *sorted((a, b), key=ranks.get)) for a, b, o in pairs if o > most), key=lambda p: (p[0], ranks[p[1]], ranks[p[2]])):
        if a not in gone and b not in gone:
            gone[b] = (a, -o)
    return gone


@pytest.mark.parametrize("shape", ["chain", "random"])
def test_drops_equal_the_greedy_walk(spark, shape):
    rng = random.Random(3)
    n = 24
    codes = [f"S{k:03}" for k in range(n)]
    pairs = [(codes[k], codes[k + 1], 90.0 - k) for k in range(n - 1)] if shape == "chain" else [(a, b, float(rng.randrange(20, 45))) for k, a in enumerate(codes) for b in codes[k + 1 :] if rng.random() < 0.3]
    table = spark.createDataFrame(pairs, PAIR)
    got = {x.scheme_code_dropped: (x.scheme_code_kept, x.overlap_pct) for x in r.overlap_drops(survivors(spark, n), table).collect()}
    assert got == greedy(pairs, {c: k for k, c in enumerate(codes)})
    assert {x.scheme_code for x in r.stage_three(survivors(spark, n), table).collect()} == set(codes) - set(got)


def test_stage_one_of_a_day(spark):
    jan, feb = (F.lit(d).cast("date") for d in ("2024-01-31", "2024-02-29"))
    rows = metrics(spark, {}, {}, {"canonical_category": "Mid Cap"})
    days = rows.withColumn("as_of_date", F.when(F.col("scheme_code") == "S0", jan).otherwise(feb))
    assert {(x.scheme_code, x.as_of_date) for x in reports.stage_one_of_day(days, skip_filters=True).collect()} == {(c, dt.date(2024, 2, 29)) for c in (x.scheme_code for x in days.filter("month(as_of_date) = 2").collect())}
    assert reports.stage_one_of_day(days, category="Mid Cap", skip_filters=True).count() == 1
    with pytest.raises(reports.NoMetrics, match="2020"):
        reports.stage_one_of_day(days, "2020-01-01")
    with pytest.raises(reports.NoMetrics, match="no metrics were"):
        reports.stage_one_of_day(days.limit(0))


def sheet(spark, path):
    return spark.read.option("header", True).csv(path)


def test_outputs_of_all_stages(spark, tmp_path):
    scored = r.stage_one(metrics(spark, {"canonical_category": "Mid Cap"}, {"canonical_category": "Mid Cap", "ptr_latest": None}, {}, {}), skip_filters=True)
    some = lambda s: s.select(F.min("scheme_code").alias("scheme_a"), F.max("scheme_code").alias("scheme_b"), F.lit(50.0).alias("overlap_pct"))
    reports.write_stages(scored, some, f"{tmp_path}/out")
    assert sheet(spark, f"{tmp_path}/out/stage1/report").count() == 4 and sheet(spark, f"{tmp_path}/out/stage2/dropped").first().missing_metrics == "ptr_latest"
    assert sheet(spark, f"{tmp_path}/out/stage2/coverage").count() == 2 and sheet(spark, f"{tmp_path}/out/stage3/dropped").count() == 1
    assert sheet(spark, f"{tmp_path}/out/stage3/report").count() == sheet(spark, f"{tmp_path}/out/stage2/report").count() - 1
    assert (tmp_path / "out/stage1/by_category/csv/category_file=mid_cap").exists()


def test_empty_stages_have_their_headings(spark, tmp_path):
    scored = r.stage_one(metrics(spark, {}), skip_filters=True).filter("false")
    none = lambda s: s.sparkSession.createDataFrame([], PAIR)
    reports.write_stages(scored, none, f"{tmp_path}/out")
    want = {"stage2/dropped": ["canonical_category", "stage1_rank", "scheme_code", "missing_metrics"], "stage3/dropped": ["scheme_code_dropped", "scheme_code_kept", "overlap_pct"], "stage3/overlap_pairs": ["scheme_a", "scheme_b", "overlap_pct"]}
    for name, columns in want.items():
        read = sheet(spark, f"{tmp_path}/out/{name}")
        assert read.columns == columns and read.count() == 0, name
    assert "n_considered" in sheet(spark, f"{tmp_path}/out/stage2/coverage").columns and not (tmp_path / "out/stage1/by_category").exists()


def test_file_names_of_categories_differ(spark):
    rows = spark.createDataFrame([("Large & Mid",), ("large mid",), ("Value",), (None,), ("Value",)], "c string")
    got = [(x.c, x.category_file) for x in store.with_file_names(rows, "c").collect()]
    assert len(got) == 5 and len({f for _, f in got}) == 4 and dict(got)["Value"] == "value" and dict(got)[None] == "none" and dict(got)["Large & Mid"].startswith("large_mid_")


def test_sections_of_companies(spark):
    one = lambda banner, c: spark.range(1).select(text.section(F.lit(banner), c).alias("s")).first().s
    assert [one("TREPS", c) for c in ("hdfc", "sbi", "nippon")] == [None, "Debt", None]
    assert [one("Net Payables", c) for c in ("hdfc", "sbi", "nippon")] == [None, "Cash", None]
    assert [one("Grand Total", c) for c in ("hdfc", "sbi", "nippon")] == [None, None, None] and one(" Others", "nippon") == "Cash"


def test_the_last_row_of_a_symbol_counts(spark):
    rows = spark.createDataFrame([("A", "I1", 1), (" A ", "I2", 3), ("A", "I3", 2), ("", "I4", 1), ("B", " ", 1), (None, "I5", 1)], "symbol string, isin string, row_no int")
    assert [tuple(x) for x in landing.equity_list(rows).collect()] == [("A", "I2")]


def test_missing_columns_are_null(spark):
    df = spark.createDataFrame([(1, "x")], "a int, z string")
    out = store.add_missing(df, {"b": "double", "a": "long"})
    assert out.dtypes == [("b", "double"), ("a", "bigint")] and tuple(out.first()) == (None, 1)


def test_validation(spark):
    bench = spark.createDataFrame([("X", dt.date(2010, 1, 1), 100.0), ("X", dt.date(2012, 1, 1), 130.0), ("X", dt.date(2000, 1, 1), 1.0), ("Y", dt.date(2012, 1, 1), 1.0)], "ticker string, date date, close double")
    nav = spark.createDataFrame([("A",), ("A",), ("B",)], "scheme_code string")
    got = lambda *a: {x.check_name: (x.value and round(x.value, 3), x.status) for x in quality.validate(bench, nav, *a).collect()}
    assert got("X", "2010-01-01") == {"index growth": (0.14, "OK"), "price rows": (3.0, "OK"), "schemes": (2.0, "OK")}
    assert got("X", "2010-01-01", 0.2)["index growth"][1] == "SUSPECT" and got("Z", "2010-01-01")["index growth"] == (None, "WARN")
