"""The whole staged plan on a small universe, and the registry."""

import datetime as dt

import __spark_entry__
from fundlab import registry
from fundlab.plans import staged
from tests.fund.test_rank_and_holdings import metrics


def test_shortlists_drop_overlapping_funds(spark):
    rows = metrics(spark, *[{"ret_3y_median": 0.30 - k / 100} for k in range(6)])
    month = dt.date(2024, 1, 1)
    held = [(f"S{k}", "X", month, f"name {j}", 25.0, "Equity", None) for k in range(6) for j in (range(4) if k < 2 else range(10 * k, 10 * k + 4))]
    holdings = spark.createDataFrame(held, "scheme_code string, ticker string, as_of_month date, security_name string, weight_pct double, instrument_type string, isin string")
    out = staged.shortlists(rows, holdings, 20, 5)
    assert [r.scheme_code for r in out.final.orderBy("stage2_rank").collect()] == ["S0", "S2", "S3", "S4"]
    assert out.coverage.first().n_considered == 6 and out.pairs.count() == 10 and out.dropped.count() == 0


def test_phase_two_reads_the_pool_only(spark):
    rows = metrics(spark, {}, {})
    rows = rows.selectExpr("*", "0.1D as beta_3y_std", "0.8D as r_squared_3y_mean")
    months = [dt.date(2024, m, 1) for m in (1, 2, 3, 4)]
    holdings = spark.createDataFrame([(f"S{k}", "X", m, f"n{j}", 10.0, "Equity", f"I{j}") for k in range(2) for m in months for j in range(4)], "scheme_code string, ticker string, as_of_month date, security_name string, weight_pct double, instrument_type string, isin string")
    index = spark.createDataFrame([("X", m, f"n{j}", 10.0) for m in months for j in range(8)], "ticker string, as_of_month date, security_name string, weight_pct double")
    turnover = spark.createDataFrame([("S0", months[0], 0.5), ("S0", months[1], 0.7)], "scheme_code string, as_of_month date, ptr double")
    adv = spark.createDataFrame([(f"I{j}", dt.date(2024, 4, 2), 1e7) for j in range(4)], "isin string, date date, total_traded_value double")
    aum = spark.createDataFrame([("S0", 100.0)], "scheme_code string, aum_crore double")
    got = staged.with_phase_two(rows, rows.filter("scheme_code = 'S0'"), holdings, index, turnover, adv, aum, "2024-05-10").collect()
    assert [(r.scheme_code, r.ptr_latest, round(r.active_share_median_1y, 6), round(r.aum_impact_cost_days, 6), round(r.style_drift_3y, 6)) for r in got] == [("S0", 0.7, 50.0, 10.0, 0.3)]


def test_every_query_with_sql_is_registered():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_all_stages_score_the_pool_again(spark):
    rows = metrics(spark, *[{"ret_3y_median": 0.30 - k / 100} for k in range(4)]).selectExpr("*", "0.1D as beta_3y_std", "0.8D as r_squared_3y_mean")
    months = [dt.date(2024, m, 1) for m in (1, 2, 3, 4)]
    holdings = spark.createDataFrame([(f"S{k}", "X", m, f"n{10 * k + j}", 10.0, "Equity", f"I{j}") for k in range(4) for m in months for j in range(4)], "scheme_code string, ticker string, as_of_month date, security_name string, weight_pct double, instrument_type string, isin string")
    index = spark.createDataFrame([("X", m, f"n{j}", 10.0) for m in months for j in range(8)], "ticker string, as_of_month date, security_name string, weight_pct double")
    turnover = spark.createDataFrame([(f"S{k}", months[0], 0.5) for k in (0, 1, 3)], "scheme_code string, as_of_month date, ptr double")
    adv = spark.createDataFrame([(f"I{j}", dt.date(2024, 4, 2), 1e7) for j in range(4)], "isin string, date date, total_traded_value double")
    aum = spark.createDataFrame([(f"S{k}", 100.0) for k in range(4)], "scheme_code string, aum_crore double")
    out = staged.rank_deep(rows, holdings, index, turnover, adv, aum, "2024-05-10", pool=3)
    assert {r.scheme_code for r in out.survivors.collect()} == {"S0", "S1"} and [r.scheme_code for r in out.dropped.collect()] == ["S2"]
    assert [r.scheme_code for r in out.final.collect()] == ["S0" if out.survivors.filter("stage2_rank = 1").first().scheme_code == "S0" else "S1"]  # equal holdings by ISIN
