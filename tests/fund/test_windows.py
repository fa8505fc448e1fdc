"""Rolling-window metrics on seeded series with known answers."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fundlab.operators import incremental, quality, series, windows


def aligned(spark, n=1008, beta=1.0, drift=1e-4, noise=0.002, seed=42, fund=None):
    rng = np.random.default_rng(seed)
    rf = np.full(n, np.log(1.000247))
    bench = rng.normal(0.00045, 0.011, n)
    y = rf + beta * (bench - rf) + drift + noise * rng.standard_normal(n) if fund is None else fund(bench)
    days = pd.date_range("2020-01-01", periods=n).date
    frame = pd.DataFrame({"scheme_code": "A", "date": days, "nav": 100 * np.exp(np.cumsum(y)), "bench_close": 1000 * np.exp(np.cumsum(bench)), "rate_daily": 0.000247, "rate_daily_log": rf, "fund_log_ret": y, "bench_log_ret": bench})
    return spark.createDataFrame(frame), frame


def test_alpha_and_beta_are_recovered(spark):
    one = windows.single_window_alpha(aligned(spark, noise=0)[0]).first()
    assert abs(one.alpha - 0.02551) < 1e-4 and abs(one.beta - 1) < 1e-6 and one.r2 > 0.99
    one = windows.single_window_alpha(aligned(spark, noise=0, drift=0, beta=1.3)[0]).first()
    assert abs(one.beta - 1.3) < 1e-6 and abs(one.alpha) < 1e-6


def test_window_metrics_equal_numpy(spark):
    df, frame = aligned(spark, n=1512, drift=3e-4)
    first, end, dates = frame["date"].iloc[0], frame["date"].iloc[-1], pd.to_datetime(frame["date"])
    want = {"beta": [], "alpha": [], "sortino": [], "ir": [], "n": []}
    stop = pd.Timestamp(first) + pd.Timedelta(days=1095)
    while stop <= pd.Timestamp(end):
        part = frame[(dates >= stop - pd.Timedelta(days=1095)) & (dates <= stop)]
        x, y = part.bench_log_ret - part.rate_daily_log, part.fund_log_ret - part.rate_daily_log
        slope, intercept = np.polyfit(x, y, 1)
        active = part.fund_log_ret - part.bench_log_ret
        want["beta"].append(slope)
        want["alpha"].append((1 + intercept) ** 252 - 1)
        want["sortino"].append(y.mean() * 252 / (np.sqrt(np.mean(np.minimum(0, y) ** 2)) * np.sqrt(252)))
        want["ir"].append(active.mean() * 252 / (active.std(ddof=1) * np.sqrt(252)))
        stop += pd.Timedelta(days=7)
    ab = windows.alpha_beta(df, least_t=-1e9).first()
    assert ab.beta_3y == pytest.approx(np.median(want["beta"])) and ab.alpha_3y_annualized == pytest.approx(np.median(want["alpha"]))
    assert ab.beta_3y_std == pytest.approx(np.std(want["beta"], ddof=1))
    assert windows.sortino(df).first().sortino_3y == pytest.approx(np.median(want["sortino"]))
    assert windows.information_ratio(df).first().info_ratio_3y == pytest.approx(np.median(want["ir"]))
    assert windows.grid(df, ["fund_log_ret"]).count() == len(want["beta"])


def test_capture_of_a_fund_that_falls_half_as_far(spark):
    got = windows.capture(aligned(spark, n=1512, seed=7, fund=lambda b: np.where(b > 0, b, b / 2))[0]).first()
    assert got.capture_up == pytest.approx(1) and got.capture_down == pytest.approx(0.5) and got.capture_efficiency == pytest.approx(2)


def test_insignificant_alpha_and_short_history(spark):
    got = windows.alpha_beta(aligned(spark, n=1200, drift=0, noise=0.005)[0], least_t=50).first()
    assert got.alpha_3y_annualized is None and got.beta_3y == pytest.approx(1, abs=0.2)
    assert windows.alpha_beta(aligned(spark, n=30)[0]).count() == 0


def test_returns_take_the_nearest_quantile_and_the_last_price_before(spark):
    df = aligned(spark, n=1512, drift=2e-4)[0].select("scheme_code", "date", "nav").withColumnRenamed("date", "nav_date")
    got = windows.rolling_returns(df, 3).first()
    assert got.ret_3y_p25 is not None and got.ret_3y_p25 <= got.ret_3y_median


def test_align_fills_one_day_only(spark):
    d = pd.date_range("2024-01-01", periods=6).date
    nav = spark.createDataFrame([("A", d[0], 10.0), ("A", d[3], 11.0), ("A", d[5], 12.0)], "scheme_code string, nav_date date, nav double")
    calendar = spark.createDataFrame([(x,) for x in d], "date date")
    bench = spark.createDataFrame([(x, 100.0 + k) for k, x in enumerate(d)], "date date, close double")
    rf = spark.createDataFrame([(d[1], 0.0002)], "date date, rate_daily double")
    got = series.align(nav, calendar, bench, rf).orderBy("date").collect()
    assert [r.nav for r in got] == [10, 10, None, 11, 11, 12] and [r.rate_daily for r in got] == [None, *[0.0002] * 5]
    assert got[1].fund_log_ret == 0 and got[2].fund_log_ret is None and got[3].fund_log_ret is None
    empty = nav.filter("false")
    assert series.align(empty, calendar, bench, rf).count() == 0


def test_risk_free_and_synthetic_index(spark):
    d = pd.date_range("2024-01-01", periods=4).date
    got = series.daily_risk_free(spark.createDataFrame([(d[0], 6.5), (d[2], 0.07)], "date date, rate double"), str(d[3])).orderBy("date").collect()
    assert [round(r.rate_annual, 4) for r in got] == [0.065, 0.065, 0.07, 0.07]
    eq = spark.createDataFrame([(d[0], 100.0), (d[1], 110.0)], "date date, close double")
    rf = spark.createDataFrame([(x, 0.0) for x in d], "date date, rate_daily double")
    got = series.synthetic_index(eq, rf, 0.5).orderBy("date").collect()
    assert got[0].close == pytest.approx(1000) and got[1].close == pytest.approx(1000 * 1.1**0.5)
    with pytest.raises(ValueError):
        series.synthetic_index(eq, rf, 1.5)


def test_a_day_on_a_window_border_counts_once_and_flat_series_have_no_ratio(spark):
    df, frame = aligned(spark, n=1200)
    gaps = frame.drop(index=[*range(700, 716), 1095])  # more than two weeks without rows, and the last day of the first window
    got = {r.window_end: r.n for r in windows.grid(spark.createDataFrame(gaps), ["fund_log_ret"]).collect()}
    dates, first = pd.to_datetime(gaps["date"]), pd.Timestamp(frame["date"].iloc[0])
    ends = [first + pd.Timedelta(days=1095 + 7 * k) for k in range(15)]
    assert got == {e.date(): int(((dates >= e - pd.Timedelta(days=1095)) & (dates <= e)).sum()) for e in ends if e.date() <= frame["date"].iloc[-1]}
    assert windows.information_ratio(aligned(spark, n=1200, fund=lambda b: b)[0]).count() == 0
    assert windows.sortino(df.withColumn("fund_log_ret", df["rate_daily_log"] + 1e-4)).count() == 0
    assert windows.regression_windows(df.withColumn("bench_log_ret", df["rate_daily_log"])).count() == 0
    assert windows.grid(df.filter("false"), ["nav"]).count() == 0


def test_observed_rates_and_their_gates(spark):
    rates = lambda *rows: spark.createDataFrame([(dt.date.fromisoformat(d), r) for d, r in rows], "date date, rate double")
    scraped, manual, none = rates(("2024-01-03", 6.8), ("2024-01-10", 6.9)), rates(("2024-01-10", 7.0), ("2024-01-11", None)), rates()
    got = series.observed_rates(scraped, manual, "2024-01-24").orderBy("date").collect()
    assert [(r.date.day, r.rate) for r in got] == [(3, 6.8), (10, 7.0)]
    with pytest.raises(quality.StaleData):
        series.observed_rates(scraped, manual, "2024-01-25")
    assert series.observed_rates(scraped, manual, "2024-01-25", allow_fallback=True).count() == 2
    with pytest.raises(quality.StaleData):
        series.observed_rates(none, none, "2024-01-25")
    got = series.observed_rates(none, none, "2024-01-25", start="2023-01-01", allow_fallback=True).collect()
    assert [tuple(r) for r in got] == [(dt.date(2023, 1, 1), 6.5)]


def test_chunks_of_days_and_the_month_before(spark):
    span = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 10)), (dt.date(2024, 2, 1), dt.date(2024, 1, 1)), (None, None)], "start date, end date")
    assert [(r.chunk_start.day, r.chunk_end.day) for r in series.date_chunks(span, 4).orderBy("chunk_start").collect()] == [(1, 4), (5, 8), (9, 10)]
    assert spark.range(1).select(series.previous_month(F.lit("2024-03-31").cast("date"))).first()[0] == dt.date(2024, 2, 1)


def test_daily_windows_equal_numpy(spark):
    """Gaps of several days, and values large enough that plain running sums would lose digits."""
    df, frame = aligned(spark, n=1300, drift=3e-4)
    keep = np.random.default_rng(3).random(1300) > 0.15
    keep[[0, -1]] = True
    frame = frame[keep].assign(fund_log_ret=lambda f: f.fund_log_ret + 1e3)
    df = spark.createDataFrame(frame)
    dates = pd.to_datetime(frame["date"])
    got = {r.window_end: r for r in windows.daily_sums(df, ["fund_log_ret"], {"s": F.col("fund_log_ret")}).collect()}
    want, stop = {}, dates.iloc[0] + pd.Timedelta(days=1095)
    while stop <= dates.iloc[-1]:
        part = frame[(dates >= stop - pd.Timedelta(days=1095)) & (dates <= stop)]
        if len(part) >= 726:
            want[stop.date()] = part
        stop += pd.Timedelta(days=1)
    assert set(got) == set(want) and len(got) > 150
    from fractions import Fraction

    for day, part in want.items():
        assert got[day].n == len(part)
        assert got[day].s == pytest.approx(float(sum(map(Fraction, part.fund_log_ret))), rel=1e-14)


def test_daily_and_weekly_steps_agree_where_both_end(spark):
    df, _ = aligned(spark, n=1300)
    daily = {r.window_end: r for r in windows.regression_windows(df, step="1d").collect()}
    weekly = windows.regression_windows(df).collect()
    assert len(daily) == 1300 - 1095 and all(daily[r.window_end].beta == pytest.approx(r.beta, rel=1e-11) and daily[r.window_end].t == pytest.approx(r.t, rel=1e-8) for r in weekly)
    assert windows.grid(df, ["fund_log_ret"], step="1d").count() == 205
    with pytest.raises(ValueError, match="2w"):
        windows.sortino(df, step="2w")


def by_end(df):
    return {(r.scheme_code, r.window_end): (r.n, *(pytest.approx(r[k], rel=1e-9, abs=1e-9) for k in ("x", "y", "xx", "xy", "yy"))) for r in df.collect()}


def test_kept_sums_equal_a_full_computation(spark, tmp_path):
    one, _ = aligned(spark, n=1400)
    two, _ = aligned(spark, n=1250, seed=5)
    rows = one.unionByName(two.withColumns({"scheme_code": F.lit("B"), "date": F.date_add("date", 140)})).withColumn("fund_log_ret", F.when(F.dayofmonth("date") != 13, F.col("fund_log_ret")))
    path, sums = f"{tmp_path}/state", windows.regression_sums()
    start = dt.date(2020, 1, 1)
    cuts = [0, 200, 1200, 1201, 1330, 1400]
    for a, b in zip(cuts, cuts[1:], strict=False):
        part = rows.filter(F.col("date").between(F.lit(start + dt.timedelta(a)), F.lit(start + dt.timedelta(b - 1))))
        incremental.load(part, path, *sums)
        upto = rows.filter(F.col("date") < F.lit(start + dt.timedelta(b)))
        assert by_end(incremental.windows(spark, path)) == by_end(windows.weekly_sums(upto, sums[0], sums[1], 3, sums[2])), b
    incremental.load(rows.filter(F.year("date") == 2022), path, *sums)  # loaded before: nothing changes
    assert by_end(incremental.windows(spark, path)) == by_end(windows.weekly_sums(rows, sums[0], sums[1], 3, sums[2]))
    with pytest.raises(ValueError, match="first"):
        incremental.load(rows.limit(1).withColumn("date", F.lit(start - dt.timedelta(1))), path, *sums)
    incremental.load(rows.limit(0), path, *sums)


def test_a_load_at_the_end_leaves_earlier_periods_alone(spark, tmp_path):
    rows, _ = aligned(spark, n=1400)
    path, sums = f"{tmp_path}/state", windows.regression_sums()
    last = F.col("date") >= F.lit(dt.date(2020, 1, 1) + dt.timedelta(1390))
    incremental.load(rows.filter(~last), path, *sums)
    files = lambda: {str(f.relative_to(tmp_path)) for f in (tmp_path / "state" / "weeks").rglob("*.parquet")}
    before = files()
    incremental.load(rows.filter(last), path, *sums)
    assert len(before & files()) >= len(before) - 2 and len({f.split("period=")[1].split("/")[0] for f in before}) > 5


def test_late_days_reach_their_windows(spark, tmp_path):
    """Days that arrive after later ones, but not before the scheme's first."""
    rows, _ = aligned(spark, n=1300)
    path, sums = f"{tmp_path}/state", windows.regression_sums()
    late = F.dayofmonth("date").isin(5, 6, 20)
    first = F.col("date") == F.lit(dt.date(2020, 1, 1))
    incremental.load(rows.filter(~late | first), path, *sums)
    incremental.load(rows.filter(late), path, *sums)
    assert by_end(incremental.windows(spark, path)) == by_end(windows.weekly_sums(rows, sums[0], sums[1], 3, sums[2]))
