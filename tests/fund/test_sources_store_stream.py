"""Parsers, tables, freshness and the price stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fundlab.operators import quality, store
from fundlab.sources import landing
from fundlab.streaming import ingest

DAILY = """Scheme Code;ISIN Div Payout/ ISIN Growth;ISIN Div Reinvestment;Scheme Name;Net Asset Value;Date

Open Ended Schemes(Equity Scheme - Large Cap Fund)

Axis Mutual Fund

100;INF1;-;Axis One Direct - Growth;10.5;01-Jan-2024
101;INF2;INF3;Axis Two;1,011.25;02-Jan-24
Other Mutual Fund
102;-;-;Third;9;03-01-2024
9999;;;garbage;N.A.;not-a-date
"""
HISTORY = """Scheme Code;Scheme Name;ISIN Div Payout/ISIN Growth;ISIN Div Reinvestment;Net Asset Value;Repurchase Price;Sale Price;Date
Open Ended Schemes ( Hybrid )
Axis Mutual Fund
100;Axis One;INF1;;10.5;;;01-Jan-2024
"""


def test_price_texts(spark, tmp_path):
    (tmp_path / "a.txt").write_text(DAILY)
    (tmp_path / "b.txt").write_text(HISTORY)
    got = sorted(map(tuple, landing.nav_text(landing.numbered_lines(spark, str(tmp_path))).select("scheme_code", "nav", "nav_date", "isin_growth", "scheme_name", "amc_name", "amfi_category").collect()))
    day, large, hybrid = dt.date(2024, 1, 1), "Open Ended Schemes(Equity Scheme - Large Cap Fund)", "Open Ended Schemes ( Hybrid )"
    assert got == [("100", 10.5, day, "INF1", "Axis One", "Axis Mutual Fund", hybrid), ("100", 10.5, day, "INF1", "Axis One Direct - Growth", "Axis Mutual Fund", large), ("101", 1011.25, dt.date(2024, 1, 2), "INF2", "Axis Two", "Axis Mutual Fund", large), ("102", 9.0, dt.date(2024, 1, 3), None, "Third", "Other Mutual Fund", large)]


@pytest.mark.parametrize("head, row, want", [("Date,Open,High,Low,Close", '01-Jan-2024,1,2,3,"29,476.18"', 29476.18), ("Index Date, Total Returns Index ", "2024-01-01,5", 5.0), ("x,y", "1,2", None)])
def test_index_files(spark, tmp_path, head, row, want):
    (tmp_path / "i.csv").write_text(f"{head}\n{row}\n")
    got = [x.close for x in landing.index_csv(spark.read.option("header", True).csv(str(tmp_path))).collect()]
    assert got == ([] if want is None else [want])


def test_constituents(spark, tmp_path):
    (tmp_path / "2024-03.csv").write_text("isin,weight_pct,security_name\nINE1,5.5%,A\n,3,B\nINE2,x,C\n")
    got = landing.constituents_csv(spark, str(tmp_path)).collect()
    assert [(x.isin, x.weight_pct, x.as_of_month) for x in got] == [("INE1", 5.5, dt.date(2024, 3, 1))]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "2024-04.csv").write_text("isin\nX\n")
    with pytest.raises(ValueError):
        landing.constituents_csv(spark, f"{tmp_path}/b")


def test_auction_pages(spark):
    page = '<td class="tableheader"><b>91-Day, 182-Day and 364-Day T-Bill Auction Result: Cut-off</b> Date : Jan 03, 2024 Cut-off Price and Implicit Yield <b>(YTM: 6.5594%)</b> YTM: 7.1'
    rows = spark.createDataFrame([(page,), ("<p>other</p>",)], "html string")
    got = [x.r for x in rows.select(landing.auction_rate(F.col("html")).alias("r")).collect()]
    assert got[0].rate_pct == 6.5594 and got[0].auction_date == dt.date(2024, 1, 3) and got[1] is None


def test_holdings_sheet_and_factsheet(spark):
    cells = [(1, "Equity & Equity related", None, None), (2, None, "ine002a01018", "5%"), (3, None, "INE002A01018", "9"), (4, "Debt Instruments", None, None), (5, None, "INE040A01034", "3"), (6, "Grand Total", None, None), (7, None, "INE009A01021", "2")]
    df = spark.createDataFrame([("s", n, b, i, f"Name {n}*", w) for n, b, i, w in cells], "sheet string, row_no int, banner string, code string, name string, w string")
    got = landing.holdings_sheet(df, "code", "name", "w", "banner").orderBy("row_no").collect()
    assert [(x.isin, x.instrument_type, x.weight_pct, x.security_name) for x in got] == [("INE002A01018", "Equity", 5.0, "Name 2"), ("INE040A01034", "Debt", 3.0, "Name 5")]
    pages = spark.createDataFrame([("m", 1, "Portfolio Turnover Ratio: 127%"), ("m", 2, "none")], "manager string, page_no int, page_text string")
    rules = spark.createDataFrame([("m", r"Turnover Ratio:\s*([0-9.]+)", 0.01)], "manager string, pattern string, scale double")
    assert [(x.page_no, round(x.ptr, 2)) for x in landing.turnover_ratio(pages, rules).collect()] == [(1, 1.27)]


def test_exchange_file(spark):
    table = spark.createDataFrame([("A", " EQ", "10", "2.5"), ("B", "BE", "1", "1"), ("C", "EQ", "x", "-")], ["SYMBOL", " SERIES", " CLOSE_PRICE", " TURNOVER_LACS"])
    equities = spark.createDataFrame([("A", "I1"), ("C", "I2")], "symbol string, isin string")
    got = landing.traded_values(table, equities, "2024-01-01").collect()
    assert [(x.isin, x.close, x.total_traded_value) for x in got] == [("I1", 10.0, 250000.0)]


def test_tables(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, part int")
    path = f"{tmp_path}/t"
    store.upsert(old, path, ["k"])
    store.upsert(spark.createDataFrame([(2, "c", 1), (3, "d", 2)], "k int, v string, part int"), path, ["k"])
    assert sorted((x.k, x.v) for x in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    store.write_table(spark.read.parquet(path), f"{tmp_path}/p", "part")
    store.replace_partitions(spark.createDataFrame([(9, "z", 2)], "k int, v string, part int"), f"{tmp_path}/p", "part")
    assert sorted(x.k for x in spark.read.parquet(f"{tmp_path}/p").collect()) == [1, 2, 9]
    part, untouched = f"{tmp_path}/p", {f.name for f in (tmp_path / "p" / "part=1").iterdir()}
    store.upsert(spark.createDataFrame([(9, "y", 2), (10, "n", 3)], "k int, v string, part int"), part, ["k", "part"], "part")
    assert sorted((x.k, x.v) for x in spark.read.parquet(part).collect()) == [(1, "a"), (2, "c"), (9, "y"), (10, "n")]
    assert {f.name for f in (tmp_path / "p" / "part=1").iterdir()} == untouched  # other partitions are not written
    (tmp_path / "t").rename(tmp_path / "t.before")  # a crash while a table took its place
    store.recover(spark, path)
    assert spark.read.parquet(path).count() == 3 and not (tmp_path / "t.before").exists()
    assert sorted((x.k, x.v) for x in store.updated(old, spark.createDataFrame([(1, "q")], "k int, v string"), ["k"]).collect()) == [(1, "q"), (2, "b")]
    store.write_by_category(old.withColumn("canonical_category", F.lit("Large & Mid Cap")), f"{tmp_path}/c")
    assert spark.read.parquet(f"{tmp_path}/c/parquet").count() == 2 and (tmp_path / "c/csv/category_file=large_mid_cap").exists()


def test_freshness(spark):
    rows = [("nav", dt.date(2024, 1, 5), "weekdays", 5), ("old", dt.date(2024, 1, 1), "weekdays", 5), ("none", None, "days", 3), ("skip", None, "days", None)]
    report = quality.freshness(spark.createDataFrame(rows, "check_name string, latest date, unit string, max_lag long"), "2024-01-13")
    assert {x.check_name: (x.lag, x.issue) for x in report.collect()} == {"nav": (5, False), "old": (9, True), "none": (None, True)}
    with pytest.raises(quality.StaleData):
        quality.require_fresh(report)


def test_price_stream_merges(spark, tmp_path):
    landing_dir = f"{tmp_path}/in"
    day = dt.date(2024, 1, 1)
    for rows in ([("A", day, 1.0), ("B", day, 2.0)], [("A", day, 3.0)]):
        spark.createDataFrame(rows, ingest.NAV_SCHEMA).write.mode("append").parquet(landing_dir)
        ingest.merge_stream(ingest.nav_stream(spark, landing_dir), f"{tmp_path}/table", f"{tmp_path}/marks").awaitTermination()
    assert sorted((x.scheme_code, x.nav) for x in spark.read.parquet(f"{tmp_path}/table").collect()) == [("A", 3.0), ("B", 2.0)]


def test_index_records_take_the_first_key_that_is_there(spark):
    rows = [("A", '{"Date": "15 Jan 2024", "TotalReturnsIndex": "32,471.80"}'), ("A", '{"HistoricalDate": "16-Jan-2024", "TR": "5", "Close": "6"}'), ("A", '{"Date": "", "TradeDate": "2024-01-17", "IndexValue": 7}'), ("A", '{"Date": "15-01-2024", "Close": "99999"}'), ("A", '{"Date": "soon", "Close": "1"}'), ("A", '{"Date": "2024-01-18", "Close": "x"}'), ("A", "no json"), ("A", None)]
    got = landing.index_records(spark.createDataFrame(rows, "ticker string, record string")).orderBy("date").collect()
    assert [(r.date.day, r.close) for r in got] == [(15, 32471.8), (16, 5.0), (17, 7.0)]


def test_index_names_match_but_for_case_and_blanks(spark):
    mapping = spark.createDataFrame([("IX 50", "Index Fifty"), ("ix 100 ", "Index  Hundred"), ("", None)], "trading_name string, long_name string")
    wanted = spark.createDataFrame([("index fifty",), ("Ix100",), ("Index Ten",), (None,), ("",)], "name string")
    got = {r.name: (r.trading_name, r.long_name) for r in map(lambda r: type("R", (), r.asDict()), landing.index_names(wanted, mapping).collect())}
    assert got == {"index fifty": ("IX 50", "Index Fifty"), "Ix100": ("IX 100", "Index  Hundred")}


def test_manual_rates(spark):
    table = spark.createDataFrame([("2024-01-05", "6.9", "a"), ("x", "7", "a"), ("2024-01-06", "-", "a")], "` Date ` string, `Yield pct` string, note string")
    assert [tuple(r) for r in landing.manual_rates(table).collect()] == [(dt.date(2024, 1, 5), 6.9)]
    assert landing.manual_rates(table.drop("Yield pct")).count() == 0


@pytest.mark.parametrize("day, label, end", [("2026-05-15", "Q4-2026", "2026-03-31"), ("2026-05-14", "Q3-2025", "2025-12-31"), ("2025-08-14", "Q1-2025", "2025-06-30"), ("2025-12-31", "Q2-2025", "2025-09-30")])
def test_quarters(spark, day, label, end):
    got = spark.range(1).select(landing.latest_quarter(F.lit(day).cast("date")).alias("label"), landing.quarter_end(F.lit(f" {label.lower()} ")).cast("string").alias("end"), landing.quarter_end(F.lit("Q5-2025")).alias("bad")).first()
    assert tuple(got) == (label, end, None)


def test_the_last_expense_ratio_counts(spark):
    rows = spark.createDataFrame([(1, "2024-01-05", "0.5", "a", 1), (1, "2024-01-05", "0.6", "b", 0), (1, "2024-01-05", "0.4", "a", 2), (2, None, "1", "a", 3)], "scheme_code int, effective_date string, ter_pct string, file string, row_no int")
    assert sorted((r.scheme_code, r.ter_pct, r.year) for r in landing.expense_ratios(rows).collect()) == [("1", 0.6, 2024), ("2", 1.0, None)]


def test_keys_of_worst_coverage(spark):
    rows = spark.createDataFrame([(k, dt.date(2024, 1, 1) + dt.timedelta(d)) for k, days in ((1, (0, 140)), (2, (0, 70)), (3, (0, 140, 140)), (4, (0, 14))) for d in days], "k int, date date")
    assert [(r.k, r.n_missing) for r in quality.worst_coverage(rows, "k").collect()] == [(1, 98), (3, 98), (2, 48)]
    assert [r.k for r in quality.worst_coverage(rows, "k", top=1).collect()] == [1]


def kv(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, day date, v string, version int")


def names(folder):
    return {str(f.relative_to(folder)) for f in folder.rglob("*.parquet") if not any(p[0] == "_" for p in f.relative_to(folder).parts)}


D = [dt.date(2024, 1, k) for k in range(1, 29)]


def test_upsert_rewrites_only_the_files_that_hold_a_key(spark, tmp_path):
    folder = tmp_path / "a table"
    path = str(folder)
    for k in range(4):  # four loads of other days: four files and more
        store.upsert(kv(spark, *[(i, D[k], f"old{k}", 1) for i in range(50)]).coalesce(1), path, ["k", "day"])
    before = names(folder)
    store.upsert(kv(spark, (7, D[2], "new", 2), (99, D[2], "more", 2), (7, D[2], "later", 2)), path, ["k", "day"])
    after = names(folder)
    assert len(before - after) == 1 and len(before & after) == len(before) - 1
    rows = {(r.k, r.day): r.v for r in store.read_table(spark, path).collect()}
    assert len(rows) == 201 and rows[7, D[2]] == "later" and rows[99, D[2]] == "more" and rows[8, D[2]] == "old2"
    store.upsert(kv(spark, (1000, D[9], "far", 1)), path, ["k", "day"])
    assert after < names(folder) and store.read_table(spark, path).count() == spark.read.parquet(path).count() == 202
    store.upsert(kv(spark).limit(0), path, ["k", "day"])
    assert store.read_table(spark, path).count() == 202


def test_upsert_of_null_keys_and_versions(spark, tmp_path):
    path = f"{tmp_path}/t"
    store.upsert(kv(spark, (None, D[0], "a", 5), (None, None, "b", 5), (1, D[0], "c", 5), (1, D[0], "d", 6)), path, ["k", "day"], version="version")
    store.upsert(kv(spark, (None, D[0], "older", 4), (None, None, "newer", 6), (1, D[0], "none", None)), path, ["k", "day"], version="version")
    assert sorted((r.k or 0, r.v) for r in store.read_table(spark, path).collect()) == [(0, "a"), (0, "newer"), (1, "d")]


def test_readers_and_crashes_during_a_change(spark, tmp_path):
    path = f"{tmp_path}/t"
    store.upsert(kv(spark, (1, D[0], "a", 1), (2, D[0], "b", 1)).coalesce(1), path, ["k"])
    seen = lambda: sorted((r.k, r.v) for r in store.read_table(spark, path).collect())
    held = store._listed(spark, path)
    staged, add = store._stage(kv(spark, (1, D[0], "a", 1), (2, D[0], "B", 2)).coalesce(1), path)
    assert seen() == [(1, "a"), (2, "b")]  # written, not committed
    commit = store._commit(spark, path, staged, add, held)
    assert seen() == [(1, "a"), (2, "B")]  # committed, nothing moved yet
    (tmp_path / "t" / staged / add[0]).rename(tmp_path / "t" / add[0])
    assert seen() == [(1, "a"), (2, "B")]  # moved, the old file still there
    store.recover(spark, path)  # the writer died here: the next one goes on
    assert seen() == [(1, "a"), (2, "B")] and names(tmp_path / "t") == set(add) and not (tmp_path / "t" / commit).exists()
    store._stage(kv(spark, (5, D[0], "lost", 1)), path)
    store.write_table(store.read_table(spark, path).filter("k = 1"), path)
    assert seen() == [(1, "a")] and not list((tmp_path / "t").glob("_staged*"))


def test_a_replaced_partitioned_table_is_read_whole_at_any_moment(spark, tmp_path):
    path = f"{tmp_path}/p"
    store.write_table(kv(spark, (1, D[0], "a", 1), (2, D[1], "b", 2)), path, "version")
    staged, add = store._stage(kv(spark, (3, D[0], "c", 1), (4, D[1], "d", 3)), path, "version")
    store._commit(spark, path, staged, add, store._listed(spark, path))
    assert sorted((r.k, r.version) for r in store.read_table(spark, path).collect()) == [(3, 1), (4, 3)]
    store.upsert(kv(spark, (5, D[0], "e", 3)), path, ["k", "version"], "version")
    assert sorted((r.k, r.version) for r in store.read_table(spark, path).collect()) == [(3, 1), (4, 3), (5, 3)]


def published(spark, folder, hour, *rows):
    data = [(s, d, n, dt.datetime(2024, 2, 1, hour)) for s, d, n in rows]
    spark.createDataFrame(data, ingest.PUBLISHED_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_stream_with_marks_in_any_order(spark, tmp_path):
    landing_dir, table = f"{tmp_path}/in", f"{tmp_path}/table"
    files = [(3, ("A", D[5], 3.0), ("B", D[5], 2.0)), (1, ("A", D[5], 1.0), ("A", D[4], 9.0)), (2, ("A", D[5], 2.0), ("C", D[1], 7.0)), (3, ("A", D[5], 3.0), ("B", D[5], 2.0))]  # late files, a replay
    for hour, *rows in files:
        published(spark, landing_dir, hour, *rows)
        stream = spark.readStream.schema(ingest.PUBLISHED_SCHEMA).parquet(landing_dir)
        ingest.merge_published(stream, table, f"{tmp_path}/checkpoint").awaitTermination()
    want = {("A", D[5]): 3.0, ("B", D[5]): 2.0, ("A", D[4]): 9.0, ("C", D[1]): 7.0}
    assert {(r.scheme_code, r.nav_date): r.nav for r in store.read_table(spark, table).collect()} == want
    marks = store.read_table(spark, f"{table}_marks")
    assert {r.scheme_code: (r.low, r.high, r.latest.hour) for r in marks.collect()} == {"A": (D[4], D[5], 3), "B": (D[5], D[5], 3), "C": (D[1], D[1], 2)}
    stream = spark.readStream.schema(ingest.PUBLISHED_SCHEMA).parquet(landing_dir)  # all batches once more, as after the loss of the checkpoint
    ingest.merge_published(stream, table, f"{tmp_path}/lost").awaitTermination()
    assert {(r.scheme_code, r.nav_date): r.nav for r in store.read_table(spark, table).collect()} == want
    marks = store.read_table(spark, f"{table}_marks")  # tables are read anew after a change
    new = spark.createDataFrame([("A", D[6], 1.0), ("A", D[5], 1.0), ("A", D[3], 1.0), ("Z", D[0], 1.0)], ingest.NAV_SCHEMA)
    assert sorted((r.scheme_code, r.nav_date.day) for r in ingest.to_load(new, marks).collect()) == [("A", 7), ("Z", 1)]
    assert sorted((r.scheme_code, r.nav_date.day) for r in ingest.to_load(new, marks, tail=2).collect()) == [("A", 6), ("A", 7), ("Z", 1)]
