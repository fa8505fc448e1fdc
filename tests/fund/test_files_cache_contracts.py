"""Files with headings of their own, the cache of parsed pages, contracts on write."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fundlab.operators import contracts, store
from fundlab.sources import cache, headed, landing


def put(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / name.replace("__", ".")).write_bytes(text.encode())
    return str(folder)


def test_three_headings_in_one_scan(spark, tmp_path):
    path = put(
        tmp_path / "in", NIFTY__csv='Date,Close\n15-Jan-2024,"32,471.80"\n15-Jan-2024,9\n16-Jan-2024,\n', MID__csv="﻿ Index Date ,Open, Total Returns Index\r\n2024-01-15,1,7.5\r\n\r\nsoon,1,8\r\n",
        SMALL__csv='"TRI","Trade Date",TRI\n5,2024-01-15,6\n"1,000"\n', OTHER__csv="day,level\n2024-01-15,1\n", EMPTY__csv="", HEAD__csv="Date,Close\n",
    )
    got = {(r.ticker, r.date.day): r.close for r in headed.index_files(spark, path).collect()}
    assert got == {("NIFTY", 15): 32471.8, ("MID", 15): 7.5, ("SMALL", 15): 5.0}
    lacking = headed.without(headed.rows(spark, path), [headed.INDEX_DATES, headed.INDEX_VALUES]).collect()
    assert [r.file.rsplit("/", 1)[1] for r in lacking] == ["OTHER.csv"]


def test_lines_of_a_file_in_many_blocks_keep_their_heading_and_order(spark, tmp_path):
    put(tmp_path / "in", A__csv="ter_pct,scheme_code,effective_date,extra\n" + "".join(f"{k / 100},S{k % 7},2024-01-0{k % 3 + 1},e{k}\n" for k in range(4000)), B__csv="scheme_code,ter_pct,effective_date\nS1,9,2024-01-01\n", C__csv="scheme_code\nS1\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {(r.scheme_code, r.effective_date.day): (r.ter_pct, r.year, dict(r.other)) for r in headed.expense_files(spark, f"{tmp_path}/in").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {(f"S{k % 7}", k % 3 + 1): (k / 100, 2024, {"extra": f"e{k}"}) for k in range(4000)} | {("S1", 1): (9.0, 2024, {})}
    assert got == want


def test_constituents_and_tickers_by_path(spark, tmp_path):
    put(tmp_path / "in" / "NIFTY 50", **{"2024-01__csv": 'ISIN,weight_pct,security_name\nINE1, 5.5% ,"A, Ltd"\n,3,B\nINE2,x,C\nINE3,2,\n', "notes__csv": "isin,weight_pct\nINE9,1\n"})
    put(tmp_path / "in" / "M+ID", **{"2024-02__csv": "weight_pct,isin\n1,INE7\n"})
    got = {(r.ticker, r.as_of_month, r.isin): (r.weight_pct, r.security_name) for r in headed.constituent_files(spark, f"{tmp_path}/in/*").collect()}
    jan, feb = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    assert got == {("NIFTY 50", jan, "INE1"): (5.5, "A, Ltd"), ("NIFTY 50", jan, "INE3"): (2.0, None), ("M+ID", feb, "INE7"): (1.0, None)}
    assert {r.ticker: r.n_files for r in headed.tickers(spark, f"{tmp_path}/in/*").collect()} == {"NIFTY 50": 2, "M+ID": 1}
    put(tmp_path / "in" / "BAD", **{"2024-02__csv": "isin,weight\nINE7,1\n"})
    with pytest.raises(ValueError, match="BAD"):
        headed.constituent_files(spark, f"{tmp_path}/in/*")


@pytest.mark.parametrize("line, want", [("a,b", ["a", "b"]), ('"a,1",b', ["a,1", "b"]), ('a,"say ""x""",', ["a", 'say "x"', ""]), ("", [""]), ('a"b,c"d', ['a"b,c"d'])])
def test_fields(spark, line, want):
    assert spark.createDataFrame([(line,)], "v string").select(headed.cells(F.col("v")).alias("c")).first().c == want


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "page_id long, html string")


def auction(rate):
    return f'<td class="tableheader"><b>91-Day, 182-Day and 364-Day T-Bill Auction Result: Cut-off</b> Date : Jan 03, 2024 Cut-off Price and Implicit Yield <b>(YTM: {rate}%)</b>'


def test_pages_are_parsed_once(spark, tmp_path):
    path = f"{tmp_path}/cache"
    first = pages(spark, (1, auction(6.5)), (2, auction(6.5)), (3, "<p>x</p>"), (4, None))
    out, n = cache.parsed(first, path, 1, landing.auction_rate)
    assert n == 2 and {r.page_id: r.result and r.result.rate_pct for r in out.collect()} == {1: 6.5, 2: 6.5, 3: None, 4: None}
    assert cache.parsed(first, path, 1, landing.auction_rate)[1] == 0
    out, n = cache.parsed(first.union(pages(spark, (5, auction(7.25)))), path, 1, landing.auction_rate)
    assert n == 1 and {r.page_id: r.result.rate_pct for r in out.filter("result is not null").collect()} == {1: 6.5, 2: 6.5, 5: 7.25}
    out, n = cache.parsed(first, path, 2, landing.auction_rate)  # another parser
    assert n == 2 and out.filter("result is not null").count() == 2
    assert sorted(r.page_id for r in cache.missing(first, 0, 5).collect()) == [0, 4, 5]
    out, n = cache.parsed(pages(spark).limit(0), f"{tmp_path}/none", 1, landing.auction_rate)
    assert n == 0 and out.count() == 0


def test_too_many_failures_leave_the_cache_alone(spark, tmp_path):
    path = f"{tmp_path}/cache"
    hoped = lambda html: html.contains("T-Bill")
    cache.parsed(pages(spark, (1, auction(6.5))), path, 1, landing.auction_rate, hoped, 0.4)
    bad = pages(spark, (2, "T-Bill?"), (3, "T-Bill??"), (4, auction(7.5)), (5, "other"))
    with pytest.raises(cache.TooManyFailures, match="2 of 3"):
        cache.parsed(bad, path, 1, landing.auction_rate, hoped, 0.4)
    assert store.read_table(spark, path).count() == 1
    assert cache.parsed(bad, path, 1, landing.auction_rate, hoped, 0.4, least=10)[1] == 4


NAV = contracts.CONTRACTS["nav_daily"]
TEXTS = "scheme_code string, nav_date string, nav string, note string"


def test_a_bad_batch_leaves_the_table_as_it_was(spark, tmp_path):
    path = f"{tmp_path}/nav"
    good = spark.createDataFrame([("A", "2024-01-01", "1.5", "x"), ("A", "2024-01-02", "1.6", "x"), ("A", "2024-01-02", "1.6", "x")], TEXTS)
    assert contracts.upsert_checked(good, path, NAV, batch="one") == {"written": 2, "broken": 0}
    files = store._listed(spark, path)
    bad = spark.createDataFrame([("A", "2024-01-01", "9", None), ("B", "soon", "2", None), (None, "2024-01-01", "2", None), ("C", "2024-01-01", "-1", None), ("D", "2024-01-01", None, None), ("E", "2024-01-01", "x", None), ("F", "2024-01-01", "1", None), ("F", "2024-01-01", "2", None)], TEXTS)
    for _ in range(2):  # a batch that is run again
        with pytest.raises(contracts.ContractBroken, match="6 of 8"):
            contracts.upsert_checked(bad, path, NAV, most_broken=0.5, batch="two")
    assert store._listed(spark, path) == files and store.read_table(spark, path).count() == 2
    broken = store.read_table(spark, f"{path}_broken")
    assert sorted(r.broken for r in broken.collect()) == ["another row has its key", "nav is missing", "nav is no double", "nav is outside its range", "nav_date is no date", "scheme_code is missing"]
    assert contracts.upsert_checked(bad, path, NAV, most_broken=0.8, batch="two") == {"written": 2, "broken": 6}
    got = store.read_table(spark, path)
    assert {(r.scheme_code, r.nav_date.day): r.nav for r in got.collect()} == {("A", 1): 9.0, ("A", 2): 1.6, ("F", 1): 1.0}
    assert got.schema.simpleString() == NAV.schema().simpleString()


def test_missing_and_further_columns(spark):
    rows = spark.createDataFrame([("INE1", dt.date(2024, 1, 1), 5, "note")], "isin string, date date, total_traded_value int, other string")
    (row,) = contracts.conformed(rows, contracts.CONTRACTS["stock_adv_daily"]).collect()
    assert (row.isin, row.symbol, row.close, row.total_traded_value, row.broken) == ("INE1", None, None, 5.0, [])


def test_empty_typed_tables(spark, tmp_path):
    made = contracts.create_tables(spark, str(tmp_path))
    assert set(made) == set(contracts.CONTRACTS) and contracts.create_tables(spark, str(tmp_path)) == []
    for name, contract in contracts.CONTRACTS.items():
        table = store.read_table(spark, f"{tmp_path}/{name}")
        assert table.count() == 0 and table.schema.simpleString() == contract.schema().simpleString()
    contracts.upsert_checked(spark.createDataFrame([("A", "2024-01-01", "1")], "scheme_code string, nav_date string, nav string"), f"{tmp_path}/nav_daily", NAV)
    assert store.read_table(spark, f"{tmp_path}/nav_daily").count() == 1
