"""All queries of the fund engine by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab import oracles
from fundlab.functions import matching, text
from fundlab.operators import holdings as h
from fundlab.operators import contracts, incremental, quality, ranking, series, store, windows
from fundlab.plans import reports
from fundlab.plans.relations import relation, tasks
from fundlab.plans.staged import Shortlists, rank_deep, shortlists
from fundlab.sources import cache, factsheets, headed, landing
from fundlab.storage import materialize, scratch

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
AS_OF = "2000-01-15"


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to a number of places, without negative zero."""
    return df.select([(F.round(c, places) + F.lit(0.0)).alias(c) if t == "double" else F.col(c).cast("long").alias(c) if t == "int" else F.col(c) for c, t in df.dtypes])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _earlier() -> Column:
    """Greater for earlier rows of a table as read, so that of rows with equal keys the first one of the table counts last."""
    marks = "".join(map(chr, range(33, 127)))
    name = F.translate(F.col("_metadata.file_name"), marks, marks[::-1])
    return F.struct(name.alias("name"), (-F.col("_metadata.row_index")).alias("row"))


def _aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = partial(relation, spark, sf_dir)
    return series.align(rel("nav_daily"), rel("calendar"), rel("benchmark_daily"), series.daily_risk_free(rel("rf_observed")))


@query
def scan_filter_project(spark, sf):
    rows = table(spark, sf, "lineitem").filter((F.col("l_shipdate") >= "1995-01-01") & (F.col("l_shipdate") < "1996-01-01") & F.col("l_returnflag").isin("A", "R") & (F.col("l_discount") > 0.05))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@query
def null_tolerant_floors(spark, sf):
    return ranking.hard_filters(relation(spark, sf, "scheme_metrics"), ["ASIA", "EUROPE", "AFRICA", "AMERICA"]).select("scheme_code", "canonical_category")


@query
def topn_per_category(spark, sf):
    scored = relation(spark, sf, "scheme_metrics").withColumn("composite_score", F.col("alpha_3y_annualized"))
    return ranking.top_n(scored, 3).select("canonical_category", "scheme_code", F.col("rank").cast("long").alias("rank"))


@query
def latest_row_per_entity(spark, sf):
    return h.latest_month(relation(spark, sf, "holdings_monthly")).groupBy("scheme_code").agg(F.max("as_of_month").alias("as_of_month"), F.count("*").alias("n"))


@query
def preferred_source_latest(spark, sf):
    return h.preferred_latest(relation(spark, sf, "scheme_aum_monthly"), "aum_crore", "aaum").select("scheme_code", "source_amc", "as_of_month", "aum_crore")


@query
def calendar_align_ffill1(spark, sf):
    return rounded(_aligned(spark, sf))


@query
def log_returns(spark, sf):
    return rounded(series.log_returns(relation(spark, sf, "nav_daily")))


@query
def rf_daily_series(spark, sf):
    return rounded(series.daily_risk_free(relation(spark, sf, "rf_observed")), 9)


@query
def rf_merge_priority(spark, sf):
    scraped = relation(spark, sf, "rf_observed").withColumn("source", F.lit("scraped"))
    manual = relation(spark, sf, "calendar").filter(F.dayofmonth("date") % 14 == 1).withColumns({"rate": F.lit(0.07), "source": F.lit("manual")})
    return series.merge_by_source([manual, scraped]).select("date", "rate", "source")


@query
def synthetic_index(spark, sf):
    rel = partial(relation, spark, sf)
    rf = series.daily_risk_free(rel("rf_observed"))
    parts = [series.synthetic_index(rel("benchmark_daily"), rf, w).withColumn("ticker", F.lit(f"H{round(100 * w)}")) for w in (0.65, 0.50, 0.30)]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), 4)


@query
def window_grid(spark, sf):
    return windows.grid(_aligned(spark, sf), ["fund_log_ret", "bench_log_ret", "rate_daily_log"])


@query
def rolling_returns_dist(spark, sf):
    nav = relation(spark, sf, "nav_daily")
    return rounded(windows.rolling_returns(nav, 3).join(windows.rolling_returns(nav, 5), "scheme_code", "left"))


@query
def rolling_alpha_beta_r2(spark, sf):
    return rounded(windows.alpha_beta(_aligned(spark, sf)), 5)


@query
def daily_step_metrics(spark, sf):
    """The window metrics of windows that end a day apart."""
    rows = materialize(_aligned(spark, sf))  # read by four parts
    parts = [windows.sortino(rows, step="1d"), windows.information_ratio(rows, step="1d"), windows.capture(rows, step="1d").drop("capture_efficiency")]
    return rounded(reduce(lambda a, b: a.join(b, "scheme_code", "left"), parts, windows.alpha_beta(rows, step="1d")), 5)


@query
def incremental_alpha_beta(spark, sf):
    """Alpha and beta from kept window sums after three loads: the series up to 1999, 2000, and the rest."""
    rows, path, sums = materialize(_aligned(spark, sf)), scratch(spark), windows.regression_sums()
    year = F.year("date")
    for part in (year < 2000, year == 2000, year > 2000):
        incremental.load(rows.filter(part), path, *sums)
    return rounded(windows.summary(windows.fitted(incremental.windows(spark, path))), 5)


@query
def regression_windows(spark, sf):
    return rounded(windows.regression_windows(_aligned(spark, sf)), 5)


@query
def single_window_alpha(spark, sf):
    return rounded(windows.single_window_alpha(_aligned(spark, sf)), 5)


@query
def rolling_sortino(spark, sf):
    return rounded(windows.sortino(_aligned(spark, sf)))


@query
def rolling_info_ratio(spark, sf):
    return rounded(windows.information_ratio(_aligned(spark, sf)))


@query
def rolling_capture(spark, sf):
    return rounded(windows.capture(_aligned(spark, sf)))


@query
def quality_flag(spark, sf):
    return windows.quality_flag(_aligned(spark, sf), relation(spark, sf, "nav_daily").select("scheme_code").distinct())


@query
def phase1_metrics(spark, sf):
    return rounded(windows.phase_one(_aligned(spark, sf), relation(spark, sf, "nav_daily")), 5)


@query
def active_share_month(spark, sf):
    n = tasks(spark, sf)
    return rounded(h.active_share(relation(spark, sf, "holdings_monthly", n), relation(spark, sf, "constituents_monthly", n), n))


@query
def active_share_trailing_median(spark, sf):
    n = tasks(spark, sf)
    share = h.active_share(relation(spark, sf, "holdings_monthly", n), relation(spark, sf, "constituents_monthly", n), n)
    return rounded(h.trailing_median(share, "active_share", "1997-06-15"))


@query
def style_drift(spark, sf):
    return rounded(h.style_drift(relation(spark, sf, "scheme_metrics")).select("scheme_code", "style_drift_3y"))


@query
def latest_ptr(spark, sf):
    return rounded(h.latest(relation(spark, sf, "turnover_monthly"), "ptr"))


@query
def adv_median(spark, sf):
    return rounded(h.median_turnover(relation(spark, sf, "stock_adv_daily")), 3)


@query
def aum_impact_days(spark, sf):
    rel = partial(relation, spark, sf)
    aum = h.preferred_latest(rel("scheme_aum_monthly"), "aum_crore", "aaum")
    return rounded(h.impact_days(rel("holdings_monthly"), h.median_turnover(rel("stock_adv_daily")), aum), 3)


@query
def derived_constituents(spark, sf):
    return h.derived_constituents(relation(spark, sf, "holdings_monthly"), 10).select("scheme_code", "isin", F.round("weight_pct", 3).alias("weight_pct"))


@query
def zscore_winsorized(spark, sf):
    z = ranking.zscores(relation(spark, sf, "scheme_metrics"))
    return rounded(z.select("scheme_code", *[f"z_{m}" for m in ranking.Z_METRICS]))


@query
def composite_stage1(spark, sf):
    scored = ranking.composite(ranking.zscores(ranking.hard_filters(relation(spark, sf, "scheme_metrics")), list(ranking.STAGE_1)), ranking.STAGE_1)
    return rounded(scored.select("scheme_code", "composite_score"))


@query
def composite_stage2(spark, sf):
    scored = ranking.composite(ranking.zscores(relation(spark, sf, "scheme_metrics")), ranking.STAGE_2, penalties=ranking.PENALTIES)
    return rounded(scored.select("scheme_code", "composite_score"))


@query
def soft_penalty(spark, sf):
    rows = relation(spark, sf, "scheme_metrics")
    return rounded(rows.select("scheme_code", *[ranking.soft_penalty(F.col(m), *p).alias(f"penalty_{m}") for m, p in ranking.PENALTIES.items()]))


@query
def dedupe_unit_classes(spark, sf):
    scored = relation(spark, sf, "scheme_metrics").withColumn("composite_score", F.col("alpha_3y_annualized"))
    return ranking.one_per_unit(scored).select("scheme_code", F.col("unit_rank").cast("long").alias("unit_rank"))


def _stage_two(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return ranking.stage_two(ranking.stage_one(relation(spark, sf, "scheme_metrics")), 12, 4)


@query
def stage2_survivors(spark, sf):
    out = _stage_two(spark, sf)[0]
    return rounded(out.select("canonical_category", "scheme_code", "stage1_rank", "stage2_rank", "composite_score", "partial_coverage_flag"))


@query
def stage2_dropped(spark, sf):
    return _stage_two(spark, sf)[1].select("canonical_category", "scheme_code", F.col("stage1_rank").cast("long").alias("stage1_rank"), "missing_metrics")


@query
def stage2_coverage(spark, sf):
    return rounded(_stage_two(spark, sf)[2], 1)


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return h.overlaps(relation(spark, sf, "holdings_monthly"), _stage_two(spark, sf)[0].select("scheme_code"))


@query
def pairwise_overlap(spark, sf):
    return _pairs(spark, sf).select("scheme_a", "scheme_b", F.round("overlap_pct", 1).alias("overlap_pct"), "n_shared", "reason")


@query
def overlap_top_shared(spark, sf):
    return _pairs(spark, sf).select("scheme_a", "scheme_b", "top_shared")


@query
def stage3_greedy_drop(spark, sf):
    out = shortlists(relation(spark, sf, "scheme_metrics"), relation(spark, sf, "holdings_monthly"), 12, 4)
    return rounded(out.final.select("canonical_category", "scheme_code", "stage2_rank", "composite_score"))


def _deep(spark: SparkSession, sf: str) -> Shortlists:
    rel = partial(relation, spark, sf)
    aum = h.preferred_latest(rel("scheme_aum_monthly"), "aum_crore", "aaum").select("scheme_code", "aum_crore")
    return rank_deep(rel("scheme_metrics"), rel("holdings_monthly"), rel("constituents_monthly"), rel("turnover_monthly"), rel("stock_adv_daily"), aum, "1997-06-15", pool=12, final=4)


@query
def rank_deep_survivors(spark, sf):
    """Stage one, holdings measures of its best, and stage two among them."""
    return rounded(_deep(spark, sf).survivors.select("canonical_category", "scheme_code", "stage1_rank", "stage2_rank", "composite_score"), 5)


@query
def rank_deep_final(spark, sf):
    """All three stages, with each stage's reports joined: what is left of each category and why the rest went."""
    out = _deep(spark, sf)
    parts = [out.survivors.select("scheme_code", F.lit("survived").alias("outcome")), out.dropped.select("scheme_code", F.concat(F.lit("missing "), "missing_metrics").alias("outcome"))]
    last = out.final.select("scheme_code", F.lit(True).alias("is_final"))
    return parts[0].unionByName(parts[1]).join(last, "scheme_code", "left").select("scheme_code", "outcome", F.coalesce("is_final", F.lit(False)).alias("is_final"))


@query
def freshness_report(spark, sf):
    latest = relation(spark, sf, "nav_daily").agg(F.lit("nav").alias("check_name"), F.max("nav_date").alias("latest"), F.lit("weekdays").alias("unit"), F.lit(5).cast("long").alias("max_lag"))
    bench = relation(spark, sf, "benchmark_daily").agg(F.lit("bench").alias("check_name"), F.max("date").alias("latest"), F.lit("weekdays").alias("unit"), F.lit(5000).cast("long").alias("max_lag"))
    rates = relation(spark, sf, "rf_observed").agg(F.lit("rates").alias("check_name"), F.max("date").alias("latest"), F.lit("days").alias("unit"), F.lit(14).cast("long").alias("max_lag"))
    return quality.freshness(latest.unionByName(bench).unionByName(rates), AS_OF)


def _user_days(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("user_id", F.to_date("ts").alias("date"))


@query
def coverage_crossjoin(spark, sf):
    rows = _user_days(spark, sf)
    return quality.coverage_by_key(rows, rows.select("date").distinct(), "user_id")


@query
def coverage_antijoin(spark, sf):
    return quality.missing_days(relation(spark, sf, "calendar"), relation(spark, sf, "rf_observed"))


@query
def coverage_nav(spark, sf):
    return rounded(quality.nav_coverage(relation(spark, sf, "nav_daily"), relation(spark, sf, "calendar")))


@query
def coverage_bucket_counts(spark, sf):
    return quality.coverage_buckets(quality.nav_coverage(relation(spark, sf, "nav_daily"), relation(spark, sf, "calendar")))


@query
def gap_inventory(spark, sf):
    return rounded(quality.gaps(_user_days(spark, sf), "user_id", 2))


@query
def missing_data_inventory(spark, sf):
    return quality.inventory(_user_days(spark, sf), "user_id")


@query
def scheme_bounds_left_join(spark, sf):
    bounds = series.scheme_bounds(relation(spark, sf, "nav_daily"))
    types = table(spark, sf, "part").select(F.explode(F.array(F.concat("p_type", F.lit("-F")), F.concat("p_type", F.lit("-O")), F.concat("p_type", F.lit("-X")))).alias("scheme_code")).distinct()
    return types.join(bounds, "scheme_code", "left").select("scheme_code", F.coalesce("first_date", F.lit("1900-01-01").cast("date")).alias("inception_date"), "last_date")


@query
def classify_plan_option(spark, sf):
    return relation(spark, sf, "scheme_names").select("scheme_code", text.plan_type(F.col("scheme_name")).alias("plan_type"), text.option_type(F.col("scheme_name")).alias("option_type"))


@query
def classify_category(spark, sf):
    return relation(spark, sf, "scheme_names").select("scheme_code", text.category(F.col("amfi_category")).alias("category"))


@query
def classify_sector(spark, sf):
    return relation(spark, sf, "scheme_names").select("scheme_code", text.sector(F.col("scheme_name")).alias("sector"))


@query
def base_fund_id(spark, sf):
    return relation(spark, sf, "scheme_names").select("scheme_code", text.base_fund_id(F.col("scheme_name"), text.amc_slug(F.col("amc"))).alias("base_fund_id"))


@query
def plan_sibling_aum_sum(spark, sf):
    names = relation(spark, sf, "scheme_names")
    keyed = names.withColumn("base_fund_id", F.concat(text.amc_slug(F.col("amc")), F.lit("::"), (F.substring("scheme_code", 2, 9).cast("long") % 97).cast("string")))
    dimension = keyed.select("scheme_code", "base_fund_id", text.plan_type(F.col("scheme_name")).alias("plan_type"), text.option_type(F.col("scheme_name")).alias("option_type"), F.lit(True).alias("is_active"))
    payload = names.groupBy((F.substring("scheme_code", 2, 9).cast("long") % 8).alias("part")).agg(F.array(F.struct(F.collect_list(F.struct(F.col("scheme_code").alias("code"), F.col("aum_lakh").alias("value"))).alias("schemes"))).alias("groups"))
    return rounded(landing.average_assets(payload, dimension), 4)


@query
def cagr_sanity(spark, sf):
    return rounded(quality.growth_check(relation(spark, sf, "benchmark_daily")))


@query
def status_counts(spark, sf):
    return quality.status({"nav": (relation(spark, sf, "nav_daily"), "scheme_code"), "holdings": (relation(spark, sf, "holdings_monthly"), "security_name")})


@query
def union_by_name(spark, sf):
    one = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    two = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    return one.unionByName(two, allowMissingColumns=True)


@query
def distinct_keep_first(spark, sf):
    order = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").withColumn("_n", F.row_number().over(order)).filter("_n = 1").select("o_custkey", "o_orderkey", "o_orderstatus")


@query
def parse_carry_forward(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    head = F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderkey"))
    return landing.carry_forward(rows, "o_custkey", "o_orderkey", head, "section").select("o_custkey", "o_orderkey", "section")


@query
def parse_dates_tolerant(spark, sf):
    day = F.col("o_orderdate")
    printed = F.when(F.col("o_orderkey") % 4 == 0, F.date_format(day, "dd-MM-yyyy")).when(F.col("o_orderkey") % 4 == 1, F.date_format(day, "yyyy-MM-dd")).when(F.col("o_orderkey") % 4 == 2, F.date_format(day, "dd/MM/yyyy")).otherwise("n.a.")
    return table(spark, sf, "orders").select("o_orderkey", text.tolerant_date(printed, text.INDEX_FORMATS).alias("day"))


@query
def parse_numbers_tolerant(spark, sf):
    printed = F.when(F.col("o_orderkey") % 5 == 0, "N.A.").when(F.col("o_orderkey") % 5 == 1, F.format_number("o_totalprice", 2)).when(F.col("o_orderkey") % 5 == 2, "-").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    return rounded(table(spark, sf, "orders").select("o_orderkey", text.tolerant_number(printed).alias("price")), 2)


@query
def html_regex_extract(spark, sf):
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    return table(spark, sf, "pages").select("page_id", title.alias("title"), F.regexp_extract("html", r"([0-9]+\.[0-9]+)", 1).alias("number"), (F.col("html").rlike("(?i)auction")).alias("is_auction"))


@query
def json_flatten(spark, sf):
    rows = table(spark, sf, "events").withColumn("m", F.from_json("props", "map<string,string>"))
    return rows.select("event_id", F.explode_outer(F.map_keys("m")).alias("key")).groupBy("key").agg(F.count("*").alias("n"))


@query
def fuzzy_match_blocked(spark, sf):
    """Every scheme's name, printed with a slip, against all names of its company."""
    names = relation(spark, sf, "scheme_names")
    canon = materialize(names.select(text.amc_slug(F.col("amc")).alias("block"), "scheme_code", text.canonical_scheme(F.col("scheme_name")).alias("name")))
    printed = canon.select("block", F.regexp_replace("name", "CUSTOMER", "CUSTOMR").alias("name")).distinct()
    return rounded(matching.match_names(printed, canon), 4)


def _schemes(spark: SparkSession, sf: str) -> DataFrame:
    """The scheme dimension of the names; every eighth scheme is closed, every eleventh a bonus one."""
    names, number = relation(spark, sf, "scheme_names"), F.substring("scheme_code", 2, 9).cast("long")
    name = F.when(number % 11 == 0, F.concat("scheme_name", F.lit(" Bonus Option"))).otherwise(F.col("scheme_name"))
    return names.select("scheme_code", text.amc_slug(F.col("amc")).alias("amc_code"), name.alias("scheme_name"), text.plan_type(name).alias("plan_type"), text.option_type(name).alias("option_type"), (number % 8 != 0).alias("is_active"))


@query
def candidate_index(spark, sf):
    return matching.candidate_index(_schemes(spark, sf))


@query
def align_by_ticker(spark, sf):
    """Each scheme on the calendar with the levels of its own index."""
    rel = partial(relation, spark, sf)
    out = series.align(rel("nav_daily"), rel("calendar"), rel("benchmark_by_ticker"), series.daily_risk_free(rel("rf_observed")), rel("scheme_ticker"))
    return rounded(out.select("scheme_code", "date", "bench_close"), 4)


@query
def merge_upsert(spark, sf):
    old = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    new = old.filter("s_suppkey % 4 = 0").select((F.col("s_suppkey") + 2).alias("s_suppkey"), F.lit("new").alias("s_name"), (F.col("s_acctbal") + 1).alias("s_acctbal"))
    return rounded(store.merged(old, new, ["s_suppkey"]), 2)


@query
def update_columns(spark, sf):
    old = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    changes = old.filter("s_suppkey % 3 = 0").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, 0.5).alias("s_acctbal"))
    return rounded(store.updated(old, changes, ["s_suppkey"]), 2)


@query
def compare_stores(spark, sf):
    rows = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("date"))
    return quality.compare(rows, rows.filter("user_id % 5 <> 0"), "user_id").select("user_id", "n_a", "n_b")


@query
def isin_check(spark, sf):
    code = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("INE"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"), F.lit("7"))).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("ine"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")))
    return table(spark, sf, "part").select("p_partkey", text.is_isin(code).alias("ok"))


@query
def normalize_names(spark, sf):
    return relation(spark, sf, "holdings_monthly").select("security_name").distinct().select("security_name", text.normalize_name(F.col("security_name")).alias("normalized"))


@query
def holdings_sheet_sections(spark, sf):
    """Sheets landed as rows: banners, ISIN rows and totals, in order of the order key."""
    code = F.concat(F.lit("INE"), F.lpad((F.col("o_orderkey") % 50).cast("string"), 8, "0"), F.lit("7"))
    kind = F.substring("o_orderpriority", 1, 1)
    banner = F.when(kind == "1", "Equity & Equity related").when(kind == "2", "Debt Instruments").when((kind == "3") & (F.col("o_orderkey") % 4 == 0), "GRAND TOTAL")
    cells = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("sheet"), F.col("o_orderkey").alias("row_no"), banner.alias("banner"), F.when(banner.isNull(), code).alias("code"), F.lit("Name*").alias("name"), F.concat(F.round("o_totalprice", 2).cast("decimal(18,2)").cast("string"), F.lit("%")).alias("w"))
    return rounded(landing.holdings_sheet(cells, "code", "name", "w", "banner"), 2)


@query
def nav_text_parse(spark, sf):
    """Price files landed as lines: a heading, then company and data lines."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), "p_brand", "p_retailprice")  # a file for each 400 lines
    data = F.concat_ws(";", F.col("k").cast("string"), F.lit("INF1"), F.lit("-"), F.concat(F.lit("Fund "), F.col("k").cast("string")), F.when(F.col("k") % 7 == 0, "N.A.").otherwise(F.col("p_retailprice").cast("decimal(18,2)").cast("string")), F.lit("05-Jan-2024"))
    line = F.when(F.col("k") % 400 == 1, "Scheme Code;ISIN Div Payout/ ISIN Growth;ISIN Div Reinvestment;Scheme Name;Net Asset Value;Date").when(F.col("k") % 10 == 2, F.concat(F.translate("p_brand", "#", " "), F.lit(" Mutual Fund"))).when(F.col("k") % 50 == 3, "Open Ended Schemes(Equity Scheme - Value Fund)").otherwise(data)
    return rounded(landing.nav_text(parts.select(F.floor((F.col("k") - 1) / 400).cast("string").alias("file"), F.col("k").alias("line_no"), line.alias("line"))), 2)


@query
def audit_scheme(spark, sf):
    """Window metrics of one scheme against the index, not written anywhere."""
    nav = relation(spark, sf, "nav_daily").filter("scheme_code = 'STANDARD-F'")
    rel = partial(relation, spark, sf)
    aligned = series.align(nav, rel("calendar"), rel("benchmark_daily"), series.daily_risk_free(rel("rf_observed")))
    return rounded(windows.phase_one(aligned, nav), 5)


@query
def rolling_r2_beta(spark, sf):
    return rounded(windows.alpha_beta(_aligned(spark, sf)).select("scheme_code", "r_squared_3y", "beta_3y"), 5)


@query
def aum_rollup_by_category(spark, sf):
    rows = relation(spark, sf, "scheme_metrics")
    return rounded(rows.groupBy("canonical_category").agg(F.count("*").alias("n"), F.sum("aum_crore").alias("aum_crore"), F.max_by("scheme_code", F.struct("aum_crore", "scheme_code")).alias("largest")), 2)


@query
def pool_semi_join(spark, sf):
    scored = relation(spark, sf, "scheme_metrics").withColumn("composite_score", F.col("alpha_3y_annualized"))
    pool = ranking.top_n(scored, 3).select("scheme_code")
    held = relation(spark, sf, "holdings_monthly").join(pool, "scheme_code", "left_semi")
    return held.groupBy("scheme_code").agg(F.count("*").alias("n"))


@query
def composite_unfiltered(spark, sf):
    """Stage one of two categories without the floors."""
    out = ranking.stage_one(relation(spark, sf, "scheme_metrics"), categories=["ASIA", "EUROPE"], skip_filters=True)
    return rounded(out.select("scheme_code", "canonical_category", "composite_score"))


@query
def worst_coverage(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("date"))
    return rounded(quality.worst_coverage(orders, "o_custkey"))


@query
def index_records_parse(spark, sf):
    """Index levels as JSON records under changing keys and date formats."""
    level, day = F.format_number(F.floor("close"), 0), F.dayofmonth("date") % 4
    record = F.when(day == 0, F.to_json(F.struct(F.date_format("date", "dd MMM yyyy").alias("Date"), level.alias("TotalReturnsIndex")))).when(day == 1, F.to_json(F.struct(F.date_format("date", "dd-MMM-yyyy").alias("HistoricalDate"), level.alias("TR"))))
    record = record.when(day == 2, F.to_json(F.struct(F.date_format("date", "yyyy-MM-dd").alias("TradeDate"), level.alias("Close")))).otherwise(F.to_json(F.struct(F.date_format("date", "dd-MM-yyyy").alias("Date"), F.when(F.dayofmonth("date") == 3, "n.a.").otherwise(level).alias("IndexValue"))))
    return landing.index_records(materialize(relation(spark, sf, "benchmark_by_ticker").select("ticker", record.alias("record"))))


@query
def index_name_match(spark, sf):
    parts = table(spark, sf, "part")
    mapping = parts.select(F.concat(F.lit("Ix "), "p_brand").alias("trading_name"), F.concat("p_brand", F.lit(" Total Return")).alias("long_name")).distinct()
    wanted = parts.select(F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lower("p_brand"), F.lit("totalreturn"))).when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" IX  "), "p_brand")).otherwise(F.lit("none")).alias("name")).distinct()
    return landing.index_names(wanted, mapping)


@query
def quarter_labels(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct().withColumn("label", landing.latest_quarter(F.col("day")))
    return days.select("day", "label", landing.quarter_end(F.col("label")).alias("quarter_end"), series.previous_month(F.col("day")).alias("previous_month"))


@query
def expense_ratio_last(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("scheme_code"), F.trunc("l_shipdate", "month").cast("string").alias("effective_date"), F.col("l_tax").cast("string").alias("ter_pct"), F.col("l_orderkey").alias("file"), F.struct("l_linenumber", _earlier().alias("earlier")).alias("row_no"))
    return rounded(landing.expense_ratios(rows))


@query
def rates_with_manual(spark, sf):
    scraped = relation(spark, sf, "rf_observed")
    manual = landing.manual_rates(relation(spark, sf, "calendar").filter("day(date) = 8 or day(date) = 9").select(F.col("date").cast("string").alias(" Date"), F.when(F.dayofmonth("date") == 8, "7.25").otherwise("x").alias("Cut-off Yield")))
    return series.observed_rates(scraped, manual, AS_OF, max_lag=500)


@query
def date_chunks(spark, sf):
    span = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("start"), F.max("o_orderdate").cast("date").alias("end"))
    return series.date_chunks(span, 365).groupBy("chunk_start", "chunk_end").agg(F.count("*").alias("n"))


#: How companies print a turnover {0}, and for the query below one that is not given.
_PRINTED = {
    "absl": "Portfolio Turnover {0}", "bandhan": "Portfolio Turnover Ratio\nEquity Total 66.87%\nEquity {0}\nAggregate^ 9.99", "bank_of_india": "PORTFOLIO TURNOVER RATIO (As on date)\n{0} Times#", "canara_robeco": "Portfolio Turnover Ratio 9.99 times\nPortfolio Turnover Ratio (Equity) {0} times",
    "edelweiss": "Portfolio Turnover Ratio3 : {0}", "franklin": "Total Portfolio Turnover $ 959.18%\nPortfolio Turnover (Equity) ** {0}%", "hdfc": "Equity Turnover {0} %", "icici_pru": "Equity - {0} times", "iti": "Portfolio Turnover Ratio {0}", "kotak": "Portfolio turnover {0}%",
    "lic": "Annual Equity Portfolio Turnover Ratio: {0} times", "mahindra_manulife": "Portfolio Turnover Ratio (Last 1 year): {0}", "mirae": "Portfolio Turnover Ratio {0} Times", "motilal_oswal": "Portfolio Turnover Ratio -{0}", "nippon": "Portfolio Turnover (Times) {0}", "pgim_india": "Portfolio Turnover: {0}",
    "sbi": "Equity Turnover : {0}", "sundaram": "Turnover Ratio {0}", "union": "Turnover Ratio 12.50% 3.10 {0} times", "uti": "Portfolio Turnover (Annual) {0}", "whiteoak_capital": "Portfolio Turn Over Ratio {0} Times",
}
_NOT_GIVEN = {"iti": "Portfolio Turnover Ratio NA", "lic": "Annual Portfolio Turnover Ratio : NA", "nippon": "Portfolio Turnover (Times) --"}


def _factsheets(spark: SparkSession, sf: str) -> DataFrame:
    """company, page_no, page_text: page texts with a turnover printed in the way of one company; every fifth page has none or a zero."""
    number = F.format_number((F.col("page_id") * 37 % 900 + 5) / 100, 2)
    kind, company = F.floor(F.col("page_id") / 21) % 5, F.get(F.array(*map(F.lit, _PRINTED)), (F.col("page_id") % 21).cast("int"))
    told = lambda value: reduce(lambda c, x: c.when(company == x[0], F.replace(F.lit(x[1]), F.lit("{0}"), value)), _PRINTED.items(), F.when(company == "", ""))
    missing = reduce(lambda c, x: c.when(company == x[0], x[1]), _NOT_GIVEN.items(), F.when(company == "", "")).otherwise(told(F.lit("0.00")))
    printed = F.when(kind == 3, "").when(kind == 4, missing).otherwise(told(number))
    noise = F.regexp_replace("html", "<[^>]*>", " ")
    return table(spark, sf, "pages").select(company.alias("company"), F.col("page_id").alias("page_no"), F.concat(F.substring(noise, 1, 600), F.lit("\n"), printed, F.lit("\n"), F.substring(noise, 601, 1 << 30)).alias("page_text"))


@query
def factsheet_turnover(spark, sf):
    """Turnover by each company's text rules."""
    return rounded(factsheets.turnover_by_text(_factsheets(spark, sf)))


def _word_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes of the pages' words, ten to a line; some words are labels and numbers, and lines are a little uneven."""
    words = F.filter(F.split(F.regexp_replace("html", "<[^>]*>", " "), r"\s+"), lambda w: w != "")
    placed = table(spark, sf, "pages").select(F.col("page_id").alias("page_no"), F.posexplode(words).alias("i", "word"))
    company = F.get(F.array(*map(F.lit, ("hdfc", "nippon", "mahindra_manulife", "sbi", "uti", "invesco", "tata", "axis", "dsp"))), (F.col("page_no") % 9).cast("int"))
    i, page = F.col("i"), F.col("page_no")
    head = F.when(company == "axis", "PORTFOLIOTURNOVER").when(company.isin("hdfc", "sbi"), "Equity").otherwise("Portfolio")
    number = F.concat((i * 7 % 90).cast("string"), F.lit("."), ((i + page) % 90 + 10).cast("string"), F.when(company == "tata", "%").otherwise(""))
    text = F.when((i + page) % 40 == 21, head).when((i + page) % 40 == 22, "Turnover").when((i + page) % 11 == 3, number).otherwise(F.col("word"))
    x0, bottom = (i % 10) * F.when(company == "tata", 18).otherwise(26), F.floor(i / 10) * 12 + (i * 5 + page) % 4
    return placed.select(company.alias("company"), "page_no", i.alias("word_no"), text.alias("text"), x0.cast("double").alias("x0"), (x0 + 15).cast("double").alias("x1"), (bottom - 9).cast("double").alias("top"), bottom.cast("double").alias("bottom"))


@query
def factsheet_turnover_by_position(spark, sf):
    """Turnover from the places of words: a label and the number beside or below it."""
    return rounded(factsheets.turnover_by_position(_word_boxes(spark, sf)))


def _as_files(rows: DataFrame, heading: Column, by: list[str], ties: str | None = None) -> str:
    """Text files of rows (the columns of by, place, line), one in each folder of by, under a heading each: their path. Lines of one place go by the column ``ties``."""
    heads = rows.select(*by, heading.alias("line")).distinct().withColumn("place", F.lit(-1).cast("long"))
    path, order = scratch(rows.sparkSession), ["place", *filter(None, [ties])]
    lines = rows.select(*by, "line", F.col("place").cast("long").alias("place"), *order[1:]).unionByName(heads, allowMissingColumns=True)
    lines.repartition(*by).sortWithinPartitions(*by, *order).drop(*order).write.partitionBy(*by).text(path)
    return path


@query
def index_files(spark, sf):
    """Index levels from files of three headings, read in one scan; tickers from their folders."""
    rows = materialize(relation(spark, sf, "benchmark_by_ticker").withColumns({"kind": F.month("date") % 3, "level": F.floor("close")}))
    level = F.concat(F.lit('"'), F.format_number("level", 0), F.lit('"'))
    line = F.when(F.col("kind") == 0, F.concat_ws(",", F.date_format("date", "dd-MMM-yyyy"), F.col("level"))).when(F.col("kind") == 1, F.concat_ws(",", F.date_format("date", "yyyy-MM-dd"), F.lit("x"), level)).otherwise(F.concat_ws(",", level, F.date_format("date", "dd/MM/yyyy")))
    heading = F.when(F.col("kind") == 0, "Date,Close").when(F.col("kind") == 1, " Index Date ,Open,Total Returns Index").otherwise('"TRI",TRADE DATE')
    files = rows.select("ticker", "kind", F.datediff("date", F.lit("1990-01-01")).alias("place"), line.alias("line"))
    return headed.index_files(spark, f"{_as_files(files, heading, ['ticker', 'kind'])}/*/*", part=3)


@query
def constituent_files(spark, sf):
    """Index constituents from a file for each ticker and month; every fifth month's file has its columns in another order."""
    rows = materialize(relation(spark, sf, "constituents_monthly").filter("security_name is not null"))
    weight, other, name = F.concat(F.col("weight_pct").cast("decimal(18,2)").cast("string"), F.lit("%")), F.month("as_of_month") % 5 == 0, F.concat(F.lit('"'), "security_name", F.lit('"'))
    isin = F.concat(F.lit("I"), F.length("security_name").cast("string"))
    line = F.when(other, F.concat_ws(",", name, weight, isin)).otherwise(F.concat_ws(",", isin, weight, F.lit("?"), name))
    heading = F.when(F.substring("month", 6, 2).cast("int") % 5 == 0, "security_name,Weight_Pct,ISIN").otherwise("isin,weight_pct,sector,security_name")
    files = rows.select("ticker", F.date_format("as_of_month", "yyyy-MM").alias("month"), F.hash("security_name").alias("place"), line.alias("line")).withColumn("place", F.col("place").cast("long") + (1 << 31))
    return rounded(headed.constituent_files(spark, f"{_as_files(files, heading, ['ticker', 'month'])}/*/*", 3, 2))


@query
def expense_files(spark, sf):
    """Expense ratios from yearly files whose further columns differ: the last line of a scheme and a day counts."""
    rows = table(spark, sf, "lineitem").select("l_suppkey", F.trunc("l_shipdate", "month").alias("day"), F.col("l_tax").cast("string").alias("ter"), "l_orderkey", "l_linenumber", F.year("l_shipdate").alias("year"), _earlier().alias("earlier"))
    line = F.when(F.col("year") % 2 == 0, F.concat_ws(",", "l_suppkey", F.col("day").cast("string"), "ter")).otherwise(F.concat_ws(",", "ter", F.lit("note"), F.col("day").cast("string"), "l_suppkey"))
    heading = F.when(F.col("year") % 2 == 0, "scheme_code,effective_date,ter_pct").otherwise("TER_PCT,Remark,Effective_Date,Scheme_Code")
    files = rows.select("year", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("place"), line.alias("line"), "earlier")
    return rounded(headed.expense_files(spark, f"{_as_files(files, heading, ['year'], 'earlier')}/*").drop("other"))


@query
def auction_pages_cached(spark, sf):
    """Bill auctions among the pages, parsed in two runs of which the second one parses only what the first has not seen."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 300).cast("int"))
    auction = F.concat(F.lit('<td class="tableheader"><b>91-Day, 182-Day and 364-Day T-Bill Auction Result: Cut-off</b> Date : '), F.date_format(day, "MMM dd, yyyy"), F.lit(" Cut-off Price and Implicit Yield <b>(YTM: "), F.format_number(5 + (F.col("page_id") % 97) / 100, 4), F.lit("%)</b></td>"))
    pages = materialize(table(spark, sf, "pages").select("page_id", F.when(F.col("page_id") % 3 == 0, auction).otherwise(F.col("html")).alias("html")))
    kept, hoped = scratch(spark), lambda html: html.contains("T-Bill Auction")
    cache.parsed(pages.filter("page_id % 2 = 0"), kept, 1, landing.auction_rate, hoped, 0.1)
    out, _ = cache.parsed(pages, kept, 1, landing.auction_rate, hoped, 0.1)
    return rounded(out.select("page_id", "result.auction_date", "result.rate_pct"), 4)


@query
def upsert_by_file(spark, sf):
    """Orders loaded by year, then late changes of some: a table whose changed files alone were written again."""
    orders, path = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice"), scratch(spark)
    for years in (F.year("day") <= 1994, F.year("day") > 1994):
        store.upsert(orders.filter(years), path, ["o_orderkey", "day"])
    store.upsert(orders.filter("o_orderkey % 7 = 0 and year(day) = 1996").withColumn("o_totalprice", F.col("o_totalprice") + 1), path, ["o_orderkey", "day"])
    return rounded(store.read_table(spark, path), 2)


@query
def contract_checked(spark, sf):
    """Prices as texts, checked while they are written: the sound ones."""
    price = F.when(F.col("l_linenumber") == 5, "n.a.").when(F.col("l_linenumber") == 6, F.concat(F.lit("-"), F.col("l_extendedprice").cast("string"))).otherwise(F.col("l_extendedprice").cast("string"))
    day = F.when(F.col("l_linenumber") == 7, "soon").otherwise(F.date_add(F.lit("2000-01-01").cast("date"), F.col("l_linenumber").cast("int")).cast("string"))
    items = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_extendedprice").alias("l_extendedprice"))
    rows = items.select(F.col("l_orderkey").cast("string").alias("scheme_code"), day.alias("nav_date"), price.alias("nav"))
    path = scratch(spark)
    contracts.upsert_checked(rows, path, contracts.CONTRACTS["nav_daily"], most_broken=0.6, batch="one")
    broken = store.read_table(spark, f"{path}_broken").groupBy(F.get_json_object("given", "$.scheme_code").alias("scheme_code")).agg(F.count("*").alias("n_broken"))
    sound = store.read_table(spark, path).groupBy("scheme_code").agg(F.count("*").alias("n"), F.sum("nav").alias("nav"))
    return rounded(sound.join(broken, "scheme_code", "full").select("scheme_code", "n", "nav", F.coalesce("n_broken", F.lit(0)).alias("n_broken")), 2)


@query
def validation(spark, sf):
    """Growth of one index since 1996, and counts of prices."""
    return rounded(quality.validate(relation(spark, sf, "benchmark_by_ticker"), relation(spark, sf, "nav_daily"), "F", "1996-01-01"))


@query
def stage3_dropped(spark, sf):
    """The funds that a stage three with a stricter limit (2 %) drops, for which fund, and their overlap."""
    survivors = materialize(_stage_two(spark, sf)[0])
    pairs = materialize(h.overlaps(relation(spark, sf, "holdings_monthly"), survivors.select("scheme_code")))
    gone = ranking.overlap_drops(survivors, pairs, 2.0)
    return rounded((pairs.limit(0).selectExpr("scheme_a AS scheme_code_dropped", "scheme_b AS scheme_code_kept", "overlap_pct") if gone is None else gone), 2)


@query
def stage1_of_day(spark, sf):
    """Stage one of one category over the metrics of the latest day, funds' ids from the dimension."""
    rows = relation(spark, sf, "scheme_metrics")
    days = rows.drop("base_fund_id").withColumn("as_of_date", F.when(F.length("scheme_code") % 2 == 0, F.lit("2024-01-31")).otherwise(F.lit("2024-02-29")).cast("date"))
    out = reports.stage_one_of_day(days, dimension=rows.select("scheme_code", "base_fund_id"), category="ASIA")
    return rounded(out.select("scheme_code", "as_of_date", "composite_score"))


@query
def section_variants(spark, sf):
    """Section headings by the rules of three companies' sheets."""
    banners = [" EQUITY & Equity related", "Equity Derivatives", "TREPS", "Tri-Party Repo", "Triparty Repo", "Certificate of Deposit", "REITs & InvITs", "Net Receivables/(Payables)", "Others", "Total", "Commercial Paper", "T-Bill", "Zero Coupon Bonds", "Grand Total of Cash"]
    kind = (F.col("p_partkey") % 16).cast("int")
    banner = F.when(kind < 14, F.get(F.array(*map(F.lit, banners)), kind)).when(kind == 14, F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", *[text.section(banner, c).alias(c) for c in ("hdfc", "sbi", "nippon")])


@query
def traded_values(spark, sf):
    """An exchange's daily file against its list of equities, of which a symbol's last row counts."""
    parts = table(spark, sf, "part")
    equities = landing.equity_list(parts.select(F.concat(F.lit(" "), "p_brand").alias("symbol"), F.concat(F.lit("INE"), F.col("p_partkey").cast("string")).alias("isin"), F.col("p_partkey").alias("row_no")))
    lacs = F.when(F.col("p_size") % 10 == 4, "-").otherwise(F.col("p_size").cast("string"))
    sheet = parts.select(F.col("p_brand").alias("SYMBOL"), F.when(F.col("p_partkey") % 3 == 0, " BE").otherwise(" EQ").alias(" SERIES"), F.round("p_retailprice", 2).cast("string").alias(" CLOSE_PRICE"), lacs.alias(" TURNOVER_LACS"))
    return rounded(landing.traded_values(sheet, equities, "2024-01-02"), 2)


@query
def category_files(spark, sf):
    """Rows written by category and read again: categories whose names would share a file have their own."""
    kind = F.col("c_custkey") % 3
    rows = table(spark, sf, "customer").select(F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("scheme_code"), F.col("c_mktsegment").alias("canonical_category"), F.when(kind == 0, "Large & Mid").when(kind == 1, "x+").otherwise("X").alias("kind"))
    path = scratch(spark)
    store.write_by_category(rows, path, "kind")
    return spark.read.parquet(f"{path}/parquet").select("scheme_code", "canonical_category", F.col("category_file").cast("string").alias("category_file"))


@query
def replaced_months(spark, sf):
    """A table by year, of which the later years are replaced."""
    orders = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderdate") < "1997-01-01").alias("old"), F.date_format("o_orderdate", "yyyy").alias("year"))
    path = scratch(spark)
    store.write_table(orders.withColumn("note", F.lit("first")), path, "year")
    store.replace_partitions(orders.filter("not old and o_orderkey % 2 = 0").withColumn("note", F.lit("second")), path, "year")
    return store.read_table(spark, path).select("o_orderkey", "old", F.col("year").cast("string").alias("year"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return oracles.sql()
