"""Freshness, coverage and status of stored relations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


class StaleData(RuntimeError):
    """A relation is missing or older than allowed."""


def weekdays_between(start: Column, end: Column) -> Column:
    """Weekdays after start up to end."""
    upto = lambda d: F.floor(F.datediff(d, F.lit("1970-01-05").cast("date")) / 7) * 5 + F.least(F.lit(5), F.pmod(F.datediff(d, F.lit("1970-01-05").cast("date")), F.lit(7)) + 1)
    return F.greatest(F.lit(0), upto(end) - upto(start)).cast("long")


def last_weekday(day: Column) -> Column:
    """The day itself or the Friday before."""
    return F.date_sub(day, F.greatest(F.lit(0), F.weekday(day) - 4))


def freshness(latest: DataFrame, as_of: str) -> DataFrame:
    """check_name, latest, lag, max_lag, issue for rows of check_name, latest, unit (weekdays or days), max_lag.

    A null limit skips its check; a missing date is an issue.
    """
    day = F.lit(as_of).cast("date")
    lag = F.when(F.col("unit") == "weekdays", weekdays_between(F.col("latest"), last_weekday(day))).otherwise(F.datediff(day, "latest").cast("long"))
    return latest.filter("max_lag is not null").select("check_name", "latest", lag.alias("lag"), "max_lag", (F.col("latest").isNull() | (lag > F.col("max_lag"))).alias("issue"))


def require_fresh(report: DataFrame) -> None:
    if stale := [r.check_name for r in report.filter("issue").select("check_name").collect()]:
        raise StaleData(", ".join(sorted(stale)))


def coverage_by_key(rows: DataFrame, calendar: DataFrame, key: str) -> DataFrame:
    """key, n_expected, n_present, n_missing against all days of the calendar."""
    total = calendar.agg(F.count("*").alias("n_expected"))
    present = rows.join(F.broadcast(calendar), "date", "left_semi").groupBy(key).agg(F.countDistinct("date").alias("n_present"))
    return present.join(F.broadcast(total)).select(key, "n_expected", "n_present", (F.col("n_expected") - F.col("n_present")).alias("n_missing"))


def missing_days(calendar: DataFrame, rows: DataFrame) -> DataFrame:
    return calendar.join(rows.select("date"), "date", "left_anti")


def nav_coverage(nav: DataFrame, calendar: DataFrame) -> DataFrame:
    """scheme_code, n_expected, n_present, pct_missing over each scheme's own part of the calendar."""
    bounds = nav.groupBy("scheme_code").agg(F.min("nav_date").alias("a"), F.max("nav_date").alias("b"))
    days = bounds.join(F.broadcast(calendar), F.col("date").between(F.col("a"), F.col("b"))).select("scheme_code", "date")
    seen = nav.select("scheme_code", F.col("nav_date").alias("date"), F.lit(1).alias("here"))
    counts = days.join(seen, ["scheme_code", "date"], "left").groupBy("scheme_code").agg(F.count("*").alias("n_expected"), F.count("here").alias("n_present"))
    return counts.withColumn("pct_missing", 100.0 * (F.col("n_expected") - F.col("n_present")) / F.col("n_expected"))


def coverage_buckets(covered: DataFrame) -> DataFrame:
    pct = F.col("pct_missing")
    return covered.agg(F.count_if(pct == 0).alias("complete"), F.count_if((pct > 0) & (pct <= 5)).alias("upto_5"), F.count_if((pct > 5) & (pct <= 30)).alias("upto_30"), F.count_if(pct > 30).alias("over_30"))


def gaps(rows: DataFrame, key: str, least_days: int = 14) -> DataFrame:
    """key, gap_start, gap_end, gap_days between neighbouring dates further apart than least_days."""
    before = F.lag("date").over(Window.partitionBy(key).orderBy("date"))
    found = rows.select(key, "date").distinct().withColumn("gap_start", before)
    days = F.datediff("date", "gap_start")
    return found.filter(days > least_days).select(key, "gap_start", F.col("date").alias("gap_end"), days.alias("gap_days"))


def inventory(rows: DataFrame, key: str) -> DataFrame:
    """key, n_rows, first_date, last_date, n_expected (five of seven days)."""
    return rows.groupBy(key).agg(F.count("*").alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")).withColumn("n_expected", F.floor((F.datediff("last_date", "first_date") + 1) * 5 / 7))


def worst_coverage(rows: DataFrame, key: str, least_missing: int = 30, top: int = 20) -> DataFrame:
    """The ``top`` keys that miss most days (more than ``least_missing``; ties: least key first) of five in seven days of their own span."""
    seen = rows.groupBy(key).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.countDistinct("date").alias("n_seen"))
    missing = F.round(F.datediff("last_date", "first_date") / 7 * 5).cast("long") - F.col("n_seen")
    return seen.withColumn("n_missing", missing).filter(F.col("n_missing") > least_missing).orderBy(F.desc("n_missing"), key).limit(top)


def status(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """table_name, n_rows, n_keys for name -> (frame, key column)."""
    return reduce(DataFrame.unionByName, [t.agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows"), F.countDistinct(k).alias("n_keys")) for n, (t, k) in tables.items()])


def growth_check(bench: DataFrame, least: float = 0.10) -> DataFrame:
    """cagr and ok: annual growth between the first and the last close."""
    ends = bench.agg(F.min_by("close", "date").alias("a"), F.max_by("close", "date").alias("b"), F.datediff(F.max("date"), F.min("date")).alias("days"))
    return ends.select((F.pow(F.col("b") / F.col("a"), 365.25 / F.col("days")) - 1).alias("cagr")).withColumn("ok", F.col("cagr") > least)


def validate(bench: DataFrame, nav: DataFrame, ticker: str, since: str, least: float = 0.10) -> DataFrame:
    """check_name, value, status: an index's annual growth since a day (OK, SUSPECT, or WARN where it has no levels), price rows and schemes."""
    growth = growth_check(bench.filter((F.col("ticker") == ticker) & (F.col("date") >= F.lit(since).cast("date"))).select("date", "close"), least)
    told = growth.select(F.lit("index growth").alias("check_name"), F.col("cagr").alias("value"), F.when(F.col("cagr").isNull(), "WARN").when(F.col("ok"), "OK").otherwise("SUSPECT").alias("status"))
    counts = nav.agg(F.count("*").alias("n"), F.countDistinct("scheme_code").alias("k"))
    both = counts.select(F.explode(F.array(F.struct(F.lit("price rows").alias("check_name"), F.col("n").cast("double").alias("value")), F.struct(F.lit("schemes").alias("check_name"), F.col("k").cast("double").alias("value")))).alias("c"))
    return told.unionByName(both.select("c.check_name", "c.value", F.lit("OK").alias("status")))


def compare(one: DataFrame, two: DataFrame, key: str) -> DataFrame:
    """Keys whose row counts or date bounds differ between two stores."""
    side = lambda df, s: df.groupBy(key).agg(F.count("*").alias(f"n_{s}"), F.min("date").alias(f"first_{s}"), F.max("date").alias(f"last_{s}"))
    both = side(one, "a").join(side(two, "b"), key, "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")) for c in ("n", "first", "last")])
    return both.filter(~same)
