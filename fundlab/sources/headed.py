"""Delimited files with differing headings, read in one scan.

Every file's first line is its heading; it is found by its place in the file's first block and joined to
the file's lines, so each file's columns are resolved inside the plan, whatever the number of files and however
large one is. Names of tickers and months come from paths.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab.functions.text import INDEX_FORMATS, tolerant_date, tolerant_number
from fundlab.skew import join_unique
from fundlab.storage import materialize

# Accepted headings, in order.
INDEX_DATES = ["date", "index date", "trade date", "historical date"]
INDEX_VALUES = ["close", "total returns index", "totalreturnsindex", "total return index", "tri", "tr", "index value", "indexvalue"]
CONSTITUENTS, EXPENSES = ["isin", "weight_pct"], ["scheme_code", "effective_date", "ter_pct"]


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, place (order within the file), line of all files; blank lines go."""
    read = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), F.regexp_replace("value", r"\r$", "").alias("line"))
    return read.filter(F.trim("line") != "").select("file", F.struct("block", "row").alias("place"), "line")


def cells(line: Column) -> Column:
    """The fields of a line; commas between double quotes stay, and two quotes stand for one."""
    fields = F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    quoted = lambda f: F.regexp_replace(F.regexp_replace(f, r'^\s*"|"\s*$', ""), '""', '"')
    return F.transform(fields, lambda f: F.when(f.rlike(r'^\s*".*"\s*$'), quoted(f)).otherwise(f))


def rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, place, cells: each data line as a map from its file's headings (trimmed, lower case; of equal ones the first) to texts.

    A line shorter than the heading has no entry for the rest; what is beyond the heading goes.
    """
    every = materialize(lines(spark, paths))
    first = every.filter("place.block = 0").groupBy("file").agg(F.min(F.struct("place", "line")).alias("h"))
    heads = materialize(first.select("file", F.col("h.place").alias("at"), F.transform(cells(F.regexp_replace("h.line", "^﻿", "")), lambda c: F.lower(F.trim(c))).alias("names")))
    both = join_unique(every, heads, ["file"]).filter(F.col("place") != F.col("at")).withColumn("fields", cells(F.col("line")))
    pairs = F.filter(F.transform("names", lambda n, k: F.struct(n.alias("key"), F.get("fields", k).alias("value"), k.alias("k"))), lambda p: p["value"].isNotNull())
    once = F.filter(pairs, lambda p: F.array_position(F.col("names"), p["key"]) == p["k"] + 1)
    out = both.select("file", "place", F.map_from_entries(F.transform(once, lambda p: F.struct(p["key"], p["value"]))).alias("cells"), "names")
    return out


def resolved(headings: list[str], names: str = "names") -> Column:
    """The first of the headings that a file has; null without one."""
    return F.coalesce(*[F.when(F.array_contains(names, h), h) for h in headings])


def value(headings: list[str]) -> Column:
    """A line's text under the first of the headings that its file has."""
    return F.element_at("cells", resolved(headings))


def without(found: DataFrame, needed: list[list[str]]) -> DataFrame:
    """file, names of the files (with a data line) that lack one of the headings needed: each is a list of names of which one must be there."""
    lacks = reduce(lambda a, b: a | b, [resolved(h).isNull() for h in needed])
    return found.filter(lacks).groupBy("file").agg(F.first("names").alias("names"))


def part_of_path(number: int) -> Column:
    """A part of the file's path, counted from its end (1: the name without its last suffix), as in folders named key=value."""
    parts = F.split(F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B"))), "/")
    return F.regexp_replace(F.regexp_replace(F.element_at(parts, -number), r"\.[^.]*$", "") if number == 1 else F.element_at(parts, -number), "^[^=]*=", "")


def tickers(spark: SparkSession, paths: str | list[str], part: int = 2) -> DataFrame:
    """ticker, n_files: the tickers that files are there for, from their paths."""
    files = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"))
    return files.groupBy(part_of_path(part).alias("ticker")).agg(F.count("*").alias("n_files"))


def index_files(spark: SparkSession, paths: str | list[str], part: int = 1) -> DataFrame:
    """ticker, date, close of index files under any of the accepted headings; of several levels of a day the first counts. Files without them give no rows."""
    read = rows(spark, paths).select(part_of_path(part).alias("ticker"), "file", "place", tolerant_date(value(INDEX_DATES), INDEX_FORMATS).alias("date"), tolerant_number(value(INDEX_VALUES)).alias("close"))
    return read.dropna(subset=["date", "close"]).groupBy("ticker", "date").agg(F.min_by("close", F.struct("file", "place")).alias("close"))


def constituent_files(spark: SparkSession, paths: str | list[str], ticker_part: int = 2, month_part: int = 1) -> DataFrame:
    """ticker, as_of_month, isin, weight_pct, security_name of files .../ticker/YYYY-MM.csv; files of other months give no rows, a file without the headings is an error."""
    read = rows(spark, paths)
    if bad := without(read, [[h] for h in CONSTITUENTS]).limit(3).collect():
        raise ValueError(f"no heading {' or '.join(CONSTITUENTS)}: " + ", ".join(f"{r.file} has {r.names}" for r in bad))
    weight = F.regexp_replace(F.trim(value(["weight_pct"])), "%+$", "").try_cast("double")
    name = F.nullif(F.trim(value(["security_name"])), F.lit(""))
    month = F.try_to_date(F.when(part_of_path(month_part).rlike("^[0-9]{4}-[0-9]{2}$"), F.concat(part_of_path(month_part), F.lit("-01"))), "yyyy-MM-dd")
    out = read.select(part_of_path(ticker_part).alias("ticker"), month.alias("as_of_month"), F.trim(value(["isin"])).alias("isin"), weight.alias("weight_pct"), name.alias("security_name"))
    return out.filter("isin <> '' and weight_pct is not null and as_of_month is not null")


def expense_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """scheme_code, effective_date, ter_pct, year, other (a map of the file's further columns): the last line of a scheme and a day counts, files in order of their names.

    Files that lack a heading needed give no rows.
    """
    read = rows(spark, paths).filter(reduce(lambda a, b: a & b, [F.array_contains("names", h) for h in EXPENSES]))
    day = F.try_to_date(F.trim(value(["effective_date"])), "yyyy-MM-dd")
    other = F.map_filter("cells", lambda k, _: ~k.isin(*EXPENSES))
    kept = read.select(value(["scheme_code"]).alias("scheme_code"), day.alias("effective_date"), value(["ter_pct"]).try_cast("double").alias("ter_pct"), other.alias("other"), "file", "place")
    last = Window.partitionBy("scheme_code", "effective_date").orderBy(F.desc("file"), F.desc("place"))
    return kept.withColumn("_n", F.row_number().over(last)).filter("_n = 1").select("scheme_code", "effective_date", "ter_pct", F.year("effective_date").alias("year"), "other")
