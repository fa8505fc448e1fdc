"""Parsed pages kept by content: a page is parsed once for each version of the parser.

The cache is a table of digest, version and what was parsed (null where nothing was). A run parses only the
contents that the cache does not hold under the present version, so a new version parses all of them again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlab.operators.store import exists, read_table, upsert
from fundlab.storage import materialize, release


class TooManyFailures(Exception):
    """More pages than allowed hold nothing although they should."""


def parsed(pages: DataFrame, cache: str, version: int, parse: Callable[[Column], Column], expected: Callable[[Column], Column] | None = None, most_failures: float = 1.0, least: int = 1) -> tuple[DataFrame, int]:
    """pages (page_id, html) with result, and how many different contents were parsed in this run.

    parse gives a struct or null for a page. Where more than ``most_failures`` of the contents parsed now for which ``expected`` holds (at least
    ``least`` of them) give null, TooManyFailures is raised and the cache stays as it was. Null pages have no result.
    """
    spark = pages.sparkSession
    keyed = pages.withColumn("digest", F.sha2("html", 256))
    contents = keyed.filter("html is not null").groupBy("digest").agg(F.first("html").alias("html"))
    if exists(spark, cache):
        known = read_table(spark, cache).filter(F.col("version") == version).select("digest")
        contents = contents.join(known, "digest", "left_anti")
    hoped = expected(F.col("html")) if expected else F.lit(True)
    fresh = contents.select("digest", F.lit(version).alias("version"), parse(F.col("html")).alias("result"), F.coalesce(hoped, F.lit(False)).alias("hoped"))
    fresh = materialize(fresh, n=F.count(F.lit(1)), hoped=F.count_if("hoped"), failed=F.count_if(F.col("hoped") & F.col("result").isNull()))
    seen = {k: v or 0 for k, v in fresh.seen.items()}
    if seen["hoped"] >= least and seen["failed"] > most_failures * seen["hoped"]:
        release(fresh)
        raise TooManyFailures(f"{seen['failed']} of {seen['hoped']} pages were not understood")
    if seen["n"]:
        upsert(fresh.drop("hoped"), cache, ["digest", "version"])
    release(fresh)
    if not exists(spark, cache):
        return keyed.drop("digest").withColumn("result", parse(F.lit(None).cast("string"))), 0
    kept = read_table(spark, cache).filter(F.col("version") == version).select("digest", "result")
    return keyed.join(kept, "digest", "left").drop("digest"), seen["n"]


def missing(pages: DataFrame, first: int, last: int) -> DataFrame:
    """page_id of the pages of a walked range that are not there: those to be fetched again."""
    walked = pages.sparkSession.range(first, last + 1).withColumnRenamed("id", "page_id")
    return walked.join(pages.filter("html is not null").select("page_id"), "page_id", "left_anti")
