"""Window sums that are kept and brought up to date, load by load.

Kept under one path are the schemes (first and last date, values of the first row), the sums of
each week of a scheme with the days it has, and the sums of each valid window. Week sums are added to; of
new days only their weeks are read and written again, and the windows that hold those weeks
are summed anew from weeks. Weeks and windows are partitioned by period, so a load at
the end of the series touches the last periods only.

A day that was loaded before is passed over, so a load can be repeated, also after a crash in its
middle. A day before a scheme's first one would move all its windows: that is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlab.operators.store import exists, read_table, upsert
from fundlab.operators.windows import least_rows, week_windows, window_days
from fundlab.storage import materialize, release

#: Weeks, or weeks of windows' ends, of one partition.
PERIOD = 26


def _kept(spark: SparkSession, path: str) -> DataFrame | None:
    return read_table(spark, path) if exists(spark, path) else None


def _spans(rows: DataFrame, known: DataFrame | None, first: dict[str, Column]) -> DataFrame:
    """scheme_code, first, last and first values of the schemes of rows."""
    new = rows.groupBy("scheme_code").agg(F.min("date").alias("first"), F.max("date").alias("last"), *[F.min_by(c, "date").alias(k) for k, c in first.items()])
    if known is None:
        return new
    old = known.select("scheme_code", F.struct(*[c for c in known.columns if c != "scheme_code"]).alias("old"))
    both = new.join(old, "scheme_code", "left")
    if both.filter(F.col("first") < F.col("old.first")).limit(1).count():
        raise ValueError("a day before a scheme's first one: load the scheme anew under another path")
    return both.select("scheme_code", F.coalesce("old.first", "first").alias("first"), F.greatest("old.last", "last").alias("last"), *[F.coalesce(f"old.{k}", k).alias(k) for k in first])


def load(rows: DataFrame, path: str, needed: list[str], sums: dict[str, Column], first: dict[str, Column], years: int = 3) -> None:
    """Add rows (scheme_code, date and ``needed``; those with nulls there do not count) to the state under a path; the sums are as for windows.weekly_sums."""
    spark, length = rows.sparkSession, window_days(years)
    weeks, head = divmod(length + 1, 7)
    rows = materialize(rows.select("scheme_code", "date", *needed).dropna(subset=needed).dropDuplicates(["scheme_code", "date"]), n=F.count(F.lit(1)))
    if not rows.seen["n"]:
        return
    spans = materialize(_spans(rows, _kept(spark, f"{path}/schemes"), first))
    day = F.datediff("date", "first")
    placed = rows.join(spans, "scheme_code").withColumns({"week": F.floor(day / 7).cast("int"), "bit": F.pow(F.lit(2), day % 7).cast("int"), "is_head": day % 7 < head, "n": F.lit(1).cast("long"), **sums})
    names, period = ["n", *sums, *[f"head_{k}" for k in ("n", *sums)]], F.floor(F.col("week") / PERIOD).cast("int").alias("period")
    touched = materialize(placed.select("scheme_code", "week").distinct())
    old = _kept(spark, f"{path}/weeks")
    if old is not None:
        periods = touched.select(period).distinct()
        old = materialize(old.join(periods, "period", "left_semi").join(touched, ["scheme_code", "week"], "left_semi").select("scheme_code", "week", "days", *names))
        placed = placed.join(old.select("scheme_code", "week", "days"), ["scheme_code", "week"], "left").filter(F.coalesce("days", F.lit(0)).bitwiseAND(F.col("bit")) == 0)
    part = placed.groupBy("scheme_code", "week").agg(F.sum("bit").cast("int").alias("days"), *[F.sum(k).alias(k) for k in ("n", *sums)], *[F.sum(F.when(F.col("is_head"), F.col(k))).alias(f"head_{k}") for k in ("n", *sums)])
    both = part if old is None else part.unionByName(old)
    added = both.groupBy("scheme_code", "week").agg(F.sum("days").cast("int").alias("days"), *[F.sum(k).alias(k) for k in names])
    upsert(added.withColumn("period", period), f"{path}/weeks", ["scheme_code", "week", "period"], "period")
    # windows that hold a touched week: the k-th one takes whole weeks from k on and the head of one more
    back = weeks if head else weeks - 1
    most = F.floor((F.datediff("last", "first") - length) / 7).cast("int")
    low = touched.groupBy("scheme_code").agg(F.greatest(F.lit(0), F.min("week") - back).alias("low")).join(spans, "scheme_code").withColumn("most", most).filter("low <= most")
    low = materialize(low)
    state = read_table(spark, f"{path}/weeks")
    of = lambda week: F.floor(week / PERIOD).cast("int")
    state = state.join(low.select(F.explode(F.sequence(of(F.col("low")), of(F.col("most") + back))).alias("period")).distinct(), "period", "left_semi")
    held = state.join(low, "scheme_code").filter(F.col("week") >= F.col("low"))
    summed = week_windows(held, ["n", *sums], weeks, head, ["first", "low", "most", *first]).filter("k between low and most")
    valid = summed.filter(F.col("n") >= least_rows(years)).select("scheme_code", F.date_add("first", F.col("k") * 7 + length).alias("window_end"), "n", *first, *sums, F.floor(F.col("k") / PERIOD).cast("int").alias("period"))
    upsert(valid, f"{path}/windows", ["scheme_code", "window_end", "period"], "period")
    upsert(spans, f"{path}/schemes", ["scheme_code"])
    for used in (rows, spans, touched, low):
        release(used)


def windows(spark: SparkSession, path: str) -> DataFrame:
    """scheme_code, window_end, n, first values and sums of every valid window."""
    found = _kept(spark, f"{path}/windows")
    if found is not None:
        return found.drop("period")
    both = read_table(spark, f"{path}/weeks").join(read_table(spark, f"{path}/schemes"), "scheme_code").filter(F.lit(False))  # no window is long enough yet
    names = [c for c in both.columns if c not in ("scheme_code", "week", "days", "n", "period", "first", "last") and not c.startswith("head_")]
    return both.select("scheme_code", F.col("last").alias("window_end"), "n", *names)
