"""Measures of what schemes hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab.functions.text import normalize_name
from fundlab.storage import materialize

CRORE = 1e7


def weights(holdings: DataFrame, keys: list[str], equity_only: bool = True, key: Column | None = None) -> DataFrame:
    """keys, security, weight: weights by security that sum to 100 over each portfolio.

    The total counts all named rows, also those whose normalised name is empty.
    """
    rows = holdings.filter("instrument_type = 'Equity'") if equity_only else holdings
    rows = rows.filter("security_name <> ''").withColumn("_total", F.sum("weight_pct").over(Window.partitionBy(*keys))).filter("_total > 0")
    rows = rows.withColumn("security", key if key is not None else normalize_name(F.col("security_name"))).filter("security <> ''")
    return rows.groupBy(*keys, "security").agg(F.sum(F.col("weight_pct") * 100 / F.col("_total")).alias("weight"))


def active_share(holdings: DataFrame, constituents: DataFrame, tasks: int | None = None) -> DataFrame:
    """scheme_code, as_of_month, active_share: half the absolute differences to the index of ``ticker``.

    holdings carry their scheme's ticker; months without both sides are absent. tasks: the number that
    holdings are dealt to at each step, so that a task's share does not grow with them; None: the session's.
    """
    # Dealt without the ticker: where it is one constant, Spark drops it from the keys and would shuffle once more by the session's number.
    dealt = lambda df, *keys: df.repartition(tasks, *keys) if tasks else df
    portfolio = ["scheme_code", "ticker", "as_of_month"]
    fund = dealt(weights(dealt(holdings, "scheme_code", "as_of_month"), portfolio), "as_of_month", "security")
    index = weights(constituents, ["ticker", "as_of_month"], equity_only=False).withColumnRenamed("weight", "index_weight")
    # Over the union of securities: all index weights are 100 in total, so what a fund does not hold follows from what it does.
    shared = fund.join(index, ["ticker", "as_of_month", "security"], "left")
    sums = dealt(shared, "scheme_code", "as_of_month").groupBy(*portfolio).agg(F.sum(F.abs(F.col("weight") - F.coalesce("index_weight", F.lit(0.0)))).alias("held"), F.sum(F.coalesce("index_weight", F.lit(0.0))).alias("met"))
    totals = index.groupBy("ticker", "as_of_month").agg(F.sum("index_weight").alias("whole"))
    return sums.join(totals, ["ticker", "as_of_month"]).select("scheme_code", "as_of_month", ((F.col("held") + F.col("whole") - F.col("met")) / 2).alias("active_share"))


def trailing_median(monthly: DataFrame, value: str, as_of, months: int = 12, least: int = 3) -> DataFrame:
    """scheme_code and the median of value over the ``months`` full months before as_of's, if ``least`` are there."""
    end = F.trunc(F.lit(as_of).cast("date"), "MM")
    rows = monthly.filter((F.col("as_of_month") < end) & (F.col("as_of_month") >= F.add_months(end, -months)) & F.col(value).isNotNull())
    return rows.groupBy("scheme_code").agg(F.count("*").alias("n_months"), F.median(value).alias("median")).filter(F.col("n_months") >= least)


def style_drift(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("style_drift_3y", F.col("beta_3y_std") + (1 - F.col("r_squared_3y_mean")))


def latest(rows: DataFrame, value: str, by: str = "as_of_month") -> DataFrame:
    """scheme_code and the value of the latest month."""
    return rows.groupBy("scheme_code").agg(F.max_by(value, by).alias(value), F.max(by).alias(by))


def preferred_latest(rows: DataFrame, value: str, preferred: str) -> DataFrame:
    """The latest value of the preferred source, else of any other."""
    order = Window.partitionBy("scheme_code").orderBy(F.desc(F.col("source_amc") == preferred), F.desc("as_of_month"), "source_amc")
    return rows.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def latest_month(holdings: DataFrame) -> DataFrame:
    """All rows of each scheme's last month."""
    return holdings.withColumn("_m", F.max("as_of_month").over(Window.partitionBy("scheme_code"))).filter("as_of_month = _m").drop("_m")


def median_turnover(daily: DataFrame, days: int = 60) -> DataFrame:
    """isin, adv: median traded value over the last ``days`` days of the data."""
    last = daily.agg(F.max("date").alias("_last"))
    recent = daily.join(F.broadcast(last), F.col("date") > F.date_sub("_last", days))  # one row
    return recent.groupBy("isin").agg(F.median("total_traded_value").alias("adv"))


def impact_days(holdings: DataFrame, adv: DataFrame, aum: DataFrame, least: int = 3) -> DataFrame:
    """scheme_code, aum_impact_days: the most days of one average turnover that any equity position of the last month takes."""
    rows = latest_month(holdings).filter("instrument_type = 'Equity' and isin is not null")
    days = F.col("weight_pct") / 100 * F.col("aum_crore") * CRORE / F.col("adv")
    return rows.join(adv.filter("adv > 0"), "isin").join(aum.filter("aum_crore > 0"), "scheme_code").groupBy("scheme_code").agg(F.count("*").alias("n"), F.max(days).alias("aum_impact_days")).filter(F.col("n") >= least).drop("n")


def derived_constituents(holdings: DataFrame, top: int | None = None) -> DataFrame:
    """isin, weight_pct: a tracker fund's last equity holdings by ISIN, the ``top`` largest, scaled to 100, 4 decimals."""
    rows = latest_month(holdings).filter("instrument_type = 'Equity' and isin is not null").groupBy("scheme_code", "isin").agg(F.sum("weight_pct").alias("w"))
    place = F.row_number().over(Window.partitionBy("scheme_code").orderBy(F.desc("w"), "isin"))
    if top:
        rows = rows.withColumn("_n", place).filter(F.col("_n") <= top).drop("_n")
    return rows.select("scheme_code", "isin", F.bround(F.col("w") * 100 / F.sum("w").over(Window.partitionBy("scheme_code")), 4).alias("weight_pct"))


#: Funds of a shortlist whose pairs are all listed: two million rows.
MOST_FUNDS = 2000


def overlap_key() -> Column:
    """ISIN where there is one, else the normalised name; the two never meet."""
    return F.when(F.col("isin").isNotNull(), F.concat(F.lit("isin:"), "isin")).otherwise(F.concat(F.lit("name:"), normalize_name(F.col("security_name"))))


def overlaps(holdings: DataFrame, funds: DataFrame, top: int = 3) -> DataFrame:
    """scheme_a, scheme_b, overlap_pct (2 decimals), n_shared, top_shared, reason for all pairs of funds (scheme_code).

    funds is a staged shortlist of at most MOST_FUNDS, which is checked; pairs come from shared securities
    and are then completed with the pairs that share none.
    """
    if funds.select("scheme_code").distinct().limit(MOST_FUNDS + 1).count() > MOST_FUNDS:
        raise ValueError(f"a table of all pairs is for shortlists of at most {MOST_FUNDS} funds")
    held = materialize(latest_month(holdings.join(F.broadcast(funds.select("scheme_code")), "scheme_code")))  # read by two branches
    book = weights(held, ["scheme_code"], key=overlap_key())
    names = held.filter("instrument_type = 'Equity' and security_name <> ''").groupBy("scheme_code", overlap_key().alias("security")).agg(F.min(F.trim("security_name")).alias("name"))
    book = materialize(book.join(names, ["scheme_code", "security"]))  # a security has a row for each of at most MOST_FUNDS funds
    a = book.select(F.col("scheme_code").alias("scheme_a"), "security", F.col("weight").alias("wa"), "name")
    b = book.select(F.col("scheme_code").alias("scheme_b"), "security", F.col("weight").alias("wb"))
    both = a.join(b, "security").filter("scheme_a < scheme_b").withColumn("w", F.least("wa", "wb"))
    place = F.row_number().over(Window.partitionBy("scheme_a", "scheme_b").orderBy(F.desc("w"), "security"))
    label = F.format_string("%s (%.1f%%)", "name", F.bround("w", 1))
    shared = both.withColumn("_n", place).groupBy("scheme_a", "scheme_b").agg(F.bround(F.sum("w"), 2).alias("overlap_pct"), F.count("*").alias("n_shared"), F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("_n") <= top, F.struct("_n", label.alias("label"))))), lambda x: x["label"]), ", ").alias("top_shared"))
    known = book.select("scheme_code").distinct().withColumn("known", F.lit(True))
    listed = funds.select("scheme_code").distinct().join(known, "scheme_code", "left")
    one, two = (listed.select(F.col("scheme_code").alias(f"scheme_{x}"), F.col("known").alias(f"known_{x}")) for x in "ab")
    pairs = one.join(F.broadcast(two), F.col("scheme_a") < F.col("scheme_b"))
    reason = F.when(F.col("known_a").isNull() | F.col("known_b").isNull(), "missing_holdings")
    full = pairs.join(shared, ["scheme_a", "scheme_b"], "left")
    value = F.when(reason.isNull(), F.coalesce("overlap_pct", F.lit(0.0)))
    return full.select("scheme_a", "scheme_b", value.alias("overlap_pct"), F.coalesce("n_shared", F.lit(0)).alias("n_shared"), F.coalesce("top_shared", F.lit("")).alias("top_shared"), reason.alias("reason"))
