"""Daily series on a shared trading calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab.operators.quality import StaleData

# The rate (in percent) where none is known, and the days a rate may be old.
FALLBACK_RATE, MAX_RATE_LAG = 6.5, 14


def scheme_bounds(nav: DataFrame) -> DataFrame:
    """First and last date of each scheme."""
    return nav.groupBy("scheme_code").agg(F.min("nav_date").alias("first_date"), F.max("nav_date").alias("last_date"))


def align(nav: DataFrame, calendar: DataFrame, bench: DataFrame, rf: DataFrame, tickers: DataFrame | None = None) -> DataFrame:
    """scheme_code, date, nav, bench_close, rate_daily, rate_daily_log, fund_log_ret, bench_log_ret.

    nav: scheme_code, nav_date, nav. calendar: date. bench: date, close. rf: date,
    rate_daily. A scheme has the calendar's days from its first to its last price;
    a missing price takes the one of the calendar day before, once; rates are filled
    without limit. The calendar holds one row a day, so it is small at any scale.

    With tickers (scheme_code, ticker) each scheme meets the index of its own ticker
    (bench: ticker, date, close); a scheme without one has null levels.
    """
    on = ["date"]
    if tickers is not None:
        on = ["ticker", "date"]
    days = (scheme_bounds(nav) if tickers is None else scheme_bounds(nav).join(tickers.dropDuplicates(["scheme_code"]), "scheme_code", "left")).join(F.broadcast(calendar), F.col("date").between(F.col("first_date"), F.col("last_date"))).select("scheme_code", *on)
    prices = nav.select("scheme_code", F.col("nav_date").alias("date"), "nav")
    joined = days.join(prices, ["scheme_code", "date"], "left").join(bench.select(*on, F.col("close").alias("bench_close")), on, "left").join(rf.select("date", "rate_daily"), "date", "left")
    by_day = Window.partitionBy("scheme_code").orderBy("date")
    filled = joined.withColumns({
        "nav": F.coalesce("nav", F.lag("nav").over(by_day)),
        "rate_daily": F.last("rate_daily", ignorenulls=True).over(by_day.rowsBetween(Window.unboundedPreceding, 0)),
    })
    change = lambda c: F.log(c) - F.lag(F.log(c)).over(by_day)
    return filled.select("scheme_code", "date", "nav", "bench_close", "rate_daily", F.log(1 + F.col("rate_daily")).alias("rate_daily_log"), change("nav").alias("fund_log_ret"), change("bench_close").alias("bench_log_ret"))


def log_returns(nav: DataFrame) -> DataFrame:
    """Log returns between a scheme's own price dates; prices that are not positive do not count."""
    by_day = Window.partitionBy("scheme_code").orderBy("nav_date")
    change = F.log("nav") - F.lag(F.log("nav")).over(by_day)
    return nav.filter("nav > 0").select("scheme_code", F.col("nav_date").alias("date"), change.alias("log_return")).filter("log_return is not null")


def daily_risk_free(observed: DataFrame, last_date=None) -> DataFrame:
    """date, rate_annual, rate_daily for every day from the first observation: the last observed rate holds.

    Rates above 1.5 are percentages.
    """
    annual = F.when(F.col("rate") > 1.5, F.col("rate") / 100).otherwise(F.col("rate"))
    rates = observed.select("date", annual.alias("rate_annual"))
    span = rates.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    last = F.lit(last_date).cast("date") if last_date else F.col("b")
    days = span.filter("a is not null").select(F.explode(F.sequence("a", last)).alias("date"))
    held = F.last("rate_annual", ignorenulls=True).over(Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0))  # one row a day
    return days.join(rates, "date", "left").select("date", held.alias("rate_annual")).withColumn("rate_daily", F.pow(1 + F.col("rate_annual"), F.lit(1 / 252)) - 1)


def observed_rates(scraped: DataFrame, manual: DataFrame, end: str, start: str | None = None, max_lag: int = MAX_RATE_LAG, allow_fallback: bool = False) -> DataFrame:
    """date, rate of both sources (date, rate), the manual one where dates meet.

    Without any rate, and only with allow_fallback, FALLBACK_RATE holds from ``start`` (or ``end``) on; without
    it no rates, or a last one more than max_lag days before end, raise StaleData.
    """
    rates = merge_by_source([manual.select("date", "rate").dropna(), scraped.select("date", "rate").dropna()])
    last = rates.agg(F.max("date").alias("last"), F.datediff(F.lit(end).cast("date"), F.max("date")).alias("lag")).first()
    if last["last"] is None:
        if not allow_fallback:
            raise StaleData("no observed rate")
        return rates.sparkSession.range(1).select(F.lit(start or end).cast("date").alias("date"), F.lit(FALLBACK_RATE).alias("rate"))
    if last["lag"] > max_lag and not allow_fallback:
        raise StaleData(f"the last rate is of {last['last']}, {last['lag']} days before {end}; allowed are {max_lag}")
    return rates


def date_chunks(span: DataFrame, days: int) -> DataFrame:
    """chunk_start, chunk_end: the spans (start, end) cut into runs of ``days`` days, the last one shorter."""
    starts = span.filter("start <= end").select("end", F.explode(F.sequence("start", "end", F.make_interval(days=F.lit(days)))).alias("chunk_start"))
    return starts.select("chunk_start", F.least("end", F.date_add("chunk_start", days - 1)).alias("chunk_end"))


def previous_month(day: Column) -> Column:
    """The first day of the month before."""
    return F.add_months(F.trunc(day, "month"), -1)


def merge_by_source(sources: list[DataFrame], key: str = "date") -> DataFrame:
    """Rows of several sources, those of earlier sources first where keys meet."""
    ranked = None
    for k, s in enumerate(sources):
        s = s.withColumn("_priority", F.lit(k))
        ranked = s if ranked is None else ranked.unionByName(s, allowMissingColumns=True)
    return ranked.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("_priority"))).filter("_n = 1").drop("_n", "_priority")


def synthetic_index(equity: DataFrame, rf: DataFrame, equity_weight: float, start=None) -> DataFrame:
    """date, close, is_synthetic: 1000 times the compounded mix of equity returns and cash.

    equity: date, close. rf: date, rate_daily. One index is one short series.
    """
    if not 0 <= equity_weight <= 1:
        raise ValueError("the equity weight must lie between 0 and 1")
    by_day = Window.orderBy("date")
    both = equity.join(rf, "date").select("date", (F.log("close") - F.lag(F.log("close")).over(by_day)).alias("r_e"), F.log(1 + F.col("rate_daily")).alias("r_f"))
    if start:
        both = both.filter(F.col("date") >= F.lit(start).cast("date"))
    mixed = equity_weight * F.coalesce("r_e", F.lit(0.0)) + (1 - equity_weight) * F.coalesce("r_f", F.lit(0.0))
    return both.select("date", (1000 * F.exp(F.sum(mixed).over(by_day.rowsBetween(Window.unboundedPreceding, 0)))).alias("close"), F.lit(True).alias("is_synthetic"))
