"""Overlapping multi-year windows, all schemes and windows in one aggregation.

Weekly windows start a week apart from a scheme's first date, so each is a run of whole
weeks and the first days of one more. Days are summed by week first, and a window is the
difference of two running sums of weeks: five times fewer rows than days, none repeated for a
window, and one shuffle, by scheme, for both steps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab.storage import materialize

#: Trading days a year, slack in the least number of rows, least t-statistic of alpha.
TRADING_DAYS, SLACK, LEAST_T = 252, 30, 1.0
#: A sum of squares about the mean below this part of the plain one is rounding.
FLAT = 1e-13
#: Windows end a week or a day apart. Running sums are exact in multiples of 1 / GRAIN up to 2**53 / GRAIN.
STEPS, GRAIN = ("1w", "1d"), float(1 << 30)


def window_days(years: int) -> int:
    return int(365.25 * years)


def least_rows(years: int) -> int:
    return TRADING_DAYS * years - SLACK


def weekly_sums(frame: DataFrame, needed: list[str], sums: dict[str, Column] | None = None, years: int = 3, first: dict[str, Column] | None = None) -> DataFrame:
    """scheme_code, window_end, n and the named sums of every window with least_rows(years) rows.

    Rows without nulls in ``needed`` count. The first window ends one length after the
    scheme's first such date; windows end up to its last date and hold both ends. ``first``
    names values of the scheme's first row, which sums may use and which are returned.
    """
    sums, first, length = sums or {}, first or {}, window_days(years)
    weeks, head = divmod(length + 1, 7)
    whole = Window.partitionBy("scheme_code")
    rows = frame.select("scheme_code", "date", *needed).dropna(subset=needed)
    rows = rows.withColumns({"_first": F.min("date").over(whole), "_last": F.max("date").over(whole), "_n": F.count("*").over(whole), **{k: F.min_by(c, "date").over(whole) for k, c in first.items()}}).filter(F.col("_n") >= least_rows(years))
    day = F.datediff("date", "_first")
    rows = rows.withColumns({"_week": F.floor(day / 7).cast("int"), "_head": day % 7 < head, "n": F.lit(1), **sums})
    by_week = rows.groupBy("scheme_code", "_first", "_last", *first, "_week").agg(*[F.sum(k).alias(k) for k in ("n", *sums)], *[F.sum(F.when(F.col("_head"), F.col(k))).alias(f"_head_{k}") for k in ("n", *sums)])
    by_week = by_week.withColumnRenamed("_week", "week")
    summed = week_windows(by_week, ["n", *sums], weeks, head, ["_first", "_last", *first], "_head_").filter(F.col("n") >= least_rows(years))
    end = F.date_add("_first", F.col("k") * 7 + length)
    return summed.filter(end <= F.col("_last")).select("scheme_code", end.alias("window_end"), "n", *first, *sums)


def week_windows(by_week: DataFrame, names: list[str], weeks: int, head: int, keep: list[str], prefix: str = "head_") -> DataFrame:
    """scheme_code, keep (equal in a scheme), k and the named sums of the k-th window: ``weeks`` weeks from the k-th on and, with ``head``, the head of one more.

    by_week: scheme_code, keep, week and the sums of each week and its head. A window is the difference of two running sums,
    kept in two parts as in daily_sums; weeks without a row repeat the sums of the week before. No row is repeated for a window.
    """
    by = Window.partitionBy("scheme_code").orderBy("week")
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    coarse = lambda c: F.rint(value(c) * GRAIN) / GRAIN
    running = [x for k in names for x in (F.sum(coarse(k)).over(upto).alias(f"coarse_{k}"), F.sum(value(k) - coarse(k)).over(upto).alias(f"fine_{k}"))]
    seen = by_week.select("scheme_code", *keep, "week", F.struct(*[value(f"{prefix}{k}").alias(k) for k in names]).alias("head"), F.coalesce(F.lead("week").over(by) - F.col("week"), F.lit(1)).alias("_weeks"), F.struct(*running).alias("upto"))
    filled = seen.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_weeks") - 1))).withColumns({"week": F.col("week") + F.col("_j"), "head": F.when(F.col("_j") == 0, F.col("head"))})
    whole, k = (F.lag("upto", 1).over(by), F.col("week") - weeks) if head else (F.col("upto"), F.col("week") - weeks + 1)
    ends = filled.select("scheme_code", *keep, k.cast("int").alias("k"), whole.alias("upto"), F.lag("upto", weeks + 1 if head else weeks).over(by).alias("before"), "head").filter("k >= 0")
    part = lambda c: F.coalesce(F.col(f"upto.{c}"), F.lit(0.0)) - F.coalesce(F.col(f"before.{c}"), F.lit(0.0))
    total = lambda c: part(f"coarse_{c}") + part(f"fine_{c}") + (F.coalesce(F.col(f"head.{c}"), F.lit(0.0)) if head else F.lit(0.0))
    return ends.select("scheme_code", *keep, "k", *[(total(c).cast("long") if c == "n" else total(c)).alias(c) for c in names])


def daily_sums(frame: DataFrame, needed: list[str], sums: dict[str, Column] | None = None, years: int = 3, first: dict[str, Column] | None = None) -> DataFrame:
    """As weekly_sums, for windows that end a day apart, on any day from one length after the first one.

    A window is the difference of two running sums: up to its end, and up to the day before its
    start. Each running sum is kept in two parts, multiples of 1 / GRAIN, whose sums and differences are exact, and the
    small rest, so that no digits are lost over long series. Days without a row repeat the sums of the day before, so the
    other end of a window is found a fixed number of rows back; no row is repeated for the windows that hold it.
    """
    sums, first, length = sums or {}, first or {}, window_days(years)
    whole, by_day = Window.partitionBy("scheme_code"), Window.partitionBy("scheme_code").orderBy("date")
    rows = frame.select("scheme_code", "date", *needed).dropna(subset=needed)
    rows = rows.withColumns({"_first": F.min("date").over(whole), "_n": F.count("*").over(whole), **{k: F.min_by(c, "date").over(whole) for k, c in first.items()}}).filter(F.col("_n") >= least_rows(years))
    rows = rows.withColumns({f"_{k}": F.coalesce(c, F.lit(0.0)) for k, c in sums.items()}).withColumns({f"_coarse_{k}": F.rint(F.col(f"_{k}") * GRAIN) / GRAIN for k in sums})
    upto = by_day.rowsBetween(Window.unboundedPreceding, 0)
    running = [F.count("*").over(upto).alias("n"), *[F.sum(f"_coarse_{k}").over(upto).alias(f"coarse_{k}") for k in sums], *[F.sum(F.col(f"_{k}") - F.col(f"_coarse_{k}")).over(upto).alias(f"fine_{k}") for k in sums]]
    summed = rows.select("scheme_code", "_first", *first, F.datediff("date", "_first").alias("_day"), F.coalesce(F.datediff(F.lead("date").over(by_day), "date"), F.lit(1)).alias("_days"), F.struct(*running).alias("upto"))
    daily = summed.withColumn("_day", F.explode(F.sequence(F.col("_day"), F.col("_day") + F.col("_days") - 1)))
    daily = daily.withColumn("before", F.lag("upto", length + 1).over(Window.partitionBy("scheme_code").orderBy("_day"))).filter(F.col("_day") >= length)
    since = lambda k: F.col(f"upto.{k}") - F.coalesce(F.col(f"before.{k}"), F.lit(0))
    out = daily.select("scheme_code", F.date_add("_first", F.col("_day")).alias("window_end"), since("n").alias("n"), *first, *[(since(f"coarse_{k}") + since(f"fine_{k}")).alias(k) for k in sums])
    return out.filter(F.col("n") >= least_rows(years))


def window_sums(frame: DataFrame, needed: list[str], sums: dict[str, Column] | None = None, years: int = 3, first: dict[str, Column] | None = None, step: str = "1w") -> DataFrame:
    """The sums of every window, a week (1w) or a day (1d) apart."""
    if step not in STEPS:
        raise ValueError(f"unsupported step: {step}")
    return (weekly_sums if step == "1w" else daily_sums)(frame, needed, sums, years, first)


def grid(frame: DataFrame, needed: list[str], years: int = 3, step: str = "1w") -> DataFrame:
    """scheme_code, window_end, n: the valid windows."""
    return window_sums(frame, needed, years=years, step=step)


def _centred(xy: str, x: str, y: str) -> Column:
    """The sum of products about the means from plain sums; what rounding alone leaves is 0."""
    value = F.col(xy) - F.col(x) * F.col(y) / F.col("n")
    return F.when(value <= F.col(xy) * FLAT, 0.0).otherwise(value) if x == y else value


def _regression(y: Column, x: Column) -> list[Column]:
    return [F.count("*").alias("n"), F.regr_intercept(y, x).alias("a"), F.regr_slope(y, x).alias("beta"), F.regr_r2(y, x).alias("r2"), F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"), F.avg(x).alias("mx")]


def _t_of_intercept(df: DataFrame) -> DataFrame:
    """df with t of its intercept; a perfect fit has t without bound, of the intercept's sign."""
    left = F.greatest(F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx")), F.lit(0.0))
    error = F.sqrt(F.try_divide(left, F.col("n") - 2) * (1 / F.col("n") + F.try_divide(F.col("mx") * F.col("mx"), F.col("sxx"))))
    t = F.when(error == 0, F.when(F.col("a") > 0, float("inf")).otherwise(float("-inf"))).otherwise(F.try_divide(F.col("a"), error))
    return df.filter("sxx > 0").withColumn("t", t).withColumn("alpha", F.pow(1 + F.col("a"), F.lit(float(TRADING_DAYS))) - 1)


def regression_sums() -> tuple[list[str], dict[str, Column], dict[str, Column]]:
    """The columns, sums and first values that fitted() takes.

    Returns are taken less the scheme's first ones, so that sums of squares keep their digits.
    """
    y, x = F.col("fund_log_ret") - F.col("rate_daily_log"), F.col("bench_log_ret") - F.col("rate_daily_log")
    dy, dx = y - F.col("y0"), x - F.col("x0")
    return ["fund_log_ret", "bench_log_ret", "rate_daily_log"], {"y": dy, "x": dx, "yy": dy * dy, "xx": dx * dx, "xy": dx * dy}, {"y0": y, "x0": x}


def fitted(one: DataFrame) -> DataFrame:
    """scheme_code, window_end, n, alpha (annual), t, beta, r2 of excess returns from the windows' sums."""
    one = one.withColumns({"sxx": _centred("xx", "x", "x"), "syy": _centred("yy", "y", "y"), "sxy": _centred("xy", "x", "y"), "mx": F.col("x") / F.col("n") + F.col("x0")})
    one = one.withColumn("beta", F.try_divide("sxy", "sxx")).withColumn("a", F.col("y") / F.col("n") + F.col("y0") - F.col("beta") * F.col("mx"))
    r2 = F.when(F.col("syy") == 0, 1.0).otherwise(F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx") * F.col("syy")))
    return _t_of_intercept(one.withColumn("r2", r2)).select("scheme_code", "window_end", "n", "alpha", "t", "beta", "r2")


def regression_windows(aligned: DataFrame, years: int = 3, step: str = "1w") -> DataFrame:
    """scheme_code, window_end, n, alpha (annual), t, beta, r2 of excess returns."""
    need, sums, first = regression_sums()
    return fitted(window_sums(aligned, need, sums, years, first, step))


def alpha_beta(aligned: DataFrame, years: int = 3, least_t: float = LEAST_T, step: str = "1w") -> DataFrame:
    """Medians of significant alphas and their t, of beta and R2; spread of beta; mean of R2."""
    return summary(regression_windows(aligned, years, step), least_t)


def summary(fits: DataFrame, least_t: float = LEAST_T) -> DataFrame:
    """alpha_beta() of the windows' regressions."""
    sure = F.col("t") >= least_t
    return fits.groupBy("scheme_code").agg(
        F.median(F.when(sure, F.col("alpha"))).alias("alpha_3y_annualized"), F.median(F.when(sure, F.col("t"))).alias("alpha_3y_tstat"), F.median("beta").alias("beta_3y"),
        F.median("r2").alias("r_squared_3y"), F.stddev_samp("beta").alias("beta_3y_std"), F.avg("r2").alias("r_squared_3y_mean"),
    )


def single_window_alpha(aligned: DataFrame, years: int = 3) -> DataFrame:
    """One regression over the last window of each scheme."""
    need = ["fund_log_ret", "bench_log_ret", "rate_daily_log"]
    rows = aligned.dropna(subset=need).withColumn("_last", F.max("date").over(Window.partitionBy("scheme_code"))).filter(F.col("date") >= F.date_sub("_last", window_days(years)))
    y, x = F.col("fund_log_ret") - F.col("rate_daily_log"), F.col("bench_log_ret") - F.col("rate_daily_log")
    return _t_of_intercept(rows.groupBy("scheme_code").agg(*_regression(y, x))).select("scheme_code", "alpha", "beta", "r2")


def sortino(aligned: DataFrame, years: int = 3, step: str = "1w") -> DataFrame:
    excess = F.col("fund_log_ret") - F.col("rate_daily_log")
    low = F.least(F.lit(0.0), excess)
    one = window_sums(aligned, ["fund_log_ret", "rate_daily_log"], {"e": excess, "low": low * low}, years, step=step).filter("low <> 0")
    return one.groupBy("scheme_code").agg(F.median(F.col("e") / F.col("n") * TRADING_DAYS / F.sqrt(F.col("low") / F.col("n") * TRADING_DAYS)).alias("sortino_3y"))


def information_ratio(aligned: DataFrame, years: int = 3, step: str = "1w") -> DataFrame:
    active = F.col("fund_log_ret") - F.col("bench_log_ret")
    d = active - F.col("a0")
    one = window_sums(aligned, ["fund_log_ret", "bench_log_ret"], {"a": d, "aa": d * d}, years, {"a0": active}, step).withColumn("saa", _centred("aa", "a", "a")).filter("saa <> 0")
    mean, sd = F.col("a") / F.col("n") + F.col("a0"), F.sqrt(F.col("saa") / (F.col("n") - 1))
    return one.groupBy("scheme_code").agg(F.median(mean * TRADING_DAYS / (sd * F.sqrt(F.lit(float(TRADING_DAYS))))).alias("info_ratio_3y"))


def capture(aligned: DataFrame, years: int = 3, step: str = "1w") -> DataFrame:
    """Median up and down capture, and the ratio of the medians. Both means of a side have its days, so their ratio is that of the sums."""
    f, b = F.col("fund_log_ret"), F.col("bench_log_ret")
    one = window_sums(aligned, ["fund_log_ret", "bench_log_ret"], {"fu": F.when(b > 0, f), "bu": F.when(b > 0, b), "fd": F.when(b < 0, f), "bd": F.when(b < 0, b)}, years, step=step)
    medians = one.filter("bu <> 0 and bd <> 0").groupBy("scheme_code").agg(F.median(F.col("fu") / F.col("bu")).alias("capture_up"), F.median(F.col("fd") / F.col("bd")).alias("capture_down"))
    return medians.withColumn("capture_efficiency", F.try_divide("capture_up", "capture_down"))


def nearest_quantile(values: Column, q: float) -> Column:
    """The element of a sorted array that lies nearest to the quantile's place."""
    return F.element_at(values, (F.floor((F.size(values) - 1) * q + 0.5) + 1).cast("int"))


def rolling_returns(nav: DataFrame, years: int) -> DataFrame:
    """Median and lower quartile of annual returns between window ends; prices as of the last date up to each end."""
    length = window_days(years)
    rows = nav.filter("nav is not null").select("scheme_code", F.col("nav_date").alias("date"), "nav")
    rows = rows.withColumn("_max", F.max("date").over(Window.partitionBy("scheme_code"))).filter(F.col("date") >= F.date_sub("_max", int(365.25 * (years + 0.05)) + length)).drop("_max")
    spans = rows.groupBy("scheme_code").agg(F.min("date").alias("a"), F.max("date").alias("b"), F.count("*").alias("n")).filter("n >= 30").filter(F.datediff("b", "a") >= length)
    ends = spans.select("scheme_code", F.explode(F.sequence(F.date_add("a", length), F.col("b"), F.expr("interval 7 days"))).alias("window_end"))
    probes = ends.select("scheme_code", "window_end", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.date_sub("window_end", length).alias("date")), F.struct(F.lit(1).alias("side"), F.col("window_end").alias("date")))).alias("p"))
    both = rows.select("scheme_code", "date", F.struct("date", "nav").alias("seen"), F.lit(None).cast("date").alias("window_end"), F.lit(-1).alias("side"))
    both = both.unionByName(probes.select("scheme_code", "p.date", F.lit(None).cast("struct<date:date,nav:double>").alias("seen"), "window_end", "p.side"))
    asof = F.last("seen", ignorenulls=True).over(Window.partitionBy("scheme_code").orderBy("date", "side").rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("hit", asof).filter("side >= 0").groupBy("scheme_code", "window_end").agg(F.max(F.when(F.col("side") == 0, F.col("hit"))).alias("s"), F.max(F.when(F.col("side") == 1, F.col("hit"))).alias("e"))
    found = found.filter("s is not null and s.date < e.date and s.nav > 0 and e.nav > 0")
    annual = F.pow(F.col("e.nav") / F.col("s.nav"), 365.25 / F.datediff("e.date", "s.date")) - 1
    lists = found.groupBy("scheme_code").agg(F.median(annual).alias(f"ret_{years}y_median"), F.sort_array(F.collect_list(annual)).alias("all"))
    return lists.select("scheme_code", f"ret_{years}y_median", nearest_quantile(F.col("all"), 0.25).alias(f"ret_{years}y_p25"))


def quality_flag(aligned: DataFrame, schemes: DataFrame, most_missing: float = 0.05) -> DataFrame:
    """scheme_code, n_days, n_present, data_quality_flag for each of schemes (scheme_code)."""
    recent = F.col("date") > F.date_sub("_last", 1095)
    rows = aligned.withColumn("_last", F.max("date").over(Window.partitionBy("scheme_code")))
    seen = rows.groupBy("scheme_code").agg(F.datediff(F.max("date"), F.min("date")).alias("span"), F.count(F.when(recent, 1)).alias("n_days"), F.count(F.when(recent, F.col("nav"))).alias("n_present"))
    short = F.col("span").isNull() | (F.col("span") < 1095)
    poor = (F.col("n_days") == 0) | ((F.col("n_days") - F.col("n_present")) > most_missing * F.col("n_days"))
    flag = F.when(short, "INSUFFICIENT_HISTORY").when(poor, "POOR").otherwise("GOOD")
    return schemes.join(seen, "scheme_code", "left").select("scheme_code", F.coalesce("n_days", F.lit(0)).alias("n_days"), F.coalesce("n_present", F.lit(0)).alias("n_present"), flag.alias("data_quality_flag"))


def phase_one(aligned: DataFrame, nav: DataFrame) -> DataFrame:
    """One row of metrics for each scheme; those with too short a history have nulls."""
    aligned = materialize(aligned)  # read by five parts
    schemes = nav.select("scheme_code").distinct()
    parts = [quality_flag(aligned, schemes).select("scheme_code", "data_quality_flag"), rolling_returns(nav, 3), rolling_returns(nav, 5), alpha_beta(aligned), sortino(aligned), information_ratio(aligned), capture(aligned)]
    return reduce(lambda a, b: a.join(b, "scheme_code", "left"), parts)
