"""Filters, z-scores, composites and stages that turn metrics into shortlists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab.storage import materialize

# Floors, weights and limits decide results.
FLOORS = {"capture_efficiency": (0.50, None), "info_ratio_3y": (-1.00, None), "r_squared_3y": (0.40, 1.00), "beta_3y": (0.30, 1.70)}
BAD_FLAGS = ["INSUFFICIENT_HISTORY", "POOR"]
Z_METRICS = ["ret_3y_median", "ret_3y_p25", "ret_5y_median", "ret_5y_p25", "alpha_3y_annualized", "sortino_3y", "info_ratio_3y", "capture_efficiency", "active_share_median_1y", "style_drift_3y"]
STAGE_1 = dict(zip(Z_METRICS, [0.15, 0.10, 0.15, 0.10, 0.25, 0.10, 0.10, 0.05], strict=False))
STAGE_2 = dict(zip(Z_METRICS, [0.10, 0.07, 0.10, 0.07, 0.20, 0.08, 0.08, 0.05, 0.10, -0.05], strict=True))
PENALTIES = {"ptr_latest": (1.50, 0.05), "aum_impact_cost_days": (5.0, 0.05)}
REQUIRED = ["active_share_median_1y", "style_drift_3y", "ptr_latest", "aum_impact_cost_days"]
WINSOR, POOL, FINAL, MOST_OVERLAP = 3.0, 20, 5, 30.0


def hard_filters(metrics: DataFrame, categories: list[str] | None = None, skip: bool = False) -> DataFrame:
    """Rows of good quality within the floors; a missing metric passes its floor. skip: rows need a category only."""
    keep = F.col("canonical_category").isNotNull()
    if categories is not None:
        keep &= F.col("canonical_category").isin(categories)
    if skip:
        return metrics.filter(keep)
    keep &= ~F.col("data_quality_flag").isin(BAD_FLAGS)
    for name, (low, high) in FLOORS.items():
        inside = F.col(name) > low if high is None else F.col(name).between(low, high)
        keep &= F.col(name).isNull() | inside
    return metrics.filter(keep)


def zscores(metrics: DataFrame, names: list[str] = Z_METRICS, limit: float = WINSOR) -> DataFrame:
    """metrics with z_<name> within each category, clipped; 0 for all where the spread is 0 or undefined."""
    group = Window.partitionBy("canonical_category")

    def z(name: str) -> Column:
        mean, sd = F.avg(name).over(group), F.stddev_samp(name).over(group)
        clipped = F.greatest(F.lit(-limit), F.least(F.lit(limit), (F.col(name) - mean) / sd))
        return F.when(sd.isNull() | (sd == 0), 0.0).when(F.col(name).isNotNull(), clipped)

    return metrics.withColumns({f"z_{n}": z(n) for n in names if n in metrics.columns})


def composite(scored: DataFrame, weights: dict[str, float], name: str = "composite_score", penalties: dict | None = None) -> DataFrame:
    """The weighted sum of z-scores; five-year ones fall back on three-year ones, missing ones count 0."""
    z = {n: F.coalesce(f"z_{n}", f"z_{n.replace('5y', '3y')}", F.lit(0.0)) for n in weights}
    total = reduce(lambda a, b: a + b, (w * z[n] for n, w in weights.items()))
    for metric, (threshold, most) in (penalties or {}).items():
        total = total - soft_penalty(F.col(metric), threshold, most)
    return scored.withColumn(name, total)


def soft_penalty(value: Column, threshold: float, most: float) -> Column:
    """0 up to the threshold, then rising to ``most`` at twice the threshold."""
    if threshold <= 0 or most == 0:
        return F.lit(0.0)
    return F.coalesce(F.least(F.lit(most), F.greatest(F.lit(0.0), (value - threshold) / threshold * most)), F.lit(0.0))


def best_first(*more: str) -> list[Column]:
    return [F.desc_nulls_last("composite_score"), *map(F.col, more or ("scheme_code",))]


def one_per_unit(scored: DataFrame) -> DataFrame:
    """scored with ``unit_rank``: 1 for the row that stands for its fund (a bonus unit only where there is no other)."""
    key = F.regexp_replace(F.coalesce("base_fund_id", F.lit("")), "_bonus$", "")
    order = Window.partitionBy("canonical_category", "_key").orderBy(F.coalesce("base_fund_id", F.lit("")).endswith("_bonus"), *best_first())
    return scored.withColumn("_key", key).withColumn("unit_rank", F.row_number().over(order)).drop("_key")


def top_n(scored: DataFrame, n: int | None, rank: str = "rank") -> DataFrame:
    place = F.row_number().over(Window.partitionBy("canonical_category").orderBy(*best_first()))
    ranked = scored.withColumn(rank, place)
    return ranked if n is None else ranked.filter(F.col(rank) <= n)


def stage_one(metrics: DataFrame, dimension: DataFrame | None = None, categories: list[str] | None = None, skip_filters: bool = False) -> DataFrame:
    """Filtered, scored and (where base_fund_id is known) deduplicated funds."""
    scored = composite(zscores(hard_filters(metrics, categories, skip_filters), list(STAGE_1)), STAGE_1)
    if dimension is not None:
        scored = scored.join(dimension, "scheme_code", "left")
    return one_per_unit(scored).filter("unit_rank = 1").drop("unit_rank") if "base_fund_id" in scored.columns else scored


def stage_two(scored: DataFrame, pool: int = POOL, final: int = FINAL) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Survivors, dropped and coverage of the pool of each category's best."""
    considered = top_n(scored, pool, "stage1_rank").drop("composite_score", *[c for c in scored.columns if c.startswith("z_")])
    missing = F.concat_ws(";", *[F.when(F.col(m).isNull(), F.lit(m)) for m in REQUIRED])
    considered = considered.withColumn("missing_metrics", missing)
    full = considered.filter("missing_metrics = ''").drop("missing_metrics")
    again = top_n(composite(zscores(full), STAGE_2, penalties=PENALTIES), final, "stage2_rank")
    n = F.count("*").over(Window.partitionBy("canonical_category"))
    survivors = again.withColumn("partial_coverage_flag", n < final)
    dropped = considered.filter("missing_metrics <> ''")
    return survivors, dropped, coverage(considered, survivors)


def coverage(considered: DataFrame, survivors: DataFrame) -> DataFrame:
    """Counts and assets of each category's pool: considered, surviving, dropped for missing metrics.

    With source_amc, top_dropped_amc is the company of most dropped rows (ties: the least name).
    """
    lived = survivors.select("scheme_code", F.lit(True).alias("lived"))
    rows = considered.join(lived, "scheme_code", "left")
    aum = F.coalesce("aum_crore", F.lit(0.0))
    out = rows.groupBy("canonical_category").agg(
        F.count("*").alias("n_considered"), F.count("lived").alias("n_survived"), F.count_if(F.col("missing_metrics") != "").alias("n_dropped"),
        F.bround(F.sum(aum), 2).alias("aum_considered"), F.bround(F.sum(F.when(F.col("lived"), aum).otherwise(0.0)), 2).alias("aum_survived"),
    )
    share = F.when(F.col("aum_considered") != 0, F.bround(100.0 * F.col("aum_survived") / F.col("aum_considered"), 1)).otherwise(0.0)
    out = out.withColumns({"pct_survived": F.bround(100.0 * F.col("n_survived") / F.col("n_considered"), 1), "aum_dropped": F.bround(F.col("aum_considered") - F.col("aum_survived"), 2), "pct_aum_survived": share})
    if "source_amc" not in considered.columns:
        return out
    lost = considered.filter("missing_metrics <> '' and source_amc is not null").groupBy("canonical_category", "source_amc").agg((-F.count("*")).alias("n"))
    return out.join(lost.groupBy("canonical_category").agg(F.min_by("source_amc", F.struct("n", "source_amc")).alias("top_dropped_amc")), "canonical_category", "left")


def overlap_drops(survivors: DataFrame, pair_table: DataFrame, most: float = MOST_OVERLAP) -> DataFrame | None:
    """scheme_code_dropped, scheme_code_kept, overlap_pct of the funds that overlap too much with a better-ranked one; None: no pair does.

    From the largest overlap down (ties: the better ranks first), the worse-ranked fund of each pair above ``most``
    whose funds are both left goes. A pair that comes before all others of both its funds can be settled at
    once, whatever the rest: each round settles all such pairs by joins, until no pair is left.
    """
    rank = F.struct(F.coalesce("stage2_rank", F.lit(10**9)).alias("r"), "scheme_code")
    ranks = materialize(survivors.select("scheme_code", rank.alias("rank")))
    of = lambda x: ranks.select(F.col("scheme_code").alias(f"scheme_{x}"), F.col("rank").alias(f"rank_{x}"))
    pairs = pair_table.filter(F.col("overlap_pct") > most).join(of("a"), "scheme_a").join(of("b"), "scheme_b")
    place = F.struct((-F.col("overlap_pct")).alias("o"), F.col("rank_a").alias("a"), F.col("rank_b").alias("b"))
    a_goes = F.col("rank_a") > F.col("rank_b")
    worse, better = F.when(a_goes, F.col("scheme_a")).otherwise(F.col("scheme_b")), F.when(a_goes, F.col("scheme_b")).otherwise(F.col("scheme_a"))
    left = materialize(pairs.select("scheme_a", "scheme_b", place.alias("place"), worse.alias("worse"), better.alias("better"), "overlap_pct"))
    gone = None
    while left.limit(1).count():
        ends = left.select(F.explode(F.array("scheme_a", "scheme_b")).alias("fund"), "place").groupBy("fund").agg(F.min("place").alias("first"))
        least = lambda x: ends.select(F.col("fund").alias(f"scheme_{x}"), F.col("first").alias(f"first_{x}"))  # noqa: B023, E731
        known = left.join(least("a"), "scheme_a").join(least("b"), "scheme_b")
        settled = known.filter((F.col("place") == F.col("first_a")) & (F.col("place") == F.col("first_b")))
        dropped = materialize(settled.select(F.col("worse").alias("scheme_code_dropped"), F.col("better").alias("scheme_code_kept"), "overlap_pct"))
        gone = dropped if gone is None else gone.union(dropped)
        for x in "ab":
            left = left.join(dropped.select(F.col("scheme_code_dropped").alias(f"scheme_{x}")), f"scheme_{x}", "left_anti")
        left = materialize(left)
    return gone


def stage_three(survivors: DataFrame, pair_table: DataFrame, most: float = MOST_OVERLAP) -> DataFrame:
    """survivors without the funds that overlap too much with a better-ranked one (see overlap_drops)."""
    gone = overlap_drops(survivors, pair_table, most)
    return survivors if gone is None else survivors.join(gone.select(F.col("scheme_code_dropped").alias("scheme_code")), "scheme_code", "left_anti")
