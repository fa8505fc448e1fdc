"""The staged shortlist from metrics to survivors without overlapping portfolios."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlab.operators import holdings as h
from fundlab.operators import ranking as r
from fundlab.storage import materialize


@dataclass
class Shortlists:
    stage_one: DataFrame
    survivors: DataFrame
    dropped: DataFrame
    coverage: DataFrame
    pairs: DataFrame
    final: DataFrame


def with_phase_two(metrics: DataFrame, pool: DataFrame, holdings: DataFrame, constituents: DataFrame, turnover: DataFrame, adv: DataFrame, aum: DataFrame, as_of: str) -> DataFrame:
    """metrics of the pool's schemes with holdings measures; only the pool's holdings are read into joins."""
    codes = pool.select("scheme_code").distinct()
    held = holdings.join(codes, "scheme_code", "left_semi")
    share = h.trailing_median(h.active_share(held, constituents), "active_share", as_of).select("scheme_code", F.col("median").alias("active_share_median_1y"))
    impact = h.impact_days(held, h.median_turnover(adv), aum).withColumnRenamed("aum_impact_days", "aum_impact_cost_days")
    ptr = h.latest(turnover, "ptr").select("scheme_code", F.col("ptr").alias("ptr_latest"))
    rows = h.style_drift(metrics.drop("active_share_median_1y", "aum_impact_cost_days", "ptr_latest", "style_drift_3y", "aum_crore")).join(codes, "scheme_code", "left_semi")
    for part in (share, impact, ptr, aum.select("scheme_code", "aum_crore")):
        rows = rows.join(part, "scheme_code", "left")
    return rows


def rank_deep(metrics: DataFrame, holdings: DataFrame, constituents: DataFrame, turnover: DataFrame, adv: DataFrame, aum: DataFrame, as_of: str, categories: list[str] | None = None, pool: int = r.POOL, final: int = r.FINAL) -> Shortlists:
    """All stages: the best of stage one get their holdings measures, are scored again among themselves and go through stages two and three."""
    best = materialize(r.top_n(r.stage_one(metrics, categories=categories), pool).select("scheme_code"))
    deep = materialize(with_phase_two(metrics, best, holdings, constituents, turnover, adv, aum, as_of))
    return shortlists(deep, holdings, pool, final)


def shortlists(metrics: DataFrame, holdings: DataFrame, pool: int = r.POOL, final: int = r.FINAL) -> Shortlists:
    """Stages one to three over metrics that already have the holdings measures."""
    one = materialize(r.stage_one(metrics))
    survivors, dropped, coverage = r.stage_two(one, pool, final)
    survivors = materialize(survivors)
    pairs = materialize(h.overlaps(holdings, survivors))
    return Shortlists(one, survivors, dropped, coverage, pairs, r.stage_three(survivors, pairs))
