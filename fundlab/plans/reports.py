"""The stages' outputs: shortlists by category, what was dropped and why, coverage, and the report of each category's best."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlab.operators import ranking as r
from fundlab.operators.store import write_by_category, write_sheet
from fundlab.storage import materialize

#: Funds of each category in the reports of stages one and two; stage three reports all.
REPORTED = {1: 5, 2: 3}


class NoMetrics(Exception):
    """There are no metrics to rank."""


def stage_one_of_day(metrics: DataFrame, as_of: str | None = None, dimension: DataFrame | None = None, category: str | None = None, skip_filters: bool = False) -> DataFrame:
    """Stage one over the metrics (with as_of_date) of a day, the latest one by default. NoMetrics if there are none, or none of that day."""
    day = F.lit(as_of).cast("date") if as_of else F.lit(metrics.agg(F.max("as_of_date")).first()[0])
    if as_of is None and metrics.limit(1).count() == 0:
        raise NoMetrics("no metrics were computed")
    rows = metrics.filter(F.col("as_of_date") == day)
    if rows.limit(1).count() == 0:
        raise NoMetrics(f"no metrics of {as_of or 'any day'}")
    return r.stage_one(rows.drop("as_of_date"), dimension, [category] if category else None, skip_filters).withColumn("as_of_date", day)


def report(ranked: DataFrame, stage: int, rank: str) -> DataFrame:
    """The best of each category."""
    return ranked.filter(F.col(rank) <= REPORTED[stage]) if stage in REPORTED else ranked


def write_stages(scored: DataFrame, holdings_pairs, path: str, pool: int = r.POOL, final: int = r.FINAL) -> None:
    """Write all stages under a path: shortlists by category, and one sheet each of what was dropped, coverage, pairs and the report.

    holdings_pairs gives the overlaps of survivors. A stage without rows has its sheets with their headings, and no files by category.
    """
    one = materialize(r.top_n(scored, None))
    survivors, dropped, coverage = r.stage_two(scored, pool, final)
    survivors = materialize(survivors)
    pairs = materialize(holdings_pairs(survivors))
    gone = r.overlap_drops(survivors, pairs)
    final_funds = materialize(r.stage_three(survivors, pairs))
    if gone is None:
        gone = scored.sparkSession.createDataFrame([], "scheme_code_dropped string, scheme_code_kept string, overlap_pct double")
    by_rank = ["canonical_category", "stage2_rank"]
    sheets = {
        "stage1/report": (report(one, 1, "rank"), ["canonical_category", "rank"]), "stage2/dropped": (dropped.select("canonical_category", "stage1_rank", "scheme_code", "missing_metrics"), ["canonical_category", "stage1_rank"]),
        "stage2/coverage": (coverage, ["canonical_category"]), "stage2/report": (report(survivors, 2, "stage2_rank"), by_rank), "stage3/dropped": (gone, ["scheme_code_dropped"]),
        "stage3/overlap_pairs": (pairs.select("scheme_a", "scheme_b", "overlap_pct"), ["scheme_a", "scheme_b"]), "stage3/report": (final_funds, by_rank),
    }
    for name, (rows, order) in sheets.items():
        write_sheet(rows, f"{path}/{name}", order)
    for name, rows in (("stage1", one), ("stage2", survivors), ("stage3", final_funds)):
        if rows.limit(1).count():
            write_by_category(rows, f"{path}/{name}/by_category")
