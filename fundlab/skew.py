"""Joins with a table of unique keys that stay spread where one key holds many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlab.storage import materialize

#: Keys that hold at least one part in MOST_HOT of all rows (so at most MOST_HOT keys) and LEAST_HOT rows are hot.
MOST_HOT, LEAST_HOT = 4096, 500
#: A narrow small side of up to so many rows is broadcast whole.
BROADCAST_ROWS = 1 << 16


def hashed(df: DataFrame) -> Column:
    """A hash of a whole row; columns that hold maps, which have no hash, count as text."""
    return F.xxhash64(*[F.to_json(F.struct(f"`{c}`")) if "map<" in kind else F.col(f"`{c}`") for c, kind in df.dtypes])


def key_counts(big: DataFrame, on: list[str]) -> DataFrame:
    """A written table of the keys and the rows ``n`` of each; it knows the sum and the most of n."""
    return materialize(big.groupBy(*on).agg(F.count("*").alias("n")), total=F.sum("n"), most=F.max("n"))


def hot_keys(counts: DataFrame, on: list[str]) -> DataFrame | None:
    """The hot keys, at most MOST_HOT rows, of a written table of counts n: the keys and ``_blocks`` of about equal rows each holds. None: no key is hot."""
    seen = counts.__dict__.get("seen") or {}
    if "most" not in seen:
        seen = counts.agg(F.sum("n").alias("total"), F.max("n").alias("most")).first().asDict()
    block = max(LEAST_HOT, (seen["total"] or 0) / MOST_HOT)
    if (seen["most"] or 0) < block:
        return None
    return counts.filter(F.col("n") >= block).select(*on, F.ceil(F.col("n") / block).cast("int").alias("_blocks"))


def join_unique(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", wide: bool = False, counts: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """big joined (inner, left or left_semi) with small, which has at most one row for each key; keys are not null.

    A small side of at most BROADCAST_ROWS rows, which are counted, is broadcast,
    unless it is ``wide``. Else the rows of a hot key are dealt to several blocks
    by their hash, and small's row for it is repeated for each block; what is
    broadcast then is the list of hot keys. counts: on and n of big, if known;
    rows: the rows of small, if known.
    """
    if not wide and (small.limit(BROADCAST_ROWS + 1).count() if rows is None else rows) <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), on, how)
    hot = hot_keys(key_counts(big, on) if counts is None else counts, on)
    if hot is None:
        return big.join(small, on, how)
    salt = F.coalesce(F.pmod(hashed(big), F.col("_blocks")), F.lit(0)).cast("int")
    dealt = big.join(F.broadcast(hot), on, "left").withColumn("_salt", salt).drop("_blocks")
    repeated = small.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_blocks", F.lit(1)) - 1))).drop("_blocks")
    return dealt.join(repeated, [*on, "_salt"], how).drop("_salt")
