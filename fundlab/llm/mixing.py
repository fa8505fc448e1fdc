"""Mixing sources to target weights by entropy balancing.

Documents get rates: the least change from rate 1, in relative entropy weighted by
size, whose expected sizes meet every source's target, with no rate above
MOST_COPIES. The languages' shares of all words are a second, soft margin: leaving
them costs in proportion to the square of what is missing. The dual has one
multiplier for each source and language, and a document's rate is exponentially
tilted by both. Given the languages' multipliers each source's is known exactly,
so that a Newton step of the joint dual is one of its Schur complement on the
languages, whose gradient and Hessian are sums over sources. Rates then become
whole copies.

Edge cases: a null text has size 0; null sources come last and are a source; null
languages are a language; a source of size 0 has target 0; a document of size 0
gives 0 words whatever its copies; rows with one id, text, source and language are
numbered, so that the mix can take some of them, always as many; an empty table gives an
empty result; columns not named here are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab.skew import join_unique
from fundlab.storage import materialize, release

WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3
SEED = 5
#: Languages with a multiplier of their own; all others share one.
LANGUAGES = 63
#: A language that misses a share x of its words has the multiplier x / SOFTNESS.
SOFTNESS = 0.25
_PLAN = "g string, h string, size long, k long, low long, extra long"


def size_of(text: Column) -> Column:
    """Number of words: maximal runs without space and U+0009 to U+000D."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")).cast("long")


def group_of(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit(""))


def keyed(docs: DataFrame, *kept: Column | str) -> DataFrame:
    """The columns ``kept`` of docs (doc_id, text, lang, source) with g, source, h, size and draw, written once.

    A row's draw depends on its id and text only. Rows that have these, the source and the language in common draw
    by their numbers 1, 2, ... among themselves, so that their draws together are the same however the rows lie in files.
    """
    draw = F.xxhash64(F.lit(SEED), "doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1))
    rows = materialize(docs.select(*kept, group_of("source").alias("g"), group_of("lang").alias("h"), size_of(F.col("text")).alias("size"), draw.alias("draw"), F.monotonically_increasing_id().alias("nth")))
    same = ["draw", "g", "h"]
    tied = materialize(rows.groupBy(*same).agg(F.count("*").alias("n")).filter("n > 1").select(*same, F.lit(True).alias("tied")), n=F.count(F.lit(1)))
    marked = join_unique(rows, tied, same, "left", rows=tied.seen["n"])
    if not tied.seen["n"]:
        return marked.drop("tied", "nth")
    number = _places(marked.filter("tied"), same)
    own = F.xxhash64("draw", "place").bitwiseAND(F.lit((1 << 62) - 1))
    return marked.filter("tied is null").drop("tied", "nth").unionByName(number.withColumn("draw", own).drop("tied", "nth", "place"))


def _places(rows: DataFrame, key: list[str]) -> DataFrame:
    """rows (with nth) with ``place``, their number from 1 among the rows of a key: a distributed sort, in which a key's rows may lie in several parts, and the sums of its rows in earlier parts."""
    at = materialize(rows.orderBy(*key, "nth").withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    parts = at.groupBy(*key, "_part").agg(F.count("*").alias("n"), F.min("_at").alias("_first"))
    before = F.sum("n").over(Window.partitionBy(*key).orderBy("_part")) - F.col("n")  # a row for each part that a key lies in
    starts = materialize(parts.select(*key, "_part", (F.col("_first") - before).alias("_start")))
    return join_unique(at, starts, [*key, "_part"]).withColumn("place", F.col("_at") - F.col("_start") + 1).drop("_at", "_part", "_start")


def _numbered(sources: DataFrame) -> DataFrame:
    """sources with ``nth``, their place from 0 by code point, null last: sorted ranges and the sums of their lengths."""
    order = F.col("source").asc_nulls_last()
    laid = materialize(sources.repartitionByRange(order).sortWithinPartitions(order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")  # one row for each partition
    lengths = laid.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select("part", before.alias("before"))
    return laid.withColumn("part", part).join(F.broadcast(lengths), "part").withColumn("nth", F.col("before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "before", "_id")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """sources (source, size) with ``target``: shares of all sizes by weight, none above ``most`` times its size.

    The common level is found from sums: what the sources at their cap leave goes
    to the others by weight, until no further source is at its cap.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int"))
    weighed = materialize(_numbered(sources).withColumn("w", weight).withColumn("cap", F.col("size") * float(most)))
    level, capped = 0.0, -1
    while True:
        over = F.lit(level) * F.col("w") > F.col("cap") * (1 + 1e-12)
        total, held, open_, n = weighed.agg(F.sum("size"), F.sum(F.when(over, F.col("cap")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("w"))), F.count_if(over)).first()
        if n == capped or not total or not open_:
            break
        level, capped = (total - held) / open_, n
    return weighed.withColumn("target", F.least(F.lit(float(level)) * F.col("w"), F.col("cap"))).drop("w", "cap", "nth")


def _rates(target: float, size: np.ndarray, mu: np.ndarray, most: float) -> np.ndarray:
    """min(most, exp(lambda + mu)) of one source's cells, with the lambda at which the rated sizes add up to the target."""
    if target <= 0 or size.sum() <= 0:
        return np.zeros(len(size))
    if target >= most * size.sum():
        return np.full(len(size), float(most))
    tilt = np.exp(mu - mu.max())
    order = np.argsort(-tilt)
    capped = 0.0
    for k, at in enumerate(order):
        level = (target - most * capped) / (size[order[k:]] @ tilt[order[k:]] or 1.0)
        if level * tilt[at] <= most:
            break
        capped += size[at]
    return np.minimum(most, level * tilt)


def _sums(mu: np.ndarray, most: float):
    """Of a partition's sources: the rated sizes by language, and their Schur complement's Hessian, as one array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(mu)
        gradient, hessian = np.zeros(n), np.zeros((n, n))
        for batch in batches:
            for row in batch.to_pylist():
                at, size = np.array(row["language"], int), np.array(row["sizes"], float)
                rate = _rates(row["target"], size, mu[at], most)
                rated = size * rate
                np.add.at(gradient, at, rated)
                free = np.where(rate < most, rated, 0.0)
                if free.sum() > 0:
                    np.add.at(hessian, (at, at), free)
                    np.add.at(hessian, (at[:, None], at[None, :]), -np.outer(free, free) / free.sum())
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([gradient, hessian.ravel()])], pa.list_(pa.float64()))], names=["sums"])

    return run


def _rated(mu: np.ndarray, most: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rate = _rates(row["target"], np.array(row["sizes"], float), mu[np.array(row["language"], int)], most)
                yield pa.RecordBatch.from_arrays([pa.array([row["g"]] * len(rate)), pa.array(row["names"], pa.string()), pa.array(rate)], names=["g", "h", "rate"])

    return run


def balance(cells: DataFrame, most: float = MOST_COPIES, softness: float = SOFTNESS, tolerance: float = 1e-7, rounds: int = 40) -> DataFrame:
    """g, h, rate such that each source's (g) rated sizes add up to its target and the languages (h) nearly keep their shares.

    cells: g, h, size, target (of g), one row for each source and language. Each
    Newton step sums over all sources; the driver solves a system of at most LANGUAGES + 1.
    """
    largest = cells.groupBy("h").agg(F.sum("size").alias("size")).filter("size > 0").orderBy(F.desc("size"), "h").limit(LANGUAGES).collect()
    names = [r.h for r in largest]
    total = cells.agg(F.sum("size")).first()[0] or 0
    wanted = np.array([float(r.size) for r in largest] + [float(total - sum(r.size for r in largest))])
    language = F.coalesce(F.array_position(F.array(*map(F.lit, names)), F.col("h")), F.lit(0)) if names else F.lit(0)
    language = F.when(language > 0, language - 1).otherwise(len(names)).cast("int")
    cell = F.struct(language.alias("language"), F.col("size").cast("double").alias("size"), F.col("h").alias("name"))
    sources = cells.groupBy("g").agg(F.first("target").cast("double").alias("target"), F.sort_array(F.collect_list(cell)).alias("c"))
    sources = materialize(sources.select("g", "target", F.col("c.language").alias("language"), F.col("c.size").alias("sizes"), F.col("c.name").alias("names")))
    mu, n = np.zeros(len(wanted)), len(wanted)
    ridge = softness * np.maximum(wanted, 1e-9 * max(total, 1))
    for _ in range(rounds if total else 0):
        sums = sources.mapInArrow(_sums(mu, most), "sums array<double>").select(F.posexplode("sums").alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x")).orderBy("place").collect()
        sums = np.array([r.x for r in sums])
        gradient = sums[:n] - wanted + ridge * mu
        if np.abs(gradient).max() <= tolerance * total:
            break
        step = np.linalg.solve(sums[n:].reshape(n, n) + np.diag(ridge), gradient)
        mu = mu - step / max(1.0, np.abs(step).max())
    return sources.mapInArrow(_rated(mu, most), "g string, h string, rate double")


def _round_copies(most: int):
    """For each source: whole copies for each language and document size, the running words kept near the running target.

    A group holds one row for each distinct size and language of one source, so its length is
    bounded by the longest document, whatever the number of documents.
    """

    def plan(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "h"], ascending=False)
        want = got = 0.0
        out = []
        for h, size, k, rate in zip(rows["h"], rows["size"], rows["k"], rows["rate"], strict=True):
            low = min(most, int(rate + 1e-9))
            high = min(most, low + 1)
            want += size * k * rate
            copies = low * k if not size else int(min(high * k, max(low * k, round((want - got) / size))))
            got += copies * size
            out.append((key[0], h, size, k, low, copies - low * k))
        return pd.DataFrame(out, columns=["g", "h", "size", "k", "low", "extra"])

    return plan


def copy_plan(docs: DataFrame, rates: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """g, h, size, low, cut: a document gets ``low`` copies and one more if its draw is at most ``cut``.

    docs: g, h, size, draw. The cut is the draw of the last document that gets one
    more. It is found by counting draws in about sqrt(k) equal bins, then ranking
    within the one bin that holds it, so a source or size that most documents
    share is never sorted in one task.
    """
    key = ["g", "h", "size"]
    histogram = docs.groupBy(*key).agg(F.count("*").alias("k"))
    plan = materialize(join_unique(histogram, materialize(rates), ["g", "h"]).groupBy("g").applyInPandas(_round_copies(most), _PLAN))
    open_ = plan.filter((F.col("extra") > 0) & (F.col("extra") < F.col("k"))).select(*key, "extra", F.ceil(F.sqrt("k")).cast("long").alias("bins"))
    placed = join_unique(docs, open_, key).withColumn("bin", F.floor(F.col("draw").cast("double") * F.col("bins") / F.lit(float(1 << 62))).cast("long"))
    counted = placed.groupBy(*key, "bin", "extra").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*key).orderBy("bin")) - F.col("n")
    right = materialize(counted.withColumn("before", before).filter((F.col("before") < F.col("extra")) & (F.col("before") + F.col("n") >= F.col("extra"))).select(*key, "bin", "before"))
    inside = join_unique(placed, right, [*key, "bin"])
    rank = F.row_number().over(Window.partitionBy(*key, "bin").orderBy("draw"))
    cuts = inside.withColumn("rank", rank).filter(F.col("rank") + F.col("before") == F.col("extra")).select(*key, F.col("draw").alias("cut"))
    cut = F.when(F.col("extra") == F.col("k"), F.lit(1 << 62)).when(F.col("extra") == 0, F.lit(-1)).otherwise(F.col("cut"))
    return materialize(plan.join(cuts, key, "left").select(*key, "low", cut.cast("long").alias("cut")))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES) -> tuple[DataFrame, DataFrame]:
    """docs (as from keyed) with ``copies``; and g, source_size and target of the sources."""
    cells = materialize(docs.groupBy("g", "h").agg(F.sum("size").alias("size")))
    sources = cells.groupBy("g").agg(F.sum("size").alias("size")).withColumn("source", F.when(F.col("g") != "", F.substring("g", 2, 1 << 30)))
    wanted = materialize(targets(sources, weights, most))
    rates = balance(join_unique(cells, wanted.select("g", "target"), ["g"]), most)
    plan = copy_plan(docs.select("g", "h", "size", "draw"), rates, most)
    copies = F.col("low") + F.when(F.col("draw") <= F.col("cut"), 1).otherwise(0)
    taken = join_unique(docs, plan, ["g", "h", "size"]).withColumn("copies", copies).drop("low", "cut")
    release(cells)
    return taken, wanted.select("g", F.col("size").alias("source_size"), "target")
