"""Importance resampling towards a target distribution of hashed n-grams.

A document's features are its words and its pairs of neighbouring words, hashed into
buckets. A bucket's gain is the log ratio of its smoothed share in the target and in the
documents; a document's weight is the mean gain of its features. Gumbel noise drawn from
the id is added, so that the highest scores are a sample without replacement in
proportion to the exponential of the weights.

All steps are DataFrame functions. Bucket numbers are written once and exploded twice: for
the counts, which are summed before the shuffle into at most BUCKETS rows, and for the
gains, joined by broadcast (at most BUCKETS rows) and summed by row before the shuffle. Ranks
come from a distributed sort: the rows of lower parts plus the place within the part.

Edge cases: null texts and texts without words have no features and weight 0; a null id
draws its noise as the empty text; repeated rows are ranked one by one (equal scores by the
smaller id, nulls last, then in any order of these equal rows); an empty target has no counts; empty
documents give an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab.storage import materialize, release

BUCKETS, SEED, PERCENT, LEAST_WORDS = 10_000, 7, 25, 20
#: What stands between words, once A to Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: monotonically_increasing_id() counts the rows of a part in its lowest bits.
_PLACE_BITS = 33


def words(text: Column) -> Column:
    """The words of a text, A to Z lower-cased."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), BETWEEN), lambda w: w != "")


def bucketed(docs: DataFrame, keep: list[str], buckets: int = BUCKETS) -> DataFrame:
    """The kept columns, n_words and the buckets of all runs of one or two words, in any order."""
    split = docs.select(*keep, words(F.col("text")).alias("words"))
    following = F.filter(F.transform("words", lambda w, k: F.concat(w, F.lit(" "), F.get("words", k + 1))), lambda pair: pair.isNotNull())
    number = lambda feature: F.pmod(F.crc32(feature.cast("binary")), F.lit(buckets)).cast("int")
    return split.select(*keep, F.size("words").alias("n_words"), F.transform(F.concat("words", following), number).alias("buckets"))


def bucket_counts(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain for the buckets of docs (bucket, n): floor(1000 ln) of the ratio of the smoothed shares in target (bucket, n) and docs."""
    double = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    totals = docs.agg(F.sum("n").alias("s_all")).crossJoin(target.agg(F.sum("n").alias("t_all")))  # one row each
    both = docs.join(F.broadcast(target.withColumnRenamed("n", "t")), "bucket", "left").crossJoin(F.broadcast(totals))
    ratio = ((double(F.col("t")) + 1) * (double(F.col("s_all")) + buckets)) / ((double(F.col("n")) + 1) * (double(F.col("t_all")) + buckets))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 x a Gumbel number drawn from the seed and the id)."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, order: list[Column]) -> tuple[DataFrame, int]:
    """rows with rank (from 1) in that order, and their number. Each part of the distributed sort adds the rows of the parts before it."""
    at = materialize(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), n=F.count(F.lit(1)))
    part = F.shiftright("_at", _PLACE_BITS)
    sizes = at.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))  # a row for each part
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    placed = at.withColumn("_part", part).join(F.broadcast(before), "_part")
    return placed.withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + 1).drop("_part", "_before", "_at"), at.seen["n"] or 0


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score of each row of docs (doc_id, text), and the rank of those drawn, else null.

    Drawn are ``percent`` of the rows with ``least_words`` words, rounded down. target: text.
    """
    rows = materialize(bucketed(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), ["row", "doc_id"]))
    gain = materialize(gains(bucket_counts(rows), bucket_counts(bucketed(target.select("text"), []))))
    each = rows.select("row", "doc_id", "n_words", F.size("buckets").cast("long").alias("n_features"), F.explode_outer("buckets").alias("bucket"))
    summed = each.join(F.broadcast(gain), "bucket", "left").groupBy("row", "doc_id", "n_words", "n_features").agg(F.coalesce(F.sum("gain"), F.lit(0)).alias("total"))
    weight = F.expr("(total - pmod(total, greatest(n_features, 1L))) div greatest(n_features, 1L)")
    scored = materialize(summed.select("row", "doc_id", "n_words", "n_features", weight.cast("long").alias("weight")).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    release(rows)
    placed, count = ranked(scored.filter(F.col("n_words") >= least_words), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")])
    names = ["doc_id", "n_features", "weight", "score"]
    drawn = placed.select(*names, F.when(F.col("rank") <= percent * count // 100, F.col("rank")).alias("rank"))
    return drawn.unionByName(scored.filter(F.col("n_words") < least_words).select(*names, F.lit(None).cast("long").alias("rank")))
