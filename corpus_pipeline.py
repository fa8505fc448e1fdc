"""A corpus pipeline: quality rules, near-duplicate removal, redaction, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it
kept, and returns the columns of documents (the last one: packed pieces). Rows with
nulls, equal ids or no text go through every stage as its operator defines them:
a row without words fails the quality rules; alone it stays in the others, with no
words in the mix and one token in the packing. Further columns pass through the first
four stages whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlab.llm import mixing, near_dup, packing, pii, quality_rules
from fundlab.session import reachable
from fundlab.skew import hashed, join_unique
from fundlab.storage import materialize, release


def _whole(docs: DataFrame) -> Column:
    """A row as one value, which no column of a stage can clash with."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    limit = materialize(quality_rules.limits(quality_rules.measured(docs, ["lang", "source"])))
    measures = quality_rules.measured(docs.select(_whole(docs), "text", "lang", "source"), ["_doc", "lang", "source"])
    return quality_rules.judge(measures, limit).filter("kept").select("_doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the least id (null last), then the least text digest.

    Rows of one id and one text are copies: the one with the least further columns stays. Texts without words all stay.
    """
    grouped = materialize(near_dup.groups(docs))
    key = lambda id_: F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit("")).alias("id")
    chosen = grouped.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("c"))
    chosen = materialize(chosen.select(key(F.col("c.doc_id")), F.col("c.digest").alias("digest")))
    whole = docs.select(_whole(docs), hashed(docs).alias("row"), key(F.col("doc_id")), F.md5("text").alias("digest"), F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]").alias("worded"))
    kept = join_unique(whole.filter("worded").drop("worded"), chosen, ["id", "digest"], "left_semi", wide=True, counts=materialize(grouped.groupBy(key(F.col("doc_id")), "digest").agg(F.count("*").alias("n"))))
    kept = kept.groupBy("id", "digest").agg(F.min_by("_doc", "row").alias("_doc"))
    release(grouped)
    return kept.select("_doc").union(whole.filter(~F.col("worded")).select("_doc")).select("_doc.*")


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and secrets replaced by their kind."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: sources at weights 1, 2, 3 by name."""
    rows, _ = mixing.mix(mixing.keyed(docs.select(_whole(docs), "doc_id", "text", "lang", "source"), "_doc"))
    return rows.filter("copies > 0").select("_doc", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("_doc.*")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 4096 tokens: one row for each piece of a document."""
    return packing.pack(packing.tokenize(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality), ("near duplicates", near_duplicates), ("personal data", redaction), ("mixing", mixture), ("packing", sequences),
]
#: SQL can express neither sampled signatures nor tokens; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over documents, each written to the shared folder and read again.

    A stage's files go when the next one's are written; the last one's when the Python process ends.
    """
    reachable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        done = materialize(stage(spark, docs, sf_dir))
        release(docs)
        docs = done
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
