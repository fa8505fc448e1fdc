"""Landed price files as a stream that merges into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fundlab.operators.store import exists, read_table, upsert

NAV_SCHEMA = "scheme_code string, nav_date date, nav double"
#: Prices with the moment their file was published: of several prices of a day the latest published counts.
PUBLISHED_SCHEMA = NAV_SCHEMA + ", published timestamp"


def nav_stream(spark: SparkSession, landing: str) -> DataFrame:
    return spark.readStream.schema(NAV_SCHEMA).parquet(landing)


def merge_stream(stream: DataFrame, table: str, checkpoint: str, key: tuple[str, ...] = ("scheme_code", "nav_date")) -> StreamingQuery:
    """Merge each batch of new files by key; a batch that is run again gives the same table."""

    def merge(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            upsert(batch, table, list(key))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def marks_of(rows: DataFrame, key: str = "scheme_code", mark: str = "nav_date", version: str = "published") -> DataFrame:
    """For each key the least and the greatest mark and the latest version of rows."""
    return rows.groupBy(key).agg(F.min(mark).alias("low"), F.max(mark).alias("high"), F.max(version).alias("latest"))


def merge_published(stream: DataFrame, table: str, checkpoint: str, key: tuple[str, ...] = ("scheme_code", "nav_date"), version: str = "published") -> StreamingQuery:
    """Merge each batch of new files by key and keep high-water marks in ``{table}_marks``.

    A row gives way only to one of a later version, so files may come in any order and any
    number of times: the table is that of one batch over all files. Each batch rewrites the files that hold its keys only. Marks are
    widened, never narrowed, after the table has the batch; a batch that is run again after a crash changes neither.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        upsert(batch, table, list(key), version=version)
        new = marks_of(batch, key[0], key[1], version)
        marks = f"{table}_marks"
        old = known_marks(spark, table, new)
        both = old.unionByName(new).groupBy(key[0]).agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("latest").alias("latest"))
        upsert(both.join(new.select(key[0]), key[0], "left_semi"), marks, [key[0]])

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def known_marks(spark: SparkSession, table: str, like: DataFrame) -> DataFrame:
    """The marks of a table; none before its first batch."""
    marks = f"{table}_marks"
    return read_table(spark, marks).select(*like.columns) if exists(spark, marks) else like.limit(0)


def to_load(landed: DataFrame, marks: DataFrame, tail: int = 0, key: str = "scheme_code", mark: str = "nav_date") -> DataFrame:
    """The landed rows beyond their key's high-water mark, and of the ``tail`` days up to it, which are looked at again; keys without a mark whole."""
    known = marks.select(key, F.col("high").alias("_high"))
    return landed.join(known, key, "left").filter(F.col("_high").isNull() | (F.col(mark) > F.date_sub("_high", tail))).drop("_high")
