"""Intermediate results in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only in local mode."""
    context = spark.sparkContext
    if folder := context.getCheckpointDir():
        return folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "/tmp/checkpoints/fundlab"
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def materialize(df: DataFrame, **seen: Column) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    This cuts the lineage like a reliable checkpoint: the rows outlive the loss
    of any executor, and later plans read only the columns they need. The files
    go when the Python process ends, or with release(). ``seen`` are aggregates that
    are taken while the rows are written, without a further job: ``out.seen`` holds them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/t-{uuid.uuid4().hex}"
    watch = Observation() if seen else None
    (df.observe(watch, *[c.alias(k) for k, c in seen.items()]) if seen else df).write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._fundlab_path = path
    out.seen = watch.get if seen else {}
    return out


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder; what is written there goes when the Python process ends."""
    path = f"{shared_dir(spark).rstrip('/')}/t-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def release(df: DataFrame) -> None:
    """Delete the files behind a frame that materialize() returned."""
    path = getattr(df, "_fundlab_path", None)
    for entry in [x for x in _written if x[1] == path]:
        _delete(*entry)
        _written.remove(entry)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@atexit.register
def _release_all() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # this session is gone; another one may still have files
            continue
