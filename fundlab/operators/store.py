"""Tables as Parquet with keys: merge, replace, update, per-category outputs.

A change of a table is first written beside its files, in a hidden folder; then a small hidden
commit file names the files that come and go; then they are moved and deleted. A crash before
the commit file changes nothing, a crash after it is carried out by the next writer, and
read_table() sees either all of a change or nothing of it at any moment. One writer at a time; a
frame that was read before a change is read anew after it.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab.functions.text import slug
from fundlab.storage import materialize, release


def merged(old: DataFrame, new: DataFrame, key: list[str], version: str | None = None) -> DataFrame:
    """old and new by key; the new row wins, and of several new ones the first by all columns.

    With a version column the row of the highest version wins, whichever side it is on; equal versions as above.
    """
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    first = [F.desc_nulls_last(version)] if version else []
    order = Window.partitionBy(*key).orderBy(*first, F.desc("_new"), *[c for c in new.columns if c not in key])
    return both.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n", "_new")


def updated(old: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """old with the columns of changes where the key matches and the new value is not null."""
    names = [c for c in changes.columns if c not in key]
    renamed = changes.select(*key, *[F.col(c).alias(f"_u_{c}") for c in names])
    joined = old.join(renamed, key, "left")
    for c in names:
        joined = joined.withColumn(c, F.coalesce(f"_u_{c}", c) if c in old.columns else F.col(f"_u_{c}"))
    return joined.drop(*[f"_u_{c}" for c in names])


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its constructor of paths."""
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), to_path


def _listed(spark: SparkSession, path: str, hidden: bool = False) -> list[str]:
    """The Parquet files below a folder, relative to it; those in hidden folders only if it is one itself."""
    files, to_path = _files(spark, path)
    if not files.exists(to_path(path)):
        return []
    root = files.makeQualified(to_path(path)).toString().rstrip("/")
    each, out = files.listFiles(to_path(path), True), []
    while each.hasNext():
        name = each.next().getPath().toString()[len(root) + 1 :]
        if name.endswith(".parquet") and not any(part[0] in "_." for part in name.split("/")):
            out.append(name)
    return sorted(out)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has files, or a commit that names some."""
    return bool(_listed(spark, path) or _commits(spark, path))


def _commits(spark: SparkSession, path: str) -> list[str]:
    files, to_path = _files(spark, path)
    found = files.globStatus(to_path(f"{path.rstrip('/')}/_commit-*"))
    return sorted(f.getPath().getName() for f in found) if found else []


def _commit(spark: SparkSession, path: str, staged: str, add: list[str], remove: list[str]) -> str:
    """Write the commit file of a change; from here on it counts."""
    files, to_path = _files(spark, path)
    name = f"_commit-{uuid.uuid4().hex}"
    draft = to_path(f"{path.rstrip('/')}/_draft-{name}")
    out = files.create(draft)
    out.write(bytearray(json.dumps({"staged": staged, "add": add, "remove": remove}).encode()))
    out.close()
    if not files.rename(draft, to_path(f"{path.rstrip('/')}/{name}")):
        raise OSError(f"cannot commit a change of {path}")
    return name


def _change(spark: SparkSession, path: str, name: str) -> dict:
    files, to_path = _files(spark, path)
    stream = files.open(to_path(f"{path.rstrip('/')}/{name}"))
    try:
        return json.loads(bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


def _apply(spark: SparkSession, path: str, name: str) -> None:
    """Carry out a committed change; what is done already is passed over."""
    files, to_path = _files(spark, path)
    change, root = _change(spark, path, name), path.rstrip("/")
    for file in change["add"]:
        target = to_path(f"{root}/{file}")
        if not files.exists(target):
            files.mkdirs(target.getParent())
            if not files.rename(to_path(f"{root}/{change['staged']}/{file}"), target):
                raise OSError(f"cannot move {file} into {path}")
    for file in change["remove"]:
        files.delete(to_path(f"{root}/{file}"), False)
    files.delete(to_path(f"{root}/{change['staged']}"), True)
    files.delete(to_path(f"{root}/{name}"), False)


def _stage(df: DataFrame, path: str, partition: str | None = None) -> tuple[str, list[str]]:
    """Write rows into a hidden folder of a table: its name, its files."""
    staged = f"_staged-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition) if partition else writer).parquet(f"{path.rstrip('/')}/{staged}")
    return staged, _listed(df.sparkSession, f"{path.rstrip('/')}/{staged}")


def write_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Replace a table, also one that df reads."""
    spark = df.sparkSession
    recover(spark, path)
    staged, add = _stage(df, path, partition)
    _apply(spark, path, _commit(spark, path, staged, add, [f for f in _listed(spark, path) if f not in add]))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table as its last commit left it, also while that commit is carried out."""
    root = path.rstrip("/")
    while True:
        commits = _commits(spark, path)
        changes = [_change(spark, path, c) for c in commits]
        there = _listed(spark, path)
        if commits == _commits(spark, path):
            break
    gone = {f for c in changes for f in c["remove"]}
    sides = {root: [f for f in there if f not in gone]} | {f"{root}/{c['staged']}": [f for f in c["add"] if f not in there] for c in changes}
    read = [spark.read.option("basePath", base).parquet(*[f"{base}/{f}" for f in files]) for base, files in sides.items() if files]
    return reduce(DataFrame.unionByName, read) if read else spark.read.parquet(path)


def _aside(path: str) -> str:
    return f"{path.rstrip('/')}.before"


def recover(spark: SparkSession, path: str) -> None:
    """After a crash: carry out what is committed, drop what is not; a table that was moved aside returns, or goes if another is there."""
    files, to_path = _files(spark, path)
    kept = to_path(_aside(path))
    if files.exists(kept):
        if files.exists(to_path(path)):
            files.delete(kept, True)
        else:
            files.rename(kept, to_path(path))
    for name in _commits(spark, path):
        _apply(spark, path, name)
    for left in files.globStatus(to_path(f"{path.rstrip('/')}/_staged-*")) or []:
        files.delete(left.getPath(), True)


def replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace only the partitions that df has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(partition).parquet(path)


def _bounds(key: list[str], new: DataFrame) -> tuple[list[str], dict[str, Column]]:
    """The key columns with an order, and what to watch while new is written: their bounds and the number of rows."""
    kinds = dict(new.dtypes)
    plain = [k for k in key if kinds[k] in ("string", "date", "timestamp", "int", "bigint", "smallint", "double")]
    return plain, {f"{what}_{k}": f(k) for k in plain for what, f in (("low", F.min), ("high", F.max))} | {"rows": F.count(F.lit(1))}


def touched_files(old: DataFrame, new: DataFrame, key: list[str]) -> list[str]:
    """The paths of the files of old that hold a key of new; null keys are equal. Only the key columns are read."""
    keys = new.select(*[F.col(k).alias(f"_k_{k}") for k in key])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key])
    held = old.select(*key, F.col("_metadata.file_path").alias("_file"))
    return [r[0] for r in held.join(keys, same, "left_semi").select("_file").distinct().collect()]


def upsert(new: DataFrame, path: str, key: list[str], partition: str | None = None, version: str | None = None) -> None:
    """new merged into a table by key (see merged); null keys are equal.

    With a partition column that is part of the key, only the partitions that new has rows
    for are read and written again. Else only the files that hold one of new's keys are: keys
    outside new's range are not read where the files' statistics allow, all other files stay as they are.
    """
    spark = new.sparkSession
    recover(spark, path)
    if not _listed(spark, path):
        one = merged(new.limit(0), new, key, version)
        return write_table(one, path, partition)
    if partition and partition in key:
        old = read_table(spark, path)
        touched = materialize(new.select(partition).distinct())
        old = old.join(touched, partition, "left_semi").select(*old.columns)
        rows = materialize(merged(old, new, key, version))
        staged, add = _stage(rows, path, partition)
        folders = {f.rpartition("/")[0] for f in add}
        _apply(spark, path, _commit(spark, path, staged, add, [f for f in _listed(spark, path) if f.rpartition("/")[0] in folders]))
        release(rows)
        return
    plain, watched = _bounds(key, new)
    rows = materialize(merged(new.limit(0), new, key, version), **watched)
    if rows.seen["rows"]:
        old, seen = read_table(spark, path), rows.seen
        inside = [F.col(k).isNull() | F.col(k).between(F.lit(seen[f"low_{k}"]), F.lit(seen[f"high_{k}"])) for k in plain if seen[f"low_{k}"] is not None]
        held = touched_files(reduce(DataFrame.filter, inside, old), rows, key)
        files, to_path = _files(spark, path)
        root = files.makeQualified(to_path(path)).toString().rstrip("/")
        held = [to_path(spark.sparkContext._jvm.java.net.URI(f)).toString() for f in held]
        again = spark.read.option("basePath", path).parquet(*held).select(*old.columns) if held else None
        staged, add = _stage(merged(rows.limit(0) if again is None else again, rows, key, version), path, partition)
        remove = sorted(files.makeQualified(to_path(f)).toString()[len(root) + 1 :] for f in held)
        _apply(spark, path, _commit(spark, path, staged, add, remove))
    release(rows)


def with_file_names(df: DataFrame, category: str = "canonical_category") -> DataFrame:
    """df with category_file, the file name of each category: its letters and digits; categories that would share one get a suffix."""
    names = df.select(F.col(category).alias("_category")).distinct().withColumn("category_file", slug(F.coalesce("_category", F.lit("none"))))
    shared = F.count("*").over(Window.partitionBy("category_file")) > 1
    names = names.withColumn("category_file", F.when(shared, F.concat_ws("_", "category_file", F.substring(F.md5("_category"), 1, 6))).otherwise(F.col("category_file")))
    return df.join(F.broadcast(names), F.col(category).eqNullSafe(F.col("_category"))).drop("_category")  # one row for each category


def write_by_category(df: DataFrame, path: str, category: str = "canonical_category") -> None:
    """CSV and Parquet folders with one part for each category's file name."""
    named = with_file_names(df, category).repartition("category_file")
    named.write.mode("overwrite").partitionBy("category_file").option("compression", "zstd").parquet(f"{path}/parquet")
    named.write.mode("overwrite").partitionBy("category_file").option("header", True).csv(f"{path}/csv")


def write_sheet(df: DataFrame, path: str, order: list) -> None:
    """A small sheet as one CSV file in that order; without rows it has its heading all the same."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def add_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with exactly these columns, in order and of these types; those that are not there are null."""
    return df.select(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])
