"""Approximate nearest neighbours by NN-descent and greedy graph search, by cosine.

Vectors of one direction (to six digits) are one node. A first graph comes from
blocks of vectors that are neighbours along random directions. Each round then
joins every node's neighbours and reverse neighbours with each other and keeps the
nearest found; a pair is only compared where one of the two is new, and only told
where it improves a list. A query walks the graph from its own node, or from the
best of a fixed number of pivots, always widening the nearest nodes not yet
widened. All rows of the nodes found that can be among its nearest are then
scored in double precision on the original vectors.

Edge cases: vectors that are null, zero, hold null or non-finite components, or
differ in length from most take no part, as queries too; scores that tie rank by
smaller id; rows are told apart even with one id or one vector, so a query's
neighbours may hold its own id from another row, and one id twice; with few vectors
all are returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab.llm.blocks import grouped
from fundlab.storage import materialize, release

#: Neighbours a node keeps; reverse ones it joins with them; blocks and directions of the first graph.
K, REVERSE, BLOCK, DIRECTIONS = 24, 12, 96, 4
ROUNDS, LEAST_CHANGE = 7, 0.002
#: Search: nodes kept and widened each step, steps, pivots.
POOL, WIDEN, STEPS, PIVOTS = 256, 64, 9, 256
#: Cosines of single precision, of directions equal to six digits, differ from exact ones by less.
ROUNDING = 2e-5
_PAIR = "node long, other long, score float, fresh boolean"


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def prepare(vectors: DataFrame, id_: str, vector: str, most_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """nodes (node, unit vector) of the distinct directions; all valid rows (row, id, node); and members (row, id, node,
    original vector), for each vector the ``most_rows`` rows of least id: a neighbour list of that length needs no others."""
    clean = vectors.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    clean = clean.filter(F.col("v").isNotNull() & ~F.exists("v", bad)).withColumn("norm", norm).filter((F.col("norm") > 0) & (F.col("norm") < float("inf")))
    usual = clean.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    clean = clean.filter(F.size("v") == (usual.d if usual else -1))
    direction = F.md5(F.to_json(F.struct(F.transform("v", lambda x: F.round(x / F.col("norm") * 1e6).cast("long")).alias("v"))))
    rows = materialize(clean.select(F.monotonically_increasing_id().alias("row"), "id", "v", "norm", F.xxhash64("v").alias("same"), F.xxhash64(direction).alias("node")))
    nth = F.row_number().over(Window.partitionBy("same", "v").orderBy("id", "row"))
    members = materialize(rows.withColumn("nth", nth).filter(F.col("nth") <= most_rows).select("row", "id", "node", "v", "norm", "nth"))
    one = members.filter("nth = 1").groupBy("node").agg(F.min_by(F.struct("v", "norm"), F.struct("id", "row")).alias("first"))
    nodes = materialize(one.select("node", F.transform("first.v", lambda x: (x / F.col("first.norm")).cast("float")).alias("v")))
    return nodes, rows, members.drop("norm", "nth")


def _top(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest others of each node; a pair told twice is fresh only if no list held it."""
    one = pairs.repartition("node").groupBy("node", "other").agg(F.max("score").alias("score"), F.min("fresh").alias("fresh"))
    nth = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "other"))
    return one.withColumn("nth", nth).filter(F.col("nth") <= k).drop("nth")


def _pairs(node, other, score, fresh=True) -> pa.RecordBatch:
    fresh = np.full(len(node), True) if fresh is True else fresh
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(other, pa.int64()), pa.array(score, pa.float32()), pa.array(fresh)], names=["node", "other", "score", "fresh"])


def _block_pairs(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def brute(node: np.ndarray, v: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(node) < 2:
                return
            s = v @ v.T
            np.fill_diagonal(s, -2)
            best = np.argsort(-s, axis=1, kind="stable")[:, : min(k, len(node) - 1)]
            yield _pairs(np.repeat(node, best.shape[1]), node[best].ravel(), np.take_along_axis(s, best, 1).ravel())

        for batch in batches:
            held.append((batch.column("node").to_numpy(), _vectors(batch.column("v"))))
            if sum(len(x[0]) for x in held) >= 2 * BLOCK:
                node, v = (np.concatenate(x) for x in zip(*held, strict=True))
                whole = (len(node) // BLOCK - 1) * BLOCK
                for a in range(0, whole, BLOCK):
                    yield from brute(node[a : a + BLOCK], v[a : a + BLOCK])
                held = [(node[whole:], v[whole:])]
        if held:
            yield from brute(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _first_graph(nodes: DataFrame, k: int) -> DataFrame:
    d = nodes.select(F.size("v").alias("d")).first()
    rng = np.random.default_rng(21)
    told = None
    for _ in range(DIRECTIONS):
        direction = rng.normal(size=d.d if d else 1)
        along = F.aggregate(F.zip_with("v", F.array(*[F.lit(float(x)) for x in direction]), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        laid = nodes.withColumn("along", along).repartitionByRange("along").sortWithinPartitions("along").drop("along")
        pairs = laid.mapInArrow(_block_pairs(k), _PAIR)
        told = pairs if told is None else told.union(pairs)
    return _top(told, k)


def _local_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs among the members of each group, where one is fresh and a list improves."""
    most = K + REVERSE
    for table in grouped(batches, "at", 1 << 14):
        at, member = table.column("at").to_numpy(), table.column("member").to_numpy()
        fresh, kth = table.column("fresh").to_numpy(zero_copy_only=False).astype(bool), table.column("kth").to_numpy()
        v = _vectors(table.column("v").combine_chunks())
        start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        n = np.diff(np.append(start, len(at)))
        for a in range(0, len(start), 512):
            s, m = start[a : a + 512], n[a : a + 512]
            width = int(min(most, m.max()))
            place = s[:, None] + np.minimum(np.arange(width)[None, :], m[:, None] - 1)
            real = np.arange(width)[None, :] < m[:, None]
            score = np.matmul(v[place], v[place].transpose(0, 2, 1))
            new = fresh[place] & real
            told = (new[:, :, None] | new[:, None, :]) & real[:, :, None] & real[:, None, :] & (score > kth[place][:, :, None]) & (member[place][:, :, None] != member[place][:, None, :])
            g, i, j = np.nonzero(told)
            if len(g):
                yield _pairs(member[place[g, i]], member[place[g, j]], score[g, i, j])


def build(nodes: DataFrame, k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """node, other, score: near the k nearest of each node."""
    graph = materialize(_first_graph(nodes, k))
    size = nodes.count()
    for _ in range(rounds):
        back = graph.select(F.col("other").alias("at"), F.col("node").alias("member"), "fresh", "score")
        nth = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), "member"))
        back = back.withColumn("nth", nth).filter(F.col("nth") <= REVERSE).drop("nth", "score")
        joined = graph.select(F.col("node").alias("at"), F.col("other").alias("member"), "fresh").union(back)
        joined = joined.groupBy("at", "member").agg(F.max("fresh").alias("fresh"))
        floor = graph.groupBy("node").agg(F.min("score").alias("low"), F.count("*").alias("n")).select("node", F.when(F.col("n") >= k, F.col("low")).otherwise(-2.0).cast("float").alias("kth"))
        carried = nodes.join(floor, "node").withColumnRenamed("node", "member")
        told = joined.join(carried, "member").select("at", "member", "fresh", "kth", "v").repartition("at").sortWithinPartitions("at")
        new = materialize(_top(graph.withColumn("fresh", F.lit(False)).union(told.mapInArrow(_local_join, _PAIR)), k))
        release(graph)
        graph = new
        if graph.filter("fresh").count() <= LEAST_CHANGE * k * size:
            break
    return graph.select("node", "other", "score")


def _best_pivots(pivots, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, v = pivots.value
        for batch in batches:
            score = _vectors(batch.column("v")) @ v.T
            best = np.argsort(-score, axis=1, kind="stable")[:, :most]
            yield _pairs(np.repeat(batch.column("query").to_numpy(), best.shape[1]), ids[best].ravel(), np.take_along_axis(score, best, 1).ravel())

    return run


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _pairs(batch.column("query").to_numpy(), batch.column("other").to_numpy(), (_vectors(batch.column("qv")) * _vectors(batch.column("v"))).sum(1))


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, pool: int = POOL, steps: int = STEPS) -> DataFrame:
    """query, other, score: the nearest nodes found for each query (query, node or null, unit vector v)."""
    spark = nodes.sparkSession
    draw = F.xxhash64(F.lit(8), "node")
    pivots = nodes.orderBy(draw).limit(PIVOTS).toArrow()  # a fixed number of vectors
    if not pivots.num_rows:
        return spark.createDataFrame([], "query long, other long, score float")
    ids, v = pivots.column("node").to_numpy(), _vectors(pivots.column("v").combine_chunks())
    shared = spark.sparkContext.broadcast((ids, v))
    started = queries.select("query", "v").mapInArrow(_best_pivots(shared, 8), _PAIR)
    own = queries.filter(F.col("node").isNotNull()).select("query", F.col("node").alias("other"), F.lit(1.0).cast("float").alias("score"), F.lit(True).alias("fresh"))
    back = F.row_number().over(Window.partitionBy("other").orderBy(F.desc("score"), "node"))
    reverse = graph.withColumn("nth", back).filter(F.col("nth") <= 2 * K)  # a node that very many have as a neighbour does not widen to all of them
    both_ways = materialize(graph.select("node", F.col("other").alias("next")).union(reverse.select(F.col("other").alias("node"), F.col("node").alias("next"))).distinct())
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "other"))
    found = materialize(started.withColumnRenamed("node", "query").union(own).groupBy("query", "other").agg(F.max("score").alias("score"), F.max("fresh").alias("fresh")))
    for _ in range(steps):
        ranked = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("fresh"), F.desc("score"), "other"))
        front = found.withColumn("n", ranked).filter((F.col("n") <= WIDEN) & F.col("fresh"))
        met = front.join(both_ways, front["other"] == both_ways["node"]).select("query", F.col("next").alias("other")).distinct()
        met = met.join(found.select("query", "other"), ["query", "other"], "left_anti")
        asked = met.join(nodes.select(F.col("node").alias("other"), "v"), "other").join(queries.select("query", F.col("v").alias("qv")), "query")
        scored = asked.mapInArrow(_scored, _PAIR).withColumnRenamed("node", "query")
        widened = front.select("query", "other", F.lit(True).alias("done"))
        old = found.join(widened, ["query", "other"], "left").select("query", "other", "score", (F.col("fresh") & F.col("done").isNull()).alias("fresh"))
        new = materialize(old.union(scored).withColumn("n", nth).filter(F.col("n") <= pool).drop("n"))
        release(found)
        found = new
        if not found.filter("fresh").limit(1).count():
            break
    return found.select("query", "other", "score")


def nearest(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows found for each row whose id ``every`` divides."""
    nodes, rows, members = prepare(vectors, id_, vector, k + 1)
    graph = build(nodes)
    asked = materialize(rows.filter(F.col("id") % every == 0).select("row", "id", "v", "node").join(nodes.select("node", F.col("v").alias("unit")), "node"))
    found = search(graph, nodes, asked.select(F.col("node").alias("query"), "node", F.col("unit").alias("v")).dropDuplicates(["query"]))
    near = Window.partitionBy("query").orderBy(F.desc("score"), "other")
    # Every node has a row: the nodes as near as the (k + 1)th, up to rounding, hold all rows that can rank.
    least = F.min(F.when(F.col("n") <= k + 1, F.col("score"))).over(Window.partitionBy("query"))
    found = found.withColumn("n", F.row_number().over(near)).withColumn("least", least).filter(F.col("score") >= F.col("least") - ROUNDING)
    held = members.withColumnRenamed("node", "other")
    pairs = asked.select(F.col("row").alias("query_row"), F.col("id").alias("query_id"), F.col("node").alias("query"), F.col("v").alias("qv"))
    pairs = pairs.join(found.select("query", "other"), "query").join(held, "other").filter(F.col("query_row") != F.col("row"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    cosine = dot("qv", "v") / (F.sqrt(dot("qv", "qv")) * F.sqrt(dot("v", "v")))
    scored = pairs.select("query_row", "query_id", "row", F.col("id").alias("vec_id"), cosine.alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
