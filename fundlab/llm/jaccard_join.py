"""Exact Jaccard join of documents on their sets of five-word shingles.

Two texts link when 100 times their common shingles are at least ``percent`` times the
shingles of either. In one order of all shingles a text of n shingles that must share o
with any partner keeps a prefix: its first n - o + l. Of a pair the shorter text must share more
than that with a longer one, so its prefix is shorter. Texts that link then share at
least l shingles of their prefixes, whatever l is. Each text chooses its own l: a longer
prefix meets more lists, but candidates must share l of them, so the choice weighs the rows
of the lists that it would meet against the candidates that can be left over, whose texts are compared.
A pair is judged by the lesser l of its two texts, on the prefixes for that l: by the number of shared
shingles that its sizes ask for there, and by what the texts can share up to a common one and have left after it.

Any order is right; the shingles that many texts hold go last, by counts in CELLS hashed
cells over all texts. Equal texts are one node from the start. Pairs within a component
need no comparison, so in lists of more than SMALL_LIST texts each text is first compared with the
list's most central text, then in ROUNDS rounds the texts of other components with the largest ones'
centres. The join itself is over all lists and leaves out only pairs of one component.
Links are confirmed on the whole sets. Lists of very frequent shingles are dealt to
blocks.

Edge cases: letters A to Z count as lower case; a text of one to four words is one shingle;
null texts and texts without words have no shingles, link with nothing and are their own
components; rows of one text are one component, also with one id; a component's id is
the least id of its rows, null if all are null; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab.llm.blocks import blocks
from fundlab.llm.graph import components
from fundlab.llm.near_dup import shingles
from fundlab.skew import join_unique, key_counts
from fundlab.storage import materialize, release

PERCENT = 80
#: The largest l a text can choose.
MOST_SHARED = 8
#: Comparing two texts costs so many rows of a list for each shingle, times the share of candidates that their sizes and places do not rule out.
COMPARE = 0.005
CELLS = 1 << 20
SMALL_LIST, ROUNDS, LIST_BLOCK = 16, 1, 1 << 11
#: Shingles that a task keeps while it compares pairs, and pairs whose texts it holds at once.
KEPT, AT_ONCE = 1 << 21, 1 << 7


def _cell(key: np.ndarray) -> np.ndarray:
    return ((key >> np.uint64(40)) & np.uint64(CELLS - 1)).astype(np.int64)


def least_shared(n, percent: int):
    """The fewest shingles that a set of n shares with any partner."""
    return (percent * n + 99) // 100


def _shared_by_both(sizes: Column, percent: int) -> Column:
    """The fewest shingles that two sets of so many in all share."""
    return F.floor((sizes * percent + 99 + percent) / (100 + percent))


def _cell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CELLS, np.int64)
    for batch in batches:
        for _, _, data, offsets in blocks(batch.column("text")):
            key, _, _ = shingles(data, offsets)
            np.add.at(counts, _cell(key), 1)
    held = np.flatnonzero(counts)
    for at in range(0, len(held), 1 << 16):
        part = held[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(counts[part])], names=["cell", "n"])


def frequencies(docs: DataFrame) -> np.ndarray:
    """How many shingles of the texts fall into each cell. The driver gets at most CELLS rows whatever the corpus."""
    found = docs.select("text").mapInArrow(_cell_counts, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CELLS, np.int64)
    counts[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return counts


def _prefixes(shared, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for first, last, data, offsets in blocks(batch.column("text")):
                key, row, _ = shingles(data, offsets)
                key = key[np.lexsort((key, counts[_cell(key)], row))]
                n = np.bincount(row, minlength=last - first)
                place = np.arange(len(key)) - (np.cumsum(n) - n)[row]
                on = place < (n - least_shared(n, percent) + MOST_SHARED)[row]
                cut = np.concatenate([[0], np.cumsum(np.bincount(row[on], minlength=last - first))])
                tokens = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(key[on].view(np.int64)))
                rows = [batch.column(c).slice(first, last - first) for c in ("row", "doc_id", "digest")]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(n, pa.int64()), tokens], names=["row", "doc_id", "digest", "n", "tokens"])

    return run


def prefixes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """row, doc_id, digest (of the text), n (its shingles) and its longest prefix, in order, of each row of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequencies(docs))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "text")
    return rows.mapInArrow(_prefixes(shared, percent), f"row long, doc_id {kind}, digest string, n long, tokens array<long>")


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0

        def keys(node: int, text: str) -> np.ndarray:
            nonlocal size
            if node not in held:
                if size > KEPT:
                    held.clear()
                    size = 0
                data = np.frombuffer(text.encode() + b"\n", np.uint8)
                held[node] = shingles(data, np.array([0, len(data)]))[0]
                size += len(held[node])
            return held[node]

        def links(part: pa.RecordBatch) -> Iterator[bool]:
            for a, b, x, y in zip(*(part.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                one, two = keys(a, x), keys(b, y)
                common = len(np.intersect1d(one, two, assume_unique=True))
                yield 100 * common >= percent * (len(one) + len(two) - common)

        for batch in batches:
            on = [linked_ for at in range(0, batch.num_rows, AT_ONCE) for linked_ in links(batch.slice(at, AT_ONCE))]
            yield batch.select(["a", "b"]).filter(pa.array(on, pa.bool_()))

    return run


def linked(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) of nodes (node, digest) that link. Only the texts of these pairs travel."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = materialize(asked.join(nodes.select("node", "digest"), "node"), n=F.count(F.lit(1)))
    rows = docs.select("doc_id", "text", F.md5("text").alias("digest")).filter("text is not null")
    texts = join_unique(rows, wanted, ["digest"], rows=wanted.seen["n"]).groupBy("node").agg(F.first("text").alias("text"))
    texts = materialize(texts)
    sides = [texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}")) for side in "ab"]
    both = join_unique(join_unique(pairs, sides[0], ["a"], wide=True), sides[1], ["b"], wide=True, counts=key_counts(pairs, ["b"]))
    out = materialize(both.mapInArrow(_linked(percent), "a long, b long"), n=F.count(F.lit(1)))
    for used in (wanted, texts):
        release(used)
    return out


def _alike(n: str, other: str, percent: int):
    """Sizes that allow a link."""
    return F.least(n, other) * 100 >= F.greatest(n, other) * percent


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def lists(rows: DataFrame, percent: int) -> DataFrame:
    """token, node, n, pos, as_long, as_short, held for the prefix shingles that ``held`` > 1 nodes (row, n, tokens) have.

    pos counts from 1; as_long and as_short are the least l whose prefix has it, in pairs with a shorter and with a longer text.
    """
    layer = lambda share: F.greatest(F.lit(1), F.col("pos") - F.col("n") + share).cast("int")
    entries = rows.select(F.col("row").alias("node"), "n", F.posexplode("tokens").alias("at", "token")).withColumn("pos", F.col("at") + 1)
    entries = entries.select("token", "node", "n", "pos", layer(F.floor((F.col("n") * percent + 99) / 100)).alias("as_long"), layer(_shared_by_both(2 * F.col("n"), percent)).alias("as_short"))
    held = key_counts(entries, ["token"])
    return join_unique(entries, held.filter("n > 1").withColumnRenamed("n", "held"), ["token"], wide=True, counts=held)


def _placed(entries: DataFrame, group: DataFrame) -> DataFrame:
    """The entries of the lists that hold several components, with their component, the list's main one and its rows there."""
    placed = materialize(entries.join(group, "node", "left").withColumn("component", F.coalesce("component", "node")))
    parts = placed.groupBy("token", "component").agg(F.count("*").alias("n_same"))
    shares = parts.groupBy("token").agg(F.max(F.struct("n_same", "component")).alias("m"), F.count("*").alias("kinds")).filter("kinds > 1")
    shares = materialize(shares.select("token", F.col("m.component").alias("main"), F.col("m.n_same").alias("n_main")), n=F.count(F.lit(1)))
    out = materialize(join_unique(placed, shares, ["token"], rows=shares.seen["n"]), n=F.count(F.lit(1)))
    release(placed)
    return out


def _stars(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs of each text of the large lists and the most central one, by the rows of the lists that it is in."""
    weight = entries.groupBy("node").agg(F.sum("held").alias("weight"))
    weighed = materialize(entries.join(weight, "node"))
    hubs = weighed.groupBy("token").agg(F.max(F.struct("weight", "node", "n")).alias("hub"))
    pairs = join_unique(weighed, hubs, ["token"], wide=True).filter((F.col("node") != F.col("hub.node")) & _alike("n", "hub.n", percent))
    return pairs.select(*_pair("node", "hub.node")).distinct()


def _between_centres(placed: DataFrame, percent: int) -> DataFrame:
    """Pairs of the texts outside a list's main component and its centre, and of the main one's texts and the centre of the largest other one."""
    weight = placed.groupBy("node").agg(F.sum("held").alias("weight"))
    weighed = materialize(placed.join(weight, "node"))
    parts = weighed.groupBy("token", "component").agg(F.first("main").alias("main"), F.count("*").alias("rows"), F.max(F.struct("weight", "node", "n")).alias("hub"))
    both = parts.groupBy("token").agg(F.max_by("hub", F.col("component") == F.col("main")).alias("main_hub"), F.max(F.when(F.col("component") != F.col("main"), F.struct("rows", "hub"))).alias("other"))
    joined = join_unique(weighed, materialize(both.select("token", "main_hub", F.col("other.hub").alias("other_hub"))), ["token"], wide=True)
    hub = F.when(F.col("component") == F.col("main"), F.col("other_hub")).otherwise(F.col("main_hub"))
    return joined.select("node", "n", hub.alias("hub")).filter(_alike("n", "hub.n", percent)).select(*_pair("node", "hub.node")).distinct()


def chosen(placed: DataFrame, percent: int) -> DataFrame:
    """placed, with the l that each text takes, by the rows of other components in the lists that it meets, and with
    the rank of each entry among the text's entries: what stands in no list of another component is shared with none."""
    others = F.col("held") - F.when(F.col("component") == F.col("main"), F.col("n_main")).otherwise(F.lit(1))
    of_node = Window.partitionBy("node")
    met = lambda k: F.sum(F.when(F.col("as_long") <= k, others).otherwise(0)).over(of_node)
    shared = F.floor((F.col("n") * percent + 99) / 100)
    met_by = placed.withColumns({"rank": F.row_number().over(of_node.orderBy("pos"))} | {f"met_{k}": met(k) for k in range(1, MOST_SHARED + 1)})
    costs = [F.when(shared >= k, F.struct((F.col(f"met_{k}") * (1 + COMPARE * F.col("n") / k)).alias("cost"), F.lit(k).alias("l"))) for k in range(1, MOST_SHARED + 1)]
    return met_by.select(*placed.columns, "rank", F.least(*costs)["l"].alias("l"))


def candidates(placed: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of nodes of different components whose prefixes, for the lesser l of both, do not rule a link out.

    Of the pair the longer text (of equal ones the one of the greater node) must share o shingles
    with any other, the shorter one s with any longer one, and both together w with each other. So all but the last w - max(o, s) + l
    shared shingles stand in both prefixes, and after the last one there both texts must have enough left for w.
    """
    rows = chosen(placed, percent).filter(F.col("as_long") <= F.col("l"))
    rows = materialize(rows.withColumn("blocks", F.ceil(F.col("held") / LIST_BLOCK).cast("int")).drop("held", "n_main"))
    one = rows.filter(F.col("component") != F.col("main")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    one = one.select("token", "block", *[F.col(c).alias(f"{c}_x") for c in ("node", "n", "pos", "rank", "as_long", "as_short", "l", "component")])
    two = rows.withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    once = (F.col("component") == F.col("main")) | (F.col("node_x") < F.col("node"))
    l = F.least("l", "l_x")  # noqa: E741
    longer = (F.col("n") > F.col("n_x")) | ((F.col("n") == F.col("n_x")) & (F.col("node") > F.col("node_x")))
    inside = F.when(longer, F.greatest("as_long", "as_short_x")).otherwise(F.greatest("as_short", "as_long_x")) <= l
    both = _shared_by_both(F.col("n") + F.col("n_x"), percent)
    after = F.least(F.col("n") - F.col("pos"), F.col("n_x") - F.col("pos_x"))
    met = one.join(two, ["token", "block"]).filter((F.col("component") != F.col("component_x")) & once & _alike("n", "n_x", percent) & inside & (F.least("rank", "rank_x") + after >= both))
    least = both - F.greatest(F.floor((F.greatest("n", "n_x") * percent + 99) / 100), _shared_by_both(2 * F.least("n", "n_x"), percent)) + l
    shared = met.select(*_pair("node", "node_x"), least.alias("least"), both.alias("both"), after.alias("after")).groupBy("a", "b")
    shared = shared.agg(F.count("*").alias("shared"), F.first("least").alias("least"), F.first("both").alias("both"), F.min("after").alias("after"))
    return shared.filter((F.col("shared") >= F.col("least")) & (F.col("shared") + F.col("after") >= F.col("both"))).select("a", "b")


def links(docs: DataFrame, rows: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between nodes, enough to connect all that link, and the nodes' groups (node, component). rows: prefixes() of docs, written."""
    nodes = rows.filter("n > 0").groupBy("digest").agg(F.min("row").alias("node"))
    nodes = materialize(nodes, n=F.count(F.lit(1)))
    whole = rows.join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    entries = materialize(lists(whole, percent), large=F.count_if(F.col("held") > SMALL_LIST))
    tried = found = group = None

    def try_pairs(pairs: DataFrame) -> bool:
        """Add the links among the pairs not tried yet; whether there are any."""
        nonlocal tried, found, group
        new = materialize(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), n=F.count(F.lit(1)))
        fresh = linked(new, docs, nodes, percent) if new.seen["n"] else None
        tried = new if tried is None else tried.union(new)
        if fresh is None or not fresh.seen["n"]:
            return False
        found = fresh if found is None else found.union(fresh)
        group = components(found)
        return True

    none = docs.sparkSession.createDataFrame([], "node long, component long")
    large = entries.filter((F.col("held") > SMALL_LIST) & (F.col("as_long") == 1))
    if entries.seen["large"] and try_pairs(_stars(large, percent)):
        for _ in range(ROUNDS):
            mixed = _placed(large, group)
            if not mixed.seen["n"] or not try_pairs(_between_centres(mixed, percent)):
                break
    placed = _placed(entries, none if group is None else group)
    if placed.seen["n"]:
        try_pairs(candidates(placed, percent))
    for used in (entries, placed):
        release(used)
    empty = docs.sparkSession.createDataFrame([], "a long, b long")
    return (empty, none) if found is None else (found, group)


def joined(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the least id that links reach) of each row of docs (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    rows = materialize(prefixes(docs, percent))
    _, group = links(docs, rows, percent)
    nodes = rows.filter("n > 0").groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"))
    labelled = nodes.join(group, "node", "left").select("digest", F.coalesce("component", "node").alias("component"), "least")
    labelled = materialize(labelled)
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = join_unique(labelled.select("digest", "component"), materialize(least), ["component"]).select("digest", "component_id")
    out = join_unique(rows.filter("n > 0").select("row", "doc_id", "digest", "n"), materialize(named), ["digest"])
    wordless = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(wordless)
