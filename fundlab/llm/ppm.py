"""Language-model scores by prediction by partial matching over bytes.

The pretrained model is a trie of byte contexts of up to five bytes. A symbol not
seen in a context costs an escape (method C: as likely as the context's distinct
symbols) and is then sought in the next shorter one, without the symbols that
the longer ones would have coded. Byte 255, which no text holds, ends a text.

What a symbol costs depends on it and the five bytes before it only. So the trie
is never held anywhere: all distinct six-byte grams of the corpus are a table with
their counts; those with the same last three context bytes (at most 256 ** 3) meet
in one group, which the nodes of order two join as rows and those of order zero and
one (at most 256 ** 2) by broadcast; each group gives its grams' costs. A text adds
up the costs of its grams: frequent grams and words are looked up in tables of
bounded size that every task has, all others are joined. Counts cover every
training text whatever the size of the corpus, and scores do not depend on the
size of the tables of frequent ones. Words are told apart by 64-bit hashes.

Edge cases: a null text is empty and has only its end; an empty table gives an
empty result; without training texts every byte is equally likely; a null id is
never held out; repeated rows are counted and scored each; columns besides the
id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fundlab.llm.blocks import LOWER, SpanHash, blocks, grouped, merge_counts, mix, row_of, words
from fundlab.storage import materialize

END = 255
WORD, GRAM, TEXTS = 0, 1, 2
ORDER = 5
#: Most entries of the tables of frequent words and grams that every task holds; all others are joined.
FREQUENT_WORDS, FREQUENT_GRAMS = 1 << 19, 1 << 20
#: Distinct keys that a task gathers before it passes them on; grams that it costs at once (more where a group has more).
HELD, AT_ONCE = 1 << 20, 1 << 17
#: Bytes of texts that are counted and that are scored at once: every byte takes up to 100 bytes of working memory.
COUNTED, LOOKED_UP = 1 << 19, 1 << 18
_TAIL = "\n" * ORDER
_BYTE = np.uint64(8)


def _symbols(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The block's bytes after ORDER end symbols, with all tail bytes of each text as end symbols."""
    out = np.concatenate([np.full(ORDER, END, np.uint8), data])
    for k in range(ORDER):
        out[offsets[1:] + k] = END
    return out


def _unscored(offsets: np.ndarray) -> np.ndarray:
    """Positions of tail bytes after the first of each text."""
    return (offsets[1:, None] - np.arange(1, ORDER)[None, :]).ravel()


def grams(symbols: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Each symbol with the ``order`` symbols before it, the symbol in the lowest byte."""
    n = len(symbols) - order
    out = np.zeros(n, np.uint64)
    for k in range(order + 1):
        out = (out << _BYTE) | symbols[k : k + n]
    return out


def _low(keys: np.ndarray, order: int) -> np.ndarray:
    """The grams of an order that end these grams."""
    return keys & np.uint64((1 << (8 * (order + 1))) - 1)


class Gathered:
    """Counts by key that are passed on whenever too many are held."""

    def __init__(self, kind: int, taught: bool) -> None:
        self.kind, self.taught, self.parts, self.held = kind, taught, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(np.unique(keys, return_counts=True))
        self.held += len(self.parts[-1][0])
        if self.held > HELD:
            self.parts = [merge_counts(self.parts)]
            self.held = len(self.parts[0][0])
            if self.held > HELD // 2:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            keys, n = merge_counts(self.parts)
            self.parts, self.held = [], 0
            for a in range(0, len(keys), 1 << 16):
                yield _counted(self.kind, keys[a : a + (1 << 16)], n[a : a + (1 << 16)], self.taught)


def _counted(kind: int, keys: np.ndarray, n: np.ndarray, taught: bool) -> pa.RecordBatch:
    n = n.astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.uint64).view(np.int64)), pa.array(n * taught), pa.array(n)], names=["kind", "key", "n", "m"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    by_word, by_gram, texts = Gathered(WORD, True), {taught: Gathered(GRAM, taught) for taught in (True, False)}, 0
    for batch in batches:
        taught_ = batch.column("held_out").to_numpy(zero_copy_only=False) == False  # noqa: E712
        texts += int(taught_.sum())
        for taught in (True, False):
            part = batch.column("text").filter(pa.array(taught_ == taught))
            for _, _, data, offsets in blocks(part, COUNTED, _TAIL):
                yield from by_gram[taught].add(np.delete(grams(_symbols(data, offsets)), _unscored(offsets)))
                if taught:
                    lower = LOWER[data]
                    yield from by_word.add(SpanHash(lower)(*words(lower)))
    for gathered in (by_word, *by_gram.values()):
        yield from gathered.flush()
    yield _counted(TEXTS, np.zeros(1), np.array([texts]), True)


def gather(docs: DataFrame) -> DataFrame:
    """kind, key, n, m: counts in training texts and in all texts of symbols with their ORDER contexts,
    and in training texts of words (by 64-bit hash) and of the texts themselves. docs: text, held_out."""
    return docs.select("text", "held_out").mapInArrow(_count, "kind int, key long, n long, m long").groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


class Index:
    """Places of 64-bit keys: the keys' bijective hashes in order, with a table of where each prefix begins."""

    def __init__(self, keys: np.ndarray) -> None:
        hashes = mix(keys.astype(np.uint64))
        self.order = np.argsort(hashes).astype(np.int32)
        self.hashes = hashes[self.order]
        self.shift = np.uint64(64 - max(1, int(len(keys)).bit_length()))
        prefixes = 1 << (64 - int(self.shift))
        self.begin = np.searchsorted((self.hashes >> self.shift).astype(np.int64), np.arange(prefixes + 1)).astype(np.int32)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key among those given at first, or -1."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.hashes):
            return out
        h = mix(keys)
        prefix = (h >> self.shift).astype(np.int64)
        at, stop = self.begin[prefix], self.begin[prefix + 1]
        left = np.flatnonzero(at < stop)
        while len(left):
            here = at[left]
            hit = self.hashes[here] == h[left]
            out[left[hit]] = self.order[here[hit]]
            at[left] += 1
            left = left[~hit]
            left = left[at[left] < stop[left]]
        return out


class Level(NamedTuple):
    """The nodes of one order: sorted grams with counts; and by context the sum of counts, the number of
    symbols, and what the next shorter context has of both besides this one's symbols."""

    grams: np.ndarray
    n: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    kinds: np.ndarray
    rest: np.ndarray
    kinds_left: np.ndarray


def level(order: int, keys: np.ndarray, n: np.ndarray, below: Level | None) -> Level:
    """From sorted distinct grams; those of ``below`` include all that end them."""
    n = n.astype(np.float64)
    context = keys >> _BYTE
    start = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(keys) else np.zeros(0, np.int64)
    contexts, kinds = context[start], np.diff(np.append(start, len(keys))).astype(float)
    total = np.add.reduceat(n, start) if len(keys) else n
    rest, kinds_left = np.zeros(len(contexts)), np.zeros(len(contexts))
    if below is not None and len(keys):
        met = np.add.reduceat(below.n[np.searchsorted(below.grams, _low(keys, order - 1))], start)
        parent = np.searchsorted(below.contexts, _low(keys[start], order - 1) >> _BYTE)
        rest, kinds_left = below.total[parent] - met, below.kinds[parent] - kinds
    return Level(keys, n, contexts, total, kinds, rest, kinds_left)


def _find(among: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted array and whether they are there."""
    if not len(among):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return at, among[at] == keys


def costs(keys: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 probability of the last symbol of each gram of the longest order after its other symbols."""
    out, left = np.zeros(len(keys)), np.arange(len(keys))
    whole, kinds = np.zeros(len(keys)), np.zeros(len(keys))  # what the longer context left, where one was seen
    known = np.zeros(len(keys), bool)
    for d in range(len(levels) - 1, -1, -1):
        at, here = _low(keys, d), levels[d]
        place, hit = _find(here.grams, at)
        context, seen = _find(here.contexts, at >> _BYTE)
        if len(here.contexts):
            whole = np.where(known, whole, here.total[context] + here.kinds[context])
            kinds = np.where(known, kinds, here.kinds[context])
            out[left[hit]] += np.log10(here.n[place[hit]] / whole[hit])
            escape = seen & ~hit & (kinds > 0)
            out[left[escape]] += np.log10(kinds[escape] / whole[escape])
            kinds = np.where(seen, here.kinds_left[context], kinds)
            whole = np.where(seen, here.rest[context] + here.kinds_left[context], whole)
        known |= seen
        miss = ~hit
        left, keys, whole, kinds, known = left[miss], keys[miss], whole[miss], kinds[miss], known[miss]
    out[left] -= np.log10(max(1, 256 - len(levels[0].grams)))
    return out


def _summed(keys: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct grams of a shorter order that end these grams, with the sums of the counts above 0."""
    return merge_counts([(_low(keys[n > 0], order), n[n > 0])])


def _group_costs(shared):
    """Costs of the grams of whole groups: rows with depth ORDER are grams, those with depth 2 nodes of order two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low_keys, low_n = shared.value
        lowest = level(0, *_summed(low_keys, low_n, 0), None)
        low = level(1, low_keys, low_n, lowest)
        for table in grouped(batches, "at", AT_ONCE):
            deep = table.column("depth").to_numpy() == ORDER
            key, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
            two, first = np.unique(key[~deep], return_index=True)
            levels = [lowest, low, level(2, two, n[~deep][first], low)]
            keys, counts = key[deep], n[deep]
            for d in range(3, ORDER + 1):
                levels.append(level(d, *_summed(keys, counts, d), levels[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(costs(keys, levels)), table.column("m").combine_chunks().filter(pa.array(deep))], names=["key", "cost", "m"])

    return run


def gram_costs(by_gram: DataFrame) -> DataFrame:
    """key, cost, m of every gram (key, n, m)."""
    ending = lambda order: F.col("key").bitwiseAND(F.lit((1 << (8 * (order + 1))) - 1))
    shorter = lambda order: by_gram.filter("n > 0").groupBy(ending(order).alias("key")).agg(F.sum("n").alias("n"))
    low = shorter(1).orderBy("key").toArrow()  # at most 256 ** 2 rows
    shared = by_gram.sparkSession.sparkContext.broadcast((low["key"].to_numpy().astype(np.uint64), low["n"].to_numpy()))
    at = F.shiftright(F.col("key"), 8).bitwiseAND(F.lit((1 << 24) - 1))
    deep = by_gram.select(at.alias("at"), "key", "n", "m", F.lit(ORDER).alias("depth"))
    groups = deep.select("at", F.col("at").bitwiseAND(F.lit((1 << 16) - 1)).alias("context")).distinct()
    two = shorter(2).withColumn("context", F.shiftright(F.col("key"), 8))
    nodes = groups.join(two, "context").select("at", "key", "n", F.lit(0).cast("long").alias("m"), F.lit(2).alias("depth"))
    laid = deep.union(nodes).repartition("at").sortWithinPartitions("at")
    return laid.mapInArrow(_group_costs(shared), "key long, cost double, m long")


def _bin(n: str) -> Column:
    """Sixteen bins for each doubling of a count."""
    return F.floor(F.log2(n) * 16)


def least_bin(counts: DataFrame, n: str, most: int) -> int:
    """The least bin such that at most ``most`` counts lie in it and above."""
    least, total = 1 << 10, 0
    for bin_, k in sorted(map(tuple, counts.groupBy(_bin(n).alias("bin")).count().collect()), reverse=True):
        total += k
        if total > most:
            break
        least = bin_
    return least


_SCORED = "row long, doc_id {id}, held_out boolean, n_tokens long, n_known long, base double, score double, kind int, key long, tf long"


class Table:
    """Values of a bounded number of frequent keys."""

    def __init__(self, rows: pa.Table) -> None:
        self.index = Index(rows["key"].to_numpy().view(np.uint64))
        self.values = rows["value"].to_numpy()

    def add_up(self, keys: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By row the sum of the known keys' values and their number; and which keys are not known."""
        place = self.index(keys)
        known = place >= 0
        of = row if known.all() else row[known]
        return np.bincount(of, self.values[place[known]], minlength=n), np.bincount(of, minlength=n), ~known


def _distinct(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, row) with their numbers."""
    order = np.lexsort((keys, row))
    keys, row = keys[order], row[order]
    new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], row[new], np.diff(np.append(new, len(keys)))


def _score(tables, id_type: pa.DataType):
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "kind", "key", "tf"]
    types = [pa.int64(), id_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int64(), pa.int64()]
    schema = pa.schema(list(zip(names, types, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_word, by_gram = tables.value
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, last, data, offsets in blocks(batch.column("text"), LOOKED_UP, _TAIL):
                n = last - first
                ids = number + np.arange(n)
                number += n
                keep = np.ones(len(data), bool)
                keep[_unscored(offsets)] = False
                gram = grams(_symbols(data, offsets))[keep]
                gram_row = np.repeat(np.arange(n), np.diff(offsets) - (ORDER - 1))
                score, _, rare_gram = by_gram.add_up(gram, gram_row, n)
                lower = LOWER[data]
                start, end = words(lower)
                word, word_row = SpanHash(lower)(start, end), row_of(offsets, start)
                base, known, rare_word = by_word.add_up(word, word_row, n)
                yield _filled(schema, n, row=ids, doc_id=batch.column("doc_id").slice(first, n), held_out=batch.column("held_out").slice(first, n), n_tokens=np.bincount(word_row, minlength=n) + 1, n_known=known.astype(np.int64), base=base, score=score)
                for kind, keys, row in ((WORD, word[rare_word], word_row[rare_word]), (GRAM, gram[rare_gram], gram_row[rare_gram])):
                    key, of, tf = _distinct(keys, row)
                    yield _filled(schema, len(key), row=ids[of], kind=np.full(len(key), kind, np.int32), key=key.view(np.int64), tf=tf.astype(np.int64))

    return run


def _filled(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    """A batch with nulls in the columns that are not given."""
    arrays = [pa.nulls(n, f.type) if f.name not in columns else columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """Whether the id's text has that CRC-32 remainder; a null id has not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == rest, F.lit(False))


def scores(docs: DataFrame, mod: int = 7, rest: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    The documents whose id's CRC-32 leaves ``rest`` modulo ``mod`` teach nothing.
    """
    docs = docs.select("doc_id", "text", held_out(F.col("doc_id"), mod, rest).alias("held_out"))
    counts = materialize(gather(docs))
    by_word = counts.filter(F.col("kind") == WORD).select("key", "n")
    total, distinct = by_word.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = counts.filter(F.col("kind") == TEXTS).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tokens, kinds = total + ends, distinct + (ends > 0)
    unit = float(tokens + kinds + 1)
    by_gram = materialize(gram_costs(counts.filter(F.col("kind") == GRAM).select("key", "n", "m")))
    value = F.log10((F.col("n") + 1) / unit)
    least_word, least_gram = least_bin(by_word, "n", FREQUENT_WORDS), least_bin(by_gram, "m", FREQUENT_GRAMS)
    common = by_word.filter(_bin("n") >= least_word).select("key", value.alias("value")).toArrow(), by_gram.filter(_bin("m") >= least_gram).select("key", F.col("cost").alias("value")).toArrow()
    tables = docs.sparkSession.sparkContext.broadcast(tuple(map(Table, common)))
    kind = docs.schema["doc_id"].dataType
    rows = materialize(docs.mapInArrow(_score(tables, to_arrow_type(kind)), _SCORED.format(id=kind.simpleString())))
    others = by_word.filter(_bin("n") < least_word).select(F.lit(WORD).alias("kind"), "key", value.alias("value"))
    others = others.union(by_gram.filter(_bin("m") < least_gram).select(F.lit(GRAM), "key", "cost"))
    rare = rows.filter(F.col("key").isNotNull()).select("row", "kind", "key", "tf").join(others, ["kind", "key"], "left")
    word = F.col("kind") == WORD
    cost = F.col("tf") * F.coalesce("value", F.lit(float(-np.log10(unit))))
    rare = rare.groupBy("row").agg(F.sum(F.when(word, cost)).alias("rare_base"), F.sum(F.when(word & F.col("value").isNotNull(), F.col("tf"))).alias("rare_known"), F.sum(F.when(~word, cost)).alias("rare_score"))
    whole = rows.filter(F.col("key").isNull()).drop("kind", "key", "tf").join(rare, "row", "left")
    end = float(np.log10((ends + 1) / unit))
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0)) + int(ends > 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) + end).alias("base_score"), (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )
