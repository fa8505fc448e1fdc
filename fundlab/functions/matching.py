"""Fuzzy matching of printed names within blocks, exact at any size of a block.

The printed names of a block are a query set that is searched against all its candidates in
tiles. In a tile two products of incidence matrices, one over words and one over the letter
pairs inside words, give for every printed name and candidate the length of the shared words,
from which most of the score follows, and a sound upper bound of the rest: an alignment
that leaves d letters of one side and e of the other out breaks at most 2d + e letter pairs of the
first. Candidates are scored in the order of that bound until it falls below what can still count.
A tile returns at most SHORTLIST candidates for a name, and the best of all tiles are merged.

What a name reaches with the few candidates that share its rarest word is known before, by a join on words. It
holds in every tile, so a tile without a name's best candidate scores hardly any for it.

Names of letters and one number need no tiles where few candidates hold their number. Those are scored. For the others the
number is an own word on both sides, so what the numbers leave out and what the letters leave out add up. The letters are
those of the shape, the name with zeros for its number: tiles of shapes, which are few, tell how much two numbers may differ
at most, and a join on numbers without a character finds the names of which they do not differ more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from fundlab.functions import text
from fundlab.storage import materialize

THRESHOLD, NEAR_BEST, SHORTLIST = 85, 2, 5
#: Printed names and candidates of a tile. The more candidates meet at once, the sooner a name's best one rules others out.
NAMES, CANDIDATES = 1024, 4096
#: Names whose bounds are held at once, and the most candidates that are tried before the tiles for a shared word.
AT_ONCE, TRIED = 256, 16
#: Most tasks that the tiles are dealt to.
MOST_TASKS = 4096
#: Bounds are in single precision.
ROUNDING = 1e-3
#: Names of letters and one number; the most candidates that are scored for a shared number, and characters left out of a number to find others.
NUMBERED, SAME_NUMBER, LEFT_OUT = r"^(\p{L}+ )*[\p{N}_]+( \p{L}+)*$", 64, 1
#: Printed names whose pairs are one task.
NAMES_A_TASK = 1 << 14

# Short names of companies whose code differs from it.
COMPANY_CODES = {
    "absl": "aditya_birla_sun_life", "icici_pru": "icici_prudential", "kotak": "kotak_mahindra", "mirae": "mirae_asset",
    "nippon": "nippon_india", "franklin": "franklin_templeton", "baroda_bnp": "baroda_bnp_paribas",
}


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, with a bit for each character of a between what both begin and end with."""
    begin, most = 0, min(len(a), len(b))
    while begin < most and a[begin] == b[begin]:
        begin += 1
    end = 0
    while end < most - begin and a[-end - 1] == b[-end - 1]:
        end += 1
    a, b = a[begin : len(a) - end], b[begin : len(b) - end]
    places: dict[str, int] = {}
    for k, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << k
    whole = (1 << len(a)) - 1
    free = whole
    for y in b:
        met = free & places.get(y, 0)
        free = (free + met | free - met) & whole
    return begin + end + len(a) - free.bit_count()


def ratio(a: str, b: str) -> float:
    """100 times twice the longest common subsequence over both lengths."""
    return 200.0 * common(a, b) / (len(a) + len(b)) if a and b else 100.0 if a == b else 0.0


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the shared words and each side's shared and own words; 100 where one side has no own."""
    x, y = set(a.split()), set(b.split())
    shared = x & y
    if not x or not y:
        return 0.0
    if shared and (x <= y or y <= x):
        return 100.0
    left, right = (" ".join(sorted(s - shared)) for s in (x, y))
    head = len(" ".join(shared)) + 1 if shared else 0  # both sides begin with the shared words and a blank
    both = head + len(left), head + len(right)
    score = 200.0 * (head + common(left, right)) / sum(both)
    return max(score, 200.0 * (head - 1) / (head - 1 + min(both))) if shared else score


def _incidence(rows: list[list], index: dict, weight=None) -> np.ndarray:
    """names x known features; a feature that is not in the index is left out."""
    out = np.zeros((len(rows), len(index)), np.float32)
    for k, features in enumerate(rows):
        for f in features:
            if (at := index.get(f)) is not None:
                out[k, at] = weight(f) if weight else 1
    return out


def _letter_pairs(words: list[str]) -> list[tuple[str, int]]:
    """The letter pairs inside words; the n-th of equal ones bears the number n."""
    seen: dict[str, int] = {}
    out = []
    for word in words:
        for k in range(len(word) - 1):
            n = seen[word[k : k + 2]] = seen.get(word[k : k + 2], 0) + 1
            out.append((word[k : k + 2], n))
    return out


def _bounds(names: list[str], candidates: list[str], at_once: int) -> Iterator[np.ndarray]:
    """The rows of upper_bounds(), at_once names at a time."""
    sides = [[sorted(set(n.split())) for n in side] for side in (names, candidates)]
    pairs = [[_letter_pairs(w) for w in side] for side in sides]
    length = [np.array([len(" ".join(w)) for w in side], np.float32) for side in sides]
    n_pairs = [np.array([len(p) for p in side], np.float32) for side in pairs]
    both = lambda of: {f: k for k, f in enumerate(sorted({f for fs in of[0] for f in fs} & {f for fs in of[1] for f in fs}))}
    words, letters = both(sides), both(pairs)
    of_words, of_letters = _incidence(sides[1], words).T, _incidence(pairs[1], letters).T
    for k in range(0, len(names), at_once):
        part = slice(k, k + at_once)
        shared = _incidence(sides[0][part], words, lambda w: len(w) + 1) @ of_words - 1  # joined by blanks; -1: none
        equal = _incidence(pairs[0][part], letters) @ of_letters
        x, y = length[0][part, None], length[1][None, :]
        most = np.minimum((equal - n_pairs[0][part, None] + 2 * x + y) / 3, (equal - n_pairs[1][None, :] + 2 * y + x) / 3)
        most = np.minimum(np.minimum(x, y), np.maximum(most, 0))
        bound = 200 * most / (x + y)
        some = np.maximum(shared, 0)
        by_words = 200 * some / (some + np.minimum(x, y))
        yield np.where((shared > 0) & ((shared == x) | (shared == y)), 100, np.maximum(bound, by_words))


def upper_bounds(names: list[str], candidates: list[str]) -> np.ndarray:
    """names x candidates: a number that token_set_ratio does not exceed, for names of at least one word."""
    return np.concatenate(list(_bounds(names, candidates, AT_ONCE)))


def shortlists(names: list[str], candidates: list[str], least: list[float]) -> Iterator[tuple[int, int, float]]:
    """(name, candidate, score) of the SHORTLIST best candidates of each name that are near its best and reach its ``least``.

    candidates are sorted; of equal scores the earlier ones count.
    """
    rows = (row for part in _bounds(names, candidates, AT_ONCE) for row in part)
    for k, (name, bounds) in enumerate(zip(names, rows, strict=True)):
        top: list[tuple[float, int]] = []  # (lost score, candidate)
        floor = least[k]
        some = np.flatnonzero(bounds >= floor - ROUNDING)
        for c in some[np.argsort(-bounds[some], kind="stable")].tolist():
            full = len(top) == SHORTLIST
            if bounds[c] < floor - ROUNDING or full and (top[-1][0] == -100 or bounds[c] < -top[-1][0] - ROUNDING):
                break
            top = sorted([*top, (-token_set_ratio(name, candidates[c]), c)])[:SHORTLIST]
            floor = max(least[k], -top[0][0] - NEAR_BEST)
        yield from ((k, c, -lost) for lost, c in top if -lost >= floor)


def apart(shapes: list[str], others: list[str], least: list[float]) -> Iterator[tuple[int, int, int, int]]:
    """(shape, other, d, e): names of both with different numbers reach ``least`` only if d characters less of the one number and e of the other leave the same.

    Pairs of shapes that do not reach it with different numbers are left out; other is -1 if d or e were more than LEFT_OUT.
    An alignment of two names aligns their numbers and the letters around them, so it leaves at least as many characters out as both alone.
    """
    sides = [[sorted(set(n.split())) for n in side] for side in (shapes, others)]
    letters = [[[w for w in words if w[0] != "0"] for words in side] for side in sides]
    length = [np.array([len(" ".join(w)) for w in side], np.int64) for side in sides]
    digits = [np.array([sum(len(x) for x in w if x[0] == "0") for w in side], np.int64) for side in sides]
    index = {w: k for k, w in enumerate(sorted({w for side in letters for words in side for w in words}))}
    shared = np.maximum(_incidence(letters[0], index, lambda w: len(w) + 1) @ _incidence(letters[1], index).T - 1, 0)
    alphabet = sorted({c for words in index for c in words})
    count = [np.array([[*map("".join(w).count, alphabet), len(w)] for w in side], np.int64) for side in letters]  # len(w): as many blanks
    for k, floor in enumerate(np.array(least) - ROUNDING):
        x, both = length[0][k], length[0][k] + length[1]
        left = both - 2 * np.ceil(floor * both / 200).astype(np.int64) - np.abs(count[1] - count[0][k]).sum(1)
        left -= (left - digits[0][k] - digits[1]) % 2  # of two numbers' lengths follows whether they leave an even number out
        d, e = (left + digits[0][k] - digits[1]) // 2, (left - digits[0][k] + digits[1]) // 2
        near = (d >= 0) & (e >= 0) & (d + e > 0)
        by_words = (shared[k] > 0) & (200 * shared[k] / (shared[k] + np.minimum(x, length[1])) >= floor)
        if (by_words | near & (np.maximum(d, e) > LEFT_OUT)).any():
            yield k, -1, 0, 0
        else:
            yield from ((k, j, int(d[j]), int(e[j])) for j in np.flatnonzero(near).tolist())


def _shapes(least: float):
    def run(key: tuple, tile: pa.Table) -> pa.Table:
        asked = pc.is_null(tile.column("scheme_code"))
        shapes, others = tile.filter(asked), tile.filter(pc.invert(asked)).column("name").to_pylist()
        names, reached = shapes.column("name").to_pylist(), shapes.column("reached").to_pylist()
        found = list(apart(names, others, [max(least, r - NEAR_BEST) for r in reached])) if names and others else []
        columns = {
            "block": pa.array([key[0].as_py()] * len(found), pa.string()), "shape": pa.array([names[k] for k, *_ in found], pa.string()), "reached": pa.array([reached[k] for k, *_ in found], pa.float64()),
            "other": pa.array([others[j] if j >= 0 else None for _, j, *_ in found], pa.string()), "d": pa.array([x[2] for x in found], pa.int32()), "e": pa.array([x[3] for x in found], pa.int32()),
        }
        return pa.table(columns)

    return run


def _tile(least: float):
    def run(key: tuple, tile: pa.Table) -> pa.Table:
        asked = pc.is_null(tile.column("scheme_code"))
        candidates = tile.filter(pc.invert(asked)).sort_by("name")
        printed = tile.filter(asked)
        names, pool = printed.column("name").to_pylist(), candidates.column("name").to_pylist()
        floors = [max(least, (reached or 0.0) - NEAR_BEST) for reached in printed.column("reached").to_pylist()]
        found = list(shortlists(names, pool, floors)) if names and pool else []
        at = pa.array([c for _, c, _ in found], pa.int64())
        columns = {
            "block": pa.array([key[0].as_py()] * len(found), pa.string()), "name": pa.array([names[k] for k, *_ in found], pa.string()), "candidate": candidates.column("name").take(at).cast(pa.string()),
            "scheme_code": candidates.column("scheme_code").take(at).cast(pa.string()), "set_score": pa.array([s for *_, s in found], pa.float64()), "plain": pa.array([ratio(names[k], pool[c]) for k, c, _ in found], pa.float64()),
        }
        return pa.table(columns)

    return run


def _tiles(names: DataFrame) -> DataFrame:
    """Of names (block, name, scheme_code; null for printed ones; reached) the rows of every tile (block, i, j): a printed name is in each j of its i, a candidate in each i of its j."""
    counts = names.groupBy("block").agg(*[F.ceil(F.count_if(F.col("scheme_code").isNull() == asked) / most).cast("int").alias(c) for asked, most, c in ((True, NAMES, "rows"), (False, CANDIDATES, "columns"))])
    counts = materialize(counts, tiles=F.sum(F.col("rows").cast("long") * F.col("columns")))
    tasks = max(1, min(MOST_TASKS, counts.seen["tiles"] or 0))  # a tile is little data and much work, so it must not be put together with others by size
    asked, place = F.col("scheme_code").isNull(), F.xxhash64("name")
    own = F.pmod(place, F.when(asked, F.col("rows")).otherwise(F.col("columns"))).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.when(asked, F.col("columns")).otherwise(F.col("rows")) - 1))
    dealt = names.join(counts, "block").filter("rows > 0 and columns > 0").withColumns({"own": own}).withColumn("every", every)
    return dealt.select("block", F.when(asked, F.col("own")).otherwise(F.col("every")).alias("i"), F.when(asked, F.col("every")).otherwise(F.col("own")).alias("j"), "name", "scheme_code", "reached").repartition(tasks, "block", "i", "j")


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = list(zip(batch.column("name").to_pylist(), batch.column("candidate").to_pylist(), strict=True))
        scores = [pa.array([of(a, b) for a, b in pairs], pa.float64()) for of in (token_set_ratio, ratio)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *scores], names=[*batch.schema.names, "set_score", "plain"])


def _scored(pairs: DataFrame) -> DataFrame:
    """pairs (name, candidate) with both scores."""
    return pairs.mapInArrow(_score, StructType([*pairs.schema.fields, StructField("set_score", DoubleType()), StructField("plain", DoubleType())]))


def _reached(asked: DataFrame, pool: DataFrame) -> DataFrame:
    """block, name, reached: the best score of a printed name among the candidates that share its rarest word, if at most TRIED do."""
    by_word = lambda df: df.select("block", "name", F.explode(F.array_distinct(F.split("name", " "))).alias("word"))
    words = by_word(pool)
    rare = words.groupBy("block", "word").agg(F.count("*").alias("n")).filter(F.col("n") <= TRIED)
    rarest = by_word(asked).join(rare, ["block", "word"]).groupBy("block", "name").agg(F.min_by("word", F.struct("n", "word")).alias("word"))
    tried = rarest.join(words.join(rare, ["block", "word"], "left_semi").withColumnRenamed("name", "candidate"), ["block", "word"]).select("block", "name", "candidate")
    return _scored(tried).groupBy("block", "name").agg(F.max("set_score").alias("reached"))


def _numbered(names: DataFrame) -> DataFrame:
    """names with their number and shape, if they are letters and one number: the words in order, with zeros for the number."""
    shape = F.array_join(F.array_sort(F.array_distinct(F.split(F.regexp_replace("name", r"[\p{N}_]", "0"), " "))), " ")
    holds = F.col("name").rlike(NUMBERED)
    return names.withColumns({"number": F.when(holds, F.regexp_extract("name", r"[\p{N}_]+", 0)), "shape": F.when(holds, shape)})


def _without(number: str, left_out: str) -> Column:
    """What is left of a number without any one character, or the number, if none is left out."""
    return F.expr(f"explode(CASE WHEN {left_out} = 0 THEN array({number}) ELSE array_distinct(transform(sequence(1, length({number})), i -> concat(substr({number}, 1, i - 1), substr({number}, i + 1)))) END)")


def _by_number(asked: DataFrame, pool: DataFrame, least: float, tasks: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of names with numbers: block, name, reached of those with a candidate of their number; of those that need no tiles for numbered candidates; and the scored pairs of these."""
    asked, pool = (df.filter("number IS NOT NULL") for df in (asked, pool))
    few = pool.groupBy("block", "number").agg(F.count("*").alias("n")).filter(F.col("n") <= SAME_NUMBER).drop("n")
    others = pool.select("block", "number", F.col("name").alias("candidate"), "scheme_code")
    equal = asked.select("block", "name", "number", "shape").join(few, ["block", "number"]).join(others, ["block", "number"])
    equal = materialize(_scored(equal.repartition(tasks, "block", "name")))
    known = equal.groupBy("block", "name", "number", "shape").agg(F.max("set_score").alias("reached"))
    shapes = known.select("block", F.col("shape").alias("name"), F.lit(None).cast("string").alias("scheme_code"), "reached").distinct()
    shapes = materialize(shapes.unionByName(pool.select("block", F.col("shape").alias("name"), F.lit("").alias("scheme_code")).distinct(), allowMissingColumns=True))
    met = materialize(_tiles(shapes).groupBy("block", "i", "j").applyInArrow(_shapes(least), "block string, shape string, reached double, other string, d int, e int"))
    found = known.join(met.filter("other IS NULL"), ["block", "shape", "reached"], "left_anti")
    near = met.filter("other IS NOT NULL")
    left = found.join(near, ["block", "shape", "reached"]).select("block", "name", "number", "other", "e", _without("number", "d").alias("rest"))
    theirs = pool.withColumnsRenamed({"name": "candidate", "number": "their", "shape": "other"}).join(near.select("block", "other", "e").distinct(), ["block", "other"])
    right = theirs.select("block", "candidate", "scheme_code", "their", "other", "e", _without("their", "e").alias("rest"))
    close = left.join(right, ["block", "other", "e", "rest"]).filter("number <> their").select("block", "name", "candidate", "scheme_code").distinct()
    counted = equal.drop("number", "shape").join(found, ["block", "name"], "left_semi")  # tiles hold the others' pairs
    pairs = counted.unionByName(_scored(close.repartition(tasks, "block", "name")))
    return known.select("block", "name", "reached"), found.select("block", "name", "reached"), pairs


def _by_tiles(asked: DataFrame, pool: DataFrame, least: float) -> DataFrame:
    """The short lists of asked (block, name, reached) among all of pool."""
    names = asked.withColumn("scheme_code", F.lit(None).cast("string")).unionByName(pool.select("block", "name", "scheme_code"), allowMissingColumns=True)
    return _tiles(materialize(names)).groupBy("block", "i", "j").applyInArrow(_tile(least), "block string, name string, candidate string, scheme_code string, set_score double, plain double")


def match_names(printed: DataFrame, candidates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """printed (block, name) with the scheme_code and score of its best candidate (block, scheme_code, name).

    Names are canonical. The best is, among the SHORTLIST highest set ratios that are near the highest
    one, the candidate with the highest plain ratio. A printed name without a candidate at the threshold has nulls, as have
    null and empty names and blocks; of equal candidates the least code counts. No candidate is left out.
    """
    filled = lambda df, c: df.filter(F.col("block").isNotNull() & (F.trim(F.coalesce(F.col(c), F.lit(""))) != ""))
    pool = filled(candidates, "name").groupBy("block", "name").agg(F.min(F.coalesce(F.col("scheme_code").cast("string"), F.lit(""))).alias("scheme_code"))
    asked = filled(printed.select("block", "name"), "name").distinct()
    least, key = threshold - NEAR_BEST, ["block", "name"]
    named = materialize(_numbered(asked.withColumn("scheme_code", F.lit(None).cast("string")).unionByName(pool)), asked=F.count_if(F.col("scheme_code").isNull()))
    tasks = max(int(named.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(named.seen["asked"] or 0) // NAMES_A_TASK))
    asked, pool = named.filter("scheme_code IS NULL").drop("scheme_code"), named.filter("scheme_code IS NOT NULL")
    known, found, pairs = _by_number(asked, pool, least, tasks)
    others = asked.select(key).join(found, key, "left_anti")
    reached = known.unionByName(_reached(others.join(known, key, "left_anti"), pool))
    near = pairs.unionByName(_by_tiles(others.join(reached, key, "left"), pool, least)).unionByName(_by_tiles(found, pool.filter("number IS NULL"), least))
    by_name = Window.partitionBy("block", "name")
    best = near.withColumns({"_r": F.row_number().over(by_name.orderBy(F.desc("set_score"), "candidate")), "_best": F.max("set_score").over(by_name)})
    best = best.filter((F.col("_r") <= SHORTLIST) & (F.col("_best") >= threshold) & (F.col("set_score") >= F.col("_best") - NEAR_BEST))
    pick = best.withColumn("_p", F.row_number().over(by_name.orderBy(F.desc("plain"), F.desc("set_score"), "candidate"))).filter("_p = 1")
    return printed.join(pick.select("block", "name", "scheme_code", F.col("set_score").alias("score")), ["block", "name"], "left")


def company_code(slug: Column) -> Column:
    """The company's code in the scheme dimension; a name that is not in the list of short names is one."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in COMPANY_CODES.items() for x in pair]), slug), slug)


def candidate_index(schemes: DataFrame, plan: str = "DIRECT", option: str = "GROWTH") -> DataFrame:
    """block, name, scheme_code: one row for each canonical name of a company's active schemes of a plan and option.

    schemes: amc_code, scheme_code, scheme_name, plan_type, option_type, is_active. Bonus schemes are left out; of equal names the least code counts.
    """
    fits = (F.col("plan_type") == plan) & (F.col("option_type") == option) & F.col("is_active") & ~F.col("scheme_name").rlike(r"(?i)\bBonus\b")
    named = schemes.filter(fits).select(F.col("amc_code").alias("block"), text.canonical_scheme(F.col("scheme_name")).alias("name"), "scheme_code")
    return named.filter("name <> ''").groupBy("block", "name").agg(F.min("scheme_code").alias("scheme_code"))
