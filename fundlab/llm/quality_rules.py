"""Quality rules whose limits come from quantile sketches per language and source.

The sketch of a measure is a histogram over fixed integer buckets: counts add
up, so sketches of partitions, sources and languages merge exactly, and a
quantile is read off with the bucket's width (1 per mille, 0.01 characters) as
its error. A limit is a high quantile of the documents that pass the base rule,
and as much further as a multiple of its distance to the median. The limit of a
source is its own, weighted by its documents, and its language's, weighted as
PRIOR documents; a language's draws on the corpus's in the same way. So a group
of few documents has much of its parent's limit and no size switches rules. Only
DataFrame functions are used.

Edge cases: a null text has no words and fails the base rule; null languages and
sources are groups of their own; a group without a document that passes the base
rule has its parent's limits; repeated rows each count; an empty table gives an
empty result; columns not named here are ignored. A text's words are one array,
so a text of 2**26 words, over 200 MB, is beyond what a row can hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundlab.storage import materialize

SEPARATORS = "[\\x20\\x09-\\x0D]+"
#: Measure -> the quantile (per mille) that sets its limit, how many of its distances to the median the limit lies
#: further, and the distance that counts where the quantile is the median. Measures with a long tail of clean
#: documents take a quantile of that tail.
RULES = {"symbols": (900, 8, 5), "dup_lines": (995, 1, 50), "repeats": (995, 1, 50), "word_length": (750, 8, 5), "capitals": (900, 6, 3)}
#: Documents that the parent's limit counts for in a group's.
PRIOR = 200
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars", "n_capitals")


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the array.

    A window is a long: the high bits of its hash and, below, its position. Sorted,
    equal windows are neighbours, so this takes n log n steps for any text.
    """
    bits, at = 26, F.lit((1 << 26) - 1).cast("long")

    def covered(windows: Column) -> Column:
        packed = F.sort_array(F.transform(windows, lambda h, i: F.shiftleft(h, bits).bitwiseOR(i.cast("long"))))

        def count(keys: Column) -> Column:
            of = lambda k: F.get(windows, k.bitwiseAND(at).cast("int"))
            twice = F.filter(keys, lambda k, i: F.coalesce(of(k) == of(F.get(keys, i + 1)), F.lit(False)) | F.coalesce(of(k) == of(F.get(keys, i - 1)), F.lit(False)))
            places = F.sort_array(F.transform(twice, lambda k: k.bitwiseAND(at)))
            return _let(places, lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(p, i + 1) - x, F.lit(3).cast("long")))), F.lit(0).cast("long"), lambda s, x: s + x))

        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), _let(packed, count)).otherwise(F.lit(0).cast("long"))

    windows = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return _let(windows, covered)


def counts(text: Column) -> Column:
    """struct of COUNTS for a text column."""
    text = F.coalesce(text, F.lit(""))

    def of(t: Column) -> Column:
        words = F.array_remove(F.split(t, SEPARATORS), "")
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
        from_words = _let(words, lambda w: F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), _repeated_words(w).alias("n_repeat_words")))
        from_lines = _let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
        left = lambda kept: F.length(F.regexp_replace(t, f"[^{kept}]+", ""))
        found = F.struct(from_words.alias("w"), from_lines.alias("l"), left("#*$%&|<>").alias("n_symbols"), left("A-Z").alias("n_capitals"), F.length(t).alias("n_chars"))
        place = {"n_words": "w", "word_chars": "w", "n_repeat_words": "w", "n_lines": "l", "n_dup_lines": "l"}
        return _let(found, lambda c: F.struct(*[(c[place[x]][x] if x in place else c[x]).cast("long").alias(x) for x in COUNTS]))

    return _let(text, of)


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep``, COUNTS, base_failed and the measures as bucket numbers.

    The counts come out of a generator of one row, so that they are computed once
    for each text wherever the columns are used or filtered later.
    """
    flat = docs.select(*keep, F.inline(F.array(counts(F.col("text")))))
    share = lambda part, whole, unit=1000: F.expr(f"{part} * {unit} div greatest({whole}, 1)")
    length = share("word_chars", "n_words", 100)
    return flat.withColumns({
        "base_failed": (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50),
        "symbols": share("n_symbols", "n_chars"), "dup_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"),
        "word_length": F.when(length < 2000, length).otherwise(F.length(F.bin(length)) + 2000), "capitals": share("n_capitals", "word_chars"),
    })


def _group(name: str) -> Column:
    """A key that a null has too."""
    return F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit(""))


def limits(measures: DataFrame, prior: int = PRIOR) -> DataFrame:
    """g_lang, g_source and, for each measure, the limit that holds there."""
    kinds = ", ".join(f"'{m}', {m}" for m in RULES)
    sketch = measures.select(_group("lang").alias("g_lang"), _group("source").alias("g_source"), (~F.col("base_failed")).cast("long").alias("n"), F.expr(f"stack({len(RULES)}, {kinds}) as (measure, bucket)"))
    sketch = materialize(sketch.groupBy("g_lang", "g_source", "measure", "bucket").agg(F.sum("n").alias("n")))
    pairs = sketch.select("g_lang", "g_source").distinct().withColumn("g_all", F.lit(""))
    part = lambda k: F.create_map(*[F.lit(x) for m, rule in RULES.items() for x in (m, rule[k])])[F.col("measure")]
    for depth, keys in enumerate((["g_all"], ["g_lang"], ["g_lang", "g_source"])):
        merged = sketch.withColumn("g_all", F.lit("")).groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n")).filter("n > 0")
        whole = Window.partitionBy(*keys, "measure")
        merged = merged.withColumn("upto", F.sum("n").over(whole.orderBy("bucket"))).withColumn("total", F.sum("n").over(whole))
        q = merged.groupBy(*keys, "measure").agg(F.max("total").alias("total"), F.min(F.when(F.col("upto") * 2 >= F.col("total"), F.col("bucket"))).alias("middle"), F.min(F.when(F.col("upto") * 1000 >= F.col("total") * part(0), F.col("bucket"))).alias("high"))
        apart = F.col("high") - F.col("middle")
        fence = F.col("high") + part(1) * F.when(apart > 0, apart).otherwise(part(2))
        own = q.groupBy(*keys).agg(F.max("total").alias(f"n{depth}"), *[F.max(F.when(F.col("measure") == m, fence)).alias(f"{m}{depth}") for m in RULES])
        pairs = pairs.join(own, keys, "left")
    fields = []
    for m in RULES:
        level = f"{m}0"
        for depth in (1, 2):
            level = f"((coalesce(n{depth} * {m}{depth}, 0) + {prior} * {level}) div (coalesce(n{depth}, 0) + {prior}))"
        fields.append(F.expr(level).alias(m))
    return pairs.select("g_lang", "g_source", F.struct(*fields).alias("_limit"))


def judge(measures: DataFrame, limit: DataFrame) -> DataFrame:
    """measures with ``kept``: the base rule holds and no measure passes its limit."""
    over = F.lit(False)
    for m in RULES:
        over = over | F.coalesce(F.col(m) > F.col(f"_limit.{m}"), F.lit(False))
    joined = measures.withColumns({"g_lang": _group("lang"), "g_source": _group("source")}).join(limit, ["g_lang", "g_source"])
    return joined.withColumn("kept", ~F.col("base_failed") & ~over).drop("g_lang", "g_source", "_limit")
