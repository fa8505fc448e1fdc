"""The registered queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlab.llm import chat, chunks, classifier, jaccard_join, mixing, near_dup, neighbours, oracles, packing, pii, ppm, quality_rules, resample, runs
from fundlab.skew import join_unique
from fundlab.storage import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every fiftieth."""
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of documents that other documents repeat."""
    return chunks.repeats(_table(spark, sf_dir, "documents")).drop("row")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from the labelled ones that are not held out."""
    held = lambda df: ppm.held_out(df["doc_id"], 5, 0)
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    model = classifier.fit(docs, labels.filter(~held(labels)).select("doc_id", F.col("quality").alias("label")))
    scored = classifier.scores(docs, model)
    return scored.select("doc_id", held(scored).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = _table(spark, sf_dir, "documents").select("doc_id", pii.spans(F.col("text")).alias("found"))
    named = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("found", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.BASE_KINDS), F.sha2(F.array_join(F.transform(base, named), ","), 256).alias("base_sha256"), F.array_join(F.transform("found", named), ",").alias("spans"), F.size("found").cast("long").alias("n_spans"), F.array_join(F.transform("found", lambda s: s["score"].cast("string")), ",").alias("scores"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3 by source, the languages' shares kept as far as that allows."""
    rows, sources = mixing.mix(mixing.keyed(_table(spark, sf_dir, "documents"), "doc_id"))
    rows = join_unique(rows, sources, ["g"])
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document."""
    return near_dup.classes(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All documents packed into windows of 4096 tokens."""
    tokens = packing.tokenize(_table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(tokens).drop("ids")


#: The extra conversation of op8's contract.
_EXTRA = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]


def _event_log(rows: DataFrame) -> DataFrame:
    """A log whose messages are the rows (conv_id, turn, role, text): each is streamed in pieces, in one of three ways.

    It is begun empty and appended to; or a draft is discarded and generated anew; or a
    wrong start is edited and then continued. Empty texts have no pieces.
    """
    nth = F.expr("row_number() over (partition by conv_id, turn order by role, text)")
    text = F.coalesce("text", F.lit(""))
    step = F.greatest(F.lit(1), F.ceil(F.length(text) / 6).cast("int"))
    pieces = F.filter(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda k: F.substring(text, k * step + 1, step)), lambda p: p != "")
    event = lambda kind, text, role=None: F.struct(F.lit(kind).alias("kind"), (F.lit(None) if role is None else role).cast("string").alias("role"), text.alias("text"))
    delta = lambda p: event("delta", p)
    begun, wrong = event("message", F.lit(""), F.col("role")), F.concat(F.lit("draft "), F.reverse(F.substring(text, 1, 20)))
    ways = [
        F.concat(F.array(begun), F.transform(pieces, delta)),
        F.concat(F.array(begun, event("delta", wrong), event("regenerate", F.lit("dropped"))), F.transform(pieces, delta)),
        F.concat(F.array(event("message", wrong, F.col("role")), event("delta", wrong), event("edit", F.coalesce(F.get(pieces, 0), F.lit("")))), F.transform(F.slice(pieces, 2, 7), delta)),
    ]
    way = F.pmod(F.xxhash64("conv_id", "turn", "nth"), F.lit(3))
    logged = rows.withColumn("nth", nth).select("conv_id", "turn", "nth", F.posexplode(F.when(way == 0, ways[0]).when(way == 1, ways[1]).otherwise(ways[2])).alias("step", "e"))
    return logged.select("conv_id", F.struct("turn", "nth", "step").alias("seq"), F.struct("turn", "nth").alias("message_id"), "e.*")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations logged as events, folded, rendered, then read back from the output."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(_EXTRA, "conv_id long, turn long, role string, text string"))
    events = _event_log(rows)
    out = chat.render(chat.reconstruct(events)).select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"), chat.learned(F.col("pieces")).alias("learned"))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every document under the byte model and under word counts."""
    return ppm.scores(_table(spark, sf_dir, "documents"), 7, 2)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the verdict of its language's and source's limits."""
    measures = materialize(quality_rules.measured(_table(spark, sf_dir, "documents"), ["doc_id", "lang", "source"]))
    judged = quality_rules.judge(measures, quality_rules.limits(measures))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents drawn towards the benchmark's distribution of hashed n-grams."""
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of five-word shingles at 0.8."""
    return jaccard_join.joined(_table(spark, sf_dir, "documents"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document by its id's CRC-32 repeats some of its words to its end; a null id's text stays."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).alias("words"))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    placed = split.withColumns({"a": (g % n).cast("int"), "p": (1 + F.floor((n - g % n) / (3 + g % 8))).cast("int")})
    repeated = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return placed.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document and what is left without their repetitions."""
    found = runs.runs(_with_planted_runs(_table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"].alias("start"), r["period"].alias("period"))))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    digests = [F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")]
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"), *digests)
    return out.select("doc_id", "n_runs", "longest.start", "longest.length", "longest.period", F.expr("1000 * longest.length div longest.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_neighbours, op2_substring_dedup, op3_quality_classifier, op4_pii, op5_mixing, op6_minhash, op7_packing, op8_chat, op9_lm_scoring, op10_quality_rules, op11_resample, op12_jaccard_join, op13_runs)}


def oracle_sql() -> dict[str, str]:
    return oracles.sql()
