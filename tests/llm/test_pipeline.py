"""Each stage of the pipeline against plain Python on its own input."""

from collections import Counter

import corpus_pipeline
from fundlab.llm import pii
from tests.llm.helpers import documents, odd_documents, words


def rows(df):
    return [tuple(r) for r in df.collect()]


def corpus():
    rnd = lambda k, j: (k * 7919 + j * j * 31 + j * k) % 7001
    good = [(k, " ".join(f"w{rnd(k, j)}a" for j in range(70 + k % 30)), "en", f"s{k % 3}") for k in range(120)]
    near = [(500 + k, good[k][1] + " tail", "en", "s1") for k in range(10)]
    junk = [(700 + k, " ".join(f"w{rnd(k, j)}|##" for j in range(80)), "en", "s0") for k in range(5)]
    private = [(800, good[50][1][::-1] + " mail a@b.co", "en", "s2")]
    return [*good, *near, *junk, *private, *[(i and i + 900, *rest) for i, *rest in odd_documents()]]


def test_stages(spark, tmp_path):
    docs = documents(spark, corpus())
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "")
        if k < 4:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        kept[k], docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        before, after = rows(kept[k]), rows(docs)
        if k == 0:
            ids = {r[0] for r in after}
            assert set(range(120)) <= ids and not ids & set(range(700, 705)) and 800 in ids and 902 not in ids
        elif k == 1:
            ids = Counter(r[0] for r in after)
            assert max(ids.values()) == 1 and not set(ids) & set(range(500, 510)) and set(range(120)) <= set(ids)
        elif k == 2:
            want = {r[0]: pii.mask(r[1], pii.spans_of(r[1])) for r in before}
            assert {r[0]: r[1] for r in after} == want and all(r[4] == len(r[1]) for r in after) and want[800].endswith("mail <EMAIL>")
        elif k == 3:
            assert set(map(str, after)) <= set(map(str, before)) and max(Counter(map(str, after)).values()) <= 3
            total = sum(len(words(r[1])) for r in before)
            assert abs(sum(len(words(r[1])) for r in after) - total) < 300
        else:
            assert sum(r[2] for r in after) == docs.groupBy("sequence_id").sum("length").selectExpr("sum(`sum(length)`)").first()[0]


CLASHES = ["_doc", "_id", "_digest", "id", "digest", "worded", "g", "h", "draw", "nth", "size", "copies", "k", "g_lang", "g_source", "_limit", "base_failed", "kept", "n_words", "symbols", "bucket", "ids", "part", "tied", "low", "cut", "col", "_salt", "_blocks"]


def test_clashing_columns_pass_through_every_stage(spark):
    """Each stage gives the same rows with and without further columns of its own inner names, and leaves those as they are."""
    plain = documents(spark, corpus()[:40] + corpus()[120:])
    docs = plain.selectExpr("*", *[f"concat('KEEP-', doc_id) as `{c}`" for c in CLASHES])
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        got = out.collect()
        assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in stage(spark, plain, "").collect()), name
        assert all(r[c] == (None if r.doc_id is None else f"KEEP-{r.doc_id}") for r in got for c in CLASHES), name
    assert corpus_pipeline.sequences(spark, docs, "").count() == corpus_pipeline.sequences(spark, plain, "").count()


def test_run_ends_with_the_tokens_of_what_the_stages_leave(spark, tmp_path):
    """End to end: the packed ids, put together again, are those of the redacted, mixed documents, and gone ones are gone."""
    import public_tokenizers
    from tokenizers import Tokenizer

    documents(spark, corpus()).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    text = {r[0]: pii.mask(r[1], pii.spans_of(r[1])) for r in corpus() if r[1]}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    copies = Counter(r.doc_id for r in out if r.start == 0)
    assert set(copies) <= {*range(120), 800, *(i + 900 for i in (4, 5, 6, 7, 8, 9)), None} and len(copies) > 80 and max(copies.values()) <= 3
    tokens = {i: len(tokenizer.encode(text[i], add_special_tokens=False).ids) + 1 for i in copies}
    assert sum(r.length for r in out) == sum(n * tokens[i] for i, n in copies.items())
    assert all(r.doc_tokens == tokens[r.doc_id] for r in out)
    assert sorted((r.sequence_id * 4096 + r.offset) for r in out) == [sum(r.length for r in sorted(out, key=lambda r: (r.sequence_id, r.offset))[:k]) for k in range(len(out))]


def test_run_on_an_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_handle_odd_rows_alone(spark):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, documents(spark, odd_documents()), "").collect()


def test_map_columns_pass_through_every_stage(spark):
    docs = documents(spark, corpus()[:30] + corpus()[120:]).selectExpr("*", "map('a', doc_id) as m", "named_struct('x', map('l', source)) as n", "array(map('k', 1)) as o")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r.m == {"a": r.doc_id} and r.o == [{"k": 1}] for r in rows), name
