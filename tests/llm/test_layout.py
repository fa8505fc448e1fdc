"""Results that do not depend on how a table's rows lie in files."""

import random
from collections import Counter

import pytest

from fundlab.llm import queries
from tests.llm.helpers import documents, odd_documents


def rows():
    rng = random.Random(6)
    passage = " ".join(f"shared{k}" for k in range(70))
    text = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    out = [(k, f"{text(30)} {passage} {text(10)}" if k % 3 else text(60), "en", f"s{k % 2}") for k in range(40)]
    tied = [(7000, "tied " * 11, "en", "s1")] * 60 + [(None, "tied " * 11, "en", "s1")] * 25 + [(7100 + k, f"t{k} " * 11, "en", "s1") for k in range(60)]
    again = [(8000, f"{passage} one", "en", "s0")] * 3 + [(None, f"{passage} two", "de", "s0")] * 2
    return out + tied + again + odd_documents()


@pytest.mark.parametrize("query", ["op2_substring_dedup", "op5_mixing", "op11_resample", "op12_jaccard_join", "op13_runs"])
def test_one_five_and_nine_files_give_equal_rows(spark, tmp_path, query):
    seen = []
    for n in (1, 5, 9):
        shuffled = rows()
        random.Random(n).shuffle(shuffled)
        documents(spark, shuffled).repartition(n).write.parquet(f"{tmp_path}/{n}/documents.parquet")
        spark.createDataFrame([(1, "shared1 shared2 w7 w9")], "item_id long, text string").write.parquet(f"{tmp_path}/{n}/benchmark.parquet")
        seen.append(Counter(map(str, getattr(queries, query)(spark, f"{tmp_path}/{n}").collect())))
    assert seen[0] == seen[1] == seen[2] and seen[0]
