"""Small tables and brute-force versions that the tests share."""

import re
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPLIT = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPLIT.split(text or "") if w]


def documents(spark, rows, extra=False):
    """documents from (doc_id, text, lang, source); extra: with clashing further columns."""
    df = spark.createDataFrame([(i, t, a, b, None if t is None else len(t)) for i, t, a, b in rows], DOCS)
    if extra:
        names = ["size", "g", "draw", "score", "kept", "spans", "n_words", "part", "ids", "copies", "digest", "class_id", "k", "bin"]
        from pyspark.sql import functions as F

        df = df.withColumns({n: F.lit("x") for n in names})
    return df


def odd_documents():
    """Nulls in every column, empty, very long, repeated and tied rows."""
    long = " ".join(f"wort{k % 977} mit{k % 31}" for k in range(60_000))
    return [
        (None, "a text without an id, " * 12, "en", "s1"), (1, None, "en", "s1"), (2, "", None, None), (3, " \n\t ", "de", "s2"),
        (4, "one", "en", None), (5, long, None, "s2"), (6, "same words here " * 30, "en", "s1"), (6, "same words here " * 30, "en", "s1"),
        (7, "same words here " * 30, "en", "s1"), (8, "été ñandú ß 漢字 🙂 x" * 9, "fr", "s3"), (9, "\x0b\x0cstrange\x85spaces here", "fr", "s3"),
    ]


def save(spark, df, folder, name="documents"):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def crc_mod(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n
