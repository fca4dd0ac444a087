"""Rows for the tests of this folder."""

from pyspark.sql import types as T

FOLDER = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names the operators use themselves
    T.StructField("size", T.StringType()), T.StructField("row", T.StringType()), T.StructField("cluster", T.StringType()),
    T.StructField("part", T.StringType()), T.StructField("score", T.StringType()), T.StructField("y", T.StringType()),
])


def make_docs(spark, rows):
    """Documents of (doc_id, text, lang, source) with columns of clashing names."""
    full = [(i, t, lang, s, None if t is None else len(t), "a", "b", "c", "d", "e", "f") for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOCS)


def prose(seed, n, line=12):
    """Invented text: n words in lines."""
    import random

    r = random.Random(seed)
    stock = ["the", "of", "and", "to", "in", "is"] + ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(2, 4))) for _ in range(80)]
    words = [r.choice(stock) for _ in range(n)]
    return "\n".join(" ".join(words[k : k + line]) for k in range(0, n, line))


LONG = prose(99, 12_000)
