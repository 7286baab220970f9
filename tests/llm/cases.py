"""Awkward documents that every operator must take."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("n_words", T.StringType()),
])
LINE = "the quick brown fox of the north and the lazy dog to the south in a row with you"
TEXTS = [
    (1, LINE), (2, LINE), (2, LINE), (3, None), (4, ""), (5, " \n\t "), (6, "one two"), (7, "one two"), (8, "One TWO"),
    (9, "x" * 50_000), (10, "é ü ñ 日本語 🙂   end"), (11, (LINE + "\n") * 400), (12, "a\n\nb\r\nc\x0bd\x0ce"), (None, LINE + " more"),
    (None, None), (13, "#### $$$$ %%%% | <a> & #"), (14, " ".join(f"w{i}" for i in range(20_000))),
]


def documents(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, None, "high", "s", "n") for i, t in texts], DOCS)


def nothing(spark):
    return spark.createDataFrame([], DOCS)
