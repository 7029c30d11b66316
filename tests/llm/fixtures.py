"""Small tables with the awkward rows every operator must take."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside.
        T.StructField("fp", T.StringType()),
        T.StructField("line", T.IntegerType()),
        T.StructField("shard", T.StringType()),
        T.StructField("score", T.StringType()),
    ]
)


def rows(texts):
    """Rows of ``DOCUMENTS`` from ``(doc_id, text)`` pairs."""
    return [(i, t, "en", None, None if t is None else len(t), "x", 1, None, "y") for i, t in texts]


SENTENCE = "one two three four five six seven eight nine ten eleven twelve"
AWKWARD = [
    (5, SENTENCE),
    (2, SENTENCE),
    (9, SENTENCE + " thirteen"),
    (9, SENTENCE + " thirteen"),
    (7, None),
    (3, ""),
    (4, " \t\n "),
    (None, "no number here at all"),
    (11, "ÀÉ ß 漢字 🙂 ▁ mixed"),
    (12, "word " * 60_000),
    (13, "a" * 50_000),
    (14, "line one is here now\n\nline one is here now\nline two is there then"),
]


def documents(spark, texts=AWKWARD):
    return spark.createDataFrame(rows(texts), DOCUMENTS)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
