"""Small tables that hold the hard cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names the operators use themselves.
        *[T.StructField(c, T.StringType()) for c in ("score", "hash", "bucket", "part", "rank", "fp", "root", "row", "rate", "entry")],
    ]
)


def row(doc_id, text, lang="en", source="src0"):
    return (doc_id, text, lang, source, None if text is None else len(text), *["x"] * 10)


def hard_rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    long = " ".join(rng.choice(words) + str(rng.randrange(400)) for _ in range(60_000))
    return [
        row(5, passage + " tail"),
        row(2, "head " + passage),
        row(9, passage.replace(" ", " \n", 3)),
        row(9, passage.replace(" ", " \n", 3)),  # a row repeated as a whole
        row(9, "another text under the same id"),
        row(11, passage),
        row(-4, passage),
        row(None, passage),
        row(None, None, None, None),
        row(13, None, None, None),
        row(14, ""),
        row(15, " \t\n "),
        row(16, "Ünïcode   Größe  日本語テキスト <|endoftext|> it's  \x0b end "),
        row(17, "12 345 !!! ###"),
        row(18, "a"),
        row(19, "A"),
        row(2**62, "far id"),
        row(20, long),
        row(21, long[: len(long) // 2] + " changed " + long[len(long) // 2 :]),
        row(22, "x" * 300_000),
    ]


def hard(spark, parts=3):
    return spark.createDataFrame(hard_rows(), DOCS).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")
