"""Rows that every operator must survive: nulls, empties, long texts, ties, repeats, clashing columns."""

from pyspark.sql import functions as F

LONG = "lorem " * 400 + "x" * 5000 + " end.\n" + "y z " * 3000
TEXTS = [
    (1, "One small text. It has a second sentence, and a third one."),
    (1, "One small text. It has a second sentence, and a third one."),
    (2, None),
    (3, ""),
    (4, " \t\n  \r\n "),
    (5, LONG),
    (None, "A text whose id is null, which is seven more words."),
    (None, None),
    (6, "¿Qué tal? – naïve façade 日本語 テスト     end"),
    (7, "word"),
    (8, "a\x1cb a\x85b ȩ́ \U0001f600️ İ ΑΣ"),
    (9, "One small text. It has a second sentence, and a third one. "),
]
CLASH = ("score", "predicted", "held_out", "cls", "sig", "bands", "length", "piece", "part", "y", "ids", "chunk", "kept", "w", "lines", "_key", "c0")


def odd_docs(spark, rows=TEXTS):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("doc_id", "text", *(F.lit(None if k % 2 else "x").alias(c) for k, c in enumerate(CLASH)))


def empty_docs(spark):
    return odd_docs(spark, [])
