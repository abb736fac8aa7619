"""Inputs that every text operator must survive, and plain versions of the contracts."""

from __future__ import annotations

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators also use inside
        T.StructField("id", T.StringType()),
        T.StructField("n_words", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("score", T.StringType()),
    ]
)


def documents(spark, texts):
    """``texts`` as documents: pairs (id, text); the other columns hold NULLs and odd values."""
    rows = [(i, t, None, None, None, "x", None, "y", None) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


PROSE = (
    "The old harbour lay quiet under the morning fog while gulls circled above the pier. "
    "Fishermen mended their nets and spoke of storms that had passed in the night. "
    "A child counted boats as they came back one by one with their lamps still burning. "
    "Nobody hurried because the tide would not turn before noon on such a calm day."
)

#: NULL id and text, empty and blank texts, repeated rows, ties, a very long text
ODD = [
    (None, "a row without an id"),
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, PROSE),
    (4, PROSE),
    (5, PROSE.upper()),
    (6, "x"),
    (7, "é" * 50_000),
    (8, "word " * 30_000),
    (9, "\x00\x1f  \U0001f600 ſK İ"),
    (10, "line\n" * 40 + PROSE),
]
