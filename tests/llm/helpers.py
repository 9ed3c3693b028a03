"""Frames of small documents with the awkward cases that every operator must take."""

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import weighted_minhash as wm

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "lorem ipsum dolor sit amet consectetur " * 3000

AWKWARD = [
    (1, "one two three four five six seven eight nine ten", "en", "a", 48),
    (1, "one two three four five six seven eight nine ten", "en", "a", 48),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (None, "a text without an id", "en", None, 20),
    (4, "word", "en", "b", 4),
    (5, LONG, "en", "b", len(LONG)),
    (6, "x" * 50_000, "en", "b", 50_000),
    (7, "7" * 20_000, "en", "b", 20_000),
    (8, " \n\t  \n", "en", "b", 6),
    (9, "日本語のテキスト 한국어 😀 ñandú", "es", "b", 22),
    (10, "one two three four five six seven eight nine ten", "en", "c", 48),
]


def documents(spark, rows=AWKWARD):
    return spark.createDataFrame(rows, DOCUMENTS)


#: Names that operators use for their own columns or results.
CLASHING = "node class bucket spans sketch key score length start _slice tokens n ids".split()


def clashing(df):
    """The frame with further columns of such names."""
    for name in CLASHING:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("mine"))
    return df


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


def document_frequencies(df):
    """Weights of the runs of a small frame (doc_id, text), all held in one place.

    ``signatures`` counts the same without that.
    """
    keyed, total, ranges = wm._chunked(df)
    rows = [(r.runs, r.counts) for r in wm._asked(keyed, ranges).select("runs", "counts").collect()]
    runs, sums, _ = wm._summed([(b"", b""), *map(lambda r: (bytes(r[0]), bytes(r[1])), rows)])
    often = sums > 1
    return wm.Weights(total, runs[often], sums[often].astype(float))
