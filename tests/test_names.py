import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import names

RAW = [
    None, "", "\t", " ", "José-María", "Łukasz", "Straße", "ﬁnal", "x²", "a_b", "O'Neil  Jr.", "Иван",
    "محمد", "李小龙", "école", "a‍b", "\x1cA b\x1c", "İstanbul", "PLAIN Name ", " ½ ", "Ω™", "ÅNGSTRÖM__x",
]


def marks_off(t):
    return "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))


def squeeze(t):
    return re.sub(r"\s+", " ", t).strip()


GOLDEN = {
    names.norm_conservative: lambda t: squeeze(re.sub(r"[^\w\s]", " ", marks_off(t.strip()).lower())),
    names.norm_alias: lambda t: squeeze(re.sub(r"[^a-z0-9]+", " ", marks_off(t.strip()).lower())),
    names.norm_label: lambda t: squeeze(re.sub("_+", " ", re.sub(r"[^\w\s]", " ", marks_off(t.strip()).lower()))),
    names.norm_compact: lambda t: re.sub(r"[^a-z0-9]+", "", marks_off(t.strip().lower())),
    names.norm_words: lambda t: squeeze(re.sub(r"[^\w\s]", " ", t.lower().strip())),
    names.norm_ascii: lambda t: squeeze(re.sub(r"[^a-z0-9]+", " ", t.strip().lower())),
    names.norm_space: lambda t: " ".join(t.strip().lower().split()),
}


@pytest.mark.parametrize("column_function", GOLDEN, ids=lambda f: f.__name__)
def test_key_equals_golden(spark, column_function):
    df = spark.createDataFrame(list(enumerate(RAW)), "i int, raw string")
    got = {r.i: r.k for r in df.select("i", column_function(F.col("raw")).alias("k")).collect()}
    want = {i: "" if t is None else GOLDEN[column_function](t) for i, t in enumerate(RAW)}
    assert got == want


def test_casefold_and_blank_names(spark):
    df = spark.createDataFrame([("Straße",), ("STRASSE ",), (" \t",), (None,)], "raw string")
    got = df.select(
        names.norm_casefold(F.col("raw")).alias("f"), names.norm_space(F.col("raw"), None).alias("s")
    ).collect()
    assert [r.f for r in got] == ["strasse", "strasse", "", None]
    assert [r.s for r in got] == ["straße", "strasse", None, None]
