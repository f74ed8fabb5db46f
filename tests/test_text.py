"""Missing-value tokens, Unicode strip, lower-case."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditlake.functions.text import normalise_text, null_na_tokens, strip_unicode
from creditlake.schemas import NA_TOKENS


def test_na_tokens_become_null(spark):
    values = list(NA_TOKENS) + ["NA ", " ", "none", "value"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.o for r in df.select(null_na_tokens("s").alias("o")).collect()]
    assert got[: len(NA_TOKENS)] == [None] * len(NA_TOKENS)
    # exact match only: padded tokens, blanks and other spellings stay
    assert got[len(NA_TOKENS):] == ["NA ", " ", "none", "value"]


def test_strip_unicode_whitespace(spark):
    values = ["\t Foo \n", "\u3000bar\u00a0", "a b", "   ", "\x1fx\x1c", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.o for r in df.select(strip_unicode("s").alias("o")).collect()]
    assert got == ["Foo", "bar", "a b", "", "x", None]


def test_normalise_lowercases_after_strip(spark):
    df = spark.createDataFrame([(" ORG_001 ",), ("Type_1\t",), (None,)], "s string")
    got = [r.o for r in df.select(normalise_text(F.col("s")).alias("o")).collect()]
    assert got == ["org_001", "type_1", None]
