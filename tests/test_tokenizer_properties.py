"""Property tests: the JVM tokenizers agree with Python's own string splitting."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiln.functions import split_tokens

# Characters that stress the patterns: ASCII and Unicode white space, separators,
# control characters Python treats as white space, letters with diacritics,
# non-Latin scripts, digits, underscore and punctuation.
ALPHABET = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0        　"
            "​﻿abcXYZéÉüßçñøΩωЖж日本٣_0-9.,;'\"!?")

texts = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=12)


def _split_all(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts)
def test_whitespace_tokenizer_is_str_split(spark, values):
    assert _split_all(spark, values, split_tokens(F.col("v"), "whitespace")) == [v.split() for v in values]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts)
def test_unicode_word_tokenizer_is_python_w(spark, values):
    got = _split_all(spark, values, split_tokens(F.col("v"), "unicode_words"))
    assert got == [re.split(r"\W+", v) for v in values]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts)
def test_ascii_word_tokenizer_is_ascii_w(spark, values):
    got = _split_all(spark, values, split_tokens(F.col("v"), "ascii_words"))
    assert got == [re.split(r"\W+", v, flags=re.ASCII) for v in values]
