import math
import re

from pyspark.sql import functions as F

from kiln.functions import (ascii_only, collapse_whitespace, contains, cosine, field_at, has_ascii,
                            split_tokens, strip_ends, tenths_celsius_to_fahrenheit)

SAMPLES = [
    "5988 748 1722 ",
    "a  b",
    "  leading and trailing  ",
    "Café crème brûlée",
    "tab\tsep\x0bvt\x1cfs\x85nel nbsp emsp end",
    "line one\r\nline two",
    "",
    "under_score dash-word it's",
]


def _one(spark, col_expr, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    return [r[0] for r in df.orderBy("i").select(col_expr).collect()]


def test_whitespace_split_matches_python_str_split(spark):
    got = _one(spark, split_tokens(F.col("v"), "whitespace"), SAMPLES)
    assert got == [s.split() for s in SAMPLES]


def test_space_split_keeps_empty_tokens(spark):
    got = _one(spark, split_tokens(F.col("v"), "space"), SAMPLES[:2])
    assert got == [["5988", "748", "1722", ""], ["a", "", "b"]]


def test_ascii_word_split_is_ascii_only(spark):
    got = _one(spark, split_tokens(F.col("v"), "ascii_words"), ["Café crème"])
    assert got == [["Caf", "cr", "me"]]
    assert got == [re.split(r"\W+", "Café crème", flags=re.ASCII)]


def test_unicode_word_split_matches_python_unicode_w(spark):
    got = _one(spark, split_tokens(F.lower(F.col("v")), "unicode_words"), SAMPLES)
    assert got == [re.split(r"\W+", s.lower()) for s in SAMPLES]


def test_ascii_only_and_filter(spark):
    vals = ["Café", "日本", "naïve", ""]
    assert _one(spark, ascii_only("v"), vals) == [v.encode("ascii", "ignore").decode() for v in vals]
    assert _one(spark, has_ascii("v"), vals) == [True, False, True, False]


def test_strip_ends_collapse_and_field(spark):
    assert _one(spark, strip_ends("v"), ['"CAPTAIN AMERICA"', "x", ""]) == ["CAPTAIN AMERICA", "", ""]
    assert _one(spark, collapse_whitespace("v"), ['"A  B"  ']) == ['"A B"']
    assert _one(spark, field_at("v", 2), ["196\t242\t3\t881250949", "1 2"]) == ["3", None]


def test_contains_differs_from_equality(spark):
    assert _one(spark, contains("v", "TMAX"), ["TMAX", "XTMAX", "TMIN"]) == [True, True, False]


def test_fahrenheit_left_to_right(spark):
    df = spark.createDataFrame([(-75.0,), (123.0,)], "t DOUBLE")
    got = [r[0] for r in df.select(tenths_celsius_to_fahrenheit("t")).collect()]
    assert got == [t * .1 * 9. / 5 + 32. for t in (-75.0, 123.0)]


def test_cosine_zero_denominator(spark):
    df = spark.createDataFrame([(0, 0, 4), (6, 4, 9)], "n BIGINT, xx BIGINT, yy BIGINT")
    null_score = [r[0] for r in df.select(cosine("n", "xx", "yy", "null")).collect()]
    zero_score = [r[0] for r in df.select(cosine("n", "xx", "yy", "zero")).collect()]
    assert null_score[0] is None and zero_score[0] == 0.0
    assert math.isclose(null_score[1], 6 / (2 * 3)) and zero_score[1] == null_score[1]


def test_lower_matches_python_on_special_cases(spark):
    vals = ["ΟΔΟΣ ΣΑΣ", "İstanbul", "ẞTRASSE", "ÉCOLE Ünïcode", "ǅemal", "ΌΣΟΣ."]
    assert _one(spark, F.lower(F.col("v")), vals) == [v.lower() for v in vals]
