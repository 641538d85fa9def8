import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kiln.operators import (closed_form_square_sum, distinct_keys, first_row,
                            global_extreme, group_count, group_extreme, group_mean,
                            group_mean_by_parts, group_sum, lookup, lookup_few, other_of_pair,
                            sum_of_squares, top_k, total_count, word_count)
from tests.conftest import rows

PEOPLE = [(0, "Will", 33, 385), (1, "Jean", 26, 2), (2, "Hugh", 55, 221), (3, "Deanna", 40, 465),
          (4, "Quark", 68, 21), (5, "Weyoun", 59, 318), (6, "Gowron", 37, 220), (7, "Will", 33, 100),
          (8, "Nobody", None, 7)]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, "id INT, name STRING, age INT, friends INT")


def test_mean_two_formulations_agree(people):
    a = rows(group_mean(people, "age", "friends", "avg"))
    b = rows(group_mean_by_parts(people, "age", "friends", "avg"))
    assert a == b
    assert (33, 242.5) in a and (None, 7.0) in a  # NULL key is its own group


def test_exact_sum_is_order_independent(spark):
    vals = [(1, 0.1), (1, 0.2), (1, 0.3), (2, 37.19), (2, 65.89)]
    df = spark.createDataFrame(vals, "k INT, v DOUBLE").repartition(3)
    got = dict(rows(group_sum(df, "k", "v", "total", exact_scale=2)))
    assert got == {1: 0.6, 2: 103.08}
    assert dict(rows(group_mean(df, "k", "v", "m", exact_scale=2)))[1] == 0.6 / 3


def test_counts_extremes_distinct_total(people):
    assert rows(group_count(people, "name", "n")) == [
        ("Deanna", 1), ("Gowron", 1), ("Hugh", 1), ("Jean", 1), ("Nobody", 1), ("Quark", 1),
        ("Weyoun", 1), ("Will", 2)]
    assert rows(group_extreme(people, "name", "friends", "max", "mx")).count(("Will", 385)) == 1
    assert rows(group_extreme(people, "name", "friends", "min", "mn")).count(("Will", 100)) == 1
    assert rows(distinct_keys(people, "name")) == sorted({(p[1],) for p in PEOPLE})
    assert rows(total_count(people, "n")) == [(len(PEOPLE),)]
    assert rows(global_extreme(people, "friends", "min", "m")) == [(2,)]


def test_sum_of_squares_and_closed_form(spark):
    n = 10 ** 6
    got = sum_of_squares(spark.range(n), "id").first()
    assert int(got["sum_of_squares"]) == 333332833333500000 and got["n"] == n
    closed = spark.range(1).select(closed_form_square_sum(F.lit(n)).alias("c")).first()["c"]
    assert int(closed) == 333333833333500000  # sums 1..n, so it differs by n^2
    assert int(closed) - int(got["sum_of_squares"]) == n * n


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(i, c) for i, c in [(5, 3), (1, 3), (3, 3), (2, 9), (4, 1)]], "k INT, c INT")
    assert [r.k for r in top_k(df, 3, ["-c"], ["k"]).collect()] == [2, 1, 3]
    assert [r.k for r in first_row(df, ["c"], ["k"]).collect()] == [4]


BOOK = [
    "Half-Day Walks: Nine Easy Hills and Three of Them Steep",
    "Reading the Weather from a Small Garden Business",
    "By Nobody Inparticular  \t Café crème déjà-vu naïve 日本語 business",
    "",
    "  trailing   spaces business  ",
]


def test_word_counts_match_python(spark):
    df = spark.createDataFrame([(t,) for t in BOOK], "value STRING")
    # DataFrame form: ASCII \W+ split, empties dropped, then lower-cased.
    expect = Counter(w.lower() for line in BOOK for w in re.split(r"\W+", line, flags=re.ASCII) if w)
    assert dict(rows(word_count(df, tokenizer="ascii_words", lower="after"))) == dict(expect)
    # RDD form: lower, Unicode \W+ split, count, keep tokens with an ASCII character.
    uni = Counter(w for line in BOOK for w in re.split(r"\W+", line.lower()))
    expect_u = {(w, w.encode("ascii", "ignore").decode(), c) for w, c in uni.items()
                if w.encode("ascii", "ignore")}
    assert set(rows(word_count(df, tokenizer="unicode_words", lower="before", ascii_filter=True))) == expect_u
    # Active form: str.split(), case kept.
    raw = Counter(w for line in BOOK for w in line.split())
    expect_r = {(w, w.encode("ascii", "ignore").decode(), c) for w, c in raw.items()
                if w.encode("ascii", "ignore")}
    assert set(rows(word_count(df, tokenizer="whitespace", ascii_filter=True))) == expect_r


def test_lookup_broadcast_strict_and_few(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id INT, n INT")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "id INT, name STRING")
    assert rows(lookup(facts, dim, "id")) == [(1, 10, "one"), (2, 20, "two"), (3, 30, None)]
    with pytest.raises(Exception):
        lookup(facts, dim, "id", strict_column="name").collect()
    top = top_k(facts, 2, ["-n"], ["id"])
    assert rows(lookup_few(top, dim, "id", "name")) == [(2, 20, "two"), (3, 30, None)]
    pairs = spark.createDataFrame([(50, 7), (9, 50)], "a INT, b INT")
    assert rows(pairs.select(other_of_pair("a", "b", 50).alias("o"))) == [(7,), (9,)]


def test_lookup_tells_a_null_name_from_a_missing_key_and_takes_the_last_row(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20)], "id INT, n INT")
    dim = spark.createDataFrame([(1, None, 0), (2, "old", 0), (2, "new", 1)], "id INT, name STRING, line INT")
    for look in (lambda: lookup(facts, dim, "id", strict_column="name", last_by="line").select("id", "n", "name"),
                 lambda: lookup_few(facts, dim, "id", "name", ["-n"], strict_column="name", last_by="line")):
        assert [tuple(r) for r in look().orderBy("id").collect()] == [(1, 10, None), (2, 20, "new")]
    assert [r.id for r in lookup_few(facts, dim, "id", "name", ["-n"], last_by="line").collect()] == [2, 1]


def test_exact_sum_keeps_every_decimal(spark):
    df = spark.createDataFrame([(1, 0.004), (1, 0.004), (1, 0.004), (2, 37.194), (2, 0.004)], "k INT, v DOUBLE")
    for scale in (12, 2):
        assert dict(rows(group_sum(df, "k", "v", "total", exact_scale=scale))) == {1: 0.012, 2: 37.198}


def test_exact_sum_takes_any_double(spark):
    inf, nan = float("inf"), float("nan")
    vals = {"carry": [0.1 + 0.2], "third": [1 / 3] * 3, "tiny": [1e-300, 1e-300], "least": [5e-324] * 3, "huge": [1e300, 1e300],
            "mixed": [1e20, 1.5, -1e20, 0.1 + 0.2], "zero": [0.0, -0.0], "inf": [1.0, inf], "both": [inf, -inf], "nan": [nan, 1.0],
            "null": [None, None], "some": [None, 2.5], "top": [1.7976931348623157e308, 1e308]}
    df = spark.createDataFrame([(k, v) for k, vs in vals.items() for v in vs], "k STRING, v DOUBLE").repartition(5)
    got = dict(rows(group_sum(df, "k", "v", "total", exact_scale=12)))
    want = {"carry": 0.30000000000000004, "third": 0.9999999999999999, "tiny": 2e-300, "least": 1.5e-323, "huge": 2e300,
            "mixed": 1.8, "zero": 0.0, "inf": inf, "null": None, "some": 2.5, "top": inf}
    assert {k: got[k] for k in want} == want
    assert math.isnan(got["both"]) and math.isnan(got["nan"])
    means = dict(rows(group_mean(df, "k", "v", "m", exact_scale=12)))
    assert means["some"] == 2.5 and means["null"] is None


def test_exact_sum_does_not_depend_on_the_order(spark):
    rng = random.Random(4)
    vals = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-18, 18) for _ in range(400)]
    sums = set()
    for _ in range(3):
        rng.shuffle(vals)
        df = spark.createDataFrame([(1, v) for v in vals], "k INT, v DOUBLE").repartition(rng.randint(1, 6))
        sums.add(group_sum(df, "k", "v", "total", exact_scale=12).first().total)
    assert len(sums) == 1 and math.isclose(sums.pop(), math.fsum(vals), rel_tol=1e-14)
