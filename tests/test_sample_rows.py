"""The repeatable row sample: bottom k by row hash, against a brute-force sort."""

import hashlib

import pytest

from kiln.operators import row_hash, sample_rows
from tests.conftest import rows


def _hash(values, seed=0):
    text = "|".join([str(seed), *["\\N" if v is None else str(v) for v in values]])
    return hashlib.md5(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def data():
    return [(i % 97, i, None if i % 11 == 0 else f"n\u00e9 {i}") for i in range(5000)]


@pytest.fixture(scope="module")
def table(spark, data):
    return spark.createDataFrame(data, "a INT, b INT, c STRING")


def test_hash_is_the_md5_of_the_values_as_text(table, data):
    got = {tuple(r[:3]): r.h for r in table.select("*", row_hash(["a", "b", "c"], 3).alias("h")).collect()}
    assert got == {t: _hash(t, 3) for t in data}


@pytest.mark.parametrize("k", [1, 40, 1000, 5000, 6000])
def test_sample_is_the_bottom_k_under_any_partitioning(table, data, k):
    want = sorted(sorted(data, key=_hash)[:k], key=lambda t: t[1])
    for df in (table, table.repartition(13, "c"), table.repartitionByRange(2, "b")):
        assert sorted(rows(sample_rows(df, k)), key=lambda t: t[1]) == want


def test_seeds_and_keys(table, data):
    by_key = rows(sample_rows(table, 50, "b", seed=5), "b")
    assert by_key == sorted((t[1],) for t in sorted(data, key=lambda t: _hash(t[1:2], 5))[:50])
    assert by_key != rows(sample_rows(table, 50, "b", seed=6), "b")


def test_repeated_rows_one_key_and_empty_tables(spark, table):
    same = spark.createDataFrame([(1,)] * 3000 + [(2,)], "a INT")
    assert sample_rows(same, 500).count() == 500 and sample_rows(same, 3001).count() == 3001
    assert sample_rows(table, 0).count() == 0 and sample_rows(table.limit(0), 5).count() == 0
