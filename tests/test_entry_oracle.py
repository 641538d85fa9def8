"""The driver contract, and every registered query against its SQL oracle (DuckDB)."""

import hashlib
import math

import pytest

from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        if hasattr(v, "as_tuple"):
            return str(v.normalize())
        return repr(v)

    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["l_partkey", "count", "p_name"]
    assert 0 < df.count() <= 10


def test_every_query_has_oracle():
    from __spark_entry__ import oracle_sql, queries
    missing = set(queries()) - set(oracle_sql())
    assert {k for k in missing if not k.startswith("op") and k != "pipeline"} == set()
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _names():
    from __spark_entry__ import oracle_sql
    return sorted(oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert _digest(got, df.columns) == _digest(want, ocols)


@pytest.mark.parametrize("name", ["popular_items_named", "similar_items", "popular_items", "spend_top5", "top_support_pairs"])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_ranked_rows_keep_their_order(spark, duck, name, threshold):
    from __spark_entry__ import oracle_sql, queries
    order = {"popular_items_named": "count DESC, l_partkey", "similar_items": "score DESC, other_item"}.get(name)
    sql = oracle_sql()[name]
    res = duck.execute(f"SELECT * FROM ({sql}) ORDER BY {order}" if order else sql)
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = [tuple(r[c] for c in cols) for r in queries()[name](spark, SF_SMALL).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [repr(r[0]) for r in got] == [repr(r[0]) for r in want] and len(got) == len(want)
