"""Answers worked out by hand on small invented files."""

import math

from pyspark.sql import functions as F

from kiln.functions import round_half_up
from kiln.operators import all_pairs_similarity, group_count, group_mean, group_sum, similar_to_item, top_k
from kiln.plans import files
from kiln.sources import read_delimited
from tests.conftest import rows

# id, name, age, friends
PEOPLE = ["0,Ada,18,10", "1,Bo,18,15", "2,Cy,18,16", "3,Di,21,7", "4,Ed,30,1", "5,Flo,30,2", "6,Gus,13,4", "7,Hal,12,3"]
# user, item, rating, time: users 1-3 rate items 1 and 2, users 1 and 2 item 3 as well, user 4 one item only
RATINGS = ["1\t1\t5\t1", "1\t2\t4\t2", "1\t3\t1\t3", "2\t1\t3\t4", "2\t2\t3\t5", "2\t3\t2\t6", "3\t1\t1\t7",
           "3\t2\t2\t8", "4\t3\t5\t9"]
RATING_SCHEMA = "user_id INT, item_id INT, rating INT, ts BIGINT"


def _write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_people(spark, tmp_path):
    plain = _write(tmp_path / "people.csv", PEOPLE)
    header = _write(tmp_path / "people-header.csv", ["id,name,age,friends", *PEOPLE])
    with_header = read_delimited(spark, header, header=True, infer_schema=True)
    without = read_delimited(spark, plain, schema="id INT, name STRING, age INT, friends INT", quote=None, mode="FAILFAST")
    assert rows(with_header) == rows(without.toDF(*with_header.columns))
    avg = dict(rows(group_mean(with_header, "age", "friends", "m").withColumn("m", round_half_up("m", 2))))
    assert avg == {18: 13.67, 21: 7.0, 30: 1.5, 13: 4.0, 12: 3.0}
    assert with_header.agg(F.sum("friends")).first()[0] == 58
    assert [tuple(r) for r in top_k(group_count(with_header, "age", "count"), 2, ["-count"], ["age"]).collect()] == [
        (18, 3), (30, 2)]
    by_age = [(r.age, r.friends_avg_rounded) for r in files.friends_by_age(spark, plain).collect()]
    assert by_age == [(12, 3.0), (13, 4.0), (18, 13.67), (21, 7.0), (30, 1.5)]
    assert sorted(r.id for r in files.people_between(spark, plain, 12, 20).collect()) == [0, 1, 2, 6]


def test_ratings(spark, tmp_path):
    data = read_delimited(spark, _write(tmp_path / "u.data", RATINGS), schema=RATING_SCHEMA, sep="\t")
    assert dict(rows(group_count(data, "rating", "count"))) == {1: 2, 2: 2, 3: 2, 4: 1, 5: 2}
    popular = top_k(group_count(data, "item_id", "count"), 2, ["-count"], ["item_id"])
    assert [tuple(r) for r in popular.collect()] == [(1, 3), (2, 3)]
    assert group_sum(data.withColumn("k", F.lit(1)), "k", "rating", "t").first()["t"] == 26


def test_similarity(spark, tmp_path):
    data = read_delimited(spark, _write(tmp_path / "u.data", RATINGS), schema=RATING_SCHEMA, sep="\t")
    want = {(1, 2): ((20 + 9 + 2) / (math.sqrt(35) * math.sqrt(29)), 3),
            (1, 3): ((5 + 6) / (math.sqrt(34) * math.sqrt(5)), 2), (2, 3): ((4 + 6) / (math.sqrt(25) * math.sqrt(5)), 2)}
    got = {(r.item_1, r.item_2): (r.score, r.num_pairs) for r in all_pairs_similarity(data).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k][0], want[k][0]) and got[k][1] == want[k][1] for k in want)
    top = similar_to_item(data, 2, min_score=0.5, min_support=1, k=10).collect()
    assert [(r.item_1, r.item_2, r.other_item, r.num_pairs) for r in top] == [(2, 1, 1, 3), (3, 2, 3, 2)]
    assert [r.other_item for r in similar_to_item(data, 2, min_score=0.5, min_support=2, k=10).collect()] == [1]
