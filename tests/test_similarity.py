import math
import random
from collections import defaultdict
from itertools import combinations

import pytest

from kiln.operators import similarity
from kiln.operators import all_pairs_similarity, pairs_above_support, rating_pairs, similar_to_item, top_pairs_by_support
from tests.conftest import rows

RATINGS = [
    # user, item, rating: user 1 rates many items (a "hot" user when split_rows is small)
    (1, 10, 5), (1, 20, 3), (1, 30, 4), (1, 40, 1), (1, 50, 2), (1, 60, 5),
    (2, 10, 4), (2, 20, 2), (2, 50, 5),
    (3, 20, 1), (3, 30, 1), (3, 50, 4),
    (4, 50, 3),                      # single-item user: no pairs
    (5, 10, 2), (5, 60, 2), (5, 50, 1),
]


def brute_force(ratings, orientation="asc"):
    by_user = defaultdict(list)
    for u, i, r in ratings:
        by_user[u].append((i, r))
    acc = defaultdict(lambda: [0, 0, 0, 0])
    for items in by_user.values():
        for (i, ri), (j, rj) in combinations(items, 2):
            if i == j:
                continue
            (a, ra), (b, rb) = ((i, ri), (j, rj)) if (i < j) == (orientation == "asc") else ((j, rj), (i, ri))
            s = acc[(a, b)]
            s[0] += ra * rb
            s[1] += ra * ra
            s[2] += rb * rb
            s[3] += 1
    return {k: (v[0] / (math.sqrt(v[1]) * math.sqrt(v[2])), v[3]) for k, v in acc.items()}


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame(RATINGS, "user_id INT, item_id INT, rating INT")


def test_pair_count_property(ratings):
    n = defaultdict(int)
    for u, _, _ in RATINGS:
        n[u] += 1
    assert rating_pairs(ratings).count() == sum(k * (k - 1) // 2 for k in n.values())


@pytest.mark.parametrize("orientation", ["asc", "desc"])
def test_all_pairs_equals_brute_force(ratings, orientation):
    got = {(a, b): (s, n) for a, b, s, n in rows(all_pairs_similarity(ratings, orientation=orientation))}
    want = brute_force(RATINGS, orientation)
    assert got.keys() == want.keys()
    for k in want:
        assert math.isclose(got[k][0], want[k][0], rel_tol=1e-12) and got[k][1] == want[k][1]
        assert 0 <= got[k][0] <= 1 + 1e-12


def test_hot_user_split_gives_same_result(ratings):
    plain = rows(all_pairs_similarity(ratings, split_rows=None))
    split = rows(all_pairs_similarity(ratings, split_rows=2))
    assert plain == split
    assert rows(rating_pairs(ratings, split_rows=2)) == rows(rating_pairs(ratings, split_rows=None))


def test_similar_to_item_equals_filtered_all_pairs(ratings):
    allp = {(a, b): (s, n) for a, b, s, n in rows(all_pairs_similarity(ratings, orientation="desc"))}
    want = sorted((a, b, (b if a == 50 else a), s, n) for (a, b), (s, n) in allp.items() if 50 in (a, b))
    got = rows(similar_to_item(ratings, 50, k=None))
    assert [g[:3] + (g[4],) for g in got] == [w[:3] + (w[4],) for w in want]
    for g, w in zip(got, want):
        assert math.isclose(g[3], w[3], rel_tol=1e-12)
    top = similar_to_item(ratings, 50, min_score=0.5, min_support=1, k=2).collect()
    assert len(top) == 2 and top[0].score >= top[1].score


def test_zero_vector_scores(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 2, 3)], "user_id INT, item_id INT, rating INT")
    assert rows(all_pairs_similarity(df, zero_denominator="zero"), "score") == [(0.0,)]
    assert rows(all_pairs_similarity(df, zero_denominator="null"), "score") == [(None,)]


def test_hot_user_grid_split_large(spark):
    # One user holds most rows (a third or more of the table); an 8 x 8 grid of slices.
    data = [(1, i, i % 5 + 1) for i in range(40)] + [(u, i, (u + i) % 5 + 1) for u in range(2, 8) for i in range(0, 40, 7)]
    df = spark.createDataFrame(data, "user_id INT, item_id INT, rating INT")
    split = rows(all_pairs_similarity(df, split_rows=5))
    assert split == rows(all_pairs_similarity(df, split_rows=None))
    want = brute_force(data)
    assert {(a, b): n for a, b, _, n in split} == {k: v[1] for k, v in want.items()}


@pytest.mark.parametrize("orientation", ["asc", "desc"])
def test_pairs_are_added_up_in_tasks_of_bounded_size(spark, monkeypatch, orientation):
    """As many tasks as the pair rows ask for, whatever the shuffle setting; an item above the bound is dealt to several."""
    monkeypatch.setattr(similarity, "TASK_PAIRS", 40)
    rng = random.Random(3)
    data = [(u, 0, u % 5) for u in range(60)] + [(u, rng.randint(1, 30), rng.randint(0, 4)) for u in range(60) for _ in range(6)]
    data += [(60, i, 3) for i in range(31)] + [(None, 1, 2), (1, None, 2), (2, 9, None)]  # repeats and nulls too
    df = spark.createDataFrame(data, "user_id INT, item_id INT, rating INT").repartition(3)
    got = all_pairs_similarity(df, orientation=orientation, split_rows=7)
    made = rating_pairs(df).count()
    assert got.rdd.getNumPartitions() >= made // 40 > 8
    want = similarity.pair_similarity(rating_pairs(df, orientation=orientation), "zero")
    assert rows(got) == rows(want)


def test_no_pair_row_is_shuffled(spark):
    """Many pair rows of few pairs: the records that reach an exchange are lists and sums, fewer than the pair rows."""
    df = spark.createDataFrame([(u, i, 1) for u in range(40) for i in range(25)], "user_id INT, item_id INT, rating INT")
    out = all_pairs_similarity(df)
    assert out.count() == 300
    assert _exchanged_rows(out) < rating_pairs(df).count() / 3


def test_sums_of_a_pair_are_not_shuffled(spark):
    """Nearly every pair has one rater: as many sums as pair rows, and fewer records reach an exchange than half of them."""
    rng = random.Random(11)
    data = [(u, i, 1 + u % 5) for u in range(60) for i in rng.sample(range(2000), 15)]
    out = all_pairs_similarity(spark.createDataFrame(data, "user_id INT, item_id INT, rating INT"))
    assert out.count() > 6000
    assert _exchanged_rows(out) < 3000


@pytest.mark.parametrize("orientation", ["asc", "desc"])
@pytest.mark.parametrize("kind,item,rating", [
    ("smallint", lambda i: i - 5, lambda r: r - 2), ("int", lambda i: i * 1_001 - 9, lambda r: r), ("int", lambda i: i * 69_000, lambda r: r), ("int", lambda i: i * 90_001 - 7, lambda r: 90 * r), ("bigint", lambda i: i << 40, lambda r: r - 4),
    (None, lambda i: (i - 8) << 59, lambda r: r << 2), (None, lambda i: f"i{i}", lambda r: r), (None, lambda i: i, lambda r: r / 4)])
def test_lists_hold_any_item_and_rating(spark, kind, item, rating, orientation):
    """Codes of every width, in one array and in two (17 and 24 bits), and structs: users of one and of several slices, repeats, NULL ratings, hot items."""
    rng = random.Random(2)
    data = [(u, item(rng.randint(0, 15)), None if rng.random() < 0.1 else rating(rng.randint(0, 5))) for u in range(30) for _ in range(rng.randint(1, 12))]
    types = {str: "STRING", int: "BIGINT", float: "DOUBLE"}
    df = spark.createDataFrame(data, f"user_id INT, item_id {types[type(item(1))]}, rating {types[type(rating(1))]}")
    assert similarity._Codes(similarity._known(df, "user_id", "item_id", "rating")).dtype == kind
    want = rows(similarity.pair_similarity(rating_pairs(df, orientation=orientation), "zero"))
    got = rows(all_pairs_similarity(df, orientation=orientation, split_rows=6))
    assert [(a, b, n) for a, b, _, n in got] == [(a, b, n) for a, b, _, n in want]
    for g, w in zip(got, want):
        assert g[2] == w[2] or math.isclose(g[2], w[2], rel_tol=1e-12)


@pytest.fixture
def shuffled(monkeypatch):
    """Records that reach an exchange on the way to each table written, in a list."""
    found, write = [], similarity.Scratch.write
    monkeypatch.setattr(similarity.Scratch, "write", lambda self, df, *a, **k: (found.append(_exchanged_rows(df)), write(self, df, *a, **k))[1])
    return found


def test_rows_of_a_support_threshold_are_shuffled_a_few_times(spark, shuffled):
    """All rows and steps counted: the raters in order, the cuts, the lists, the pairs; most pairs have one rater."""
    rng = random.Random(7)
    data = [(u, i, 1 + u % 5) for u in range(100) for i in rng.sample(range(150), 20)]
    df = spark.createDataFrame(data, "user_id INT, item_id INT, rating INT")
    out = pairs_above_support(df, 6)
    sums = defaultdict(int)
    for u in range(100):
        for pair in combinations(sorted(i for v, i, _ in data if v == u), 2):
            sums[pair] += 1
    assert {(a, b): n for a, b, _, n in rows(out)} == {k: n for k, n in sums.items() if n > 6}
    assert sum(shuffled) + _exchanged_rows(out) < 5 * len(data)


def test_top_pairs_shuffle_rows_a_few_times_and_no_sums(spark, shuffled):
    rng = random.Random(9)
    data = [(u, i, 1 + u % 5) for u in range(100) for i in rng.sample(range(1000), 20)]
    df = spark.createDataFrame(data, "user_id INT, item_id INT, rating INT")
    out = top_pairs_by_support(df, 5, unique=True)
    every = sorted(rows(similarity.pair_similarity(rating_pairs(df, orientation="asc"))), key=lambda t: (-t[3], t[0], t[1]))
    assert len(every) > 15_000 and [tuple(r) for r in out.collect()] == every[:5]
    assert sum(shuffled) + _exchanged_rows(out) < 7 * len(data)


def _exchanged_rows(df):
    """Rows written by the exchanges of a plan that has run."""
    df.collect()
    found, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            left.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            left.append(node.plan())
        if node.nodeName() == "Exchange":
            found += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        left += [children.apply(k) for k in range(children.size())]
    return found


def _random_ratings(seed, users=60, items=14):
    """A user of every item, users of a few, two items rated alike and one rated once."""
    rng = random.Random(seed)
    data = [(0, i, rng.randint(0, 5)) for i in range(items)]
    for u in range(1, users):
        share = rng.choice([0.05, 0.3, 0.9])
        data += [(u, i, rng.randint(0, 5)) for i in range(items - 3) if rng.random() < share]
        if u % 2:
            data += [(u, items - 3, 2), (u, items - 2, 4)]
    return data


@pytest.mark.parametrize("min_support,held_back", [(1, None), (5, None), (8, 8), (8, 1), (20, None), (29, 7), (100, None)])
def test_pairs_above_support_equal_filtered_brute_force(spark, min_support, held_back):
    data = _random_ratings(min_support)
    df = spark.createDataFrame(data, "user_id INT, item_id INT, rating INT")
    got = {(a, b): (s, n) for a, b, s, n in rows(pairs_above_support(df, min_support, held_back=held_back, split_rows=4))}
    sums = defaultdict(lambda: [0, 0, 0, 0])
    by_user = defaultdict(list)
    for u, i, r in data:
        by_user[u].append((i, r))
    for rated in by_user.values():
        for (i, a), (j, b) in combinations(sorted(rated), 2):
            for k, v in enumerate((a * b, a * a, b * b, 1)):
                sums[i, j][k] += v
    want = {k: v for k, v in sums.items() if v[3] > min_support}
    assert got.keys() == want.keys() and (min_support == 100) == (not want)
    for k, (xy, xx, yy, n) in want.items():
        assert got[k][1] == n and math.isclose(got[k][0], xy / math.sqrt(xx * yy) if xx * yy else 0.0, rel_tol=1e-12)


def test_pairs_above_support_with_nulls_and_bad_arguments(spark):
    data = [(u, i, None if (u, i) == (3, 1) else 2) for u in range(6) for i in (1, 2)] + [(None, 1, 5), (7, None, 5)]
    df = spark.createDataFrame(data, "user_id INT, item_id INT, rating INT")
    want = rows(all_pairs_similarity(df, min_support=4))
    assert len(want) == 1 and rows(all_pairs_similarity(df, min_support=4, unique=True)) == want
    assert rows(all_pairs_similarity(df, min_support=5, unique=True)) == []
    assert rows(pairs_above_support(df.limit(0), 3)) == []
    for support, held_back in ((0, None), (3, 4), (3, 0)):
        with pytest.raises(ValueError):
            pairs_above_support(df, support, held_back=held_back)


def test_support_of_repeated_ratings_counts_every_pair_of_rows(spark):
    df = spark.createDataFrame([(1, 1, 2), (1, 1, 3), (1, 2, 4), (1, 2, 5)], "user_id INT, item_id INT, rating INT")
    assert rows(all_pairs_similarity(df, min_support=3), "item_1", "item_2", "num_pairs") == [(1, 2, 4)]


@pytest.mark.parametrize("k,share", [(1, 0.1), (3, 0.0), (3, 9.0), (10, 0.0), (1000, 0.1)])
def test_top_pairs_by_support(spark, monkeypatch, k, share):
    monkeypatch.setattr(similarity, "HELD_BACK_SHARE", share)
    df = spark.createDataFrame(_random_ratings(k), "user_id INT, item_id INT, rating INT")
    every = sorted(rows(all_pairs_similarity(df)), key=lambda t: (-t[3], t[0], t[1]))[:k]
    for unique in (True, False):
        got = [tuple(r) for r in top_pairs_by_support(df, k, unique=unique).collect()]
        assert [(a, b, n) for a, b, _, n in got] == [(a, b, n) for a, b, _, n in every]


def test_prefix_filter_pairs_fewer_rows_than_the_full_join(spark):
    """Rows that are paired or looked up, counted on ratings where a few users have rated nearly everything."""
    rng = random.Random(5)
    data = [(u, i, 1) for u in range(8) for i in range(60)] + \
           [(u, i, 1) for u in range(8, 400) for i in rng.sample(range(60), 3)] + \
           [(u, i, 1) for u in range(400, 430) for i in (60, 61, 62)]
    df = spark.createDataFrame(data, "user_id INT, item_id INT, rating INT")
    out = pairs_above_support(df, 16)
    assert rows(out, "item_1", "item_2", "num_pairs") == [(60, 61, 30), (60, 62, 30), (61, 62, 30)]
    full = rating_pairs(df).count()
    assert _joined_rows(out) + _written_pair_rows(spark, df, 16) < full / 5


def _joined_rows(df):
    """Rows of the largest join of a plan that has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, left = [0], [plan]
    while left:
        node = left.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            left.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            left.append(node.plan())
        if "Join" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        left += [children.apply(k) for k in range(children.size())]
    return max(found)


def _written_pair_rows(spark, df, min_support):
    from kiln.operators.similarity import _known, _rater_lists
    lists = _rater_lists(_known(df, "user_id", "item_id", "rating"), min_support, min_support // 2)
    return rating_pairs(lists.where("_key < _cut"), "_u", "_i", "_r").count()
