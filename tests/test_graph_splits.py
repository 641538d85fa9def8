import random
import re
from collections import defaultdict, deque

import pytest

from kiln.operators import graph
from kiln.operators import (bfs, bfs_target, contiguous_folds, degree_ranking, fold_parts,
                            global_row_number, holdout_split, least_connected, node_degrees,
                            nodes_at_minimum, running_number)
from kiln.scratch import Scratch
from tests.conftest import rows

EDGES = [(1, 2), (1, 3), (1, 3), (2, 4), (3, 4), (3, 4), (4, 5), (5, 6), (6, 7), (7, 8), (8, 9),
         (10, 11), (2, 1), (12, 1)]


def python_bfs(edges, start, levels):
    adj = defaultdict(list)
    for s, d in edges:
        adj[s].append(d)
    dist = {start: 0}
    q = deque([start])
    while q:
        n = q.popleft()
        if dist[n] >= levels:
            continue
        for m in adj[n]:
            if m not in dist:
                dist[m] = dist[n] + 1
                q.append(m)
    return dist


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "src BIGINT, dst BIGINT")


def test_bfs_distances_and_colors(edges):
    got = {n: (d, c) for n, d, c in rows(bfs(edges, 1, max_levels=5))}
    want = python_bfs(EDGES, 1, 5)
    for n, (d, c) in got.items():
        if n in want:
            assert d == want[n]
            assert c == ("BLACK" if d < 5 else "GRAY")
        else:
            assert (d, c) == (9999, "WHITE")
    # every edge source is listed, and reached sinks without own edges too
    assert set(got) == {s for s, _ in EDGES} | set(want)


def test_bfs_stops_when_frontier_empty(edges):
    got = {n: (d, c) for n, d, c in rows(bfs(edges, 10, max_levels=5))}
    assert got[10] == (0, "BLACK") and got[11] == (1, "BLACK") and got[1] == (9999, "WHITE")


def test_bfs_target_counts_repeated_edges(edges):
    r = bfs_target(edges, 1, 4, max_levels=5).first()
    # level 2: frontier {2, 3}; edges 2->4 once and 3->4 twice
    assert (r.degrees, r.hits) == (2, 3)
    assert bfs_target(edges, 1, 99, max_levels=5).first().degrees is None
    assert tuple(bfs_target(edges, 1, 1).first())[2:] == (0, 0)


def test_degrees_ranking_and_minimum(spark):
    lines = spark.createDataFrame([(5988, 3), (5989, 2), (5988, 1), (7, 0), (8, 0)], "node INT, degree INT")
    deg = node_degrees(lines)
    assert [tuple(r) for r in degree_ranking(deg).collect()] == [(5988, 4), (5989, 2), (7, 0), (8, 0)]
    assert rows(least_connected(deg, 1)) == [(7, 0), (8, 0)]
    assert rows(nodes_at_minimum(deg)) == [(7, 0), (8, 0)]


@pytest.fixture(scope="module")
def shuffled(spark):
    rnd = random.Random(7)
    data = [(u, i, rnd.randint(1, 5)) for u in range(1, 40) for i in rnd.sample(range(1, 300), rnd.randint(1, 30))]
    rnd.shuffle(data)
    return data, spark.createDataFrame(data, "user_id INT, item_id INT, rating INT").repartition(5)


def test_global_row_number_is_dense_and_ordered(shuffled):
    data, df = shuffled
    got = rows(global_row_number(df, ["user_id", "item_id"], partitions=4), "row_num", "user_id", "item_id")
    want = [(n + 1, u, i) for n, (u, i, _) in enumerate(sorted(data))]
    assert got == want


def test_running_number_per_user(shuffled):
    data, df = shuffled
    got = rows(running_number(df, "user_id", ["item_id"]), "user_id", "item_id", "rank_in_key")
    want, seen = [], defaultdict(int)
    for u, i, _ in sorted(data):
        seen[u] += 1
        want.append((u, i, seen[u]))
    assert got == sorted(want)


@pytest.mark.parametrize("max_test", [0, 25])
def test_holdout_matches_line_by_line_reference(shuffled, max_test):
    data, df = shuffled
    got = rows(holdout_split(df, "user_id", ["item_id"], 2, 4, max_test=max_test), "user_id", "item_id", "part")
    count, tests, want = defaultdict(int), 0, []
    for u, i, _ in sorted(data):  # input order = (user, item)
        count[u] += 1
        if (tests < max_test or max_test <= 0) and 2 <= count[u] <= 4:
            tests += 1
            want.append((u, i, "test"))
        else:
            want.append((u, i, "base"))
    assert got == sorted(want)


def test_contiguous_folds_cover_and_are_disjoint(shuffled):
    data, df = shuffled
    folded = contiguous_folds(df, ["user_id", "item_id"], 5)
    got = rows(folded, "user_id", "item_id", "fold")
    want = [(u, i, n * 5 // len(data) + 1) for n, (u, i, _) in enumerate(sorted(data))]
    assert got == sorted(want)
    test, base = fold_parts(folded, 2, order=["user_id", "item_id"])
    t, b = [tuple(r)[:2] for r in test.collect()], [tuple(r)[:2] for r in base.collect()]
    assert t == sorted(t) and b == sorted(b)
    assert not set(t) & set(b) and len(t) + len(b) == len(data)


def test_bfs_edge_property_on_random_graph(spark):
    rnd = random.Random(11)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(150)]
    df = spark.createDataFrame(edges, "src BIGINT, dst BIGINT")
    dist = {n: d for n, d, _ in rows(bfs(df, 0, max_levels=4))}
    assert dist == {**{s: 9999 for s, _ in edges}, **python_bfs(edges, 0, 4)}
    for s, d in edges:
        if dist[s] < 4:
            assert dist[d] <= dist[s] + 1


def test_null_user_rows_are_kept(spark):
    df = spark.createDataFrame([(None, 1, 3), (None, 2, 4), (1, 1, 5), (1, 2, 1), (1, 3, 2)],
                               "user_id INT, item_id INT, rating INT")
    got = rows(holdout_split(df, "user_id", ["item_id"], 1, 1, max_test=2), "user_id", "item_id", "part")
    assert got == [(None, 1, "test"), (None, 2, "base"), (1, 1, "test"), (1, 2, "base"), (1, 3, "base")]
    ranks = rows(running_number(df, "user_id", ["item_id"]), "user_id", "item_id", "rank_in_key")
    assert ranks == [(None, 1, 1), (None, 2, 2), (1, 1, 1), (1, 2, 2), (1, 3, 3)]


def test_hot_user_is_split_across_range_partitions(spark):
    from pyspark.sql import functions as F
    data = [(1, i, 1) for i in range(2000)] + [(u, i, 2) for u in range(2, 100) for i in range(10)]
    df = spark.createDataFrame(data, "user_id INT, item_id INT, rating INT")
    ranged = df.repartitionByRange(8, "user_id", "item_id")
    hot_parts = ranged.where(F.col("user_id") == 1).select(F.spark_partition_id()).distinct().count()
    assert hot_parts >= 4  # the hot user's rows are spread over several tasks
    got = rows(global_row_number(df, ["user_id", "item_id"], partitions=8), "row_num")
    assert got == [(n,) for n in range(1, len(data) + 1)]
    ranks = running_number(df, "user_id", ["item_id"]).where(F.col("user_id") == 1)
    assert rows(ranks, "rank_in_key") == [(n,) for n in range(1, 2001)]


def test_bfs_target_strict_neighbours(spark):
    back = spark.createDataFrame([(1, 2), (2, 1), (2, 3)], "src BIGINT, dst BIGINT")
    assert tuple(bfs_target(back, 1, 1).first())[2:] == (0, 0)
    assert tuple(bfs_target(back, 1, 1, strict_neighbours=True).first())[2:] == (2, 1)
    loop = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "src BIGINT, dst BIGINT")
    assert tuple(bfs_target(loop, 1, 1, strict_neighbours=True).first())[2:] == (1, 2)
    none = spark.createDataFrame([(1, 2)], "src BIGINT, dst BIGINT")
    assert tuple(bfs_target(none, 1, 1, strict_neighbours=True).first())[2:] == (None, 0)


def test_holdout_cap_and_folds_with_repeated_rows(spark):
    from kiln.operators import contiguous_folds, holdout_split
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 2)], "u INT, i INT")
    out = holdout_split(df, "u", ["i"], 1, 1, max_test=2)
    assert out.count() == 6 and out.where("part = 'test'").count() == 2
    folds = contiguous_folds(df, ["u", "i"], 5)
    assert sorted(r["count"] for r in folds.groupBy("fold").count().collect()) == [1, 1, 1, 1, 2]


def _edge_tables(spark):
    folder = spark._jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return [f.getPath().getName() for f in files if f.getPath().getName().startswith("kiln-bfs-")]


def test_bfs_without_level_bound_and_no_table_left(spark, edges):
    before = _edge_tables(spark)
    got = {n: (d, c) for n, d, c in rows(bfs(edges, 1, max_levels=None))}
    want = python_bfs(EDGES, 1, 100)
    assert {n: d for n, (d, _) in got.items() if d != 9999} == want and got[9] == (7, "BLACK")
    assert tuple(bfs_target(edges, 1, 9, max_levels=None).first())[2:] == (7, 1)
    assert bfs_target(edges, 1, 11, max_levels=None).first().degrees is None
    assert _edge_tables(spark) == before


def _ancestors(plan, leaf):
    """The operators above the line that holds ``leaf``, nearest first."""
    lines = plan.splitlines()
    at = next(k for k, line in enumerate(lines) if leaf(line))
    depth = lambda line: len(re.match(r"[\s:|+\-]*", line).group())
    out, now = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < now:
            out.append(line)
            now = depth(line)
    return out


@pytest.mark.parametrize("max_bytes", [graph.MAX_BROADCAST_BYTES, -1])
def test_bfs_is_the_same_with_any_frontier_bound(spark, monkeypatch, max_bytes):
    """With the bound below 0 every level goes over the salted layout, hot sources over several salts."""
    monkeypatch.setattr(graph, "HOT_EDGES", 3)
    rnd = random.Random(12)
    data = [(rnd.choice([0, 0, rnd.randrange(80)]), rnd.randrange(80)) for _ in range(300)]
    df = spark.createDataFrame(data, "src BIGINT, dst BIGINT")
    dist = {n: d for n, d, _ in rows(bfs(df, 0, max_broadcast_bytes=max_bytes)) if d != 9999}
    want = python_bfs(data, 0, 10 ** 6)
    assert dist == want
    far = max(want, key=lambda n: (want[n], n))
    hits = sum(want.get(s) == want[far] - 1 for s, d in data if d == far)
    assert tuple(bfs_target(df, 0, far, max_broadcast_bytes=max_bytes).first())[2:] == (want[far], hits)
    back = spark.createDataFrame([(1, 2), (2, 1), (2, 3)], "src BIGINT, dst BIGINT")
    assert tuple(bfs_target(back, 1, 1, strict_neighbours=True, max_broadcast_bytes=max_bytes).first())[2:] == (2, 1)


def test_large_frontiers_leave_the_edges_where_they_are(spark):
    df = spark.range(3000).selectExpr("id % 50 as src", "id as dst")
    with Scratch(spark) as scratch:
        table, buckets = graph.edge_table(df, scratch)
        search = graph._Search(table, buckets, scratch, -1)
        front = scratch.write(spark.range(40).selectExpr("id as node", "1 as distance", "1L as hits"))
        reached = search.expand(front, 2, 1)
        assert reached.count() == 40 * 60
        plan = reached._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        above = _ancestors(plan, lambda line: "FileScan parquet" in line and "SelectedBucketsCount" in line)
        join = next(k for k, line in enumerate(above) if "SortMergeJoin" in line)
        assert not [line for line in above[:join] if "Exchange" in line], plan


def test_hot_sources_have_several_salts(spark):
    df = spark.range(1000).selectExpr("case when id < 700 then 1 else id end as src", "id as dst")
    with Scratch(spark) as scratch:
        laid, hot = graph.salted_layout(df, scratch, hot_edges=100)
        assert rows(hot) == [(1, 7)] and laid.where("src = 1").select("salt").distinct().count() == 7
        assert laid.count() == 1000 and laid.where("src <> 1 and salt <> 0").count() == 0


def test_observed_values_count_once_when_a_task_runs_twice(spark, tmp_path):
    """The first attempt of a task fails after it has passed rows; the numbers are those of the rows written."""
    mark = str(tmp_path / "failed")

    def fail_once(batches):
        for batch in batches:
            yield batch
        import os
        if not os.path.exists(mark):
            open(mark, "w").close()
            raise RuntimeError("first attempt")

    # Local mode gives a task one attempt; a failed write is simply run again by hand there.
    df = spark.range(0, 1000, 1, 4)
    with Scratch(spark) as scratch:
        from pyspark.sql import functions as F
        with pytest.raises(Exception):
            scratch.write(df.mapInArrow(fail_once, "id long"), rows=F.count(F.lit(1)))
        again = scratch.write(df.mapInArrow(fail_once, "id long"), rows=F.count(F.lit(1)), top=F.max("id"))
        assert scratch.values == {"rows": 1000, "top": 999} and again.count() == 1000


def test_scratch_tables_end_with_their_owner(spark):
    import os
    with Scratch(spark, "kiln-owned") as scratch:
        table = scratch.write(spark.range(10))
        folder = scratch.path.replace("file:", "")
        assert table.count() == 10 and os.path.isdir(folder)
        assert scratch.bucketed(spark.range(10), "id").count() == 10
        names = list(scratch.names)
        assert spark.catalog.tableExists(names[0])
    assert not os.path.exists(folder) and not spark.catalog.tableExists(names[0])
