"""What a file's order decides: line numbers over splits, the last line of an id, holdout line by line."""

import os
import random
from collections import defaultdict

import pytest

from kiln.operators import dimension, holdout_split
from kiln.plans import files
from kiln.sources import first_lines, read_dimension, read_numbered_lines
from tests.conftest import rows


@pytest.fixture()
def small_splits(spark):
    """Files are read in splits of a few hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "50"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _files(tmp_path, ends=("\n", "\r\n")):
    rng, want, row = random.Random(3), [], 0
    for name in ("b.txt", "a.txt", "c.txt"):
        text = "".join("x" * rng.randint(0, 50) + rng.choice(["", "é"]) + rng.choice(ends) for _ in range(120))
        (tmp_path / name).write_bytes(text.encode() if name != "c.txt" else text.encode() + b"last, not ended")
    (tmp_path / "empty.txt").write_bytes(b"")
    for name in ("a.txt", "b.txt", "c.txt"):
        at = 0
        lines = (tmp_path / name).read_bytes().split(b"\n")
        for k, line in enumerate(lines[:-1] if not lines[-1] else lines):
            row += 1
            want.append((name, k + 1, row, at, line.rstrip(b"\r").decode()))
            at += len(line) + 1
    return want


def test_lines_know_their_place_over_many_splits(small_splits, tmp_path):
    want = _files(tmp_path)
    df = read_numbered_lines(small_splits, str(tmp_path), byte_offset=True)
    assert df.rdd.getNumPartitions() > 10
    assert rows(df, "line", "row", "offset", "value") == sorted(w[1:] for w in want)
    assert {os.path.basename(r.file): r.n for r in df.groupBy("file").count().withColumnRenamed("count", "n").collect()} == {
        n: sum(w[0] == n for w in want) for n in ("a.txt", "b.txt", "c.txt")}
    plain = read_numbered_lines(small_splits, str(tmp_path))
    assert rows(plain, "row", "value") == sorted((w[2], w[4]) for w in want)
    assert rows(first_lines(small_splits, str(tmp_path), 7), "row", "value") == sorted((w[2], w[4]) for w in want)[:7]


def test_the_lines_are_not_shuffled(small_splits, tmp_path):
    _files(tmp_path)
    df = read_numbered_lines(small_splits, str(tmp_path))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scan = plan.index("FileScan text")
    above = [line for line in plan[:scan].splitlines() if "Exchange" in line]
    # Between the scan of the lines and the result there is a broadcast join, and no exchange of the lines.
    assert all("Broadcast" in line for line in above), plan


def test_the_last_line_of_an_id_wins(small_splits, tmp_path):
    names = [(i % 40, f"Film {i} Á") for i in range(400)]
    path = tmp_path / "u.item"
    path.write_bytes("".join(f"{i}|{t}|01-Jan|x\n" for i, t in names).encode("latin-1"))
    assert rows(read_dimension(small_splits, str(path))) == sorted(dict(names).items())
    assert read_dimension(small_splits, str(path), repeated="all").count() == 400
    first = read_dimension(small_splits, str(path), max_lines=50)
    assert rows(first) == sorted(dict(names[:50]).items())
    with pytest.raises(ValueError):
        read_dimension(small_splits, str(path), repeated="first")


def test_a_repeated_name_gives_one_row_in_a_top_k(small_splits, tmp_path):
    (tmp_path / "u.data").write_text("".join(f"{u}\t{i}\t3\t1\n" for i in range(1, 6) for u in range(i)))
    (tmp_path / "u.item").write_text("".join(f"{i}|old {i}\n" for i in range(1, 6)) + "5|new 5\n")
    top = files.popular_items(small_splits, str(tmp_path / "u.data"), str(tmp_path / "u.item"), k=3).collect()
    assert [(r.item_id, r.title) for r in top] == [(5, "new 5"), (4, "old 4"), (3, "old 3")]


@pytest.mark.parametrize("start, stop, cap", [(1, 10, 0), (2, 4, 0), (2, 4, 25), (1, 3, 10_000), (3, 2, 0)])
def test_holdout_line_by_line(small_splits, tmp_path, start, stop, cap):
    """Every line is tested and counted in the order of the file; user 1 has a third of the lines."""
    rng = random.Random(6)
    data = [(1 if rng.random() < 0.33 else rng.randint(2, 60), rng.randint(1, 99), rng.randint(1, 5)) for _ in range(900)]
    path = tmp_path / "u.data"
    path.write_text("".join(f"{u}\t{i}\t{r}\t{k}\n" for k, (u, i, r) in enumerate(data)))
    seen, taken, want = defaultdict(int), 0, []
    for k, (u, i, r) in enumerate(data):
        seen[u] += 1
        test = start <= seen[u] <= stop and (cap <= 0 or taken < cap)
        taken += test
        want.append((k + 1, u, i, r, "test" if test else "base"))
    got = rows(files.leave_out(small_splits, str(path), start, stop, cap), "row", "user_id", "item_id", "rating", "part")
    assert got == want


def test_holdout_never_sorts_a_whole_user(spark):
    df = spark.range(5000).selectExpr("case when id % 3 = 0 then 1 else id end as u", "id as i")
    plan = holdout_split(df, "u", ["i"], 1, 10, unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_lookup_takes_the_last_row_of_a_key(spark):
    facts = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    dim = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (2, "c", 3)], "k int, name string, row int")
    assert rows(dimension.lookup(facts, dim, "k", last_by="row"), "k", "name") == [(1, "a"), (2, "c"), (2, "c")]
