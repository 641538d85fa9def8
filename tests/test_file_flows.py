"""The reference's flows over its own file formats (fixture files written here)."""

import math

import pytest

from kiln.plans import files
from tests.conftest import rows


def _write(tmp_path, name, data):
    p = tmp_path / name
    p.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(p)


def test_weather_extremes_with_extra_columns(spark, tmp_path):
    path = _write(tmp_path, "1800.csv",
                  "ITE00100554,18000101,TMAX,-75,,,E,\nITE00100554,18000101,TMIN,-148,,,E,\n"
                  "GM000010962,18000101,PRCP,0,,,E,\nEZE00100082,18000101,TMAX,-86,,,E,\n"
                  "EZE00100082,18000101,TMIN,-135,,,E,\nITE00100554,18000102,TMAX,-60,I,,E,\n"
                  "ITE00100554,18000102,XTMAX,-10,,,E,\n")
    mins = {s: t for s, t, _ in rows(files.station_extremes(spark, path, "TMIN", "min"))}
    assert mins == {"ITE00100554": -148 * .1 * 9. / 5 + 32., "EZE00100082": -135 * .1 * 9. / 5 + 32.}
    maxes = {s: r for s, _, r in rows(files.station_extremes(spark, path, "TMAX", "max", match="contains"))}
    assert maxes == {"ITE00100554": 30.2, "EZE00100082": 16.52}  # XTMAX counts under containment


def test_customer_spend_exact(spark, tmp_path):
    path = _write(tmp_path, "orders.csv", "44,8602,37.19\n35,5368,65.89\n44,3391,65.89\n2,4,0.1\n2,5,0.2\n")
    got = [tuple(r) for r in files.customer_spend(spark, path).collect()]
    assert got == [("44", 103.08), ("35", 65.89), ("2", 0.3)]
    assert [r.customer_id for r in files.customer_spend(spark, path, k=1).collect()] == ["44"]


def test_book_word_counts(spark, tmp_path):
    path = _write(tmp_path, "book.txt", "The the cat.\r\nCafé the  dog\n")
    raw = {w: c for w, _, c in rows(files.book_word_counts(spark, path))}
    assert raw == {"The": 1, "the": 2, "cat.": 1, "Café": 1, "dog": 1}
    ascii_words = dict(rows(files.book_word_counts(spark, path, "ascii_words")))
    assert ascii_words == {"the": 3, "cat": 1, "caf": 1, "dog": 1}
    uni = {w: c for w, _, c in rows(files.book_word_counts(spark, path, "unicode_words"))}
    assert uni == {"the": 3, "cat": 1, "café": 1, "dog": 1}


def test_ratings_popularity_similarity_and_splits(spark, tmp_path):
    data = "".join(f"{u}\t{i}\t{(u * i) % 5 + 1}\t8812{u}{i}\n" for u in range(1, 9) for i in range(1, 7) if (u + i) % 3)
    ratings = _write(tmp_path, "u.data", data)
    names = _write(tmp_path, "u.item", "".join(f"{i}|Title {i} (199{i})|01-Jan-1995||http://x|0|1\n"
                                               for i in range(1, 7)).encode("latin-1"))
    hist = dict(rows(files.rating_histogram(spark, ratings)))
    assert sum(hist.values()) == data.count("\n") and all(isinstance(k, str) for k in hist)
    top = files.popular_items(spark, ratings, names, k=3).collect()
    assert len(top) == 3 and all(r.title.startswith("Title ") for r in top)
    sims = files.similar_items(spark, ratings, 2, names, min_score=0.0, min_support=0, k=10).collect()
    assert sims and all(r.title for r in sims) and all(2 in (r.item_1, r.item_2) for r in sims)
    held = files.leave_out(spark, ratings, 1, 2)
    assert held.where("part = 'test'").groupBy("user_id").count().where("count > 2").count() == 0
    assert files.folds(spark, ratings, 3).select("fold").distinct().count() == 3


def test_colon_ratings_all_pairs(spark, tmp_path):
    path = _write(tmp_path, "ratings.dat", "1::10::5::978300760\n1::20::3::978302109\n2::10::4::1\n2::20::2::1\n3::20::1::1\n")
    got = [tuple(r) for r in files.all_item_pairs(spark, path).collect()]
    assert len(got) == 1 and got[0][0:2] == (10, 20) and got[0][3] == 2
    assert math.isclose(got[0][2], (5 * 3 + 4 * 2) / (math.sqrt(25 + 16) * math.sqrt(9 + 4)))


def test_graph_popularity_and_separation(spark, tmp_path):
    graph = _write(tmp_path, "graph.txt", "1 2 3\n2 4 \n1 4\n3 4 5\n5 6\n7\n")
    names = _write(tmp_path, "names.txt", '1 "ONE MAN"\n2 "TWO  MEN"\n3 "THRÉE"\n4 "FOUR"\n'.encode("latin-1"))
    ws = [tuple(r) for r in files.node_popularity(spark, graph, names).collect()]
    assert ws[0] == (1, 3, "ONE MAN")
    assert dict((n, c) for n, c, _ in ws)[2] == 1
    space = dict((n, c) for n, c, _ in rows(files.node_popularity(spark, graph, names, tokenizer="space")))
    assert space[2] == 2  # "2 4 " has a trailing blank
    dist = {n: d for n, d, _ in rows(files.separation(spark, graph, 1))}
    assert dist == {1: 0, 2: 1, 3: 1, 4: 1, 5: 2, 6: 3, 7: 9999}
    hit = files.separation(spark, graph, 1, target=6).first()
    assert (hit.degrees, hit.hits) == (3, 1)
