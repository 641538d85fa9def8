"""Every operator on an empty input returns an empty (or zero) result instead of failing."""

from kiln.operators import (all_pairs_similarity, bfs, bfs_target, contiguous_folds, global_row_number,
                            group_count, group_mean, holdout_split, similar_to_item, top_k, total_count,
                            word_count)


def test_empty_inputs(spark):
    ratings = spark.createDataFrame([], "user_id INT, item_id INT, rating INT")
    assert all_pairs_similarity(ratings).count() == 0
    assert similar_to_item(ratings, 1).count() == 0
    assert global_row_number(ratings, ["user_id", "item_id"]).count() == 0
    assert holdout_split(ratings, "user_id", ["item_id"], 1, 2, max_test=3).count() == 0
    assert contiguous_folds(ratings, ["user_id", "item_id"], 5).count() == 0
    assert group_count(ratings, "user_id").count() == 0
    assert group_mean(ratings, "user_id", "rating").count() == 0
    assert total_count(ratings).first()[0] == 0
    assert top_k(ratings, 3, ["-rating"], ["user_id"]).count() == 0
    text = spark.createDataFrame([], "value STRING")
    assert word_count(text).count() == 0
    edges = spark.createDataFrame([], "src BIGINT, dst BIGINT")
    assert [tuple(r) for r in bfs(edges, 1).collect()] == [(1, 0, "BLACK")]
    assert tuple(bfs_target(edges, 1, 2).first())[2:] == (None, 0)
