"""DataFrame -> DataFrame operators."""

from kiln.operators.graph import (bfs, bfs_target, degree_ranking, least_connected, node_degrees,
                                  nodes_at_minimum)
from kiln.operators.groupstats import (closed_form_square_sum, distinct_keys, global_extreme,
                                       group_count, group_extreme, group_mean, group_mean_by_parts,
                                       group_sum, sum_of_squares, total_count)
from kiln.operators.dimension import last_per_key, lookup, lookup_few, other_of_pair
from kiln.operators.profile import partition_profile, partition_rows, schema_table
from kiln.operators.similarity import (all_pairs_similarity, pair_similarity, pairs_above_support,
                                       rating_pairs, similar_to_item, top_pairs_by_support)
from kiln.operators.splits import (contiguous_folds, fold_parts, global_row_number, holdout_split,
                                   running_number)
from kiln.operators.text import token_total, tokens, word_count
from kiln.operators.topk import first_row, preview, ranked, row_hash, sample_rows, top_k
from kiln.operators.graph import edge_table

__all__ = [
    "all_pairs_similarity", "bfs", "bfs_target", "closed_form_square_sum", "edge_table",
    "contiguous_folds", "degree_ranking", "distinct_keys", "first_row", "last_per_key",
    "fold_parts", "global_extreme", "global_row_number", "group_count", "group_extreme",
    "group_mean", "group_mean_by_parts", "group_sum", "holdout_split", "least_connected", "lookup",
    "lookup_few", "node_degrees", "nodes_at_minimum", "other_of_pair", "pair_similarity", "pairs_above_support",
    "partition_profile", "partition_rows", "preview", "ranked", "rating_pairs", "row_hash", "running_number",
    "sample_rows",
    "schema_table", "similar_to_item", "sum_of_squares", "token_total", "tokens", "top_k",
    "top_pairs_by_support", "total_count", "word_count",
]
