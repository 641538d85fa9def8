"""The registered queries: kiln operators bound to the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over whole tables.
Column names match the SQL oracle in ``kiln.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions.numeric import round_half_up, tenths_celsius_to_fahrenheit
from kiln.functions.text import collapse_whitespace, contains, field_at
import kiln.operators.dimension as lk
from kiln.operators import graph, groupstats as gs, similarity, splits, text, topk
from kiln.plans import params as P
from kiln.sources import tables
from kiln.sources.text import line_degree

Query = Callable[[SparkSession, str], DataFrame]


# ---- ratings view: histogram, popularity --------------------------------------------------------

def rating_histogram(spark, sf):
    return topk.ranked(gs.group_count(tables.ratings(spark, sf), "rating", "count"), ["rating"])


def rating_total(spark, sf):
    return gs.total_count(tables.ratings(spark, sf), "total")


def popular_items(spark, sf):
    li = tables.table(spark, sf, "lineitem", ["l_partkey"])
    return topk.top_k(gs.group_count(li, "l_partkey", "count"), P.TOP_ITEMS, ["-count"], ["l_partkey"])


def popular_items_named(spark, sf):
    part = tables.table(spark, sf, "part", ["p_partkey", "p_name"]).withColumnRenamed("p_partkey", "l_partkey")
    return lk.lookup_few(popular_items(spark, sf), part, "l_partkey", "p_name", ["-count"], ["l_partkey"],
                         last_by="p_name")


def item_counts_strict(spark, sf):
    li = tables.table(spark, sf, "lineitem", ["l_partkey"])
    part = tables.table(spark, sf, "part", ["p_partkey", "p_name"]).withColumnRenamed("p_partkey", "l_partkey")
    return lk.lookup(gs.group_count(li, "l_partkey", "count"), part, "l_partkey", strict_column="p_name")


# ---- people-style group statistics on customer --------------------------------------------------

def _customer(spark, sf, cols=None):
    return tables.table(spark, sf, "customer", cols)


def avg_by_group(spark, sf):
    c = _customer(spark, sf, ["c_nationkey", "c_acctbal"])
    return gs.group_mean(c, "c_nationkey", "c_acctbal", "avg_acctbal", exact_scale=12)


def avg_by_group_pairs(spark, sf):
    c = _customer(spark, sf, ["c_nationkey", "c_acctbal"])
    return gs.group_mean_by_parts(c, "c_nationkey", "c_acctbal", "avg_acctbal", exact_scale=12)


def avg_by_group_rounded(spark, sf):
    mean = avg_by_group(spark, sf).withColumn("avg_acctbal", round_half_up("avg_acctbal", 2))
    return topk.ranked(mean, ["c_nationkey"])


def mean_by_group_int(spark, sf):
    li = tables.table(spark, sf, "lineitem", ["l_suppkey", "l_linenumber"])
    return topk.ranked(gs.group_mean(li, "l_suppkey", "l_linenumber", "avg_linenumber"), ["l_suppkey"])


def range_filter_sql(spark, sf):
    return spark.sql("SELECT * FROM {people} WHERE c_nationkey < :high AND c_nationkey > :low",
                     args={"high": P.RANGE_HIGH, "low": P.RANGE_LOW}, people=_customer(spark, sf))


def group_size(spark, sf):
    return topk.ranked(gs.group_count(_customer(spark, sf, ["c_nationkey"]), "c_nationkey", "count"),
                       ["c_nationkey"])


def select_columns(spark, sf):
    return _customer(spark, sf, ["c_name"])


def filter_less_than(spark, sf):
    return _customer(spark, sf).where(F.col("c_nationkey") < F.lit(P.LESS_THAN))


def shifted_column(spark, sf):
    c = _customer(spark, sf, ["c_name", "c_nationkey"])
    return c.select("c_name", (F.col("c_nationkey") + F.lit(P.SHIFT)).alias("nationkey_shifted"))


# ---- spend per customer -------------------------------------------------------------------------

def spend_by_customer(spark, sf):
    o = tables.table(spark, sf, "orders", ["o_custkey", "o_totalprice"])
    totals = gs.group_sum(o, "o_custkey", "o_totalprice", "total_purchases", exact_scale=12)
    return topk.ranked(totals.withColumn("total_purchases", round_half_up("total_purchases", 2)),
                       ["-total_purchases"], ["o_custkey"])


def spend_top5(spark, sf):
    return spend_by_customer(spark, sf).limit(P.TOP_SPENDERS)


# ---- weather-style extremes on events -----------------------------------------------------------

def _events(spark, sf):
    return tables.table(spark, sf, "events", ["user_id", "event_type", "value"])


def extreme_by_station_max(spark, sf):
    e = _events(spark, sf).where(contains("event_type", P.MEASURE))
    ext = gs.group_extreme(e, "user_id", tenths_celsius_to_fahrenheit("value"), "max", "temp_f")
    return ext


def extreme_by_station_min(spark, sf):
    e = _events(spark, sf).where(F.col("event_type") == F.lit(P.MEASURE))
    ext = gs.group_extreme(e, "user_id", "value", "min", "min_value")
    return ext.withColumn("temp_f", tenths_celsius_to_fahrenheit("min_value"))


def distinct_stations(spark, sf):
    e = _events(spark, sf).where(contains("event_type", P.MEASURE))
    return gs.distinct_keys(e, "user_id")


def station_counts(spark, sf):
    e = _events(spark, sf).where(contains("event_type", P.MEASURE))
    return gs.group_count(e, "user_id", "count")


# ---- word counts over whole documents -----------------------------------------------------------

def _docs(spark, sf):
    return tables.table(spark, sf, "documents", ["text"], spread_rows=True)


def word_count_ascii(spark, sf):
    wc = text.word_count(_docs(spark, sf), "text", "ascii_words", lower="after")
    return topk.ranked(wc, ["-count"], ["word"])


def word_count_unicode(spark, sf):
    wc = text.word_count(_docs(spark, sf), "text", "unicode_words", lower="before", ascii_filter=True)
    return topk.ranked(wc, ["count"], ["word"])


def word_count_raw(spark, sf):
    wc = text.word_count(_docs(spark, sf), "text", "whitespace", ascii_filter=True)
    return topk.ranked(wc, ["-count"], ["word"])


def word_total(spark, sf):
    return text.token_total(_docs(spark, sf), "text", "ascii_words", lower="after", alias="n_words")


# ---- degrees --------------------------------------------------------------------------------------

def _order_degrees(spark, sf):
    per_order = tables.order_lines(spark, sf)
    line = per_order.select(F.col("hub").alias("node"), (F.col("n_items") - F.lit(1)).alias("degree"))
    return graph.node_degrees(line)


def _part_names(spark, sf):
    return tables.table(spark, sf, "part", ["p_partkey", "p_name"]).withColumnRenamed("p_partkey", "node")


def degree_ranking(spark, sf):
    deg = _order_degrees(spark, sf)
    names = _part_names(spark, sf)
    named = lk.lookup(deg, names, "node", "left")
    # Cross-check of the lookup by a plain left join on a renamed attribute.
    checked = named.join(names.withColumnRenamed("p_name", "p_name_check"), "node", "left")
    return graph.degree_ranking(checked)


def most_connected(spark, sf):
    deg = _order_degrees(spark, sf)
    top = topk.first_row(deg, ["-connections"], ["node"])
    return lk.lookup_few(top, _part_names(spark, sf), "node", "p_name")


def least_connected(spark, sf):
    few = graph.least_connected(_order_degrees(spark, sf), P.FEW_CONNECTIONS)
    return lk.lookup(few, _part_names(spark, sf), "node", "left")


def global_min_degree(spark, sf):
    return gs.global_extreme(_order_degrees(spark, sf), "connections", "min", "min_connections")


def min_degree_nodes(spark, sf):
    return graph.nodes_at_minimum(_order_degrees(spark, sf))


def _doc_line_degrees(spark, sf, tokenizer):
    lines = tables.document_lines(spark, sf)
    return graph.node_degrees(line_degree(lines, "value", tokenizer))


def line_degree_space(spark, sf):
    return _doc_line_degrees(spark, sf, "space")


def line_degree_each(spark, sf):
    return line_degree(tables.document_lines(spark, sf), "value", "space")


def line_fields(spark, sf):
    lines = tables.document_lines(spark, sf)
    return lines.select("doc_id", "line_no", field_at("value", 2).alias("third_field"),
                        collapse_whitespace("value").alias("collapsed"))


def line_degree_ws(spark, sf):
    return _doc_line_degrees(spark, sf, "whitespace")


# ---- BFS ----------------------------------------------------------------------------------------

def bfs_distances(spark, sf):
    nodes, edges = tables.order_graph(spark, sf)
    return graph.bfs(edges, P.BFS_START, nodes=nodes, max_levels=P.BFS_LEVELS)


def bfs_target(spark, sf):
    _, edges = tables.order_graph(spark, sf)
    return graph.bfs_target(edges, P.BFS_START, P.BFS_TARGET, max_levels=P.BFS_LEVELS)


# ---- similarity ---------------------------------------------------------------------------------

def similar_items(spark, sf):
    sims = similarity.similar_to_item(tables.ratings(spark, sf), P.REF_ITEM, min_score=P.MIN_SCORE,
                                      min_support=P.MIN_SUPPORT, k=P.TOP_SIMILAR, orientation="desc")
    names = (tables.table(spark, sf, "supplier", ["s_suppkey", "s_name"])
             .withColumnRenamed("s_suppkey", "other_item"))
    return lk.lookup_few(sims, names, "other_item", "s_name", ["-score"], ["other_item"])


def all_pairs_similarity(spark, sf):
    return similarity.all_pairs_similarity(tables.ratings(spark, sf), orientation="asc",
                                           zero_denominator="zero")


def similar_pairs(spark, sf):
    return similarity.all_pairs_similarity(tables.ratings(spark, sf), orientation="asc", zero_denominator="zero",
                                           min_score=P.MIN_SCORE, min_support=P.MIN_SUPPORT, unique=True)


def top_support_pairs(spark, sf):
    return similarity.top_pairs_by_support(tables.ratings(spark, sf), P.TOP_PAIRS, orientation="asc", zero_denominator="zero",
                                           unique=True)


# ---- sums, splits, layout -----------------------------------------------------------------------

def sum_of_squares(spark, sf):
    exact = gs.sum_of_squares(tables.table(spark, sf, "lineitem", ["l_orderkey"]), "l_orderkey", "_s")
    # The exact DECIMAL as text, plus its double value: both compare the same however fetched.
    return exact.select(F.col("_s").cast("double").alias("sum_of_squares"),
                        F.col("_s").cast("string").alias("sum_of_squares_exact"), "n")


def holdout_per_user(spark, sf):
    return splits.holdout_split(tables.ratings(spark, sf), "user_id", ["item_id"],
                                P.HOLDOUT_START, P.HOLDOUT_STOP, unique=True)


def holdout_capped(spark, sf):
    return splits.holdout_split(tables.ratings(spark, sf), "user_id", ["item_id"],
                                P.HOLDOUT_START, P.HOLDOUT_STOP, max_test=P.HOLDOUT_MAX_TEST, unique=True)


def contiguous_folds(spark, sf):
    return splits.contiguous_folds(tables.ratings(spark, sf), ["user_id", "item_id"], P.FOLDS)


def fold_base(spark, sf):
    folded = splits.contiguous_folds(tables.ratings(spark, sf), ["user_id", "item_id"], P.FOLDS)
    _, base = splits.fold_parts(folded, P.BASE_OF_FOLD, order=["user_id", "item_id"])
    return base


def sampled_ratings(spark, sf):
    return topk.sample_rows(tables.ratings(spark, sf), P.SAMPLE_ROWS, ["user_id", "item_id"], P.SAMPLE_SEED)


QUERIES: dict[str, Query] = {
    "rating_histogram": rating_histogram,
    "rating_total": rating_total,
    "popular_items": popular_items,
    "popular_items_named": popular_items_named,
    "item_counts_strict": item_counts_strict,
    "avg_by_group": avg_by_group,
    "avg_by_group_rounded": avg_by_group_rounded,
    "avg_by_group_pairs": avg_by_group_pairs,
    "mean_by_group_int": mean_by_group_int,
    "range_filter_sql": range_filter_sql,
    "group_size": group_size,
    "select_columns": select_columns,
    "filter_less_than": filter_less_than,
    "shifted_column": shifted_column,
    "spend_by_customer": spend_by_customer,
    "spend_top5": spend_top5,
    "extreme_by_station_max": extreme_by_station_max,
    "extreme_by_station_min": extreme_by_station_min,
    "distinct_stations": distinct_stations,
    "station_counts": station_counts,
    "word_count_ascii": word_count_ascii,
    "word_count_unicode": word_count_unicode,
    "word_count_raw": word_count_raw,
    "word_total": word_total,
    "degree_ranking": degree_ranking,
    "most_connected": most_connected,
    "least_connected": least_connected,
    "global_min_degree": global_min_degree,
    "min_degree_nodes": min_degree_nodes,
    "line_degree_space": line_degree_space,
    "line_degree_each": line_degree_each,
    "line_fields": line_fields,
    "line_degree_ws": line_degree_ws,
    "bfs_distances": bfs_distances,
    "bfs_target": bfs_target,
    "similar_items": similar_items,
    "all_pairs_similarity": all_pairs_similarity,
    "similar_pairs": similar_pairs,
    "top_support_pairs": top_support_pairs,
    "sum_of_squares": sum_of_squares,
    "holdout_per_user": holdout_per_user,
    "holdout_capped": holdout_capped,
    "contiguous_folds": contiguous_folds,
    "fold_base": fold_base,
    "sampled_ratings": sampled_ratings,
}
