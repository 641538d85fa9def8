"""The same analytics over the reference's own file formats.

Each function takes file paths (any Hadoop URI) and returns a DataFrame, so a
user of the original scripts can run the same questions on the same files. They
are compositions of ``kiln.sources`` readers and ``kiln.operators``; nothing is
collected to the driver.

Formats (fixed by the files, not by kiln):
  ratings ``user item rating timestamp`` tab-separated; ratings ``::``-separated;
  item names ``id|title|...`` or ``id::title::genres`` in ISO-8859-1; people
  ``id,name,age,friends``; orders ``customer,order,amount``; weather
  ``station,date,measure,tenths_celsius[,...]``; graph lines ``node n1 n2 ...``;
  node names ``id "NAME"`` in ISO-8859-1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions.numeric import round_half_up, tenths_celsius_to_fahrenheit
from kiln.functions.text import contains, field_at
from kiln.operators import dimension, graph, groupstats as gs, similarity, splits, text, topk
from kiln.sources import (adjacency_edges, line_degree, parse_adjacency, read_delimited,
                          read_dimension, read_lines, read_numbered, read_quoted_names)

RATINGS_TAB = "user_id INT, item_id INT, rating INT, ts BIGINT"
RATINGS_COLON = "user_id INT, item_id INT, rating DOUBLE, ts BIGINT"
PEOPLE = "id INT, name STRING, age INT, friends INT"
ORDERS = "customer_id STRING, order_id STRING, amount DOUBLE"
WEATHER = "station STRING, date INT, measure STRING, temperature DOUBLE"


def read_ratings(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Ratings files: tab-separated with integer ratings, or ``::`` with decimal ones."""
    schema = RATINGS_TAB if sep == "\t" else RATINGS_COLON
    return read_delimited(spark, path, schema=schema, sep=sep, quote=None).select("user_id", "item_id", "rating")


def rating_histogram(spark: SparkSession, path: str) -> DataFrame:
    """Count per rating value (third whitespace field of each line), by rating."""
    lines = read_lines(spark, path)
    ratings = lines.select(field_at("value", 2).alias("rating"))
    return topk.ranked(gs.group_count(ratings, "rating", "count"), ["rating"])


def friends_by_age(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Mean friends per age, with its value rounded to 2 places, by age."""
    people = (read_delimited(spark, path, header=True, infer_schema=True) if header
              else read_delimited(spark, path, schema=PEOPLE, quote=None, mode="FAILFAST"))
    mean = gs.group_mean(people, "age", "friends", "friends_avg")
    return topk.ranked(mean.withColumn("friends_avg_rounded", round_half_up("friends_avg", 2)), ["age"])


def people_between(spark: SparkSession, path: str, low: int, high: int, view: str = "people") -> DataFrame:
    """Rows with low < age < high, by SQL over a temporary view."""
    read_delimited(spark, path, schema=PEOPLE, quote=None, mode="FAILFAST").createOrReplaceTempView(view)
    return spark.sql("SELECT * FROM IDENTIFIER(:view) WHERE age < :high AND age > :low",
                     args={"view": view, "high": int(high), "low": int(low)})


def customer_spend(spark: SparkSession, path: str, k: int | None = None) -> DataFrame:
    """Total amount per customer (exact to the cent), largest first; top ``k`` if given."""
    orders = read_delimited(spark, path, schema=ORDERS, quote=None)
    totals = gs.group_sum(orders, "customer_id", "amount", "total", exact_scale=12)
    totals = totals.withColumn("total", round_half_up("total", 2))
    return topk.top_k(totals, k, ["-total"], ["customer_id"]) if k else topk.ranked(totals, ["-total"], ["customer_id"])


def station_extremes(spark: SparkSession, path: str, measure: str = "TMIN", how: str = "min",
                     match: str = "equals") -> DataFrame:
    """Per station, the min or max reading of one measure, in Fahrenheit (and rounded).
    ``match="contains"`` keeps measures that contain the name (``XTMAX`` matches ``TMAX``)."""
    w = read_delimited(spark, path, schema=WEATHER, quote=None)
    keep = contains("measure", measure) if match == "contains" else (F.col("measure") == F.lit(measure))
    ext = gs.group_extreme(w.where(keep), "station", "temperature", how, "extreme")
    temp_f = tenths_celsius_to_fahrenheit("extreme")
    return ext.select("station", temp_f.alias("temp_f"), round_half_up(temp_f, 2).alias("temp_f_rounded"))


def book_word_counts(spark: SparkSession, path: str, tokenizer: str = "whitespace") -> DataFrame:
    """Word counts of a text file. ``"ascii_words"``: DataFrame form (\\W+, lower-cased,
    most frequent first). ``"unicode_words"``: lower-cased Unicode words, least frequent
    first, ASCII-bearing only. ``"whitespace"``: raw tokens, most frequent first,
    ASCII-bearing only."""
    lines = read_lines(spark, path)
    if tokenizer == "ascii_words":
        return topk.ranked(text.word_count(lines, "value", "ascii_words", lower="after"), ["-count"], ["word"])
    if tokenizer == "unicode_words":
        wc = text.word_count(lines, "value", "unicode_words", lower="before", ascii_filter=True)
        return topk.ranked(wc, ["count"], ["word"])
    return topk.ranked(text.word_count(lines, "value", "whitespace", ascii_filter=True), ["-count"], ["word"])


def popular_items(spark: SparkSession, ratings_path: str, names_path: str | None = None,
                  k: int = 10, names_sep: str = "|") -> DataFrame:
    """The k most rated items, with their titles when a names file is given."""
    counts = gs.group_count(read_ratings(spark, ratings_path), "item_id", "count")
    top = topk.top_k(counts, k, ["-count"], ["item_id"])
    if names_path is None:
        return top
    names = read_dimension(spark, names_path, sep=names_sep, key="item_id", name="title")
    return dimension.lookup_few(top, names, "item_id", "title", ["-count"], ["item_id"])


def similar_items(spark: SparkSession, ratings_path: str, ref: int, names_path: str | None = None,
                  min_score: float = 0.95, min_support: int = 50, k: int = 10, sep: str = "\t",
                  names_sep: str = "|") -> DataFrame:
    """Items most similar to ``ref`` (cosine over co-raters), with titles if given."""
    sims = similarity.similar_to_item(read_ratings(spark, ratings_path, sep), ref, min_score=min_score,
                                      min_support=min_support, k=k, orientation="desc")
    if names_path is None:
        return sims
    names = read_dimension(spark, names_path, sep=names_sep, key="other_item", name="title")
    return dimension.lookup_few(sims, names, "other_item", "title", ["-score"], ["other_item"])


def all_item_pairs(spark: SparkSession, ratings_path: str, sep: str = "::", k: int | None = None) -> DataFrame:
    """Similarity of every co-rated item pair (score 0 for a zero vector), by support."""
    sims = similarity.all_pairs_similarity(read_ratings(spark, ratings_path, sep), orientation="asc",
                                           zero_denominator="zero")
    order = (["-num_pairs"], ["item_1", "item_2"])
    return topk.top_k(sims, k, *order) if k else topk.ranked(sims, *order)


def node_popularity(spark: SparkSession, graph_path: str, names_path: str,
                    tokenizer: str = "whitespace") -> DataFrame:
    """Connections per node (a node may own several lines) with its name, most
    connected first; ``tokenizer="space"`` counts as a single-blank split does."""
    deg = graph.node_degrees(line_degree(read_lines(spark, graph_path), tokenizer=tokenizer))
    deg = deg.withColumn("node", F.col("node").try_cast("int"))
    names = read_quoted_names(spark, names_path, key="node", name="name")
    return graph.degree_ranking(dimension.lookup(deg, names, "node", "left"))


def separation(spark: SparkSession, graph_path: str, start: int, target: int | None = None,
               max_levels: int | None = None, strict_neighbours: bool = False) -> DataFrame:
    """BFS over an adjacency file: distances from ``start`` or, with a target, its
    degrees of separation and the number of hits on that level. ``max_levels=None`` searches
    to the end; a number stops there, and nodes further away count as not reached."""
    edges = adjacency_edges(parse_adjacency(read_lines(spark, graph_path), id_type="int"))
    if target is None:
        nodes = parse_adjacency(read_lines(spark, graph_path), id_type="int").select("node").distinct()
        return graph.bfs(edges, start, nodes=nodes, max_levels=max_levels)
    return graph.bfs_target(edges, start, target, max_levels=max_levels, strict_neighbours=strict_neighbours)


def leave_out(spark: SparkSession, ratings_path: str, start: int, stop: int, max_test: int = 0) -> DataFrame:
    """Per-user holdout over a ratings file in the order of its lines: a user's lines start..stop go to test, as far
    as ``max_test`` of them in the whole file; all others to base. ``row`` is the line's number."""
    rows = read_numbered(spark, ratings_path, RATINGS_TAB, "\t")
    return splits.holdout_split(rows, "user_id", ["row"], start, stop, max_test, unique=True, cap_order=["row"])


def folds(spark: SparkSession, ratings_path: str, k: int = 5) -> DataFrame:
    """k contiguous folds over a ratings file (order: user, item)."""
    return splits.contiguous_folds(read_ratings(spark, ratings_path), ["user_id", "item_id"], k)
