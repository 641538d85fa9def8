"""Parquet test tables and the derived views the queries run on.

* ``ratings``: (user_id, item_id, rating) with user = customer, item = supplier,
  rating = max(CAST(l_quantity AS INT) % 5 + 1) per (user, item). Integer
  ratings keep every similarity sum exact.
* ``order_graph``: every order is one adjacency line. Its first token (the node,
  or "hub") is the smallest part key of the order, the other tokens are the parts
  of its remaining line items. Nodes are hubs; a hub may own many lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """Repartition ``df`` only when its scan gives fewer tasks than the cluster has
    cores (e.g. one large Parquet row group); a scan that is already split across
    many files or row groups is returned untouched, so no shuffle is added at scale.
    Filters and column pruning still reach the scan through the repartition."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # sessions without the RDD API (Spark Connect): leave the scan as it is
        return df
    return df.repartition(cores) if splits < cores else df


def table(spark: SparkSession, sf_dir: str, name: str, columns=None, spread_rows: bool = False) -> DataFrame:
    """A test table; selecting ``columns`` here lets the scan read only those.
    ``spread_rows`` applies ``spread``: worth it only before heavy per-row work
    (regex tokenising of whole texts); for cheap rows the extra shuffle costs more."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return spread(df) if spread_rows else df


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratings view (one row per distinct customer/supplier pair)."""
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_quantity"])
    od = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    joined = li.join(od, li.l_orderkey == od.o_orderkey)
    return (joined.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_suppkey").alias("item_id"))
            .agg(F.max(F.pmod(F.col("l_quantity").cast("int"), F.lit(5)) + F.lit(1)).alias("rating")))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: its hub (smallest part) and its number of line items.

    A partial/final aggregate, so an order holding a large share of all line
    items is combined map-side and never gathered into one task."""
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"])
    return li.groupBy("l_orderkey").agg(F.min("l_partkey").alias("hub"),
                                        F.count(F.lit(1)).alias("n_items"))


def order_graph(spark: SparkSession, sf_dir: str):
    """``(nodes, edges)`` of the order graph.

    ``nodes(node)``: distinct hubs. ``edges(src, dst)``: one row per line item of
    an order whose part differs from the hub (repeated parts stay repeated)."""
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"])
    hubs = order_lines(spark, sf_dir).select("l_orderkey", "hub")
    edges = (li.join(hubs, "l_orderkey")
             .where(F.col("l_partkey") != F.col("hub"))
             .select(F.col("hub").alias("src"), F.col("l_partkey").alias("dst")))
    nodes = hubs.select(F.col("hub").alias("node")).distinct()
    return nodes, edges


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document (whole texts), column ``value``."""
    from kiln.sources.text import text_lines
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"], spread_rows=True)
    return text_lines(docs, "text", keep=("doc_id",))
