"""Graph analytics on edge tables: degree ranking and breadth-first search.

A graph is an edge DataFrame ``(src, dst)`` (repeats allowed) plus, optionally,
a node DataFrame ``(node)``. BFS is level-synchronous: each level joins the
frontier to the edges, aggregates the reached nodes, removes visited ones with
an anti-join and writes the new level to the shared folder, which cuts the
lineage and survives executor loss. A level is one job: the number of new nodes,
their bytes and the target's hits are observed on the write itself.

Only the frontier moves, the edges are laid out once:

* A frontier small enough to be broadcast (by the bytes observed) meets edges stored
  by a hash bucket of ``src``; dynamic partition pruning reads only the buckets that
  hold frontier nodes, so that a search's first levels touch a small part of them.
* For larger frontiers the edges are stored in hash buckets of (source, salt), once, when
  the first such frontier appears; a source of more than ``HOT_EDGES`` edges has
  several salts and so several buckets. The frontier is shuffled to the buckets, a row
  per salt of its node; the edges stay where they are.

All of it is deleted when the search ends; the result is checkpointed.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.scratch import Scratch
from kiln.session import reliable_checkpoint

#: Bytes of a frontier, or of the visited nodes, that are broadcast at most.
MAX_BROADCAST_BYTES = 32 << 20
#: Edges of one source in one partition of the salted layout, about.
HOT_EDGES = 100_000

# BFS state names and the distance of a node that was never reached.
WHITE, GRAY, BLACK = "WHITE", "GRAY", "BLACK"
UNREACHED = 9999


def node_degrees(line_degrees: DataFrame, node: str = "node", degree: str = "degree",
                 alias: str = "connections") -> DataFrame:
    """Sum the per-line degrees of every node (a node may own several lines)."""
    return line_degrees.groupBy(node).agg(F.sum(degree).alias(alias))


def degree_ranking(degrees: DataFrame, connections: str = "connections", node: str = "node") -> DataFrame:
    """Nodes by connections, most connected first (ties by node id)."""
    return degrees.orderBy(F.col(connections).desc(), F.col(node).asc())


def least_connected(degrees: DataFrame, below: int, connections: str = "connections") -> DataFrame:
    """Nodes with fewer than ``below`` connections."""
    return degrees.where(F.col(connections) < F.lit(below))


def nodes_at_minimum(degrees: DataFrame, connections: str = "connections") -> DataFrame:
    """Nodes whose connections equal the global minimum.

    The minimum is a one-row aggregate; it is joined back on the value (an
    equi-join with a one-row broadcast side), not by a cross join."""
    low = degrees.agg(F.min(connections).alias("_min"))
    return degrees.join(F.broadcast(low), F.col(connections) == F.col("_min")).drop("_min")


def _bucket(col: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(col)), F.lit(buckets)).cast("int")


def edge_table(edges: DataFrame, scratch: Scratch, buckets: int | None = None) -> tuple[DataFrame, int]:
    """``(src, dst, src_bucket)`` written to ``scratch`` partitioned by ``src_bucket``, and the number of
    buckets. The ``rebalance`` hint lets AQE split a bucket that holds a
    large share of the edges into several files instead of one task writing it."""
    if buckets is None:
        # About one bucket per core: fine-grained pruning on a cluster, few files locally.
        buckets = min(4096, max(8, edges.sparkSession.sparkContext.defaultParallelism))
    table = edges.select("src", "dst", _bucket("src", buckets).alias("src_bucket"))
    return scratch.write(table.hint("rebalance", "src_bucket"), partition_by="src_bucket"), buckets


def salted_layout(edges: DataFrame, scratch: Scratch, hot_edges: int = HOT_EDGES) -> tuple[DataFrame, DataFrame]:
    """``(src, salt, dst)`` in stored buckets of (src, salt); and ``(src, salts)`` of the sources that have more
    than one salt."""
    hot = scratch.write(
        edges.groupBy("src").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > F.lit(hot_edges))
        .select("src", F.ceil(F.col("n") / F.lit(hot_edges)).cast("int").alias("salts")))
    salt = F.pmod(F.xxhash64("dst"), F.coalesce("salts", F.lit(1))).cast("int")
    return scratch.bucketed(edges.join(hot, "src", "left").select("src", salt.alias("salt"), "dst"), ["src", "salt"]), hot


class _Search:
    """The edges in the layouts that a search needs."""

    def __init__(self, edges: DataFrame, buckets: int, scratch: Scratch, max_broadcast_bytes: int):
        self.edges, self.buckets, self.scratch, self.max_bytes = edges, buckets, scratch, max_broadcast_bytes
        self.laid = self.hot = None

    def expand(self, front: DataFrame, level: int, size: int) -> DataFrame:
        """(node, hits): every (frontier node, edge) pair counted, repeated edges included."""
        # The distance predicate on the broadcast side lets dynamic partition pruning run.
        front = front.where(F.col("distance") == F.lit(level - 1)).select(F.col("node").alias("src"))
        if size <= self.max_bytes:
            front = F.broadcast(front.withColumn("src_bucket", _bucket("src", self.buckets)))
            met = self.edges.join(front, ["src_bucket", "src"])
        else:
            if self.laid is None:
                self.laid, self.hot = salted_layout(self.edges.select("src", "dst"), self.scratch, HOT_EDGES)
            salts = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - F.lit(1))
            front = front.join(self.hot, "src", "left").select("src", F.explode(salts).alias("salt"))
            met = self.laid.join(front.hint("merge"), ["src", "salt"])
        return met.groupBy(F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("hits"))


def _row_bytes(node: str):
    """About what a row takes in a broadcast: its key, and a word for each of pointer, length and hash."""
    return F.octet_length(F.col(node).cast("string")) + F.lit(24)


def _levels(edges: DataFrame, buckets: int, scratch: Scratch, start, max_levels: int | None, target, max_broadcast_bytes: int,
            strict_neighbours: bool = False):
    """Run the BFS loop. Returns (reached frame, expansions done, hit level, hits).

    Each level is one job: frontier x edges, hits aggregated per reached node
    (partial aggregate, so a node reached from many frontier rows is combined
    map-side), already-visited nodes removed by an anti-join, and the new level
    written, with its size and the target's hits observed."""
    spark = edges.sparkSession
    key_type = edges.schema["src"].dataType
    seed = spark.range(1).select(F.lit(start).cast(key_type).alias("node"), F.lit(0).alias("distance"),
                                 F.lit(0).cast("bigint").alias("hits"))
    # Written so that the optimizer treats the start as data, not as a constant to fold.
    levels = [scratch.write(seed)]
    expansions = 0
    # Only neighbours are tested in strict mode, so a start that is also the target is found
    # again through a back edge or a self-loop; otherwise it is found at distance 0.
    find_start_again = target is not None and target == start and strict_neighbours
    if target is not None and target == start and not strict_neighbours:
        return levels[0].select("node", "distance"), expansions, 0, 0
    search = _Search(edges, buckets, scratch, max_broadcast_bytes)
    front_rows, front_bytes, visited_bytes = 1, 0, 0

    def reached_so_far():
        out = levels[0]
        for lv in levels[1:]:
            out = out.unionByName(lv)
        return out.select("node", "distance")

    for level in itertools.count(1):
        if front_rows == 0 or (max_levels is not None and level > max_levels):
            break
        reached = search.expand(levels[-1], level, front_bytes)
        visited = reached_so_far().select("node")
        if find_start_again:
            visited = visited.where(F.col("node") != F.lit(start).cast(key_type))
        if visited_bytes <= max_broadcast_bytes:
            visited = F.broadcast(visited)
        new = reached.join(visited, "node", "left_anti").select("node", F.lit(level).alias("distance"), "hits")
        hit = (F.max(F.when(F.col("node") == F.lit(target).cast(key_type), F.col("hits"))) if target is not None
               else F.max(F.lit(None).cast("bigint")))
        levels.append(scratch.write(new, rows=F.count(F.lit(1)), bytes=F.sum(_row_bytes("node")), hits=hit))
        seen = scratch.values
        expansions += 1
        if seen["hits"] is not None:
            if find_start_again:
                levels.pop()
            return reached_so_far(), expansions, level, int(seen["hits"])
        front_rows, front_bytes = seen["rows"], seen["bytes"] or 0
        visited_bytes += front_bytes
        if not front_rows:
            levels.pop()
    return reached_so_far(), expansions, None, 0


def bfs(edges: DataFrame, start, nodes: DataFrame | None = None, max_levels: int | None = None,
        max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Distances from ``start`` by level-synchronous BFS over directed edges.

    One row per node of ``nodes`` (default: every edge source) and per reached
    node: node, distance (``UNREACHED`` if not reached within ``max_levels``), and
    color: BLACK = expanded, GRAY = reached on the last level but not expanded,
    WHITE = not reached. The search ends when no new node is found, or with ``max_levels``, and then
    nodes further away count as not reached."""
    with Scratch(edges.sparkSession, "kiln-bfs") as scratch:
        edges, buckets = edge_table(edges, scratch)
        reached, expansions, _, _ = _levels(edges, buckets, scratch, start, max_levels, None, max_broadcast_bytes)
        base = nodes.select("node") if nodes is not None else edges.select(F.col("src").alias("node"))
        everyone = base.unionByName(reached.select("node")).distinct()
        d = F.col("distance")
        out = everyone.join(reached, "node", "left").select(
            "node",
            F.coalesce(d, F.lit(UNREACHED)).alias("distance"),
            F.when(d.isNull(), F.lit(WHITE)).when(d < F.lit(expansions), F.lit(BLACK))
             .otherwise(F.lit(GRAY)).alias("color"))
        return reliable_checkpoint(out)


def bfs_target(edges: DataFrame, start, target, max_levels: int | None = None,
               max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
               strict_neighbours: bool = False) -> DataFrame:
    """Search for ``target``: stop at the first level whose expansion reaches it.

    One row: start, target, degrees (the level, i.e. degrees of separation; NULL
    when not reached within ``max_levels``) and hits (the number of frontier-edge
    pairs that reached it on that level). A target equal to the start is found at
    0, or with ``strict_neighbours`` only through its neighbours (a self-loop gives
    1, a back edge 2), as a search that tests neighbours only does."""
    spark = edges.sparkSession
    with Scratch(spark, "kiln-bfs") as scratch:
        edges, buckets = edge_table(edges, scratch)
        _, _, level, hits = _levels(edges, buckets, scratch, start, max_levels, target, max_broadcast_bytes,
                                    strict_neighbours)
    key_type = edges.schema["src"].dataType
    return spark.range(1).select(
        F.lit(start).cast(key_type).alias("start"), F.lit(target).cast(key_type).alias("target"),
        F.lit(level).cast("int").alias("degrees"), F.lit(hits).cast("bigint").alias("hits"))
