"""Measures of trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import cut


def skeleton(nodes: DataFrame, depth: int) -> DataFrame:
    """Nodes down to a level; those at it have no children list any more."""
    return nodes.filter(F.col("level") <= depth).withColumn("children_at", F.when(F.col("level") != depth, F.col("children_at")))


def find_node(nodes: DataFrame, node_id: str) -> DataFrame:
    """The first node of an id in document order, in each document."""
    return nodes.filter((F.col("id") == node_id) & F.col("is_object")).groupBy("file_key").agg(F.min_by(F.struct("id", "parent_id", "level", "ord", "path", "type", "props"), "path").alias("n")).select("file_key", "n.*")


def count_nodes(nodes: DataFrame) -> DataFrame:
    """(file_key, n_nodes); children that are no objects do not count."""
    return nodes.groupBy("file_key").agg(F.count_if("is_object").alias("n_nodes"))


def own_bytes(nodes: DataFrame) -> DataFrame:
    """nodes with own_bytes: the share of each in the canonical text of its ancestors.

    A node's text is its props with "children":[...] put in; that adds 13 bytes, one comma if
    there are other keys, and one comma before each child but the first."""
    put_in = F.when(F.col("children_at").isNotNull(), F.lit(13) + (F.col("props") != "{}").cast("int")).otherwise(0)
    return nodes.withColumn("own_bytes", (F.octet_length("props") + put_in + (F.col("ord") > 0).cast("int")).cast("long"))


def subtree_sizes(nodes: DataFrame) -> DataFrame:
    """nodes with bytes (canonical text of the subtree), descendants and children.

    Every node adds its share to each of its ancestors: one shuffle with sums made before it,
    instead of a join for each level.  Rows grow by the depth of the tree."""
    sized = own_bytes(nodes)
    up = sized.select("file_key", "own_bytes", "is_object", F.size("path").alias("deep"), F.explode(F.transform(F.sequence(F.lit(0), F.size("path")), lambda k: F.slice("path", 1, k))).alias("path"))
    sums = up.groupBy("file_key", "path").agg(F.sum("own_bytes").alias("bytes"), (F.count_if("is_object") - 1).alias("descendants"), F.count_if(F.col("deep") == F.size("path") + 1).alias("children"))
    back = sized.join(sums, ["file_key", "path"])
    return back.withColumn("bytes", F.col("bytes") - (F.col("ord") > 0).cast("int")).withColumn("descendants", F.greatest("descendants", F.lit(0)))


def rolled_up(edges: DataFrame, deepest: int) -> DataFrame:
    """(id, parent_id, level, bytes, descendants) of an edge list with levels: sums go up one
    level at a time, so work is one row for each edge, whatever the depth.  Each level but the
    deepest is stored once, and the next one reads it."""
    rest = edges.select("id", "parent_id", "level", "own_bytes")
    carried = rest.filter(F.col("level") == deepest).select("id", "parent_id", "level", F.col("own_bytes").alias("bytes"), F.lit(0).cast("long").alias("descendants"))
    out = carried
    for level in range(deepest - 1, -1, -1):
        sums = carried.groupBy(F.col("parent_id").alias("id")).agg(F.sum("bytes").alias("b"), F.sum(F.col("descendants") + 1).alias("d"))
        here = rest.filter(F.col("level") == level).join(sums, "id", "left")
        carried = cut(here.select("id", "parent_id", "level", (F.col("own_bytes") + F.coalesce("b", F.lit(0))).alias("bytes"), F.coalesce("d", F.lit(0)).alias("descendants")))
        out = out.unionByName(carried)
    return out


def signals(nodes: DataFrame, depth: int, envelope_bytes: DataFrame | None = None) -> DataFrame:
    """(file_key, n_nodes, frontier_width, skeleton_bytes) of the skeletons down to `depth`;
    envelope_bytes (file_key, envelope_bytes) adds what surrounds the trees."""
    out = own_bytes(skeleton(nodes, depth)).groupBy("file_key").agg(
        F.count_if("is_object").alias("n_nodes"),
        F.count_distinct(F.when((F.col("level") == depth) & F.col("is_object") & (F.col("id") != ""), F.col("id"))).alias("frontier_width"),
        F.sum("own_bytes").alias("skeleton_bytes"),
    )
    if envelope_bytes is not None:
        out = out.join(envelope_bytes, "file_key", "left").withColumn("skeleton_bytes", F.col("skeleton_bytes") + F.coalesce("envelope_bytes", F.lit(0))).drop("envelope_bytes")
    return out
