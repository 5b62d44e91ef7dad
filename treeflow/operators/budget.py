"""Splitting of parts that exceed a budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import batch_sha
from ..shared import cut
from .flatten import serialise

MAX_SPLIT_LEVEL = 4


def batch_over(n_bytes, ms, max_bytes: int, max_ms: int, rechunk: bool = True) -> Column:
    """Whether a fetched batch breaches a budget; a budget of 0 is none."""
    over = F.lit(False)
    if rechunk and max_bytes > 0:
        over = over | (F.col(n_bytes) > max_bytes)
    if rechunk and max_ms > 0:
        over = over | (F.col(ms) > max_ms)
    return over


def node_over(n_bytes, max_bytes: int) -> Column:
    """Nodes are split by size only, never by time."""
    return F.col(n_bytes) > max_bytes if max_bytes > 0 else F.lit(False)


def can_split(level, children, max_level: int = MAX_SPLIT_LEVEL, rechunk: bool = True) -> Column:
    """Levels are those of the tree, not counted from the frontier."""
    return F.lit(rechunk) & (F.col(level) < max_level) & (F.col(children) > 0)


def split_plan(sized: DataFrame, roots: DataFrame, max_bytes: int, max_level: int = MAX_SPLIT_LEVEL, keys=("file_key",), rechunk: bool = True) -> DataFrame:
    """One row for each part: keys, id, root, level, bytes, split (a shallow parent), oversized.

    sized: keys, id, parent_id, level, bytes, children.  roots: keys, id of the nodes to start
    at.  A split node gives a shallow part and its children go on: one join a level of what was
    split with its children, until nothing is.  Each level is stored, so the next reads it."""
    keys = list(keys)
    over = node_over("bytes", max_bytes)
    marked = sized.withColumn("split", over & can_split("level", "children", max_level, rechunk)).withColumn("oversized", over & (F.col("children") == 0))
    row = [*keys, "id", "root", "level", "bytes", "split", "oversized"]
    now = cut(marked.join(roots.select(*keys, "id").distinct(), [*keys, "id"]).withColumn("root", F.col("id")).select(*row))
    out, below = now, marked.filter(F.col("level") <= max_level)
    for _ in range(max_level):
        above = now.filter("split").select(*keys, F.col("id").alias("parent_id"), "root")
        if above.isEmpty():
            break
        now = cut(below.join(above, [*keys, "parent_id"]).select(*row))
        out = out.unionByName(now)
    return out.withColumn("sha", batch_sha(F.array("id")))


def oversized_leaves(plan: DataFrame, order: list[str], keys=("file_key",)) -> DataFrame:
    """keys and oversizedLeaves: distinct ids, the first seen first."""
    first = plan.filter("oversized").groupBy(*keys, "id").agg(F.min(F.struct(*order)).alias("o"))
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "id"))), lambda x: x["id"]).alias("oversizedLeaves"))


def shallow_parts(nodes: DataFrame, split: DataFrame) -> DataFrame:
    """(file_key, id, document) of split nodes (file_key, id): the node and its children, these
    without their own children.  Children that are no objects stay as they are."""
    own = nodes.filter("is_object").join(split.select("file_key", "id").distinct(), ["file_key", "id"], "left_semi")
    own = own.select("file_key", "id", F.col("path").alias("at"), "props", "children_at")
    kids = nodes.filter(F.size("path") > 0).select("file_key", F.slice("path", 1, F.size("path") - 1).alias("at"), "ord", "props", "is_object")
    heads = own.select("file_key", "id", "at", F.array().cast("array<int>").alias("path"), "props", "children_at", F.lit(True).alias("is_object"))
    below = kids.join(own.select("file_key", "id", "at"), ["file_key", "at"]).select("file_key", "id", "at", F.array("ord").alias("path"), "props", F.lit(None).cast("int").alias("children_at"), "is_object")
    return serialise(heads.unionByName(below), keys=("file_key", "id", "at")).select("file_key", "id", "document")
