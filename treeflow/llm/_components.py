"""Connected components of an edge table by alternating large and small stars.

A graph of at most SMALL edges (counted first) is finished by one task instead: rounds of
shuffles over a few rows would cost more than the rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._spark import cut, ship

SMALL = 200_000


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """u and the least of u and its neighbours v; a group is one running minimum."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _union_find(batches):
    parent: dict[int, int] = {}

    def find(x):
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for u, v in zip(T.column(batch, "u").to_pylist(), T.column(batch, "v").to_pylist(), strict=True):
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "component"])


def components(edges: DataFrame, max_rounds: int = 50, small: int = SMALL) -> DataFrame:
    """(node, component) of every node of the edges (u, v); component is its least node.

    Every round halves paths at least, and a star of any size costs one row for each of
    its edges: no neighbour lists are gathered.  Loops and repeated edges change nothing,
    edges with a null are left out.
    """
    now = cut(edges.select("u", "v").filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if now.count() <= small:
        ship(edges.sparkSession)
        return now.coalesce(1).mapInArrow(_union_find, "node long, component long")
    mark = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least_neighbour(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = _least_neighbour(large)
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark is not None and tuple(new) == mark:
            break
        mark = tuple(new)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
