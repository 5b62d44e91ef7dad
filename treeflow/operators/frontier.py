"""Frontiers and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import batch_sha
from ..shared import cut


def first_of_each(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row of each key, the first by the order, as a combinable minimum."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*(F.col(o) if isinstance(o, str) else o for o in order))
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_r")).select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest)).select(*df.columns)


def collect_frontier(nodes: DataFrame, depth: int) -> DataFrame:
    """FRONTIER: ids at exactly a level, each once, in document order from 0.

    Positions come from a window over each document's frontier, which is bounded by its width."""
    at = nodes.filter((F.col("level") == depth) & F.col("is_object") & F.col("id").isNotNull() & (F.col("id") != ""))
    once = at.groupBy("file_key", "id").agg(F.min("path").alias("path"))
    order = W.partitionBy("file_key").orderBy("path")
    return once.select("file_key", "id", (F.row_number().over(order) - 1).cast("long").alias("pos"))


def batches(frontier: DataFrame, size) -> DataFrame:
    """(file_key, batch_no, sha, ids): consecutive ids, `size` (at least 1) at a time."""
    size = F.greatest(F.col(size) if isinstance(size, str) else F.lit(size), F.lit(1))
    cut = frontier.withColumn("batch_no", F.floor(F.col("pos") / size))
    grouped = cut.groupBy("file_key", "batch_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("ids"))
    return grouped.select("file_key", "batch_no", batch_sha("ids").alias("sha"), "ids")


def batch_count(n_ids, size):
    """ceil(n / size)"""
    return F.ceil(F.col(n_ids) / F.greatest(F.lit(size), F.lit(1))).cast("long")


def with_answers(frontier: DataFrame, entries: DataFrame) -> DataFrame:
    """The requested ids in their order with the entries (file_key, id, document) that came
    back, and `there`: whether one has a document."""
    back = entries.select("file_key", "id", "document")
    return frontier.join(back, ["file_key", "id"], "left").withColumn("there", F.col("document").isNotNull())


def returned(frontier: DataFrame, entries: DataFrame) -> DataFrame:
    """(file_key, requested, returned): ids asked for, and those that came back with a document."""
    back = entries.filter(F.col("document").isNotNull()).select("file_key", "id").distinct().withColumn("there", F.lit(1))
    return frontier.join(back, ["file_key", "id"], "left").groupBy("file_key").agg(F.count("*").alias("requested"), F.count("there").alias("returned"))


def numbered(df: DataFrame, order: list[str], name: str = "place") -> DataFrame:
    """df with each row's place in the order, from 1: ranges are sorted side by side, and the
    rows of the ranges before a row's own (one number for each range) are added to its place."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = cut(dealt.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    counts = dealt.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = counts.select("_range", (F.sum("_rows").over(W.orderBy("_range")) - F.col("_rows")).alias("_before"))
    return dealt.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_range", "_at", "_before")
