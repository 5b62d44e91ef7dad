"""Size tiers and download strategies.

Tiers and presets are five-row tables, so classifying is a CASE or a range join and a
strategy is a join with a broadcast side of fixed size.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIB = 1 << 20
# The tiers by size; inclusive upper bounds of all but the last.
TIERS = ("sm", "md", "large", "xl", "xxxxl")
BOUNDS = {
    "nodes": (3_000, 30_000, 150_000, 1_000_000),
    "frontier": (0, 50, 300, 2_000),
    "bytes": (2 * MIB, 8 * MIB, 50 * MIB, 50 * MIB),
}


@dataclass(frozen=True)
class Strategy:
    size: str
    mode: str
    depth: int
    batch_size: int
    concurrency: int
    stream: bool
    rechunk: bool
    max_part_bytes: int
    max_part_ms: int
    resume: bool


# Size, mode, depth, batch, concurrency, stream, rechunk, MiB a part, ms a part, resume.
PRESETS = {
    row[0]: Strategy(*row[:7], row[7] * MIB, *row[8:])
    for row in (
        ("sm", "whole", 2, 10, 1, False, False, 0, 0, False),
        ("md", "frontier", 2, 10, 4, False, True, 32, 45_000, False),
        ("large", "frontier", 2, 5, 6, True, True, 24, 45_000, True),
        ("xl", "frontier", 3, 3, 8, True, True, 16, 40_000, True),
        ("xxxxl", "frontier", 3, 2, 8, True, True, 8, 30_000, True),
    )
}


def tier_number(value, signal: str, bounds=BOUNDS) -> Column:
    """Place among TIERS of the first bound that is not below the value."""
    v = F.col(value) if isinstance(value, str) else value
    out = F
    for i, bound in enumerate(bounds[signal]):
        out = out.when(v <= bound, F.lit(i))
    return out.otherwise(F.lit(len(TIERS) - 1))


def tier_name(number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, TIERS)), number + 1)


def classify(nodes="n_nodes", frontier="frontier_width", size="skeleton_bytes", bounds=BOUNDS) -> Column:
    """The largest of the three signals' tiers; small documents without a frontier are sm."""
    small = (F.col(frontier) == 0) & (F.col(nodes) <= bounds["nodes"][0])
    every = F.greatest(*(tier_number(c, s, bounds) for c, s in ((nodes, "nodes"), (frontier, "frontier"), (size, "bytes"))))
    return F.when(small, F.lit(TIERS[0])).otherwise(tier_name(every))


def threshold_table(spark: SparkSession, signal: str, bounds=BOUNDS) -> DataFrame:
    return spark.createDataFrame([(i, TIERS[i], b) for i, b in enumerate(bounds[signal])], "ord int, tier string, bound long")


def tier_by_join(df: DataFrame, value: str, signal: str, key: str, bounds=BOUNDS) -> DataFrame:
    """key, value and tier by a range join with the four bounds."""
    limits = F.broadcast(threshold_table(df.sparkSession, signal, bounds))
    joined = df.select(key, value).join(limits, F.col(value) <= F.col("bound"), "left")
    return joined.groupBy(key, value).agg(F.coalesce(F.min_by("tier", "ord"), F.lit(TIERS[-1])).alias("tier"))


def preset_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([tuple(asdict(p).values()) for p in PRESETS.values()], "size string, mode string, depth int, batch_size int, concurrency int, stream boolean, rechunk boolean, max_part_bytes long, max_part_ms long, resume boolean")


def with_strategy(df: DataFrame, tier: str = "tier", *, depth=None, batch_size=None, concurrency=None, max_part_bytes=None, max_part_ms=None) -> DataFrame:
    """df with its tier's preset; values that are given win.  A byte budget switches re-chunking
    on, or off if it is 0; a time budget does not.  An unknown tier is an error."""
    joined = df.join(F.broadcast(preset_table(df.sparkSession)), F.col(tier) == F.col("size"), "left")
    known = F.when(F.col("size").isNull(), F.raise_error(F.concat(F.lit("unknown size tier: "), F.coalesce(tier, F.lit("null"))))).otherwise(F.col("size"))
    joined = joined.withColumn("size", known.cast("string"))
    for name, value in {"depth": depth, "batch_size": batch_size, "concurrency": concurrency, "max_part_bytes": max_part_bytes, "max_part_ms": max_part_ms}.items():
        if value is not None:
            joined = joined.withColumn(name, F.lit(value))
    return joined if max_part_bytes is None else joined.withColumn("rechunk", F.lit(max_part_bytes > 0))


def strategy_for(tier: str, **given) -> Strategy:
    """The same for one document on the driver."""
    if tier not in PRESETS:
        raise ValueError(f"unknown size tier: {tier}")
    given = {k: v for k, v in given.items() if v is not None}
    if "max_part_bytes" in given:
        given["rechunk"] = given["max_part_bytes"] > 0
    return replace(PRESETS[tier], **given)
