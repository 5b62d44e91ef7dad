"""Run manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sizing import TIERS

# Keys every manifest has, and the least value of its numbers.
REQUIRED = ("fileKey", "size", "frontierDepth", "batchSize", "concurrency", "idCount", "batchCount", "downloaded", "resumedSkipped", "rechunked", "oversizedLeaves", "parts")
LEAST = {"frontierDepth": 0, "batchSize": 1, "concurrency": 1, "idCount": 0, "batchCount": 0, "downloaded": 0, "resumedSkipped": 0, "rechunked": 0}
PART_REQUIRED = ("file", "ids", "sha", "bytes")


def whole_manifest(key: str, size: str) -> dict:
    """The manifest of a document that came in one request."""
    return {"fileKey": key, "size": size} | {k: v for k, v in LEAST.items()} | {"oversizedLeaves": [], "frontierIds": [], "parts": [], "groups": [], "mode": "whole"}


def faults(m: dict) -> list[str]:
    """What a manifest breaks; empty if it is in order."""
    out = [f"{k} is missing" for k in REQUIRED if k not in m]
    if m.get("size") not in TIERS:
        out.append("size is no tier")
    for k, least in LEAST.items():
        v = m.get(k)
        if k in m and (not isinstance(v, int) or isinstance(v, bool) or v < least):
            out.append(f"{k} is no integer of at least {least}")
    for k in ("oversizedLeaves", "frontierIds"):
        if not all(isinstance(i, str) for i in m.get(k) or []):
            out.append(f"{k} holds other than strings")
    for p in m.get("parts") or []:
        out += [f"a part lacks {k}" for k in PART_REQUIRED if k not in p]
        if not isinstance(p.get("bytes", 0), int) or p.get("bytes", 0) < 0:
            out.append("a part's bytes are no size")
    return out


def counters(groups: DataFrame, parts: DataFrame) -> DataFrame:
    """(file_key, batchCount, resumedSkipped, rechunked, downloaded, parts): sums over groups
    (file_key, sha, resumed, rechunked) and over parts (file_key, file, ids, sha, bytes,
    elapsed_ms, fresh), a file counted once and parts listed by file name."""
    g = groups.groupBy("file_key").agg(F.count("*").alias("batchCount"), F.count_if("resumed").alias("resumedSkipped"), F.sum("rechunked").cast("long").alias("rechunked"))
    once = parts.groupBy("file_key", "file").agg(F.min_by(F.struct("ids", "sha", "bytes", "elapsed_ms", "fresh"), "sha").alias("p")).select("file_key", "file", "p.*")
    p = once.groupBy("file_key").agg(F.count_if("fresh").alias("downloaded"), F.array_sort(F.collect_list(F.struct("file", "ids", "sha", "bytes", F.col("elapsed_ms").alias("elapsedMs")))).alias("parts"))
    return g.join(p, "file_key", "left").withColumn("downloaded", F.coalesce("downloaded", F.lit(0)))


COMPARED = ("fileKey", "size", "frontierDepth", "batchSize", "concurrency", "idCount", "batchCount", "rechunked", "oversizedLeaves")


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """(fileKey, column) in which two runs' manifests differ; a run that lacks the file differs in all."""
    x, y = a.alias("x"), b.alias("y")
    both = x.join(y, F.col("x.fileKey") == F.col("y.fileKey"), "full_outer")
    bad = [F.when(~F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")), F.lit(c)) for c in COMPARED]
    return both.select(F.coalesce("x.fileKey", "y.fileKey").alias("fileKey"), F.explode(F.array_compact(F.array(*bad))).alias("column"))
