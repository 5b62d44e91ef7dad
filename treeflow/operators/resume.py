"""Reuse of groups that are already there.

A group's key is its ids' digest and, unlike a digest of ids alone, whatever else decides its
content (version, geometry, depth): stale groups do not match.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_CHARS = 12


def content_key(sha, version, options) -> Column:
    """Digest over ids' digest, document version and request options."""
    return F.left(F.sha2(F.concat_ws("|", F.col(sha), F.coalesce(F.col(version), F.lit("")), F.coalesce(F.col(options), F.lit(""))), 256), F.lit(KEY_CHARS))


def key_of(sha: str, version: str | None, options: str | None) -> str:
    """content_key of one group."""
    return hashlib.sha256("|".join((sha, version or "", options or "")).encode()).hexdigest()[:KEY_CHARS]


def complete_groups(groups: DataFrame, present: DataFrame, keys=("file_key", "sha")) -> DataFrame:
    """Prior groups that have parts, all of which are present (file_key, file)."""
    keys = list(keys)
    parts = groups.select(*keys, F.explode("parts").alias("file")).join(present.select("file_key", "file").distinct().withColumn("there", F.lit(True)), ["file_key", "file"], "left")
    return parts.groupBy(*keys).agg(F.bool_and(F.coalesce("there", F.lit(False))).alias("whole")).filter("whole").select(*keys)


def split_by_resume(wanted: DataFrame, groups: DataFrame, present: DataFrame, keys=("file_key", "sha")) -> tuple[DataFrame, DataFrame]:
    """(to fetch, to reuse with their old parts)."""
    whole = complete_groups(groups, present, keys)
    old = groups.join(whole, list(keys), "left_semi").select(*keys, "parts", "rechunked")
    return wanted.join(whole, list(keys), "left_anti"), wanted.join(old, list(keys))
