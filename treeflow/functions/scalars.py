"""Scalar functions as Spark columns; all stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import NO_WORDS
from ..errors import BODY_CHARS, ERROR_KINDS

BACKOFF_MS, BACKOFF_CAP_MS = 500, 15_000
KEY_SEGMENT = "^[0-9A-Za-z]{20,}$"
SHA_CHARS = 12


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def escape_separators(text) -> Column:
    """U+2028 and U+2029 as their backslash-u escapes."""
    out = _col(text)
    for point in (0x2028, 0x2029):
        out = F.replace(out, F.lit(chr(point)), F.lit(f"\\u{point:04x}"))
    return out


def byte_length(text) -> Column:
    """UTF-8 bytes."""
    return F.octet_length(_col(text)).cast("long")


def pad(number, width: int = 4) -> Column:
    """Zero-padded at the left; never shortened."""
    s = _col(number).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def longest(items) -> Column:
    """The longest element of an array, the first of equals; null of an empty array."""
    ranked = F.transform(_col(items), lambda s, i: F.struct(F.length(s).alias("n"), (-i).alias("i"), s.alias("s")))
    return F.array_max(ranked)["s"]


def key_segments(text) -> Column:
    """Path segments that look like a key."""
    return F.filter(F.split(_col(text), "[\\\\/]"), lambda s: s.rlike(KEY_SEGMENT))


def file_key(text, host_pattern: str = "[^/]+") -> Column:
    """Key of a document: behind /file/ or /design/ of a URL on the host, else the longest
    key-like path segment, else empty."""
    s = F.trim(F.coalesce(_col(text), F.lit("")))
    named = F.regexp_extract(s, f"(?i){host_pattern}/(?:file|design)/([0-9A-Za-z]{{10,}})", 1)
    return F.when(named != "", named).otherwise(F.coalesce(longest(key_segments(s)), F.lit("")))


def backoff_ms(attempt) -> Column:
    """500 ms doubled for each attempt, at most 15 s."""
    return F.least(F.lit(BACKOFF_MS) * F.pow(F.lit(2), _col(attempt)), F.lit(BACKOFF_CAP_MS)).cast("long")


def retry_wait_ms(retry_after, attempt) -> Column:
    """Retry-After in seconds if it is a positive number, else the backoff."""
    seconds = F.expr("double(null)") if retry_after is None else _col(retry_after).try_cast("double")
    return F.when(seconds > 0, seconds * 1000).otherwise(backoff_ms(attempt))


def error_kind(status) -> Column:
    s = _col(status)
    return (
        F.when(s.isin(401, 403), "auth").when(s == 404, "not_found").when(s == 429, "rate_limit").when(s >= 500, "server").otherwise("generic")
    )


def _by_kind(kind, place: int) -> Column:
    out = F
    for name, row in ERROR_KINDS.items():
        out = out.when(_col(kind) == name, F.lit(row[place]))
    return out


def exit_code(kind) -> Column:
    return _by_kind(kind, 2).otherwise(F.lit(1))


def retryable(kind) -> Column:
    return _by_kind(kind, 1).otherwise(F.lit(False))


def body_preview(text, chars: int = BODY_CHARS) -> Column:
    return F.left(_col(text), F.lit(chars))


def as_bool(text) -> Column:
    """Whether a setting reads as yes; null counts as no text and so as no."""
    return ~F.lower(F.trim(F.coalesce(_col(text).cast("string"), F.lit("")))).isin(*NO_WORDS)


def redacted(proxy) -> Column:
    """A proxy URL with its credentials hidden."""
    return F.regexp_replace(_col(proxy), "^([A-Za-z][A-Za-z0-9+.-]*://)[^/?#]*@", "$1***@")


def header(headers, name: str) -> Column:
    """A header's value whatever the case of its name."""
    return F.element_at(F.map_from_entries(F.transform(F.map_entries(_col(headers)), lambda e: F.struct(F.lower(e["key"]), e["value"]))), name.lower())


def batch_sha(ids, chars: int = SHA_CHARS) -> Column:
    """Digest of a set of ids: sha256 over the sorted ids, comma-joined, shortened."""
    return F.left(F.sha2(F.array_join(F.array_sort(_col(ids)), ","), 256), F.lit(chars))


def number(text, name: str) -> Column:
    """The number a text holds; any other text is an error, null stays null."""
    c = _col(text)
    value = c.try_cast("double")
    return F.when(c.isNull() | value.isNotNull(), value).otherwise(F.raise_error(F.concat(F.lit(f"{name} must be a number (got "), c, F.lit(")"))).cast("double"))
