"""Vectorised word, line and hash primitives over Arrow text columns.

Texts are handled as UTF-8 bytes in blocks of about one MiB (one text at least), so memory
stays flat whatever the size of a batch.  All separators in use are ASCII, therefore bytes
split exactly where code points would.

A byte string's hash is a polynomial over a fixed random value for each byte, taken modulo
2**64 and passed through a finaliser.  Prefix sums give the hash of any span in O(1).
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def _byte_values() -> np.ndarray:
    """256 fixed random odd-looking 64-bit values (SplitMix64 of the byte)."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def mix(h: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, elementwise."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _fold(values: np.ndarray) -> np.ndarray:
    """The same values with A-Z hashed as a-z."""
    out = values.copy()
    out[65:91] = values[97:123]
    return out


VALUES = _byte_values()
VALUES_FOLDED = _fold(VALUES)

#: [\x20\x09-\x0D]
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: [^\x20\x09-\x0D]
NON_SPACE = ~SPACE
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] once A-Z are lower-cased
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int, name: str) -> np.ndarray:
    """base**0 .. base**n modulo 2**64; kept for the block size, made anew for longer texts."""
    have = _powers.get(name)
    if have is not None and len(have) > n:
        return have
    out = np.empty(max(n, BLOCK) + 1, np.uint64)
    out[0] = 1
    filled, step = 1, base & ((1 << 64) - 1)
    while filled < len(out):  # doubling: out[filled:2*filled] = out[:filled] * base**filled
        k = min(filled, len(out) - filled)
        out[filled : filled + k] = out[:k] * np.uint64(step)
        filled += k
        step = step * step % (1 << 64)
    if len(out) <= 4 * BLOCK:
        _powers[name] = out
    return out


_holders: dict[str, Callable[[], None]] = {}


def hold(owner: str, drop: Callable[[], None]) -> None:
    """Registers what a reused worker keeps from task to task for one operator."""
    _holders[owner] = drop


def release(owner: str = "") -> None:
    """Drops what other operators keep in this worker and gives free memory back, so that an
    executor's workers do not add up the caches of a whole pipeline."""
    for name in [n for n in _holders if n != owner]:
        _holders.pop(name)()
    pa.set_memory_pool(pa.system_memory_pool())  # malloc_trim() gives this one's free memory back
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it keeps the memory for later use


class Spans:
    """Hashes of byte spans of one block."""

    def __init__(self, data: np.ndarray, fold: bool):
        vals = (VALUES_FOLDED if fold else VALUES)[data]
        vals *= _power(_BASE, len(data), "base")[: len(data)]
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(vals, out=self.sums[1:])
        self.inverse = _power(_BASE_INV, len(data), "inverse")

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def blocks(texts: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of rows that together have about
    `limit` bytes.  A null counts as an empty text."""
    if not len(texts):
        return
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, at, raw = texts.buffers()
    at = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        hi = min(hi, len(texts))
        yield lo, hi, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of member bytes inside a text, and the number of runs
    of each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    inside = member[data]
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(edge & inside)
    last = np.empty(len(data), bool)
    last[-1] = True
    np.copyto(last[:-1], edge[1:])
    ends = np.flatnonzero(last & inside) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive entries; windows across texts are included and must be
    masked by the caller."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[j : j + n]
    return mix(out)


def starts_of(counts: np.ndarray) -> np.ndarray:
    """0 and the running sums of counts."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges [starts[i], starts[i] + lengths[i])."""
    total = int(lengths.sum())
    first = starts_of(lengths)[:-1]
    return np.arange(total) - np.repeat(first - starts, lengths)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every \\n-separated line, and the number of lines of each text (an
    empty text has one empty line)."""
    breaks = np.flatnonzero(data == 10)
    n = len(offsets) - 1
    before = np.searchsorted(breaks, offsets)
    counts = np.diff(before) + 1
    text = np.repeat(np.arange(n), counts - 1)
    total = len(breaks) + n
    starts, ends = np.empty(total, np.int64), np.empty(total, np.int64)
    follow = np.arange(len(breaks)) + text + 1
    starts[follow] = breaks + 1
    ends[follow - 1] = breaks
    starts[before[:-1] + np.arange(n)] = offsets[:-1]
    ends[before[1:] + np.arange(n)] = offsets[1:]
    return starts, ends, counts


def strip(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans without [\\x20\\x09-\\x0D] at both ends; an all-space span becomes empty."""
    solid = np.flatnonzero(NON_SPACE[data])
    if not len(solid):
        return starts, starts.copy()
    first = np.searchsorted(solid, starts)
    last = np.searchsorted(solid, ends) - 1
    empty = last < first
    s = np.where(empty, starts, solid[np.minimum(first, len(solid) - 1)])
    e = np.where(empty, starts, solid[np.maximum(last, 0)] + 1)
    return s, e
