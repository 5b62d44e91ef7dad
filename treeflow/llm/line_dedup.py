"""Line dedup: lines that many documents share are dropped from all of them.

Lines are keyed by the hash of their normalised bytes (white space [\\x20\\x09-\\x0D] stripped
at both ends, A-Z lower-cased).  Each task counts the documents of a key before the shuffle,
so a line that a third of all documents hold costs one row a task.  Keys at the threshold
form the drop set; documents are then read again and rebuilt in line order.

The drop set is handed to the tasks only if its row count is at most `broadcast_keys`
(8 bytes each).  Beyond that, (text, key) pairs are joined with the drop set by shuffle and
each text gets just its own keys back; both ways give the same rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._spark import cut, fields, ship, with_places

MIN_DOCS, MIN_CHARS = 10, 1
BROADCAST_KEYS = 4_000_000
_FLUSH = 1_000_000


def _keyed(data: np.ndarray, offsets: np.ndarray, min_chars: int):
    """Lines of a block: start, end, lines of each text, hash of the key, whether it counts."""
    starts, ends, counts = T.lines(data, offsets)
    s, e = T.strip(data, starts, ends)
    if min_chars <= 0:
        counted = np.ones(len(s), bool)
    elif min_chars == 1:
        counted = e > s
    else:  # code points: bytes that do not continue one
        heads = T.starts_of(((data & 0xC0) != 0x80).astype(np.int64))
        counted = heads[e] - heads[s] >= min_chars
    return starts, ends, counts, T.Spans(data, fold=True).hash(s, e), counted


def _once(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places of the first line of each (text, key); text must ascend."""
    order = np.argsort(keys, kind="stable")
    k, t = keys[order], text[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    return order[new]


def _count_keys(text_col: str, min_chars: int):
    def run(batches):
        T.release()
        held, size = [], 0

        def summed():
            keys, n = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(n, weights=np.concatenate([c for _, c in held]), minlength=len(keys)).astype(np.int64)

        def emit(keys, n):
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

        for batch in batches:
            for _, _, data, offsets in T.blocks(T.column(batch, text_col)):
                _, _, counts, keys, counted = _keyed(data, offsets, min_chars)
                text = np.repeat(np.arange(len(counts)), counts)
                keys, text = keys[counted], text[counted]
                keys = keys[_once(keys, text)]
                held.append((keys, np.ones(len(keys), np.int64)))
                size += len(keys)
                if size > _FLUSH:
                    held = [summed()]
                    size = len(held[0][0])
                    if size > _FLUSH // 2:
                        yield emit(*held[0])
                        held, size = [], 0
        if held:
            yield emit(*summed())

    return run


def _pairs(text_col: str, min_chars: int):
    """(text hash, key) once for each text of a block."""

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in T.blocks(T.column(batch, text_col)):
                _, _, counts, keys, counted = _keyed(data, offsets, min_chars)
                whole = T.Spans(data, fold=False).hash(offsets[:-1], offsets[1:])
                text = np.repeat(np.arange(len(counts)), counts)[counted]
                keys = keys[counted]
                at = _once(keys, text)
                yield pa.RecordBatch.from_arrays([pa.array(whole[text[at]].view(np.int64)), pa.array(keys[at].view(np.int64))], ["text_hash", "key"])

    return run


def _add_hash(text_col: str, carried: list[str]):
    def run(batches):
        for batch in batches:
            whole = [T.Spans(d, fold=False).hash(o[:-1], o[1:]) for _, _, d, o in T.blocks(T.column(batch, text_col))]
            whole = np.concatenate(whole) if whole else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*(T.column(batch, c) for c in carried), pa.array(whole.view(np.int64))], [*carried, "text_hash"])

    return run


def _rebuild(text_col: str, carried: list[str], output: str, drop, min_chars: int, own_keys: bool):
    def run(batches):
        T.release()
        hot = None if own_keys else np.sort(drop.value)
        for batch in batches:
            texts = T.column(batch, text_col)
            kept, n_lines, n_dropped = [], [], []
            mine = T.column(batch, "_keys").to_pylist() if own_keys else None
            for lo, hi, data, offsets in T.blocks(texts):
                starts, ends, counts, keys, counted = _keyed(data, offsets, min_chars)
                if own_keys:
                    first = T.starts_of(counts)
                    gone = np.zeros(len(keys), bool)
                    for i in range(lo, hi):
                        if mine[i]:
                            a, b = first[i - lo], first[i - lo + 1]
                            gone[a:b] = np.isin(keys[a:b].view(np.int64), mine[i])
                    gone &= counted
                elif len(hot):
                    at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
                    gone = (hot[at] == keys) & counted
                else:
                    gone = np.zeros(len(keys), bool)
                first = T.starts_of(counts)
                dropped = np.diff(T.starts_of(gone.astype(np.int64))[first])
                raw = data.tobytes()
                for i in range(hi - lo):
                    if not dropped[i]:
                        kept.append(raw[offsets[i] : offsets[i + 1]])
                    else:
                        a, b = first[i], first[i + 1]
                        kept.append(b"\n".join(raw[s:e] for s, e, g in zip(starts[a:b], ends[a:b], gone[a:b], strict=True) if not g))
                n_lines.append(counts)
                n_dropped.append(dropped)
            new = pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()) if output == "kept_sha256" else pa.array(kept, pa.binary()).cast(pa.string())
            counts = [pa.array(np.concatenate([*n, np.zeros(0, np.int64)])) for n in (n_lines, n_dropped)]
            yield pa.RecordBatch.from_arrays([*(T.column(batch, c) for c in carried), *counts, new], [*carried, "n_lines", "n_dropped", output])

    return run


def _rebuilt(work: DataFrame, text_col: str, carried: list[str], output: str, min_docs: int, min_chars: int, broadcast_keys: int) -> DataFrame:
    """carried, n_lines, n_dropped and output of every row."""
    spark = ship(work.sparkSession)
    hot = (
        work.select(text_col)
        .mapInArrow(_count_keys(text_col, min_chars), "key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= min_docs)
        .select("key")
    )
    hot = cut(hot)
    schema = fields(work, carried, f"n_lines long, n_dropped long, {output} string")
    if hot.count() <= broadcast_keys:
        keys = np.fromiter((r[0] for r in hot.toLocalIterator()), np.int64).view(np.uint64)
        return work.mapInArrow(_rebuild(text_col, carried, output, spark.sparkContext.broadcast(keys), min_chars, False), schema)
    own = (
        work.select(text_col)
        .mapInArrow(_pairs(text_col, min_chars), "text_hash long, key long")
        .join(hot, "key")
        .groupBy("text_hash")
        .agg(F.collect_set("key").alias("_keys"))
    )
    hashed = work.mapInArrow(_add_hash(text_col, work.columns), fields(work, work.columns, "text_hash long"))
    return hashed.join(own, "text_hash", "left").mapInArrow(_rebuild(text_col, carried, output, None, min_chars, True), schema)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    broadcast_keys: int = BROADCAST_KEYS,
    output: str = "kept_text",
) -> DataFrame:
    """id_col, n_lines, n_dropped and `output`: kept_text, or kept_sha256 (hex of its UTF-8).

    Every row counts as one document, also where ids repeat or are null.  A null or empty
    text has one empty line; a line of white space has an empty key, which is never dropped
    unless min_chars is 0.  A text all of whose lines go becomes empty.  No rows give
    no rows.  Other columns of docs are ignored, so their names cannot clash.
    """
    work = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return _rebuilt(work, "_text", ["_id"], output, min_docs, min_chars, broadcast_keys).withColumnRenamed("_id", id_col)


def drop_shared_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """docs, all columns and rows, with shared lines gone from the texts; a null text stays null."""
    work = with_places(docs)
    text = f"_{docs.columns.index(text_col)}"
    out = _rebuilt(work, text, work.columns, "kept_text", min_docs, min_chars, broadcast_keys)
    return out.select(*(F.when(F.col(c).isNotNull(), F.col("kept_text")).alias(n) if c == text else F.col(c).alias(n) for c, n in zip(work.columns, docs.columns, strict=True)))
