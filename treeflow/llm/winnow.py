"""Benchmark decontamination by winnowing.

Of every 6 consecutive 5-grams of word hashes the smallest is kept (the last of equals), in
documents and benchmark items alike.  A span of 10 equal words therefore keeps the same
5-gram on both sides, so joining the kept fingerprints meets every shared window of 10
words.  Each meeting is then extended word by word, 5 at most to either side: the windows
of 10 that hold the fingerprint reach no further, and other windows of a longer shared span
have fingerprints of their own.  Items of fewer words are looked up as one gram of their length.

Documents are read once and not shuffled.  Benchmark items are split into blocks of at most
`block_bytes` of text, each handed to the tasks as a sorted fingerprint table; a larger
benchmark takes more passes over the documents, with the marks carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._spark import cut, fields, ship, with_places

SPAN, GRAM = 10, 5
BLOCK_BYTES = 16 << 20


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the kept fingerprints: the last smallest of each `window` consecutive hashes."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, at = hashes[:n].copy(), np.arange(n)
    for j in range(1, window):
        other = hashes[j : j + n]
        lower = other <= least
        np.copyto(least, other, where=lower)
        np.copyto(at, np.arange(j, j + n), where=lower)
    return np.unique(at)


def _hashed(data, offsets):
    starts, ends, counts = T.words(data, offsets, T.ALNUM)
    return T.Spans(data, fold=True).hash(starts, ends), counts


def _prints(h: np.ndarray, first: np.ndarray, doc: np.ndarray, span: int, gram: int):
    """Fingerprints of a block: hash and place, for texts laid end to end.  Winnowing runs
    over the whole block; windows that cross texts only add fingerprints, and 5-grams that
    cross texts are then dropped.  What a text needs is still kept, as its own windows are
    among those seen."""
    g = T.grams(h, gram)
    at = winnow(g, span - gram + 1)
    at = at[doc[at] == doc[at + gram - 1]]
    return g[at], at


class Index:
    """Fingerprints of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, str | None]], span: int, gram: int):
        texts = pa.array([t for _, t in items], pa.large_string())
        self.names = [i for i, _ in items]
        hs, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, _, data, offsets in T.blocks(texts):
            h, c = _hashed(data, offsets)
            hs.append(h)
            counts.append(c)
        self.words, n = np.concatenate(hs), np.concatenate(counts)
        self.first = T.starts_of(n)
        self.item = np.repeat(np.arange(len(n)), n)
        self.short = {}
        for k in sorted(set(n[(n > 0) & (n < span)].tolist())):
            own = np.flatnonzero(n == k)
            keys = T.grams(self.words, k)[self.first[own]]
            order = np.argsort(keys, kind="stable")
            self.short[k] = (keys[order], own[order])
        keys, at = _prints(self.words, self.first, self.item, span, gram)
        long = n[self.item[at]] >= span if len(at) else np.zeros(0, bool)
        keys, at = keys[long], at[long]
        order = np.argsort(keys, kind="stable")
        self.keys, self.at = keys[order], at[order]

    @staticmethod
    def meet(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (place in keys, place in table) with equal hashes."""
        lo = np.searchsorted(table, keys, "left")
        known = np.flatnonzero((lo < len(table)) & (table[np.minimum(lo, max(len(table) - 1, 0))] == keys) if len(table) else np.zeros(len(keys), bool))
        n = np.searchsorted(table, keys[known], "right") - lo[known]
        return np.repeat(known, n), T.ragged(lo[known], n)


def _mark(index: Index, h, counts, span, gram):
    """Hit words of a block as a mask, and (text, item) pairs."""
    first = T.starts_of(counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    edges = np.zeros(len(h) + 1, np.int64)
    texts, items = [], []

    def cover(lo, hi, item):
        np.add.at(edges, lo, 1)
        np.add.at(edges, hi, -1)
        texts.append(doc[lo])
        items.append(item)

    if len(index.keys):
        keys, at = _prints(h, first, doc, span, gram)
        i, j = index.meet(index.keys, keys)
        p, q = at[i], index.at[j]
        same = np.ones(len(p), bool)
        for step in range(gram):  # the words themselves, not only the gram's hash
            same &= h[p + step] == index.words[q + step]
        p, q = p[same], q[same]
        item, text = index.item[q], doc[p]
        reach = []
        for sign, p0, q0 in ((-1, p - 1, q - 1), (1, p + gram, q + gram)):
            going, far = np.ones(len(p), bool), np.zeros(len(p), np.int64)
            for step in range(span - gram):
                a, b = p0 + sign * step, q0 + sign * step
                going &= (a >= first[text]) & (a < first[text + 1]) & (b >= index.first[item]) & (b < index.first[item + 1])
                ok = np.flatnonzero(going)
                going[ok] = h[a[ok]] == index.words[b[ok]]
                far += going
            reach.append(far)
        full = reach[0] + reach[1] + gram >= span
        cover((p - reach[0])[full], (p + gram + reach[1])[full], item[full])
    for k, (table, own) in index.short.items():
        g = T.grams(h, k)
        inside = np.flatnonzero(doc[: len(g)] == doc[k - 1 : k - 1 + len(g)])
        i, j = index.meet(table, g[inside])
        cover(inside[i], inside[i] + k, own[j])
    hit = np.cumsum(edges[:-1]) > 0
    return hit, np.concatenate([*texts, np.zeros(0, np.int64)]), np.concatenate([*items, np.zeros(0, np.int64)])


def _pass(text_col, carried, index_of, span, gram, merge):
    """Adds n_words, n_hit, _hit (bits of the words hit) and _items to the carried columns."""

    def run(batches):
        T.release()
        index = index_of.value
        for batch in batches:
            n_words, bits, found = [], [], []
            old_bits = T.column(batch, "_hit") if merge else None
            old_items = T.column(batch, "_items") if merge else None
            for lo, hi, data, offsets in T.blocks(T.column(batch, text_col)):
                h, counts = _hashed(data, offsets)
                hit, texts, items = _mark(index, h, counts, span, gram)
                first = T.starts_of(counts)
                n_words.extend(counts.tolist())
                pairs = np.unique(texts * len(index.names) + items) if len(texts) else texts
                names = [set() for _ in range(hi - lo)]
                for x in pairs.tolist():
                    names[x // len(index.names)].add(index.names[x % len(index.names)])
                any_hit = np.diff(T.starts_of(hit.astype(np.int64))[first]) > 0
                for i in range(hi - lo):
                    own = np.packbits(hit[first[i] : first[i + 1]]).tobytes() if any_hit[i] else b""
                    if merge and (old := old_bits[lo + i].as_py()):
                        own = (np.frombuffer(own, np.uint8) | np.frombuffer(old, np.uint8)).tobytes() if own else old
                        names[i].update(old_items[lo + i].as_py())
                    bits.append(own)
                    found.append(sorted(names[i]))
            made = {"n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array([int(np.unpackbits(np.frombuffer(x, np.uint8)).sum()) if x else 0 for x in bits], pa.int64()), "_hit": pa.array(bits, pa.binary()), "_items": pa.array(found, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([T.column(batch, c) for c in carried] + list(made.values()), [*carried, *made])

    return run


def _marked(work: DataFrame, text_col, carried, benchmark, item_col, item_text, span, gram, block_bytes) -> DataFrame:
    """carried, n_words, n_hit, _hit and _items of every row."""
    spark = ship(work.sparkSession)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"), F.col(item_text).cast("string").alias("t")).filter(F.col("t").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("t")).alias("b")).first()["b"] or 0
    n_blocks = 1 + int(size // block_bytes)
    schema = fields(work, carried, "n_words long, n_hit long, _hit binary, _items array<string>")
    out = work
    for b in range(n_blocks):
        rows = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == b).collect()
        index = spark.sparkContext.broadcast(Index(sorted((r["i"], r["t"]) for r in rows), span, gram))
        if b:
            out = cut(out)
        out = out.mapInArrow(_pass(text_col, carried, index, span, gram, b > 0), schema)
    return out


def hits(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text="text", span=SPAN, gram=GRAM, block_bytes=BLOCK_BYTES) -> DataFrame:
    """id_col, n_words, n_hit, items (the item ids found, as sorted strings), contaminated.

    Words are runs of ASCII letters and digits and of all non-ASCII characters, A-Z
    lower-cased.  Null and empty texts have no words and are never contaminated; items
    without words match nothing; a null item id counts as an empty string.  Rows with equal
    or null document ids are separate documents.  Equal item ids are one item of several
    texts.  Other columns are ignored.  An empty benchmark contaminates nothing.
    """
    work = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    out = _marked(work, "_text", ["_id", "_text"], benchmark, item_col, item_text, span, gram, block_bytes)
    return out.select(F.col("_id").alias(id_col), "n_words", "n_hit", F.col("_items").alias("items"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col="text", item_col="item_id", item_text="text", span=SPAN, gram=GRAM, block_bytes=BLOCK_BYTES) -> DataFrame:
    """The rows of docs, all columns, in which no window of an item occurs."""
    work = with_places(docs)
    out = _marked(work, f"_{docs.columns.index(text_col)}", work.columns, benchmark, item_col, item_text, span, gram, block_bytes)
    return out.filter("n_hit = 0").select(*work.columns).toDF(*docs.columns)
