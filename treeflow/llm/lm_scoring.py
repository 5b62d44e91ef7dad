"""Cross-entropy difference: a target and a background bigram model over one vocabulary.

The vocabulary is every word of the rows.  Both models are the same hierarchical Dirichlet
bigram model, p(b | a) = (n(a, b) + m p(b)) / (n(a) + m) with p(b) = (n(b) + l) / (N + l V),
once with the counts of the target rows and once with those of all counted rows; what a
history's probabilities lack to one is that of the text's end.  The models are matched: m and
l are MU and ALPHA in proportion to the model's words, so that a word or pair that neither
knows is as likely in both, however small the target.  Every count is taken without the scored row itself (leave one out), so no text is judged by a model that
holds it: a copy of it elsewhere counts, its own words do not.

That model needs no more for a word than the counts of the word and of its pair, so one
shuffle by word both counts and scores:

1. One pass finds words and pairs that are frequent in some stretch of a task; the most
   frequent (at most `hot_words` and `hot_pairs`) go to the tasks.  A second pass counts them
   exactly, with the vocabulary and the totals.
2. Tasks settle frequent pairs in place.  Every other (row, pair) goes, packed, to the bucket
   of its word, or of the pair where the word is frequent.  There all rows of the key meet,
   are counted, and each text's sum of logarithms goes back, packed by stretch.

What goes to the tasks changes the work, never the scores: nothing is cut off.  A key of a
bucket has fewer rows than the frequent ones; buckets grow in number with the corpus.  Words
are compared by 64 bits in the tasks and by 40 bits inside a bucket.  A text is read whole: its
task holds some 100 bytes a word of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._spark import cut, ship, shuffle_partitions

HOT_WORDS, HOT_PAIRS = 65_535, 131_072
ALPHA, MU = 0.5, 1000.0
#: words and rows of a stretch, and entries of a bucket on average
CHUNK_WORDS, CHUNK_ROWS, BUCKET_ENTRIES = 1_000_000, 50_000, 1_000_000
_START = np.uint64(0)  # history of a first word
_WORD, _PAIR, _ROWS = 0, 1, 2


# --- packed arrays --------------------------------------------------------------------------


def _pack(*arrays: np.ndarray) -> bytes:
    """Integers and floats as byte planes, which compress well where high bytes are zero."""
    out = [np.array([len(a) for a in arrays], "<i8").tobytes()]
    out += [np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays]
    return b"".join(out)


def _unpack(raw: bytes, *kinds) -> list[np.ndarray]:
    n, at, out = np.frombuffer(raw, "<i8", len(kinds)).tolist(), 8 * len(kinds), []
    for m, kind in zip(n, map(np.dtype, kinds), strict=True):
        planes = np.frombuffer(raw, np.uint8, m * kind.itemsize, at).reshape(kind.itemsize, m)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(m))
        at += m * kind.itemsize
    return out


def _low40(keys: np.ndarray) -> np.ndarray:
    """The lowest five bytes of each key, end to end."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).reshape(-1)


def _from40(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, :5] = raw.reshape(-1, 5)
    return wide.view("<u8").reshape(-1)


def _grouped(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Number of each entry's key among the different keys, and the weights' sums by that number."""
    order = np.argsort(keys)
    new = np.empty(len(keys), bool)
    new[:1] = True
    np.not_equal(keys[order[1:]], keys[order[:-1]], out=new[1:])
    of = np.empty(len(keys), np.int64)
    of[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    return of, [np.add.reduceat(w[order], at) if len(at) else w[:0] for w in weights]


# --- reading texts --------------------------------------------------------------------------


class _Stretch:
    """Some whole texts of a task: word hashes, the row each is in, and the rows' columns."""

    def __init__(self, hashes, counts, batches):
        self.h, self.n = np.concatenate(hashes), np.concatenate(counts)
        self.row = np.repeat(np.arange(len(self.n)), self.n)
        column = lambda c: pa.chunked_array([T.column(b, c) for b in batches])
        flag = lambda c: column(c).fill_null(False).to_numpy().astype(bool)
        self.batches, self.target, self.counted = batches, flag("target"), flag("counted")
        self.target &= self.counted
        inner = np.zeros(len(self.h), bool)
        inner[1:] = self.row[1:] == self.row[:-1]
        self.before = np.where(inner, np.roll(self.h, 1), _START)
        self.last = np.ones(len(self.h), bool)
        self.last[:-1] = ~inner[1:]

    @property
    def pairs(self):
        return T.mix(self.h * np.uint64(0xD6E8FEB86659FD93) + self.before)


def _stretches(batches):
    """Texts in stretches of about CHUNK_WORDS words, and CHUNK_ROWS rows at most."""
    T.release()
    hashes, counts, held, size, rows = [], [], [], 0, 0
    for batch in batches:
        for lo, hi, data, offsets in T.blocks(T.column(batch, "text")):
            for a in range(lo, hi, CHUNK_ROWS):
                b = min(hi, a + CHUNK_ROWS)
                part = offsets[a - lo : b - lo + 1]
                starts, ends, n = T.words(data[part[0] : part[-1]], part - part[0], T.NON_SPACE)
                if rows and (size + len(starts) > CHUNK_WORDS or rows + b - a > CHUNK_ROWS):
                    yield _Stretch(hashes, counts, held)
                    hashes, counts, held, size, rows = [], [], [], 0, 0
                hashes.append(T.Spans(data[part[0] : part[-1]], fold=True).hash(starts, ends))
                counts.append(n)
                held.append(batch.slice(a, b - a))
                size, rows = size + len(starts), rows + b - a
    if rows:
        yield _Stretch(hashes, counts, held)


def _places(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in the sorted table, or -1."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


# --- first pass: which words and pairs are frequent --------------------------------------------


def _frequent(batches):
    """(kind, key, n): counts of a task's frequent words and pairs, and its words."""
    held, words = {_WORD: [], _PAIR: []}, 0

    def rows(kind):
        keys, n = (np.concatenate(c) for c in zip(*held[kind], strict=True))
        order = np.argsort(keys)
        at = np.flatnonzero(np.append(True, keys[order[1:]] != keys[order[:-1]])[: len(keys)])
        held[kind] = [(keys[order[at]], np.add.reduceat(n[order], at) if len(at) else n[:0])]
        return held[kind][0]

    def batch(kind):
        keys, n = rows(kind)
        held[kind] = []
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(n)], ["kind", "key", "n"])

    for s in _stretches(batches):
        words += len(s.h)
        least = max(2, len(s.h) >> 18)
        for kind, keys in ((_WORD, s.h), (_PAIR, s.pairs)):
            keys = np.sort(keys)
            at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
            n = np.diff(np.append(at, len(keys)))
            held[kind].append((keys[at[n >= least]], n[n >= least]))
            if len(held[kind]) > 1 and sum(len(k) for k, _ in held[kind]) > 1_000_000 and len(rows(kind)[0]) > 500_000:
                yield batch(kind)
    for kind, found in held.items():
        if found:
            yield batch(kind)
    yield pa.RecordBatch.from_arrays([pa.array([_ROWS], pa.int32()), pa.array([0], pa.int64()), pa.array([words], pa.int64())], ["kind", "key", "n"])


def _top(sums: DataFrame, most: int) -> np.ndarray:
    """Sorted keys of at least the count c, c the least with no more than `most` such rows."""
    histogram = sums.groupBy("n").count().orderBy(F.desc("n"))
    total, least = 0, 1 << 62
    for r in histogram.toLocalIterator():  # one row for each different count
        total += r["count"]
        if total > most:
            break
        least = r["n"]
    return np.sort(sums.filter(F.col("n") >= least).select("key").toArrow().column("key").to_numpy().view(np.uint64))


# --- second pass: exact counts of these, the vocabulary, the totals -----------------------------

_SLICE = 8192


def _count(hot, buckets: int):
    """(kind, part, body): sums of the frequent words' and pairs' counts by slices, the other
    words by buckets, and the totals."""

    def run(batches):
        words, pairs = hot.value
        sums, totals, held, size = np.zeros((2, len(words) + len(pairs)), np.int64), np.zeros(4, np.int64), [], 0

        def rare():
            own = np.unique(np.concatenate(held))
            order = np.argsort(own % np.uint64(buckets), kind="stable")
            parts = own[order] % np.uint64(buckets)
            cuts = np.append(np.flatnonzero(np.append(True, parts[1:] != parts[:-1])[: len(parts)]), len(parts))
            return made(_PAIR, parts[cuts[:-1]].astype(np.int32), [_low40(own[order[a:b]] >> np.uint64(24)).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)])

        def made(kind, parts, bodies):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), kind, np.int32)), pa.array(parts, pa.int32()), pa.array(bodies, pa.binary())], ["kind", "part", "body"])

        for s in _stretches(batches):
            place = _places(words, s.h)
            counted, target = s.counted[s.row], s.target[s.row]
            for at, first in ((place, 0), (_places(pairs, s.pairs), len(words))):
                for k, chosen in enumerate((counted, target)):
                    sums[k] += np.bincount(at[chosen & (at >= 0)] + first, minlength=sums.shape[1])
            some = s.n > 0
            totals += [counted.sum(), target.sum(), (some & s.counted).sum(), (some & s.target).sum()]
            held.append(np.unique(s.h[place < 0]))
            size += len(held[-1])
            if size > CHUNK_WORDS:
                yield rare()
                held, size = [], 0
        if size:
            yield rare()
        slices = [k for k in range(-(-sums.shape[1] // _SLICE)) if sums[0, k * _SLICE : (k + 1) * _SLICE].any()]
        yield made(_WORD, slices, [_pack(*sums[:, k * _SLICE : (k + 1) * _SLICE]) for k in slices])
        yield made(_ROWS, [0], [_pack(totals)])

    return run


def _summed(batches):
    """Rows sorted by kind and part -> one row of each: the number of different words, or sums."""
    T.release()
    own, held, size = None, [], 0

    def done():
        kind, part = own
        words = len(np.unique(np.concatenate(held))) if kind == _PAIR else 0
        body = pa.array([None if kind == _PAIR else held[0].tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([words], pa.int64()), body], ["kind", "part", "words", "body"])

    for batch in batches:
        for kind, part, raw in zip(T.column(batch, "kind").to_pylist(), T.column(batch, "part").to_pylist(), T.column(batch, "body").to_pylist(), strict=True):
            if (kind, part) != own:
                if own:
                    yield done()
                own, held, size = (kind, part), [], 0
            if kind == _PAIR:
                held.append(_from40(np.frombuffer(raw, np.uint8)))
                size += len(held[-1])
                if size > 2_000_000:
                    held = [np.unique(np.concatenate(held))]
                    size = 0
            else:
                x = np.stack(_unpack(raw, "<i8", "<i8") if kind == _WORD else _unpack(raw, "<i8"))
                held = [held[0] + x] if held else [x]
    if own:
        yield done()


class Totals:
    """What goes to the tasks: frequent words and pairs with their counts, and the totals of
    all counted rows [0] and of the target rows [1]."""

    def __init__(self, words, pairs, sums, totals, vocabulary, alpha, mu):
        self.words, self.pairs = words, pairs
        self.word_n, self.pair_n = sums[:, : len(words)], sums[:, len(words) :]
        self.size, self.texts, self.vocabulary = totals[:2], totals[2:], vocabulary
        self.alpha, self.mu = alpha, mu

    def left(self, length, use) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each model its words without each row, and their ratio to those of all rows; use:
        whether the row is in the background, in the target."""
        sizes = [self.size[k] - length * use[k] for k in (0, 1)]
        return [(s, np.maximum(s, 1) / np.maximum(sizes[0], 1)) for s in sizes]

    def spread(self, n, size, ratio) -> np.ndarray:
        """m p(b) for a word of n occurrences in a model of that size and ratio."""
        return self.mu * ratio * (n + self.alpha * ratio) / (size + self.alpha * ratio * self.vocabulary)


def totals(rows: DataFrame, hot_words: int = HOT_WORDS, hot_pairs: int = HOT_PAIRS, alpha: float = ALPHA, mu: float = MU) -> tuple[Totals, int]:
    """The counts that go to the tasks, and the number of words; rows: text, target, counted."""
    found = cut(rows.mapInArrow(_frequent, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))
    spark = rows.sparkSession
    n = found.filter(F.col("kind") == _ROWS).agg(F.sum("n")).first()[0] or 0
    hot = [_top(found.filter(F.col("kind") == kind), most) for kind, most in ((_WORD, hot_words), (_PAIR, hot_pairs))]
    buckets = max(shuffle_partitions(spark), n // BUCKET_ENTRIES + 1)
    counted = rows.mapInArrow(_count(spark.sparkContext.broadcast(hot), buckets), "kind int, part int, body binary")
    counted = counted.repartition(shuffle_partitions(spark), "kind", "part").sortWithinPartitions("kind", "part").mapInArrow(_summed, "kind int, part int, words long, body binary")
    counted = cut(counted)
    sums, whole = np.zeros((2, len(hot[0]) + len(hot[1])), np.int64), np.zeros(4, np.int64)
    vocabulary = len(hot[0]) + (counted.agg(F.sum("words")).first()[0] or 0)
    for r in counted.filter("body is not null").collect():  # a row for each slice of the frequent
        x = np.frombuffer(r["body"], "<i8")
        if r["kind"] == _WORD:
            sums[:, r["part"] * _SLICE : (r["part"] + 1) * _SLICE] = x.reshape(2, -1)
        else:
            whole = x
    return Totals(*hot, sums, whole, vocabulary, alpha, mu), n


# --- third pass: scoring ------------------------------------------------------------------------

_ENTRY = ["<u2", np.uint8, np.uint8, "<u4", "<u4", "<u2", "<u4", "<i8"]


def _entries(shared, buckets: int, id_col: str):
    """A row for each text with what its task knows of it, and packed rows of what it does not:
    by bucket the texts' places, the pairs, how often each text has the pair and its word."""

    def run(batches):
        t: Totals = shared.value
        chunk = TaskContext.get().partitionId() << 32
        for s in _stretches(batches):
            place, pair = _places(t.words, s.h), _places(t.pairs, s.pairs)
            row, m = s.row.astype(np.uint64), len(s.n)
            # (row, word) and (row, pair): how often
            word_of, (own,) = _grouped(T.mix(s.h + row * np.uint64(0x9E3779B97F4A7C15)), np.ones(len(s.h), np.int64))
            own = own[word_of]
            pair_of, (times,) = _grouped(T.mix(s.pairs + row * np.uint64(0xC2B2AE3D27D4EB4F)), np.ones(len(s.h), np.int64))
            times = times[pair_of]
            use, sums, known = (s.counted[s.row], s.target[s.row]), np.zeros((2, m)), t.left(s.n, (s.counted, s.target))
            at = np.flatnonzero(place >= 0)
            settled = at[pair[at] >= 0]
            rest = at[pair[at] < 0]
            for k in (0, 1):
                gone, (size, ratio) = use[k], known[k]
                spread = t.spread(t.word_n[k][place[at]] - own[at] * gone[at], size[s.row[at]], ratio[s.row[at]])
                log = np.zeros(len(s.h))
                log[at] = spread
                log[settled] += t.pair_n[k][pair[settled]] - times[settled] * gone[settled]
                log[at] = np.log2(log[at])
                go = at[~s.last[at]]  # a frequent word as history
                log[go] -= np.log2(t.word_n[k][place[go]] - own[go] * gone[go] + t.mu * ratio[s.row[go]])
                sums[k] = np.bincount(s.row, log, m)
                first = t.texts[k] - (s.target if k else s.counted)
                sums[k] -= np.where(s.n > 0, np.log2(np.maximum(first, 0) + t.mu * ratio), 0)
            ids = pa.chunked_array([T.column(b, id_col) for b in s.batches]).combine_chunks()
            ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
            place_in = np.arange(m)
            yield _batch(ids.type, bucket=-1 - place_in % 1024, chunk=np.full(m, chunk), doc=place_in, id=ids, words=s.n, n=sums[0], t=sums[1])

            # one entry for each (row, pair) that is open, by bucket and row
            open_ = np.concatenate([rest, np.flatnonzero(place < 0)])
            _, once = np.unique(pair_of[open_], return_index=True)
            at_last = np.zeros(len(times), bool)
            at_last[pair_of[s.last]] = True
            open_ = open_[once]
            rare = place[open_] < 0
            key = np.where(rare, s.h[open_], s.pairs[open_])
            bucket = (key % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((s.row[open_], ~rare, bucket))
            open_, rare, bucket = open_[order], rare[order], bucket[order]
            cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)]), len(bucket))
            flags = s.n * 4 + s.counted * 2 + s.target
            bodies = []
            for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
                e = open_[a:b]
                r = int(rare[a:b].sum())  # rare words come first
                docs, n = [], [r, b - a - r]
                for part in (s.row[e[:r]], s.row[e[r:]]):
                    docs.append(np.diff(part, prepend=0))
                bodies.append(_pack(
                    np.concatenate(docs).astype("<u2"),
                    _low40(s.h[e[:r]] >> np.uint64(24)), _low40(s.before[e] >> np.uint64(24)),
                    (times[e] * 2 + at_last[pair_of[e]]).astype("<u4"), own[e[r:]].astype("<u4"), place[e[r:]].astype("<u2"),
                    np.array(n, "<u4"), flags[_runs(s.row[e], r)].astype("<i8"),
                ))
            k = len(bodies)
            yield _batch(ids.type, bucket=bucket[cuts[:-1]], chunk=np.full(k, chunk), body=pa.array(bodies, pa.binary()))
            chunk += 1

    return run


def _runs(rows: np.ndarray, cut_at: int) -> np.ndarray:
    """The rows without repetitions, in either part."""
    new = np.append(True, rows[1:] != rows[:-1])[: len(rows)]
    if cut_at < len(rows):
        new[cut_at] = True
    return rows[new]


_COLUMNS = {"bucket": pa.int32(), "chunk": pa.int64(), "body": pa.binary(), "doc": pa.int32(), "words": pa.int64(), "n": pa.float64(), "t": pa.float64()}


def _batch(id_type, **cols) -> pa.RecordBatch:
    n = len(next(iter(cols.values())))
    kinds = _COLUMNS | {"id": id_type}
    return pa.RecordBatch.from_arrays([cols[c] if isinstance(cols.get(c), pa.Array) else pa.array(cols[c], k) if c in cols else pa.nulls(n, k) for c, k in kinds.items()], list(kinds))


def _answers(shared):
    """Rows sorted by bucket -> the rows of texts as they are, and for each packed row the sums
    of its texts."""

    def bucket(held, t: Totals):
        """(chunk, texts, sums of both models) of each packed row of one bucket"""
        got = [_unpack(raw, *_ENTRY) for _, raw in held]
        n = np.array([g[6].tolist() for g in got], np.int64)
        made, whose = [], []
        # texts, numbered through all packed rows, with their flags
        docs, texts, flags = [], [], 0
        for g, (r, _) in zip(got, n.tolist(), strict=True):
            rows = g[0].astype(np.int64)
            rows[:r], rows[r:] = np.cumsum(rows[:r]), np.cumsum(rows[r:])
            new = np.append(True, rows[1:] != rows[:-1])[: len(rows)]
            if r < len(rows):
                new[r] = True
            texts.append(flags + np.cumsum(new) - 1)
            docs.append(rows[new])
            flags += len(docs[-1])
        flag = np.concatenate([g[7] for g in got])
        use = ((flag >> 1) & 1, flag & 1)
        known = t.left(flag >> 2, use)
        rare = np.concatenate([np.append(np.ones(r, bool), np.zeros(h, bool)) for r, h in n.tolist()])
        text, history = np.concatenate(texts), _from40(np.concatenate([g[2] for g in got]))
        coded = np.concatenate([g[3] for g in got]).astype(np.int64)
        times, last = coded >> 1, coded & 1
        sums = np.zeros((2, flags))
        for is_rare in (True, False):
            e = np.flatnonzero(rare == is_rare)
            if not len(e):
                continue
            x, c = text[e], times[e]
            u = [v[x] for v in use]
            if is_rare:
                word = _from40(np.concatenate([g[1] for g in got]))
                of, word_n = _grouped(word, c * u[0], c * u[1])
                word_n = [w[of] for w in word_n]
                in_text, (own,) = _grouped(T.mix(word + x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), c)
                own = own[in_text]
            else:
                word = np.concatenate([g[5] for g in got]).astype(np.int64)
                own = np.concatenate([g[4] for g in got]).astype(np.int64)
                word_n = [w[word] for w in t.word_n]
                word = word.astype(np.uint64)
            of, pair_n = _grouped(T.mix(history[e] + (word << np.uint64(24)) * np.uint64(0xD6E8FEB86659FD93)), c * u[0], c * u[1])
            for k in (0, 1):
                left, (size, ratio) = word_n[k] - own * u[k], known[k]
                spread = t.spread(left, size[x], ratio[x])
                both = pair_n[k][of] - c * u[k]
                if is_rare:
                    log = c * np.log2(both + spread) - (c - last[e]) * np.log2(left + t.mu * ratio[x])
                else:  # the rest of it is known to the task of the text
                    log = np.where(both > 0, c * np.log2(1 + both / spread), 0.0)
                sums[k] += np.bincount(x, log, flags)
        at = 0
        for (chunk, _), d in zip(held, docs, strict=True):
            s = sums[:, at : at + len(d)]
            at += len(d)
            some = s.any(0)
            if some.any():
                made.append(_pack(d[some].astype("<u2"), s[0, some].astype("<f4"), s[1, some].astype("<f4")))
                whose.append(chunk)
        return whose, made

    def run(batches):
        T.release()
        t, own, held = shared.value, None, []
        for batch in batches:
            b = T.column(batch, "bucket").to_numpy()
            known = int(np.searchsorted(b, 0))  # rows of texts have negative buckets
            if known:
                yield batch.slice(0, known)
            id_type = T.column(batch, "id").type
            more = batch.slice(known)
            for at, chunk, raw in zip(b[known:].tolist(), T.column(more, "chunk").to_pylist(), T.column(more, "body").to_pylist(), strict=True):
                if at != own:
                    if held:
                        whose, made = bucket(held, t)
                        yield _batch(id_type, bucket=np.full(len(made), own), chunk=np.array(whose, np.int64), body=pa.array(made, pa.binary()))
                    own, held = at, []
                held.append((chunk, raw))
        if held:
            whose, made = bucket(held, t)
            yield _batch(id_type, bucket=np.full(len(made), own), chunk=np.array(whose, np.int64), body=pa.array(made, pa.binary()))

    return run


def _scores(id_col: str):
    """Rows sorted by chunk, bucket -> the scores of its texts."""

    def run(batches):
        T.release()
        own, ids, held, bodies = None, [], [], []

        def done():
            doc, words, n, t = (np.concatenate(c) for c in zip(*held, strict=True))
            sums = np.zeros((2, int(doc.max()) + 1))
            if bodies:
                d, *s = (np.concatenate(c) for c in zip(*(_unpack(raw, "<u2", "<f4", "<f4") for raw in bodies), strict=True))
                sums = [np.bincount(d, x, sums.shape[1]) for x in s]
            none = words == 0
            a, b = (-(x + sums[k][doc]) / np.maximum(words, 1) for k, x in ((1, t), (0, n)))
            every = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays([every, pa.array(words), *(pa.array(x, mask=none) for x in (a, b, b - a))], [id_col, "n_tokens", "target_loss", "background_loss", "difference"])

        for batch in batches:
            chunk = T.column(batch, "chunk").to_numpy()
            cuts = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), len(chunk)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if own is not None and chunk[lo] != own:
                    yield done()
                    ids, held, bodies = [], [], []
                own, part = chunk[lo], batch.slice(lo, hi - lo)
                known = int(np.searchsorted(T.column(part, "bucket").to_numpy(), 0))
                if known:
                    x = part.slice(0, known)
                    ids.append(T.column(x, "id"))
                    held.append([T.column(x, c).to_numpy() for c in ("doc", "words", "n", "t")])
                bodies += T.column(part.slice(known), "body").to_pylist()
        if own is not None:
            yield done()

    return run


def score(docs: DataFrame, id_col="doc_id", text_col="text", target_col="target", counted_col: str | None = None, hot_words: int = HOT_WORDS, hot_pairs: int = HOT_PAIRS, alpha: float = ALPHA, mu: float = MU) -> DataFrame:
    """id_col, n_tokens, target_loss, background_loss (mean bits a word) and difference
    (background less target): higher is more like the target.

    Words are runs without [\\x20\\x09-\\x0D], A-Z lower-cased.  target_col marks the rows of the
    target model; where counted_col is given, rows without its mark are scored but in neither
    model.  A null mark is no.  A text without words, or a null, has 0 words and null losses.
    Rows are taken singly, so ids may repeat or be null; a repeated row leaves out itself, not
    its copies.  Without target rows the target model is the even spread over the vocabulary.
    Extra columns are ignored, and no rows give no rows.  `hot_words` is 65,535 at most.
    """
    spark = ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    flag = lambda c: F.col(c).cast("boolean")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), flag(target_col).alias("target"), (flag(counted_col) if counted_col else F.lit(True)).alias("counted"))
    known, n = totals(rows.select("text", "target", "counted"), min(hot_words, HOT_WORDS), hot_pairs, alpha, mu)
    shared = spark.sparkContext.broadcast(known)
    parts = shuffle_partitions(spark)
    buckets = max(parts, n // BUCKET_ENTRIES + 1)
    schema = f"bucket int, chunk long, body binary, doc int, words long, n double, t double, id {kind}"
    sent = rows.mapInArrow(_entries(shared, buckets, "id"), schema).repartition(parts, "bucket").sortWithinPartitions("bucket", "chunk")
    back = sent.mapInArrow(_answers(shared), schema).repartition(parts, "chunk").sortWithinPartitions("chunk", "bucket", "doc")
    return back.mapInArrow(_scores(id_col), f"`{id_col}` {kind}, n_tokens long, target_loss double, background_loss double, difference double")


BROADCAST_IDS = 500_000


def mark_target(docs: DataFrame, labels: DataFrame, id_col="doc_id", where=None, broadcast_ids=BROADCAST_IDS) -> DataFrame:
    """docs with `target`: whether a label row of the id passes `where`.

    Up to `broadcast_ids` target ids (counted first) go to the texts; beyond, the join is
    shuffled and its result stored, so that a task that runs again reads the same rows."""
    chosen = labels.filter(F.col(id_col).isNotNull()).filter(F.expr(where) if where else F.lit(True)).select(F.col(id_col).alias("_tid")).distinct()
    few = chosen.count() <= broadcast_ids
    out = docs.join(F.broadcast(chosen) if few else chosen, docs[id_col] == chosen["_tid"], "left").withColumn("target", F.col("_tid").isNotNull()).drop("_tid")
    return out if few else cut(out)
