"""Language ID of mixed-language text: script ranges, then Viterbi over words.

Words are runs of letters of one script.  A word's script narrows the languages it may
belong to (those that used the script in training); each of these gets the word's summed
log-probability of hashed character n-grams with word boundaries.  Viterbi with a price for
every change of language labels the words of a text, so a foreign passage becomes a span of
its own and a stray word does not.  The text's language is the one with most letters.

The model is counted on at most about `train_docs` documents of each language (chosen by a
hash, so in proportion everywhere) and has a fixed number of n-gram buckets.  Prediction
reads every whole text once, without a shuffle.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._spark import fields, ship, with_places

TRAIN_DOCS, BUCKETS, SIZES = 5000, 1 << 16, (1, 2, 3, 4)
SWITCH, FLOOR, MIN_SHARE, MIN_SCORE = 12.0, 10.0, 0.001, 0.4
_GROUP = 4 << 20
_PLANES = 0x20000


@cache
def _letters() -> tuple[np.ndarray, np.ndarray, list[str]]:
    """By code point: script (0: no letter) and lower-case form; the scripts' names.

    A letter's script is the first word of its Unicode name; code points beyond the first
    two planes are ideographs and taken as CJK."""
    names, script, lower = [""], np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.int32)
    known: dict[str, int] = {}
    for cp in range(_PLANES):
        c = chr(cp)
        if c.isalpha():
            name = unicodedata.name(c, "OTHER").split()[0]
            if name not in known:
                known[name] = min(len(names), 255)
                names.append(name)
            script[cp] = known[name]
            low = c.lower()
            if len(low) == 1:
                lower[cp] = ord(low)
    script[0x20000:0x32000] = known.get("CJK", 1)
    return script, lower, names


def _points(texts: list[str]) -> np.ndarray:
    """Code points of the texts, each ended by a line break."""
    return np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


class Words:
    """Words of some texts: place, length, script, words of each text, and n-gram buckets."""

    def __init__(self, texts: list[str], buckets: int, sizes: tuple[int, ...]):
        script, lower, _ = _letters()
        cps = _points(texts)
        kind = script[cps]
        edge = np.ones(len(cps), bool)
        edge[1:] = kind[1:] != kind[:-1]
        self.start = np.flatnonzero(edge & (kind > 0))
        stop = np.flatnonzero(np.append(edge[1:], True) & (kind > 0)) + 1
        self.length = stop - self.start
        self.script = kind[self.start]
        self.base = T.starts_of(np.array([len(t) + 1 for t in texts], np.int64))
        self.counts = np.diff(np.searchsorted(self.start, self.base))
        # letters with one boundary before each word and one behind it
        n = len(self.start)
        at = T.starts_of(self.length + 1)  # boundary, then the word
        low = np.zeros(int(at[-1]) + 1, np.uint64)
        low[T.ragged(at[:-1] + 1, self.length)] = lower[cps[T.ragged(self.start, self.length)]].astype(np.uint64)
        self.grams, self.owner = [], []
        for size in sizes:
            m = len(low) - size + 1
            if m <= 0 or not n:
                continue
            h = np.full(m, size, np.uint64)
            whole = np.ones(m, bool)
            for j in range(size):
                h = (h ^ low[j : j + m]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                if 0 < j < size - 1 or size == 1:
                    whole &= low[j : j + m] != 0  # a boundary may stand at either end only
            if size == 2:
                whole &= (low[:m] != 0) | (low[1:] != 0)
            place = np.flatnonzero(whole)
            self.grams.append((h[place] % np.uint64(buckets)).astype(np.int64))
            # the word of a gram: that of its first letter
            first = place + (low[place] == 0)
            self.owner.append(np.minimum(np.searchsorted(at, first, "right") - 1, n - 1))


class Model:
    """Log-probabilities of n-gram buckets, and the languages of each script."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray, sizes: tuple[int, ...]):
        """counts: buckets x languages; scripts: 256 x languages."""
        self.langs, self.sizes, self.buckets = langs, sizes, len(counts)
        total = counts.sum(0) + 0.5 * len(counts)
        self.table = np.log((counts + 0.5) / total).astype(np.float32)
        share = scripts / np.maximum(scripts.sum(0), 1)
        self.allowed = share >= MIN_SHARE

    def scores(self, words: Words) -> np.ndarray:
        """words x languages: 0 for the best language of a word, less for others, at least -FLOOR."""
        n, k = len(words.start), len(self.langs)
        out = np.zeros((n, k), np.float64)
        for grams, owner in zip(words.grams, words.owner, strict=True):
            if len(grams):
                for j in range(k):
                    out[:, j] += np.bincount(owner, self.table[:, j][grams], n)
        allowed = self.allowed[words.script]
        some = allowed.any(1)
        out[~allowed & some[:, None]] = -np.inf
        out[~some] = 0.0  # no language writes so: no evidence
        out -= out.max(1, keepdims=True, initial=-np.inf) if n else 0
        return np.maximum(out, -FLOOR).astype(np.float32)


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """The best label of every word of texts laid end to end; runs over all texts at once,
    the longest first.  Of equal ways the one without a change, then the first label."""
    n, k = scores.shape
    labels = np.zeros(n, np.int64)
    if not n:
        return labels
    order = np.argsort(-counts, kind="stable")
    size, first = counts[order], T.starts_of(counts)[:-1][order]
    active = np.searchsorted(-size, -np.arange(int(size[0])), "left")  # texts with more than t words
    stays, froms = np.ones((n, k), bool), np.zeros(n, np.int16)
    best = np.zeros((int(active[0]), k))
    value = np.zeros((len(counts), k))
    for t in range(int(size[0])):
        a = active[t]
        at = first[:a] + t
        s = scores[at]
        if t:
            v = value[:a]
            top = v.argmax(1)
            jump = v[np.arange(a), top] - switch
            keep = v >= jump[:, None]
            stays[at], froms[at] = keep, top
            best = np.where(keep, v, jump[:, None])
            value[:a] = best + s
        else:
            value[:a] = s
    state = value.argmax(1)
    for t in range(int(size[0]) - 1, -1, -1):
        a = active[t]
        at = first[:a] + t
        own = state[:a]
        labels[at] = own
        state[:a] = np.where(stays[at, own], own, froms[at])
    return labels


def held_out(id_col: str = "doc_id"):
    """crc32(id as text) mod 3 is 1 (a null id counts as empty)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", train_docs=TRAIN_DOCS, buckets=BUCKETS, sizes=SIZES) -> Model | None:
    """The model of the documents that are not held out; None if there is no labelled text."""
    spark = ship(docs.sparkSession)
    rows = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    n = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not n:
        return None
    langs = sorted(n)
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, train_docs / n[lang]))])
    chosen = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20))

    def run(batches):
        T.release()
        counts, scripts = {}, {}
        for batch in batches:
            lang = T.column(batch, "lang").to_pylist()
            texts = T.column(batch, "text").to_pylist()
            for own in sorted(set(lang)):
                mine = [t for t, x in zip(texts, lang, strict=True) if x == own]
                for i in range(0, len(mine), 200):
                    w = Words(mine[i : i + 200], buckets, sizes)
                    counts.setdefault(own, np.zeros(buckets, np.int64))
                    scripts.setdefault(own, np.zeros(256, np.int64))
                    for g in w.grams:
                        counts[own] += np.bincount(g, minlength=buckets)
                    scripts[own] += np.bincount(w.script, minlength=256)
        for own in counts:
            every = np.concatenate([counts[own], scripts[own]])
            at = np.flatnonzero(every)
            yield pa.RecordBatch.from_arrays([pa.array([own] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(every[at], pa.int64())], ["lang", "place", "n"])

    summed = chosen.select("lang", "text").mapInArrow(run, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    table = np.zeros((buckets + 256, len(langs)), np.float64)
    column = {lang: j for j, lang in enumerate(langs)}
    for r in summed.toLocalIterator():
        table[r["place"], column[r["lang"]]] = r["n"]
    return Model(langs, table[:buckets], table[buckets:], sizes)


def _label(model: Model, texts: list[str], switch: float, spans: bool):
    """Language, score and spans of each text."""
    scores, counts, parts, evidence = [], [], [], []
    size, held = 0, []

    def block():
        w = Words(held, model.buckets, model.sizes)
        scores.append(model.scores(w))
        # a word tells something if languages differ on it, or if the only one uses its script
        evidence.append(scores[-1].min(1) < 0 if len(model.langs) > 1 else model.allowed[w.script][:, 0])
        counts.append(w.counts)
        parts.append((w.start - np.repeat(w.base[:-1], w.counts), w.length))

    for t in texts:
        held.append(t)
        size += len(t)
        if size > T.BLOCK // 2:
            block()
            size, held = 0, []
    if held:
        block()
    n = np.concatenate(counts)
    label = viterbi(np.concatenate(scores), n, switch)
    evidence = np.concatenate(evidence)
    start, length = (np.concatenate(c) for c in zip(*parts, strict=True))
    text = np.repeat(np.arange(len(n)), n)
    k = len(model.langs)
    weight = np.bincount(text * k + label, length * np.where(evidence, 1.0, 1e-6), len(n) * k).reshape(len(n), k)
    letters = np.bincount(text, length, len(n))
    best = weight.argmax(1)
    share = weight[np.arange(len(n)), best] / np.maximum(letters, 1)
    langs = [model.langs[b] if m else "und" for b, m in zip(best.tolist(), n.tolist(), strict=True)]
    share = np.where(n > 0, np.minimum(share, 1.0), 0.0)
    if not spans:
        return langs, share, None
    out: list[list[dict]] = [[] for _ in langs]
    for i, (s, m, x) in enumerate(zip(start.tolist(), length.tolist(), label.tolist(), strict=True)):
        own = out[text[i]]
        if own and own[-1]["lang"] == model.langs[x]:
            own[-1]["end"] = s + m
        else:
            own.append({"start": s, "end": s + m, "lang": model.langs[x]})
    return langs, share, out


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None, switch: float = SWITCH, spans: bool = False) -> DataFrame:
    """The columns `keep` (default: all), lang_pred, score and, if asked for, spans.

    score is the share of letters labelled lang_pred.  A null text, or one without a letter,
    is `und` with score 0, as is every text if nothing could be learned.  A text whose
    scripts no learned language uses gets the first language with a score near 0.  Columns
    of docs named like the new ones are replaced.  Each row is judged by its text alone, so
    ids may repeat or be null.  A task holds some 100 bytes for each character of its longest
    text, and of a group of shorter ones.
    spans: code point ranges [start, end) with their language, in order.
    """
    spark = ship(docs.sparkSession)
    new = ["lang_pred", "score", *["spans"] * spans]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col(text_col).cast("string").alias("_text"))
    carried = [f"_{i}" for i in range(len(keep))]

    def run(batches):
        T.release()
        model = shared.value
        for batch in batches:
            every = [t or "" for t in T.column(batch, "_text").to_pylist()]
            # texts of like length share a group: a group takes as many steps as its longest text
            order = np.argsort([len(t) for t in every], kind="stable")
            langs, share, found = np.full(len(every), "und", object), np.zeros(len(every)), [[] for _ in every]
            at = 0
            while model and at < len(every):
                size, end = 0, at
                while end < len(every) and (size < _GROUP):
                    size += len(every[order[end]])
                    end += 1
                own = order[at:end]
                langs[own], share[own], some = _label(model, [every[i] for i in own], switch, spans)
                for i, x in zip(own.tolist(), some or (), strict=False):
                    found[i] = x
                at = end
            made = [pa.array(langs, pa.string()), pa.array(share, pa.float64())]
            if spans:
                made.append(pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))))
            yield pa.RecordBatch.from_arrays([*(T.column(batch, c) for c in carried), *made], [*carried, *new])

    more = ", ".join(["lang_pred string", "score double", *["spans array<struct<start:long,end:long,lang:string>>"] * spans])
    return rows.mapInArrow(run, fields(rows, carried, more)).toDF(*keep, *new)


def drop_unknown(docs: DataFrame, model: Model | None, text_col: str = "text", min_score: float = MIN_SCORE, switch: float = SWITCH) -> DataFrame:
    """The rows of docs, all columns, whose text has a language: not `und`, and at least
    min_score of its letters in one language."""
    work = with_places(docs)
    out = predict(work, model, f"_{docs.columns.index(text_col)}", switch=switch)
    return out.filter((F.col("lang_pred") != "und") & (F.col("score") >= min_score)).select(*work.columns).toDF(*docs.columns)
