import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.llm.common import EDGES, low, with_clashes, words
from treeflow.llm import lm_scoring as X
from treeflow.llm.queries import op4_cross_entropy


class Brute:
    """The same model in dictionaries, without one text."""

    def __init__(self, every, counted):
        self.size = len({w for d in every for w in d})
        self.words = Counter(w for d in counted for w in d)
        self.pairs = Counter(p for d in counted for p in zip([None, *d], d, strict=False))
        self.words[None] = sum(1 for d in counted if d)
        self.total = sum(map(len, counted))

    def without(self, own, all_words, own_all):
        """p(b | a) without the words `own`; all_words, own_all: words of both models, and those
        of the text among them"""
        words, pairs, size = Counter(own), Counter(zip([None, *own], own, strict=False)), self.total - len(own)
        words[None] = bool(own)
        ratio = max(size, 1) / max(all_words - own_all, 1)
        base = lambda b: (self.words[b] - words[b] + X.ALPHA * ratio) / (size + X.ALPHA * ratio * self.size)
        return lambda a, b: (self.pairs[a, b] - pairs[a, b] + X.MU * ratio * base(b)) / (self.words[a] - words[a] + X.MU * ratio)


def loss(p, d):
    return -sum(math.log2(p(a, b)) for a, b in zip([None, *d], d, strict=False)) / len(d)


def brute(rows):
    """rows: id, text, target, counted"""
    docs = [([low(w) for w in words(t)], bool(x and c), bool(c)) for _, t, x, c in rows]
    every = [d for d, _, _ in docs]
    target, both = Brute(every, [d for d, x, _ in docs if x]), Brute(every, [d for d, _, c in docs if c])
    out = []
    for (i, *_), (d, x, c) in zip(rows, docs, strict=True):
        a, b = (loss(m.without(d if own else [], both.total, len(d) * c), d) for m, own in ((target, x), (both, c))) if d else (None, None)
        out.append((repr(i), len(d), a, b))
    return sorted(out, key=repr)


def check(df, rows, **options):
    got = sorted(((repr(r.doc_id), r.n_tokens, r.target_loss, r.background_loss) for r in X.score(df, **options).collect()), key=repr)
    own = brute(rows)
    assert [g[:2] for g in got] == [o[:2] for o in own]
    for g, o in zip(got, own, strict=True):
        assert g[2:] == (pytest.approx(o[2:], abs=2e-5) if o[2] is not None else o[2:])


ROWS = [(i, t, i is not None and i % 2 == 0, True) for i, t in EDGES]
ROWS += [(100 + i, f"the cat sat on mat {i % 7} the cat rare{i} end{i}", i % 4 == 0, True) for i in range(60)]
ROWS += [(200, "the dog " * 10_000, None, True), (300, "unseen words the cat mat rare3 rare5 unseen", True, False), (301, "rare1 cat end7", False, None)]


@pytest.mark.parametrize(("hot_words", "hot_pairs"), [(X.HOT_WORDS, X.HOT_PAIRS), (40, 60), (10**6, 20), (5, 1), (0, 0)])
def test_brute_force(spark, hot_words, hot_pairs):
    rows = sorted(ROWS, key=repr)
    df = spark.createDataFrame(rows, "doc_id long, text string, target boolean, counted boolean").repartition(3)
    check(with_clashes(df, ["chunk", "bucket", "n", "t", "id", "body"]), rows, counted_col="counted", hot_words=hot_words, hot_pairs=hot_pairs)


def test_stretches(monkeypatch):
    """In the driver's own process: every row is in one stretch, with all its words."""
    import pyarrow as pa

    monkeypatch.setattr(X, "CHUNK_WORDS", 20)
    texts = [t for _, t, _, _ in ROWS if t is None or len(t) < 100]
    batch = pa.RecordBatch.from_pydict({"text": texts, "target": [True] * (len(ROWS) - 1), "counted": [True] * (len(ROWS) - 1)})
    made = list(X._stretches(batch.slice(i, 1) for i in range(len(batch))))
    assert len(made) > 10 and sum(len(s.n) for s in made) == len(ROWS) - 1
    assert [int(n) for s in made for n in s.n] == [len(words(t)) for _, t, _, _ in ROWS if t is None or len(t) < 100]


def test_table(spark):
    d, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    for most in (X.BROADCAST_IDS, 0):
        marked = X.mark_target(d.select("doc_id", "text"), labels, where="quality = 1 and toxic = 0", broadcast_ids=most)
        assert marked.filter("target").count() == labels.filter("quality = 1 and toxic = 0").select("doc_id").distinct().count()
    rows = [(r.doc_id, r.text, r.target, True) for r in marked.collect()]
    check(marked, rows)
    check(marked, rows, hot_words=500, hot_pairs=1000)


def test_the_registered_query_scores_every_document(spark):
    own = {r.doc_id: (r.n_tokens, r.difference) for r in op4_cross_entropy(spark, DATA).collect()}
    d = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert sorted(own) == sorted(r.doc_id for r in d)
    assert all(own[r.doc_id][0] == len(words(r.text)) for r in d)


def auc(good, bad):
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def test_target_rows_have_no_advantage_of_their_own_text(spark):
    """Of random texts, those in the target model score no higher than those outside it."""
    import random

    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(120)), i % 2 == 0) for i in range(400)]
    by = {r.doc_id: r.difference for r in X.score(spark.createDataFrame(rows, "doc_id long, text string, target boolean")).collect()}
    assert 0.35 < auc([by[i] for i, _, x in rows if x], [by[i] for i, _, x in rows if not x]) < 0.65


def test_held_out_labels(spark):
    """Half of the labels mark the target; the others are told apart."""
    folder = DATA.replace("sf0.001", "sf0.01")
    d, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    marked = X.mark_target(d.select("doc_id", "text"), labels.filter("doc_id % 2 = 0"), where="quality = 1 and toxic = 0")
    by = {r.doc_id: r.difference for r in X.score(marked).collect()}
    for held_out in (1, 0):  # rows that marked nothing, and rows that did but are left out
        own = [(by[r.doc_id], r.quality == 1 and r.toxic == 0) for r in labels.filter(f"doc_id % 2 = {held_out}").collect() if by[r.doc_id] is not None]
        found = auc([s for s, good in own if good], [s for s, good in own if not good])
        print("AUC", held_out, found)
        assert found > 0.6


def test_target_like_text_scores_higher(spark):
    rows = [(i, "alpha beta gamma delta", True) for i in range(20)] + [(100 + i, "red green blue white", False) for i in range(20)]
    by = {r.doc_id: r.difference for r in X.score(spark.createDataFrame(rows, "doc_id long, text string, target boolean")).collect()}
    assert min(by[i] for i in range(20)) > max(by[100 + i] for i in range(20))


def test_probabilities_of_a_history_sum_to_one(spark):
    docs = [low(t).split() for _, t, _, _ in ROWS[10:40]]
    model = Brute(docs, docs)
    p = model.without([], model.total, 0)
    for a in ("the", "cat", "end3", None):
        end = sum(1 for d in docs if d[-1] == a) / (model.words[a] + X.MU)
        assert sum(p(a, b) for b in {w for d in docs for w in d}) + end == pytest.approx(1)


def test_no_target_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", False)], "doc_id long, text string, target boolean")
    assert X.score(df).first().n_tokens == 2
    assert X.score(df.limit(0)).count() == 0
    assert X.score(spark.createDataFrame([(1, None, None), (2, " ", True)], "doc_id long, text string, target boolean")).filter("difference is null").count() == 2
