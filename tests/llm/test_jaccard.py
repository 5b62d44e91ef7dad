import random
from collections import Counter, defaultdict

import pytest

from tests.conftest import DATA
from tests.llm.common import EDGES, low, with_clashes, words
from treeflow.llm import jaccard_join as J
from treeflow.llm._components import components


def shingles(text):
    w = [low(x) for x in words(text)]
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """Rows (id, n_shingles, component) with multiplicity, by comparing every two sets."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    least = {}
    for i, (own, _) in enumerate(rows):
        r = find(i)
        least[r] = own if least.get(r) is None else least[r] if own is None else min(own, least[r])
    return Counter((own, len(sets[i]), least[find(i)] if sets[i] else own) for i, (own, _) in enumerate(rows))


def groups(seed=5):
    """Unrelated texts, near copies around the threshold, chains, copies, shared passages."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    rows, own = [], 0
    add = lambda w: rows.append((len(rows) * 3 % 1009 + 1009 * (len(rows) // 1009), " ".join(w)))
    for _ in range(60):
        add([r.choice(vocabulary) for _ in range(r.randint(6, 120))] + passage)
    for size, edits, copies in ((300, 6, 40), (120, 3, 30), (60, 2, 30), (40, 1, 10), (30, 3, 10)):
        base = [r.choice(vocabulary) for _ in range(size)]
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randint(0, edits)):
                w[r.randrange(len(w))] = f"e{own}"
                own += 1
            add(w)
    chain = [r.choice(vocabulary) for _ in range(200)]
    for _ in range(25):
        chain = chain[6:] + [f"c{own + i}" for i in range(6)]
        own += 6
        add(chain)
    rows += [(5000 + i, t) for i, (_, t) in enumerate(rows[:40])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"route_keys": 0}, {"list_chunk": 7}, {"common": 3}, {"common_cells": 0}, {"split_level": 0}, {"split_level": 3, "common": 4}])
def test_brute_force(spark, options):
    rows = groups()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(tuple(r) for r in J.jaccard_components(docs, **options).collect())
    assert got == brute(rows)


def test_edges(spark):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [*EDGES, (50, "A  a\na a"), (51, "a a a a"), (52, long), (53, long + " end"), (54, "one two three four five"), (55, "one two three four five")]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"), ["key", "size", "id", "component_id", "n_shingles"])
    assert Counter(tuple(r) for r in J.jaccard_components(docs).collect()) == brute(rows)
    assert J.jaccard_components(docs.limit(0)).count() == 0


def test_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(tuple(r) for r in J.jaccard_components(docs).collect()) == brute(rows)


@pytest.mark.parametrize("drop_ids", [0, 1000])
def test_keep_one(spark, drop_ids):
    rows = [(7, "p q r s t u"), (3, "p q r s t u"), (4, ""), (4, ""), (5, None), (None, "p q r s t u"), (8, "other words stand here now")]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"), ["component_id", "_own_"])
    out = J.keep_one(docs, drop_ids=drop_ids)
    assert out.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 3), (False, 4), (False, 5), (False, 8), (True, 0)]


@pytest.mark.parametrize("drop_ids", [0, 1000])
def test_keep_one_of_repeated_ids(spark, drop_ids):
    """Rows of one id with different texts are lost only to a linked row."""
    first, other, third = "a b c d e f", "other words stand here now", "quite another text of some words"
    rows = [(1, first), (1, other), (0, first), (2, third), (2, None), (2, ""), (2, third), (3, other), (4, third + " x"), (4, "no copy of any other row"), (None, first)]
    out = J.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), drop_ids=drop_ids)
    own = [(None, first), (0, first), (1, other), (2, third), (2, None), (2, ""), (4, third + " x"), (4, "no copy of any other row")]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, own))


@pytest.mark.parametrize("small", [0, 1000])
def test_components(spark, small):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long"), small=small).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long"), small=small).count() == 0
