import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import DATA
from tests.llm.common import EDGES, low, with_clashes
from treeflow.llm import winnow as X

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(low(text or ""))


def brute(docs, items, span=10):
    windows = defaultdict(set)
    for own, text in items:
        w = words(text)
        k = min(span, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[i : i + k])].add("" if own is None else str(own))
    out = Counter()
    for own, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if x := windows.get(tuple(w[i : i + k])):
                    hit.update(range(i, i + k))
                    found |= x
        out[own, len(w), len(hit), tuple(sorted(found)), bool(hit)] += 1
    return out


def run(spark, docs, items, **options):
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    d = with_clashes(d, ["n_hit", "_hit", "_items", "item_id"])
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in X.hits(d, b, **options).collect())


def planted(seed):
    """Items, and documents with spans of 8 to 14 of an item's words, also at their ends."""
    r = random.Random(seed)
    v = [f"v{i}" for i in range(30)]  # few words, so that parts of windows meet by chance
    items = [(i, " ".join(r.choice(v) for _ in range(r.choice([1, 2, 5, 9, 10, 11, 40])))) for i in range(25)]
    items += [(3, items[5][1]), (None, items[6][1].upper()), (90, None), (91, " - "), (92, "")]
    docs = list(EDGES)
    for i in range(120):
        w = words(r.choice(items)[1])
        a = r.randrange(len(w)) if w else 0
        part = w[a : a + r.randint(8, 14)]
        docs.append((1000 + i, " ".join([*(r.choice(v) for _ in range(r.choice([0, 20]))), *part, *(r.choice(v) for _ in range(r.choice([0, 20])))])))
    docs.append((2000, " ".join(r.choice(v) for _ in range(30_000))))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block_bytes", [X.BLOCK_BYTES, 400])
def test_brute_force(spark, seed, block_bytes):
    docs, items = planted(seed)
    assert run(spark, docs, items, block_bytes=block_bytes) == brute(docs, items)


def test_empty_tables(spark):
    assert not run(spark, [], [(1, "a b")])
    assert run(spark, [(1, "a b")], []) == Counter({(1, 2, 0, (), False): 1})


def test_winnowing_keeps_one_fingerprint_in_every_window():
    h = np.random.default_rng(0).integers(0, 6, 500).astype(np.uint64)  # with ties
    at = X.winnow(h, 6)
    for i in range(len(h) - 5):
        inside = at[(at >= i) & (at < i + 6)]
        assert len(inside) and h[inside].min() == h[i : i + 6].min()
    again = X.winnow(h[100:140], 6) + 100
    assert set(again) <= set(at)


def test_drop_contaminated_passes_columns_through(spark):
    docs, items = planted(3)
    d = with_clashes(spark.createDataFrame(docs, "doc_id long, text string"), ["n_hit", "_0", "_items"])
    b = spark.createDataFrame(items, "item_id long, text string")
    out = X.drop_contaminated(d, b)
    assert out.columns == d.columns
    clean = Counter((r[0], bool(r[4])) for r in brute(docs, items).elements())
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: n for (k, bad), n in clean.items() if not bad})


def test_table(spark):
    d, b = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in X.hits(d, b).collect())
    assert got == brute([(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in b.collect()])
