import os
import random
from collections import Counter

import pytest

from tests.llm.test_jaccard import brute, groups
from tests.test_disk import left, shuffled
from treeflow.llm import jaccard_join as J


@pytest.mark.parametrize("options", [{}, {"route_keys": 0}, {"split_level": 0}])
def test_join_gives_back_its_disk(spark, options):
    """Before its result is read, the join has removed its lists and sets, and what it shuffled
    but for counts and other single rows."""
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    kept = lambda: {x for x in os.listdir(folder) if x.startswith(("lists-", "sets-"))}
    rows = groups()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folders, files = kept(), shuffled(spark)
    out = J.jaccard_components(docs, **options)
    assert kept() == folders
    assert len(left(spark, files)) < 40
    assert Counter(map(tuple, out.collect())) == brute(rows)


def test_unlike_sets_are_not_stored_or_paired(spark, monkeypatch):
    """Texts that share one passage by twos meet in short lists; their parities refute them."""
    r = random.Random(3)
    rows = []
    for i in range(120):
        passage = [f"p{i}-{k}" for k in range(40)]
        rows += [(2 * i + j, " ".join([f"w{r.randrange(10**6)}" for _ in range(200)] + passage)) for j in (0, 1)]
    rows += [(1000 + i, t + " end") for i, (_, t) in enumerate(rows[:4])]
    made, stored = [], []
    between, sets = J._between, J._stored_sets
    monkeypatch.setattr(J, "_between", lambda *a: made.append(between(*a)) or made[-1])
    monkeypatch.setattr(J, "_stored_sets", lambda *a: stored.append(sets(*a)) or stored[-1])
    counts = []
    monkeypatch.setattr(J, "remove_folder", lambda *a: counts.append((sum(x.count() for x in made), sum(x.count() for x in stored))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, J.jaccard_components(docs).collect())) == brute(rows)
    assert all(pairs <= 4 and kept <= 16 for pairs, kept in counts) and len(counts) == 2
