import hashlib
import random
from collections import Counter

import pytest

from tests.llm.common import EDGES, SPACES, low, with_clashes
from treeflow.llm import line_dedup as X


def key(line):
    return low(line.strip(SPACES))


def brute(rows, min_docs, min_chars):
    n = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = Counter()
    for own, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and n[key(x)] >= min_docs)]
        out[own, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def rows():
    r = random.Random(4)
    lines = [f"Line {i} é" for i in range(40)] + ["", " ", "x", "é", "\tLINE 3 É \r"]
    out = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(0, 9)))) for i in range(200)]
    return [*out, *EDGES, *((700, "everywhere") for _ in range(3)), (800, "line 1 é\n" * 20_000), (801, "y" * 2_000_000)]


@pytest.mark.parametrize("broadcast_keys", [X.BROADCAST_KEYS, 0])
@pytest.mark.parametrize(("min_docs", "min_chars"), [(3, 1), (2, 0), (10, 2), (10_000, 1)])
def test_brute_force(spark, broadcast_keys, min_docs, min_chars):
    data = rows()
    docs = with_clashes(spark.createDataFrame(data, "doc_id long, text string").repartition(4), ["key", "n_lines", "_keys", "text_hash"])
    out = X.dedup_lines(docs, min_docs=min_docs, min_chars=min_chars, broadcast_keys=broadcast_keys).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out) == brute(data, min_docs, min_chars)


def test_digest_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a\nb"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.kept_sha256 for r in X.dedup_lines(docs, output="kept_sha256").collect()}
    assert got == {1: hashlib.sha256(b"a\nb").hexdigest(), 2: hashlib.sha256(b"").hexdigest()}
    assert X.dedup_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("broadcast_keys", [X.BROADCAST_KEYS, 0])
def test_drop_shared_lines_keeps_columns(spark, broadcast_keys):
    data = rows()
    docs = with_clashes(spark.createDataFrame(data, "doc_id long, text string"), ["n_lines", "_1", "kept_text"])
    out = X.drop_shared_lines(docs, min_docs=3, broadcast_keys=broadcast_keys)
    assert out.columns == docs.columns
    own = Counter((r[0], r[3]) for r in brute(data, 3, 1).elements())
    null = Counter(i for i, t in data if t is None)
    got = out.collect()
    assert Counter(r.doc_id for r in got if r.text is None) == null
    assert Counter((r.doc_id, r.text or "") for r in got) == own and {r["_1"] for r in got} == {"extra"}
