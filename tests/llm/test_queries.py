import pytest

pytest.importorskip("treeflow.llm.queries")
from treeflow.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(name, same_as_sql):
    same_as_sql(QUERIES[name], ORACLE_SQL[name])


def test_all_ten_are_there():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 11))


def documents(spark):
    from tests.conftest import DATA

    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def ids_of(tokenizer, text, end):
    import numpy as np

    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@pytest.fixture(scope="module")
def tokenizers():
    from tokenizers import Tokenizer

    paths = pytest.importorskip("public_tokenizers")
    return {n: Tokenizer.from_file(paths.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}


def test_token_store_query(spark, tokenizers):
    import zlib

    from tests.conftest import DATA

    docs, at, own = documents(spark), 0, []
    for i in sorted(docs):
        ids = ids_of(tokenizers["word_bpe_49k.json"], docs[i].text, 2)
        own.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op2_token_store"](spark, DATA).collect()) == own


def test_packing_query(spark, tokenizers):
    import zlib
    from collections import defaultdict

    from tests.conftest import DATA

    docs, own, bins, total = documents(spark), [], defaultdict(list), 0
    for i in sorted(docs):
        ids = ids_of(tokenizers["byte_bpe_50k.json"], docs[i].text, 0)
        total += len(ids)
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        own += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    rows = QUERIES["op10_best_fit"](spark, DATA).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == own
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))] and sum(n for _, n in pieces) <= 2048
    assert len(bins) <= 1.05 * -(-total // 2048) + 1


def test_language_query(spark):
    import zlib

    from tests.conftest import DATA

    docs, right = documents(spark), []
    rows = QUERIES["op8_language_spans"](spark, DATA).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    langs = {d.lang for i, d in docs.items() if d.lang is not None and zlib.crc32(str(i).encode()) % 3 != 1}
    for r in rows:
        d = docs[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in d.text or "")) and r.lang_pred in langs | {"und"}
        if r.held_out and d.lang is not None and r.lang_pred != "und":
            right.append(r.lang_pred == d.lang)
    assert sum(right) / len(right) > 0.95
