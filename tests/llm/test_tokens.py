"""Encoder, token store and packing."""

import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from tests.conftest import DATA  # noqa: E402
from tests.llm.common import EDGES, with_clashes  # noqa: E402
from treeflow.llm import _tokens, packing, token_store  # noqa: E402

FILES = {"words": "word_bpe_49k.json", "byte_level": "byte_bpe_50k.json"}
ODD = ["  a  b ", "a\n\nb", " lead", "trail\n", "it's we'll 'tis don't", "<|endoftext|> x<|endoftext|>y", "a<|b", "x,y;z! (q) [r]", "12a 3.5 $%", "  x", "é ́x é", "\x1c\x1d", "A\tB\rC"]
ROWS = [*EDGES, *((100 + i, t) for i, t in enumerate(ODD)), (500, "x " * 9000), (501, "end"), (501, "other"), *((600, f"k {i}") for i in range(300))]


TOKENIZERS = {kind: Tokenizer.from_file(P.path(name)) for kind, name in FILES.items()}


def ids_of(kind, text, end):
    tk = TOKENIZERS[kind]
    return np.array([*tk.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@pytest.mark.parametrize("kind", FILES)
@pytest.mark.parametrize("parts", [_tokens.CACHE_PARTS, 3])
def test_encoder_is_the_whole_text_encoder(kind, parts, monkeypatch, spark):
    monkeypatch.setattr(_tokens, "CACHE_PARTS", parts)
    enc = _tokens.Encoder(P.path(FILES[kind]), kind)
    texts = [t for _, t in ROWS] + [r[0] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").collect()]
    for chunk in (texts, texts[::-1]):
        ids, n = enc.encode(pa.array(chunk, pa.string()))
        at = np.concatenate([[0], np.cumsum(n)])
        for i, t in enumerate(chunk):
            assert ids[at[i] : at[i + 1]].tolist() == ids_of(kind, t, 0)[:-1].tolist(), t


def test_special_strings_as_text():
    enc = _tokens.Encoder(P.path(FILES["byte_level"]), "byte_level", special=False)
    ids, _ = enc.encode(pa.array(["<|endoftext|>"]))
    assert 50256 not in ids.tolist()


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)


def test_minimal_perfect_hash():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64))
    mph = token_store.PerfectHash.build(keys)
    assert mph.n == len(keys) and sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
    bucket = token_store.Bucket(b"".join(token_store._bucket_bytes(keys, np.zeros(len(keys)), np.arange(len(keys)), np.ones(len(keys)))))
    there, slot = bucket.find(keys)
    assert there.all() and (bucket.table["record"][slot] == np.arange(len(keys))).all()
    strange, _ = bucket.find(rng.integers(0, 1 << 63, 5000).astype(np.uint64))
    assert strange.sum() <= 1


@pytest.mark.parametrize("keys_per_bucket", [7, 1 << 20])
def test_store_round_trip(spark, keys_per_bucket):
    uri = "file://" + tempfile.mkdtemp()
    docs = with_clashes(frame(spark), ["shard", "key", "n_tokens"])
    token_store.write_store(docs, uri, P.path(FILES["words"]), keys_per_bucket=keys_per_bucket)
    rows = token_store.read_keys(docs, uri, with_ids=True).collect()
    own = Counter((i, ids_of("words", t, 2).tobytes()) for i, t in ROWS)
    assert Counter((r.doc_id, bytes(r.ids)) for r in rows) == own
    at, last = 0, -1
    for r in sorted(rows, key=lambda r: r.start):
        assert (r.start, r.ids_crc32, 4 * r.n_tokens) == (at, zlib.crc32(r.ids), len(r.ids))
        assert (key := -1 if r.doc_id is None else r.doc_id) >= last
        at, last = at + r.n_tokens, key
    unknown = spark.range(10_000, 10_050).withColumnRenamed("id", "doc_id")
    assert token_store.read_keys(unknown, uri).count() == 0
    store = token_store.TokenStore(uri)
    assert [len(store.get(k)) for k in (600, 501, 2, None, 77)] == [300, 2, 2, 2, 0]
    assert store.get(500)[0].tolist() == ids_of("words", "x " * 9000, 2).tolist()


def test_buckets_are_those_of_spark(spark):
    rows = spark.range(-50, 1000).select(F.col("id").alias("key")).union(spark.createDataFrame([(9_000_000_000_000,), (-(1 << 63),), ((1 << 63) - 1,)], "key long"))
    for n in (1, 7, 50, 4096):
        assert all(token_store.bucket_of(r.key, n) == r.b for r in rows.select("key", token_store._bucket(n).alias("b")).collect())


def test_keys_that_are_strings(spark):
    uri = "file://" + tempfile.mkdtemp()
    docs = frame(spark).select(F.concat(F.lit("k-"), F.col("doc_id").cast("string")).alias("doc_id"), "text")
    token_store.write_store(docs, uri, P.path(FILES["words"]), keys_per_bucket=5)
    rows = token_store.read_keys(docs, uri, with_ids=True).collect()
    named = lambda i: None if i is None else f"k-{i}"
    assert Counter((r.doc_id, bytes(r.ids)) for r in rows) == Counter((named(i), ids_of("words", t, 2).tobytes()) for i, t in ROWS)
    store = token_store.TokenStore(uri)
    assert [len(store.get(k)) for k in ("k-600", "k-501", None, "k-77")] == [300, 2, 2, 0]


def test_a_task_opens_few_files(spark, monkeypatch):
    """Of 50 index buckets and 8 shards each of 8 tasks reads its own share."""
    uri = "file://" + tempfile.mkdtemp()
    docs = spark.range(0, 4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text of "), "id").alias("text"))
    store = token_store.write_store(docs, uri, P.path(FILES["words"]), shards=8, keys_per_bucket=80)
    assert store["n_buckets"] > 50 and len(store["records"]) == 8
    opened: list[str] = []
    own_read, own_open = token_store._read, token_store._open

    class Files:
        def __init__(self, fs):
            self.fs = fs

        def open_input_file(self, path):
            opened.append(path[-13:])
            return self.fs.open_input_file(path)

    monkeypatch.setattr(token_store, "_open", lambda u: (Files(own_open(u)[0]), own_open(u)[1]))
    monkeypatch.setattr(token_store, "_read", lambda u, name: (opened.append(name), own_read(u, name))[1])
    asked = docs.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("key")).withColumn("bucket", token_store._bucket(store["n_buckets"]))
    asked = asked.repartition(8, "bucket").sortWithinPartitions("bucket").toArrow().to_batches()  # a batch for each task
    parts, most = [], 0
    for batch in asked:
        opened.clear()
        parts += list(token_store._look_up(uri, store, 8)([batch]))
        most = max(most, len(opened))
    assert most <= 20  # a fair share is 7 of 51
    table = pa.Table.from_batches(parts).sort_by([("range", "ascending"), ("shard", "ascending"), ("record", "ascending")])
    n = 0
    for k in range(8):
        own = table.filter(pa.compute.equal(table["range"], k)).combine_chunks().to_batches()
        opened.clear()
        n += sum(len(b) for b in token_store._payload(uri, store, 0)(own))
        first = np.cumsum([0, *store["records"]])
        mine = [s for s in range(8) if first[s] < (k + 1) * 500 and first[s + 1] > k * 500]
        assert sorted(opened) == sorted(f"ids/{s:05d}.{kind}" for s in mine for kind in ("bin", "off"))
    assert n == 4000


def test_look_ups_need_no_spark(tmp_path, spark):
    import subprocess
    import sys

    uri = f"file://{tmp_path}/store"
    token_store.write_store(frame(spark), uri, P.path(FILES["words"]), keys_per_bucket=7)
    code = f"from treeflow.llm.token_store import TokenStore; s = TokenStore({uri!r}); print(len(s.get(600)), s.get(500)[0].size, len(s.get(77)))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert out == ["300", str(len(ids_of("words", "x " * 9000, 2))), "0"]


def test_store_of_no_rows(spark):
    uri = "file://" + tempfile.mkdtemp()
    none = frame(spark).limit(0)
    token_store.write_store(none, uri, P.path(FILES["words"]))
    assert token_store.read_keys(none, uri).count() == 0


def test_store_refuses_narrow_ids(spark):
    with pytest.raises(Exception, match="bytes"):
        token_store.write_store(frame(spark), "file://" + tempfile.mkdtemp(), P.path(FILES["words"]), width=1)


def test_best_fit_takes_the_fullest_bin_and_closes_it_first():
    b = packing.BestFit(10, 2)
    assert [b.place(n) for n in (6, 5, 4)] == [(0, 0), (1, 0), (0, 6)]  # bin 0 fits 4 exactly
    assert b.place(8) == (2, 0) and b.place(9) == (3, 0)  # a third open bin closes the fullest, bin 3
    assert b.place(1) == (2, 8)


@pytest.mark.parametrize("capacity", [8, 2048])
def test_packing(spark, capacity):
    docs = with_clashes(frame(spark), ["piece", "offset", "used"])
    rows = packing.pack(docs, P.path(FILES["byte_level"]), capacity=capacity, open_bins=4, merge_tasks=2).collect()
    own, total = Counter(), 0
    for i, t in ROWS:
        ids = ids_of("byte_level", t, 0)
        at, size, piece = 0, len(ids) % capacity or capacity, 0
        total += len(ids)
        while at < len(ids):
            own[i, piece, at, size, zlib.crc32(ids[at : at + size].tobytes())] += 1
            at, size, piece = at + size, capacity, piece + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == own
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= 1.25 * -(-total // capacity) + 3
    assert packing.pack(docs.limit(0), P.path(FILES["byte_level"])).count() == 0
