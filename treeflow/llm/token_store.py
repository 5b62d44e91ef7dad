"""Raw token-id files with a minimal perfect hash index over the document keys.

Layout of a store (a folder on any file system pyarrow opens by URI):

* ids/00000.bin: the ids of the shard's records end to end, little-endian unsigned 16- or
  32-bit by vocabulary size; records ascend by key through all shards;
* ids/00000.off: places of the records in ids, n + 1 little-endian signed 64-bit integers;
* mph/00000.idx: an index bucket: hash levels, and for each slot a 32-bit fingerprint, the
  shard, the record in the shard and the number of records of that key;
* store.json: id width, records and ids of each shard, index buckets, null key.

A key's hash names its bucket.  In a bucket keys are hashed onto level bitmaps of twice the
number of keys left; a key whose bit no other key takes is settled there, the rest go on to
the next level.  Its slot is the number of set bits before its own, so n keys get slots
0..n-1 with some 4 bits a key, and a look-up is a few probes and one fingerprint comparison.

Shards are written by the tasks that hold them after one range shuffle of the texts by
(key, text hash), so even a key that holds a third of all rows spreads over shards.  A file
gets its name only when complete and depends on its rows alone: repeated tasks are harmless.

Keys are read back by bucket, so a task opens few index files, and then by contiguous ranges
of records, so a task reads its slice of a few shards from end to end, many records at once.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._spark import cut, ship, shuffle_partitions
from ._tokens import encoded, encoder

KEYS_PER_BUCKET = 1 << 18
MAX_LEVELS = 48
#: least keys of a task that looks keys up; bytes of one read, and those read over for nothing
LOOK_UP_KEYS, READ_BYTES, GAP_BYTES = 16_384, 4 << 20, 64 << 10


def _open(uri: str):
    return pafs.FileSystem.from_uri(uri)


def _write(uri: str, name: str, *chunks) -> None:
    """Writes a whole file under another name, then renames it."""
    fs, root = _open(uri)
    ctx = TaskContext.get()
    tmp = f"{root}/{name}.tmp-{ctx.taskAttemptId() if ctx else 'driver'}"
    fs.create_dir(f"{root}/{name}".rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(tmp) as out:
        for c in chunks:
            out.write(c)
    fs.move(tmp, f"{root}/{name}")


def _read(uri: str, name: str) -> bytes:
    fs, root = _open(uri)
    with fs.open_input_file(f"{root}/{name}") as f:
        return f.read()


# --- minimal perfect hash -------------------------------------------------------------


def _probe(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return T.mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(size)


def _finger(keys: np.ndarray) -> np.ndarray:
    return (T.mix(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Slots 0..n-1 for n different 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # of uint8 bitmaps, one byte for 8 places
        self.ranks, before = [], 0
        for bits in levels:
            ones = np.bitwise_count(bits).astype(np.int64)
            self.ranks.append(before + T.starts_of(ones)[:-1])
            before += int(ones.sum())
        self.n = before

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, levels = keys.astype(np.uint64), []
        while len(left):
            if len(levels) == MAX_LEVELS:
                raise ValueError("keys with equal hashes")
            size = -(-2 * len(left) // 8) * 8
            at = _probe(left, len(levels), size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """-1 where no level has the key's bit; other strange keys get some slot."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            if not len(left):
                break
            at = _probe(keys[left], level, 8 * len(bits)).astype(np.int64)
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            found = (bits[byte] >> bit) & 1 == 1
            below = np.bitwise_count(bits[byte] & ((1 << bit.astype(np.int64)) - 1).astype(np.uint8))
            out[left[found]] = (self.ranks[level][byte] + below)[found]
            left = left[~found]
        return out


def _bucket_bytes(keys, shard, record, n):
    mph = PerfectHash.build(keys)
    slot = mph.slots(keys)
    table = np.zeros(len(keys), [("finger", "<u4"), ("shard", "<u4"), ("record", "<i8"), ("n", "<i8")])
    table["finger"][slot], table["shard"][slot], table["record"][slot], table["n"][slot] = _finger(keys), shard, record, n
    head = np.array([len(mph.levels), len(keys), *(len(b) for b in mph.levels)], "<i8")
    return [head.tobytes(), *(b.tobytes() for b in mph.levels), table.tobytes()]


class Bucket:
    """One index bucket, opened."""

    def __init__(self, raw: bytes):
        n_levels, n = np.frombuffer(raw, "<i8", 2)
        sizes, at, levels = np.frombuffer(raw, "<i8", n_levels, 16), 16 + 8 * int(n_levels), []
        for size in sizes.tolist():
            levels.append(np.frombuffer(raw, np.uint8, size, at))
            at += size
        self.mph = PerfectHash(levels)
        self.table = np.frombuffer(raw, [("finger", "<u4"), ("shard", "<u4"), ("record", "<i8"), ("n", "<i8")], n, at)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there (by fingerprint), and its entry's slot."""
        slot = self.mph.slots(keys)
        if not len(self.table):
            return np.zeros(len(keys), bool), slot
        return (slot >= 0) & (self.table["finger"][np.maximum(slot, 0)] == _finger(keys)), slot


# --- writing --------------------------------------------------------------------------


INTEGERS = ("tinyint", "smallint", "int", "bigint")


def key_hash(col: str, kind: str) -> Column:
    """64-bit key hash; integers keep their value (a bijection), others are hashed."""
    c = F.col(col)
    return c.cast("long") if kind in INTEGERS else F.when(c.isNotNull(), F.xxhash64(c.cast("string")))


# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
_64 = (1 << 64) - 1


def _rotated(x: int, n: int) -> int:
    return (x << n | x >> (64 - n)) & _64


def bucket_of(key: int, n: int) -> int:
    """The bucket of a key hash, as _bucket() gives it in Spark: XXH64 of its eight bytes."""
    h = (42 + _P5 + 8) & _64
    h ^= _rotated((key & _64) * _P2 & _64, 31) * _P1 & _64
    h = (_rotated(h, 27) * _P1 + _P4) & _64
    for shift, prime in ((33, _P2), (29, _P3), (32, 1)):
        h = (h ^ h >> shift) * prime & _64
    return struct.unpack("<q", struct.pack("<Q", h))[0] % n


def _shards(uri, path, splitting, end_id, special, width):
    kind = np.dtype(f"<u{width}")

    def run(batches):
        T.release("tokens")
        enc, shard, lengths, keys = encoder(path, splitting, special), TaskContext.get().partitionId(), [], []
        fs, root = _open(uri)
        fs.create_dir(f"{root}/ids", recursive=True)
        tmp = f"{root}/ids/{shard:05d}.bin.tmp-{TaskContext.get().taskAttemptId()}"
        with fs.open_output_stream(tmp) as out:
            for batch in batches:
                for _, counts, ids in encoded(enc, T.column(batch, "text"), end_id):
                    if int(ids.max()) > np.iinfo(kind).max:
                        raise ValueError(f"an id needs more than {width} bytes")
                    lengths.append(counts)
                    out.write(ids.astype(kind).tobytes())
                keys.append(T.column(batch, "key"))
        lengths = np.concatenate([*lengths, np.zeros(0, np.int64)])
        off = T.starts_of(lengths)
        _write(uri, f"ids/{shard:05d}.off", off.astype("<i8").tobytes())
        fs.move(tmp, f"{root}/ids/{shard:05d}.bin")
        n, at = len(lengths), 0
        for k in keys:
            m = len(k)
            yield pa.RecordBatch.from_arrays([k, pa.array(np.full(m, shard, np.int32)), pa.array(np.arange(at, at + m)), pa.array(lengths[at : at + m])], ["key", "shard", "record", "n_tokens"])
            at += m
        if not n:
            yield pa.RecordBatch.from_arrays([pa.nulls(0, pa.int64()), pa.nulls(0, pa.int32()), pa.nulls(0, pa.int64()), pa.nulls(0, pa.int64())], ["key", "shard", "record", "n_tokens"])

    return run


def _index(uri):
    """Rows come sorted by bucket; one file for each."""

    def run(batches):
        held, bucket = [], None

        def done():
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            _write(uri, f"mph/{bucket:05d}.idx", *_bucket_bytes(T.mix(cols[0].view(np.uint64)), *cols[1:]))
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([len(cols[0])], pa.int64())], ["bucket", "n_keys"])

        for batch in batches:
            b = T.column(batch, "bucket").to_numpy()
            cols = [T.column(batch, c).to_numpy() for c in ("key", "shard", "record", "n")]
            cuts = [0, *(np.flatnonzero(b[1:] != b[:-1]) + 1).tolist(), len(b)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi > lo:
                    if held and b[lo] != bucket:
                        yield done()
                        held = []
                    bucket = int(b[lo])
                    held.append([c[lo:hi] for c in cols])
        if held:
            yield done()

    return run


def _bucket(n_buckets: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(n_buckets)).cast("int")


def write_store(docs: DataFrame, uri: str, tokenizer: str, id_col="doc_id", text_col="text", splitting="words", end_id=2, special=True, width=2, shards: int | None = None, keys_per_bucket=KEYS_PER_BUCKET) -> dict:
    """Writes the store and returns store.json's content.

    A null or empty text is a record of the end id alone.  Records of a null key come first;
    records of equal keys stand together in the order of their texts' hashes.  No rows give a
    store without shards.  `width`: bytes of an id; ids that need more raise an error.  Keys
    that are no integers are known by 64-bit hashes: two keys of one hash, a chance of 1 in
    2**64 for a pair, would each be given the records of both.
    """
    spark = ship(docs.sparkSession)
    if end_id >= 1 << 8 * width:
        raise ValueError("end_id needs a larger width")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), key_hash(id_col, kind).alias("key"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(shards or shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    made = cut(dealt.select("key", "text").mapInArrow(_shards(uri, tokenizer, splitting, end_id, special, width), "key long, shard int, record long, n_tokens long"))
    totals = {r["shard"]: r for r in made.groupBy("shard").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t")).collect()}
    n = max(totals, default=-1) + 1
    runs = made.groupBy("key").agg(F.min(F.struct("shard", "record")).alias("at"), F.count("*").alias("n")).select("key", "at.*", "n")
    null = runs.filter("key is null").collect()
    n_buckets = 1 + sum(r["n"] for r in totals.values()) // keys_per_bucket
    index = runs.filter("key is not null").withColumn("bucket", _bucket(n_buckets))
    built = index.repartition(min(n_buckets, 4 * shuffle_partitions(spark)), "bucket").sortWithinPartitions("bucket").mapInArrow(_index(uri), "bucket int, n_keys long").collect()
    store = {
        "width": width,
        "n_buckets": n_buckets,
        "buckets": sorted(r["bucket"] for r in built),  # those with keys; the others have no file
        "records": [totals[i]["n"] if i in totals else 0 for i in range(n)],
        "ids": [totals[i]["t"] if i in totals else 0 for i in range(n)],
        "null": [null[0]["shard"], null[0]["record"], null[0]["n"]] if null else None,
        "key": kind,
    }
    _write(uri, "store.json", json.dumps(store).encode())
    return store


# --- reading --------------------------------------------------------------------------


def _runs(store, shard, record, n, ranges: int = 1):
    """A run of records as (range, shard, first record, records) for each shard and range of
    records it covers; there are `ranges` equal ranges over all shards."""
    total = sum(store["records"])
    before = sum(store["records"][:shard]) + record
    while n > 0:
        at = before * ranges // total
        end = -(-(at + 1) * total // ranges)  # the first record of the next range
        k = min(n, store["records"][shard] - record, end - before)
        if k > 0:
            yield at, shard, record, k
        before, record, n = before + k, record + k, n - k
        if record == store["records"][shard]:
            shard, record = shard + 1, 0


def _bucket_file(uri: str, store: dict, bucket: int) -> Bucket:
    if bucket in set(store["buckets"]):
        return Bucket(_read(uri, f"mph/{bucket:05d}.idx"))
    return Bucket(np.zeros(2, "<i8").tobytes())


def _look_up(uri, store, ranges):
    """Rows sorted by bucket -> where their records are."""
    records = np.array(store["records"], np.int64)
    before, total = T.starts_of(records), int(records.sum())

    def run(batches):
        opened: tuple[int, Bucket | None] = (-1, None)
        for batch in batches:
            ids, keys, buckets = T.column(batch, "id"), T.column(batch, "key"), T.column(batch, "bucket").to_pylist()
            place = np.array(buckets, np.int64)
            row, runs, plain = [], [], []
            cuts = [0, *(np.flatnonzero(place[1:] != place[:-1]) + 1).tolist(), len(place)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi == lo:
                    continue
                if buckets[lo] == -1:
                    found, entries = range(lo, hi), [store["null"]] * (hi - lo)
                else:
                    if opened[0] != buckets[lo]:
                        opened = (buckets[lo], _bucket_file(uri, store, buckets[lo]))
                    there, slot = opened[1].find(T.mix(keys.slice(lo, hi - lo).to_numpy().view(np.uint64)))
                    found = lo + np.flatnonzero(there)
                    e = opened[1].table[slot[there]]
                    one = e["n"] == 1  # most keys have one record
                    shard, record = e["shard"][one].astype(np.int64), e["record"][one]
                    plain.append((found[one], (before[shard] + record) * ranges // max(total, 1), shard, record, np.ones(len(shard), np.int64)))
                    more = e[~one]
                    found, entries = found[~one].tolist(), zip(more["shard"].tolist(), more["record"].tolist(), more["n"].tolist(), strict=True)
                for i, entry in zip(found, entries, strict=True):
                    if entry:
                        for r in _runs(store, *entry, ranges):
                            row.append(i)
                            runs.append(r)
            plain.append([np.array(c, np.int64) for c in (row, *(list(zip(*runs, strict=True)) or [[]] * 4))])
            at, *cols = (np.concatenate(c) for c in zip(*plain, strict=True))
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), pa.array(cols[0].astype(np.int32)), pa.array(cols[1].astype(np.int32)), pa.array(cols[2]), pa.array(cols[3])], ["id", "range", "shard", "record", "n"])

    return run


def _payload(uri, store, with_ids):
    kind = np.dtype(f"<u{store['width']}")
    bases = T.starts_of(np.array(store["ids"], np.int64))

    def made(batch, row, out):
        cols = [pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [[]] * (3 + with_ids), [pa.int64()] * 3 + [pa.binary()] * with_ids, strict=True)]
        return pa.RecordBatch.from_arrays([T.column(batch, "id").take(pa.array(row, pa.int64())), *cols], ["id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    def run(batches):
        fs, root = _open(uri)
        for batch in batches:
            shard, record, n = (T.column(batch, c).to_numpy().astype(np.int64) for c in ("shard", "record", "n"))
            row, out = [], []
            # runs of one shard that follow each other closely share their reads
            apart = np.flatnonzero((shard[1:] != shard[:-1]) | (record[1:] - record[:-1] - n[:-1] > GAP_BYTES // 8)) + 1
            cuts = [0, *apart.tolist(), len(shard)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                s, first = int(shard[lo]), int(record[lo])
                with fs.open_input_file(f"{root}/ids/{s:05d}.off") as f:
                    off = np.frombuffer(f.read_at(8 * (int(record[hi - 1] + n[hi - 1]) - first + 1), 8 * first), "<i8")
                which = np.repeat(np.arange(lo, hi), n[lo:hi])
                at = T.ragged(record[lo:hi] - first, n[lo:hi])
                begin, end = off[at], off[at + 1]
                with fs.open_input_file(f"{root}/ids/{s:05d}.bin") as f:
                    i = 0
                    while i < len(at):
                        j = i + 1
                        while j < len(at) and (begin[j] - end[j - 1]) * kind.itemsize <= GAP_BYTES and (end[j] - begin[i]) * kind.itemsize <= READ_BYTES:
                            j += 1
                        a = int(begin[i])
                        raw = np.frombuffer(f.read_at((int(end[j - 1]) - a) * kind.itemsize, a * kind.itemsize), kind)
                        for k in range(i, j):
                            own = raw[begin[k] - a : end[k] - a].astype("<u4").tobytes()
                            row.append(which[k])
                            out.append((int(bases[s] + begin[k]), int(end[k] - begin[k]), zlib.crc32(own), *([own] if with_ids else [])))
                        i = j
                        if with_ids and len(row) > 4096:
                            yield made(batch, row, out)
                            row, out = [], []
            yield made(batch, row, out)

    return run


def read_keys(keys: DataFrame, uri: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """id_col, start, n_tokens, ids_crc32 (and ids, as little-endian unsigned 32-bit bytes) of
    every record of the keys; keys are taken once each, and unknown ones give no row."""
    spark = ship(keys.sparkSession)
    store = json.loads(_read(uri, "store.json"))
    kind = keys.schema[id_col].dataType.simpleString()
    n_parts = shuffle_partitions(spark)
    asked = keys.select(F.col(id_col).alias("id")).distinct().select("id", key_hash("id", kind).alias("key"))
    asked = asked.withColumn("bucket", F.when(F.col("key").isNull(), F.lit(-1)).otherwise(_bucket(store["n_buckets"])))
    # where there are fewer buckets than tasks, a large one is shared by some
    shares = max(1, min(-(-n_parts // store["n_buckets"]), sum(store["records"]) // store["n_buckets"] // LOOK_UP_KEYS))
    asked = asked.withColumn("share", F.pmod(F.hash("id"), F.lit(shares)))
    found = asked.repartition(n_parts, "bucket", "share").sortWithinPartitions("bucket").mapInArrow(_look_up(uri, store, n_parts), f"id {kind}, range int, shard int, record long, n long")
    by_range = found.repartitionById(n_parts, F.col("range")).sortWithinPartitions("shard", "record")
    out = by_range.mapInArrow(_payload(uri, store, int(with_ids)), f"id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
    return out.withColumnRenamed("id", id_col)


class TokenStore:
    """Keyed access from one process, without Spark."""

    def __init__(self, uri: str):
        self.uri, self.meta, self.buckets = uri, json.loads(_read(uri, "store.json")), {}

    def get(self, key: int | str | None) -> list[np.ndarray]:
        """The ids of every record of a key, an integer or a string as in the written table."""
        if key is None:
            entry = self.meta["null"]
        else:
            if self.meta["key"] not in INTEGERS:
                import xxhash

                key = struct.unpack("<q", struct.pack("<Q", xxhash.xxh64(str(key).encode(), seed=42).intdigest()))[0]
            b = bucket_of(key, self.meta["n_buckets"])
            if b not in self.buckets:
                self.buckets[b] = _bucket_file(self.uri, self.meta, b)
            there, slot = self.buckets[b].find(T.mix(np.array([key], np.int64).view(np.uint64)))
            entry = self.buckets[b].table[slot[0]].tolist()[1:] if there[0] else None
        out, fs = [], _open(self.uri)
        kind = np.dtype(f"<u{self.meta['width']}")
        for _, shard, record, n in _runs(self.meta, *entry) if entry else ():
            with fs[0].open_input_file(f"{fs[1]}/ids/{shard:05d}.off") as f:
                off = np.frombuffer(f.read_at(8 * (n + 1), 8 * record), "<i8")
            with fs[0].open_input_file(f"{fs[1]}/ids/{shard:05d}.bin") as f:
                for a, b in zip(off.tolist(), off[1:].tolist(), strict=False):
                    out.append(np.frombuffer(f.read_at((b - a) * kind.itemsize, a * kind.itemsize), kind).astype(np.uint32))
        return out
