"""Best-fit packing of token sequences.

Documents become runs of ids closed by an end id; only runs over the capacity are cut, into
full pieces, the remainder first.  Each task packs its pieces online: a fixed number of bins
stays open, found through a bitset with one bit for each amount of free space.  A piece goes
where the least space remains; if it fits nowhere a bin is opened, and the fullest open bin
closes once there are too many.

Bins still open at the end of a task are the only waste that grows with the number of
tasks, so they are packed again as units, those of `merge_tasks` tasks together, by the same
method.  Only these bins' rows are shuffled, never texts or ids.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._spark import cut, ship
from ._tokens import encoded, encoder

CAPACITY, OPEN_BINS, MERGE_TASKS = 2048, 256, 32


class BestFit:
    """Bounded-space online best-fit."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits, self.n_open, self.n_made = 0, 0, 0

    def place(self, size: int) -> tuple[int, int]:
        """The bin and the place in it of an item of `size`, 1 to capacity."""
        if fits := self.bits >> size:
            room = size + (fits & -fits).bit_length() - 1
            bin_ = self._take(room)
        else:
            bin_, room = self.n_made, self.capacity
            self.n_made += 1
        if room > size:
            self.free[room - size].append(bin_)
            self.bits |= 1 << (room - size)
            self.n_open += 1
            if self.n_open > self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return bin_, self.capacity - room

    def _take(self, room: int) -> int:
        bin_ = self.free[room].pop()
        if not self.free[room]:
            self.bits ^= 1 << room
        self.n_open -= 1
        return bin_

    def open(self) -> list[tuple[int, int]]:
        """(bin, space used) of the bins that have room."""
        return [(b, self.capacity - room) for room, bins in enumerate(self.free) for b in bins]


_FIELDS = "piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _pack(id_col, text_col, path, splitting, end_id, capacity, open_bins, special):
    def run(batches):
        T.release("tokens")
        enc, bins = encoder(path, splitting, special), BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = T.column(batch, id_col)
            for first, counts, tokens in encoded(enc, T.column(batch, text_col), end_id):
                raw, before = memoryview(tokens.astype("<u4").tobytes()), 0
                row, out = [], []
                for i, n in enumerate(counts.tolist()):
                    at, size, piece = 0, n % capacity or capacity, 0
                    while at < n:
                        bin_, place = bins.place(size)
                        a = 4 * (before + at)
                        out.append((piece, at, size, zlib.crc32(raw[a : a + 4 * size]), base + bin_, place))
                        row.append(first + i)
                        at, piece, size = at + size, piece + 1, capacity
                    before += n
                cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), *[pa.int64()] * 5), strict=True)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), *cols, pa.nulls(len(row), pa.int64())], [id_col, *(f.split()[0] for f in _FIELDS.split(", ")), "used"])
        if still := bins.open():
            n = len(still)
            empty = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, batch.schema.field(id_col).type), pa.nulls(n, pa.int32()), empty, empty, empty, pa.array([base + b for b, _ in still]), empty, pa.array([u for _, u in still])],
                [id_col, *(f.split()[0] for f in _FIELDS.split(", ")), "used"],
            )

    return run


def _merge(capacity, open_bins):
    def run(batches):
        bins, host = BestFit(capacity, open_bins), {}
        for batch in batches:
            own, used = T.column(batch, "sequence_id").to_pylist(), T.column(batch, "used").to_pylist()
            to, shift = [], []
            for s, u in zip(own, used, strict=True):
                b, place = bins.place(u)
                to.append(host.setdefault(b, s))
                shift.append(place)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(to, pa.int64()), pa.array(shift, pa.int64())], ["sequence_id", "to", "shift"])

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    splitting: str = "byte_level",
    end_id: int = 0,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    merge_tasks: int = MERGE_TASKS,
    special: bool = True,
) -> DataFrame:
    """id_col, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    A null or empty text is a run of the end id alone.  Rows with equal or null ids are
    separate documents.  Sequences have no gaps and hold at most `capacity` ids.  No rows
    give no rows; other columns are ignored.  `special`: whether the tokenizer's special
    strings in a text become their ids.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    kind = docs.schema[id_col].dataType.simpleString()
    packed = cut(docs.mapInArrow(_pack(id_col, text_col, tokenizer, splitting, end_id, capacity, open_bins, special), f"`{id_col}` {kind}, {_FIELDS}, used long"))
    pieces = packed.filter("used is null").drop("used")
    still = packed.filter("used is not null").select("sequence_id", "used")
    group = F.shiftright("sequence_id", 40)
    groups = 1 + packed.rdd.getNumPartitions() // merge_tasks
    moved = cut(still.repartition(groups, F.floor(group / merge_tasks)).sortWithinPartitions("sequence_id").mapInArrow(_merge(capacity, open_bins * merge_tasks), "sequence_id long, to long, shift long"))
    return (
        pieces.join(moved, "sequence_id", "left")
        .withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0)))
        .withColumn("sequence_id", F.coalesce("to", "sequence_id"))
        .select(id_col, *(f.split()[0] for f in _FIELDS.split(", ")))
    )
