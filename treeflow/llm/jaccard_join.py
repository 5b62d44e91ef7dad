"""Exact n-gram Jaccard join with set-relation skipping, up to connected components.

A document's set holds its distinct word n-grams as 59-bit hashes.  Equal sets form one
class, named by a 64-bit signature of the set; all later work is on classes.

1. Global order.  Tasks count their classes' n-grams by 40 bits of the hashes, and send those
   that TASK_COMMON or more of some thousand sets share.  N-grams of which COMMON sets or
   more are known are ordered by the logarithm of that count behind all others, so shared
   passages come last.  If there are more of them than COMMON_CELLS, the count from which they
   are told apart rises; the order changes what work is done, never the result.
2. Index.  A class lists its first |x| - ceil(t|x|) + 1 n-grams with its size and their
   positions.  Two sets with Jaccard >= t share a listed n-gram.
3. Index skipping.  A list is sorted by size, then position.  Its leader's block ends where
   sizes can no longer reach t, and 1 + min(rest of x, rest of z) below the needed overlap
   skips an entry at its position.  Entries get the parities of their set over 512 cells: two
   sets differ in at least as many elements as parities, which refutes most pairs of unlike
   sets before they leave their list.  Lists of two or three need it as well: their number,
   where texts share an n-gram by chance, grows with the square of the table.
4. Answers by relation.  Each class is first checked against one leader only, then against
   the class of each long list whose parities are nearest, which settles nearly all members
   of a group of copies.  Of lists whose classes already are in one component nothing more is asked.
   Between components the leaders r, s are compared, and
   members' answers follow from the leaders': with |x D r| = a, |z D s| = b known exactly,
   |r D s| - a - b <= |x D z| <= |r D s| + a + b.  Only pairs these bounds leave open are
   checked themselves.

No pair is lost: a candidate pair ends in one component, is refuted by a bound, or is checked
on the full sets.  A long list is cut into chunks and every pair of chunks is one group of
rows, but for pairs within the list's largest component, so no task holds an unbounded list.  The texts are read to describe them, to
list n-grams, and three times at most (less where no class is new) to store the sets of
classes in pairs that are left; stored sets travel once for each group that needs them.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from ._components import components
from ._spark import cut, give_back, new_folder, remove_folder, ship, shuffle_partitions, stored, with_places

N, NUMER, DENOM = 5, 4, 5  # words of a shingle; threshold 4/5
COMMON, COMMON_CELLS = 16, 8_000_000
ID_BITS = 40  # of 59
TASK_GRAMS, TASK_COMMON = 4_000_000, 3
ROUTE_KEYS = 2_000_000
LIST_CHUNK, SPLIT_LEVEL = 2000, 13
NEAREST_ROUNDS = 1
GROUP_MEMBERS = 100
SIGNATURE_WORDS = 8


def _needed(total, numer, denom):
    """Least overlap of two sets of together `total` elements at the threshold."""
    return -(-numer * total // (numer + denom))


def _sets(batch, text_col: str, n: int):
    """Row, and sorted distinct n-gram hashes (below 2**59), of every text with a word."""
    for lo, _, data, offsets in T.blocks(T.column(batch, text_col)):
        starts, ends, counts = T.words(data, offsets, T.NON_SPACE)
        h = T.Spans(data, fold=True).hash(starts, ends)
        first = T.starts_of(counts)
        g = T.grams(h, n) >> np.uint64(5)
        short = {k: T.grams(h, k) >> np.uint64(5) for k in range(1, n) if (counts == k).any()}
        for i, c in enumerate(counts.tolist()):
            a = int(first[i])
            if c >= n:
                s = np.sort(g[a : a + c - n + 1])
                new = np.empty(len(s), bool)
                new[0] = True
                np.not_equal(s[1:], s[:-1], out=new[1:])
                yield lo + i, s[new]
            elif c:  # all its words as one
                yield lo + i, (short[c][a : a + 1] ^ np.uint64(c))


def _signature(s: np.ndarray) -> int:
    total = T.mix(s).sum(dtype=np.uint64)
    return int(T.mix(np.array([total ^ np.uint64(len(s) * 0x9E3779B97F4A7C15 % (1 << 64))], np.uint64)).view(np.int64)[0])


def _describe(id_col, text_col, n):
    """(id, size, class, parities, cells) of every document; parities, and those over a fixed
    number of cells, only where the task first meets the class.  And (gram, n): 40-bit ids that
    several classes of the task have."""

    def run(batches):
        T.release()
        seen, held, rows = set(), [], 0
        for batch in batches:
            ids = T.column(batch, id_col)
            size, (key, parities, cells) = np.zeros(len(ids), np.int32), ([None] * len(ids) for _ in range(3))
            for i, s in _sets(batch, text_col, n):
                size[i], key[i] = len(s), _signature(s)
                if key[i] not in seen:
                    if len(seen) < 1_000_000:
                        seen.add(key[i])
                    cells[i], parities[i] = _parities(s), _parities(s, 128 << max(0, (2 * len(s) - 1).bit_length() - 7))
                    held.append(s >> np.uint64(59 - ID_BITS))
                    rows += len(s)
                    if rows > TASK_GRAMS:
                        yield _described(ids.type, *_often(held))
                        held, rows = [], 0
            none = pa.nulls(len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(size), pa.array(key, pa.int64()), pa.array(parities, pa.binary()), pa.array(cells, pa.binary()), none, none], _OWN)
        if held:
            yield _described(ids.type, *_often(held))

    return run


_OWN = ["id", "size", "key", "parities", "cells", "gram", "n"]


def _described(id_type, grams, n):
    none = lambda t: pa.nulls(len(grams), t)
    return pa.RecordBatch.from_arrays([none(id_type), none(pa.int32()), none(pa.int64()), none(pa.binary()), none(pa.binary()), pa.array(grams.view(np.int64)), pa.array(n)], _OWN)


def _often(held):
    """Ids that TASK_COMMON sets or more have, and how many."""
    ids = np.sort(np.concatenate(held))
    at = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    n = np.diff(np.append(at, len(ids)))
    often = n >= TASK_COMMON
    return ids[at[often]], n[often]


def _classes(batch, text_col, n, seen: set):
    """Class and set of the texts whose class the task has not met yet (as far as it can
    remember: a class that comes again costs work, not results)."""
    for _, s in _sets(batch, text_col, n):
        key = _signature(s)
        if key not in seen:
            if len(seen) < 1_000_000:
                seen.add(key)
            yield key, s


def _levels(found: DataFrame, least: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted ids of common n-grams, their levels (1 to 31), and a bitmap that most others miss;
    found: (gram, n) of the tasks."""
    counted = cut(found.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))
    total, bound = 0, None
    for r in counted.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        total += r["count"]
        if total > cells:
            break
        bound = r["n"]
    table = counted.filter(F.col("n") >= (bound or 1 << 62)).toArrow()
    ids, n = table.column("gram").to_numpy().astype(np.uint64), table.column("n").to_numpy()
    order = np.argsort(ids)
    bitmap = np.zeros(1 << 24, bool)
    bitmap[ids.astype(np.int64) & (len(bitmap) - 1)] = True
    return ids[order], np.clip(np.log2(np.maximum(n[order], 2)), 1, 31).astype(np.uint8), np.packbits(bitmap, bitorder="little")


def _ordered(s: np.ndarray, ids, levels, bitmap) -> np.ndarray:
    """The set as (level, hash) numbers, sorted."""
    if not len(ids):
        return s
    own = s >> np.uint64(59 - ID_BITS)
    low = (own & np.uint64(8 * len(bitmap) - 1)).astype(np.int64)
    maybe = np.flatnonzero((bitmap[low >> 3] >> (low & 7).astype(np.uint8)) & 1)
    if not len(maybe):
        return s
    at = np.minimum(np.searchsorted(ids, own[maybe]), len(ids) - 1)
    level = np.where(ids[at] == own[maybe], levels[at], 0).astype(np.uint64)
    out = s.copy()
    out[maybe] |= level << np.uint64(59)
    out.sort()
    return out


def _parities(s: np.ndarray, cells: int = 64 * SIGNATURE_WORDS) -> bytes:
    """Whether an odd number of elements falls in each cell; cells is a power of two."""
    return np.packbits((np.bincount((s % np.uint64(cells)).astype(np.int64), minlength=cells) & 1).astype(np.uint8)).tobytes()


def _list_entries(text_col, n, numer, denom, levels_of):
    """(gram, place, key) of the listed n-grams, once for each class of a task; place is the
    set's size times 2**32 plus the n-gram's position."""

    def made(held):
        size, listed = np.array([m for _, m, _ in held], np.int64), np.array([len(p) for _, _, p in held])
        place = (np.repeat(size, listed) << 32) + T.ragged(np.zeros(len(held), np.int64), listed)
        keys = np.repeat(np.array([k for k, _, _ in held], np.int64), listed)
        grams = np.concatenate([p for _, _, p in held])
        return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(place), pa.array(keys)], ["gram", "place", "key"])

    def run(batches):
        T.release()
        table, seen = levels_of.value, set()
        for batch in batches:
            held, rows = [], 0
            for key, s in _classes(batch, text_col, n, seen):
                m = len(s)
                listed = _ordered(s, *table)[: m - -(-numer * m // denom) + 1]
                held.append((key, m, listed))
                rows += len(listed)
                if rows > 200_000:
                    yield made(held)
                    held, rows = [], 0
            if held:
                yield made(held)

    return run


_ENTRY = ["gram", "key", "size", "pos"]


def _shared(numer, denom):
    """Rows sorted by gram, salt, place, key -> the entries of grams with two classes or more,
    and all of a list that is split by a salt, each with the leader whose block it falls in
    (null for a leader) and the entry before it.  Holds four leaders at most."""

    def run(batches):
        T.release()
        gram, leaders, first, last_key, alone = None, [], None, None, False
        for batch in batches:
            g, salt, place, key = (T.column(batch, c).to_numpy() for c in ("gram", "salt", "place", "key"))
            if not len(g):
                continue
            # rows that surely stand alone are dropped without a look
            near = np.zeros(len(g), bool)
            near[1:] = g[1:] == g[:-1]
            near[:-1] |= near[1:]
            near |= salt >= 0
            near[0] = near[-1] = True
            out = []
            for x in zip(zip(g[near].tolist(), salt[near].tolist(), strict=True), key[near].tolist(), (place[near] >> 32).tolist(), (place[near] & 0xFFFFFFFF).tolist(), strict=True):
                if x[0] != gram:
                    gram, first, last_key, alone = x[0], x, x[1], True
                    leaders = [x]
                    if x[0][1] >= 0:
                        out.append((*x, None, None))
                        alone = False
                    continue
                if x[1] == last_key:  # the class again, from another task
                    continue
                before, last_key = last_key, x[1]
                if alone:
                    out.append((*first, None, None))
                    alone = False
                while leaders and numer * x[2] > denom * leaders[0][2]:
                    leaders.pop(0)  # its block has ended
                own = next((y[1] for y in leaders if min(y[2] - y[3], x[2] - x[3]) >= _needed(y[2] + x[2], numer, denom)), None)
                if own is None and len(leaders) < 4:
                    leaders.append(x)
                out.append((*x, own, before if own is not None and before != own else None))
            if out:
                lists, *cols = zip(*out, strict=True)
                cols = [*zip(*lists, strict=True), *cols]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["gram", "salt", *_ENTRY[1:], "leader", "before"])

    return run


def _led(listed: DataFrame, numer, denom, split_level: int, folder: str) -> DataFrame:
    """The entries that _shared() leaves of (gram, place, key), stored in the folder.

    The lists of n-grams that more than 2**split_level sets have are split by class; the
    leaders of such a list's pieces then meet as one list of their own."""
    schema = "gram long, salt int, key long, size int, pos int, leader long, before long"
    level = F.shiftrightunsigned("gram", 59).cast("int")
    pieces = F.when(level > split_level, F.expr(f"shiftleft(1, cast(shiftrightunsigned(gram, 59) as int) - {split_level})"))
    listed = listed.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("key"), pieces).cast("int"), F.lit(-1)))

    def run(rows, *by):
        dealt = rows.repartition(shuffle_partitions(rows.sparkSession), *by).sortWithinPartitions("gram", "salt", "place", "key")
        return dealt.select("gram", "salt", "place", "key").mapInArrow(_shared(numer, denom), schema)

    first = stored(run(listed, "gram", "salt"), f"{folder}/first")
    tops = (F.col("salt") >= 0) & F.col("leader").isNull()
    again = first.filter(tops).select("gram", F.lit(-1).alias("salt"), (F.shiftleft(F.col("size").cast("long"), 32) + F.col("pos")).alias("place"), "key")
    if again.isEmpty():
        return first.drop("salt")
    return first.filter(~tops).unionByName(stored(run(again, "gram"), f"{folder}/tops")).drop("salt")


# --- comparing full sets ----------------------------------------------------------------


_SEND_BYTES = 8 << 20


def _keep(text_col, n, keys_of):
    """(key, members) of the task's classes among the given ones, or of all of them."""

    def made(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64(), pa.binary()], strict=True)], ["key", "members"])

    def run(batches):
        T.release()
        keys, seen, out, size = keys_of.value if keys_of else None, set(), [], 0
        for batch in batches:
            for key, s in _classes(batch, text_col, n, seen):
                if keys is not None:
                    at = int(np.searchsorted(keys, key))
                    if at == len(keys) or keys[at] != key:
                        continue
                out.append((key, s.tobytes()))
                size += len(out[-1][1])
                if size > _SEND_BYTES:
                    yield made(out)
                    out, size = [], 0
        if out:
            yield made(out)

    return run


def _stored_sets(texts: DataFrame, wanted: DataFrame, text_col: str, n: int, route_keys: int, folder: str) -> DataFrame:
    """(key, members): the sets of the wanted classes (key, distinct), written once, to the folder.
    A class of several tasks may stand there more than once."""
    spark = texts.sparkSession
    give_back(spark)
    if wanted.count() <= route_keys:
        keys = spark.sparkContext.broadcast(np.sort(wanted.toArrow().column("key").to_numpy()))
        sets = texts.mapInArrow(_keep(text_col, n, keys), "key long, members binary")
    else:
        sets = texts.mapInArrow(_keep(text_col, n, None), "key long, members binary").join(wanted, "key", "left_semi")
    return stored(sets, folder)


def _send(route_of):
    """(a, part, role, key, members) for the groups a class is needed in."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]

    def run(batches):
        T.release()
        keys, first, groups, parts, roles = route_of.value
        out, size, seen = [], 0, set()

        def made():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["a", "part", "role", "key", "members"])

        for batch in batches:
            own, members = T.column(batch, "key").to_numpy(zero_copy_only=False), T.column(batch, "members")
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            for i in np.flatnonzero(keys[at] == own).tolist():
                key, raw = int(own[i]), members[i].as_py()
                if key in seen:
                    continue
                seen.add(key)
                for j in range(first[at[i]], first[at[i] + 1]):
                    out.append((int(groups[j]), int(parts[j]), int(roles[j]), key, raw))
                    size += len(raw)
                    if size > _SEND_BYTES:
                        yield made()
                        out, size = [], 0
        if out:
            yield made()

    return run


def _compare(batches):
    """Rows sorted by a, part, role, key: a group's leader, then its members -> overlaps."""
    T.release()
    group, lead, last = None, None, None
    for batch in batches:
        a, part, role, key = (T.column(batch, c).to_pylist() for c in ("a", "part", "role", "key"))
        raw = T.column(batch, "members")
        out = []
        for i in range(len(a)):
            if (a[i], part[i]) != group:
                group, lead, last = (a[i], part[i]), None, None
            if role[i] == 0:
                if lead is None:
                    lead = np.frombuffer(raw[i].as_py(), np.uint64)
            elif key[i] != last:
                last = key[i]
                s = np.frombuffer(raw[i].as_py(), np.uint64)
                at = np.minimum(np.searchsorted(lead, s), len(lead) - 1)
                out.append((a[i], key[i], len(lead), len(s), int((lead[at] == s).sum())))
        if out:
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "size_a", "size_b", "overlap"])


def _overlaps(sets: DataFrame, pairs: DataFrame, route_keys: int) -> DataFrame:
    """(a, b, size_a, size_b, overlap) of the class pairs (a, b), from the full sets.

    Groups of one a hold at most about GROUP_MEMBERS members; a larger one has several parts."""
    spark = sets.sparkSession
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP_MEMBERS).cast("int").alias("parts"))
    route = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), F.col("b").alias("key"))
    route = route.unionByName(route.select("a", "part", F.lit(0).alias("role"), F.col("a").alias("key")).distinct())
    route = cut(route)
    n_routes = route.count()
    if not n_routes:
        return spark.createDataFrame([], "a long, b long, size_a long, size_b long, overlap long")
    give_back(spark)
    if n_routes <= route_keys:
        rows = [route.select("key", "a", "part", "role").toArrow()]
        cols = [rows[0].column(i).to_numpy() for i in range(4)]
        order = np.argsort(cols[0], kind="stable")
        keys, first = np.unique(cols[0][order], return_index=True)
        shared = spark.sparkContext.broadcast((keys, np.append(first, len(order)), cols[1][order], cols[2][order], cols[3][order]))
        sent = sets.mapInArrow(_send(shared), "a long, part int, role int, key long, members binary")
    else:
        sent = sets.join(route, "key").select("a", "part", "role", "key", "members")
    sent = sent.repartition(shuffle_partitions(spark), "a", "part").sortWithinPartitions("a", "part", "role", "key")
    return cut(sent.mapInArrow(_compare, "a long, b long, size_a long, size_b long, overlap long"))


# --- pairs between components -----------------------------------------------------------


def _cross(numer, denom, nearest: bool):
    """Rows sorted by gram, c1, c2, size, pos: pairs (a, b) of classes in different components
    that the filters leave; entries come with the parities of their sets.
    nearest: of these, and for each only the pair with the fewest differing ones, so that a
    list gives no more pairs than it has entries."""

    def pairs(c):
        """Entries i and j = i + d of one group, for all groups at once and d = 1, 2, ..."""
        gram, c1, c2, key, size, pos, comp, chunk, signed, parities = c
        group = np.cumsum(np.append(False, (gram[1:] != gram[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])))
        i, d = np.arange(len(gram)), 0
        if nearest:
            i = i[signed]
            best, other = np.full(len(gram), np.iinfo(np.int64).max), np.full(len(gram), -1)
        while True:
            d += 1
            i = i[i + d < len(gram)]
            i = i[(group[i + d] == group[i]) & (numer * size[i + d] <= denom * size[i])]  # else i's block has ended
            if not len(i):
                break
            j = i + d
            ok = (comp[i] != comp[j]) & (np.minimum(size[i] - pos[i], size[j] - pos[j]) >= -(-numer * (size[i] + size[j]) // (numer + denom)))
            # a pair within one chunk belongs to that chunk's own group
            ok &= (c1[i] == c2[i]) | (chunk[i] != chunk[j])
            i_, j_ = i[ok], j[ok]
            both = np.flatnonzero(signed[i_] & signed[j_])
            if len(both):
                a, b = i_[both], j_[both]
                differ = np.bitwise_count(parities[a] ^ parities[b]).sum(1, dtype=np.int64)
                fits = np.ones(len(i_), bool)
                fits[both] = differ <= (size[a] + size[b]) * (denom - numer) // (numer + denom)
                if nearest:
                    differ, a, b = differ[fits[both]], a[fits[both]], b[fits[both]]
                    for x, y in ((a, b), (b, a)):  # at one distance d an entry stands once on either side
                        closer = differ < best[x]
                        best[x[closer]], other[x[closer]] = differ[closer], y[closer]
                i_, j_ = i_[fits], j_[fits]
            if len(i_) and not nearest:
                yield np.minimum(key[i_], key[j_]), np.maximum(key[i_], key[j_])
        if nearest:
            i_ = np.flatnonzero(other >= 0)
            yield np.minimum(key[i_], key[other[i_]]), np.maximum(key[i_], key[other[i_]])

    def emit(held):
        found = list(pairs([np.concatenate(c) for c in zip(*held, strict=True)]))
        if found:
            cols = [np.concatenate(c) for c in zip(*found, strict=True)]
            order = np.lexsort((cols[1], cols[0]))
            a, b = cols[0][order], cols[1][order]
            once = order[:0] if not len(a) else order[np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))]
            yield pa.RecordBatch.from_arrays([pa.array(c[once]) for c in cols], ["a", "b"])

    def run(batches):
        held = []  # whole groups and the last, maybe unfinished one
        for batch in batches:
            c = [T.column(batch, x).to_numpy().astype(np.int64) for x in ("gram", "c1", "c2", "key", "size", "pos", "comp", "chunk")]
            if not len(c[0]):
                continue
            raw = T.column(batch, "cells")
            signed = raw.is_valid().to_numpy(zero_copy_only=False)
            words = np.zeros((len(signed), SIGNATURE_WORDS), np.uint64)
            if signed.any():
                words[signed] = np.frombuffer(b"".join(raw.drop_null().to_pylist()), np.uint64).reshape(-1, SIGNATURE_WORDS)
            c += [signed, words]
            new = np.flatnonzero((c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1]) | (c[2][1:] != c[2][:-1])) + 1
            starts_new = held and any(held[-1][k][-1] != c[k][0] for k in range(3))
            cut_at = int(new[-1]) if len(new) else 0
            if cut_at or starts_new:
                yield from emit([*held, [x[:cut_at] for x in c]])
                held = [[x[cut_at:] for x in c]]
            else:
                held.append(c)
        if held:
            yield from emit(held)

    return run


def _between(entries: DataFrame, labels: DataFrame, cells: DataFrame, numer, denom, chunk: int, long_list: int, nearest: bool = False) -> DataFrame:
    """Candidate pairs of entries in different components, distinct; cells: (key, cells).

    nearest: only from lists of at least `long_list` entries."""
    give_back(entries.sparkSession)
    e = entries.join(labels.select("key", "comp"), "key", "left").select(*_ENTRY, F.coalesce("comp", "key").alias("comp"))
    # of a list's largest component each chunk only meets the entries of other components
    mixed = e.groupBy("gram", "comp").agg(F.count("*").alias("n")).groupBy("gram").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("comps")).filter("comps > 1")
    if nearest:
        mixed = mixed.filter(F.col("n") >= long_list)
    mixed = mixed.select("gram", F.col("top.comp").alias("most"), F.ceil(F.col("top.n") / chunk).cast("int").alias("tops"), F.ceil((F.col("n") - F.col("top.n")) / chunk).cast("int").alias("rest"))
    e = e.join(mixed, "gram").withColumn("is_top", F.col("comp") == F.col("most"))
    e = e.withColumn("chunk", F.when(F.col("is_top"), F.pmod(F.xxhash64("key"), F.col("tops"))).otherwise(F.col("tops") + F.pmod(F.xxhash64("key"), F.col("rest"))).cast("int"))
    e = e.join(cells, "key", "left")
    e = e.withColumn("other", F.explode(F.sequence(F.when(F.col("is_top"), F.col("tops")).otherwise(F.lit(0)), F.col("tops") + F.col("rest") - 1)))
    e = e.withColumn("c1", F.least("chunk", "other")).withColumn("c2", F.greatest("chunk", "other"))
    e = e.repartition(shuffle_partitions(entries.sparkSession), "gram", "c1", "c2").sortWithinPartitions("gram", "c1", "c2", "size", "pos")
    return e.mapInArrow(_cross(numer, denom, nearest), "a long, b long").distinct()


def _fold(raw: bytes, size: int) -> np.ndarray:
    """Parities over the first `size` bytes' cells; cells are halved by adding the halves."""
    bits = np.frombuffer(raw, np.uint8)
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _refute(numer, denom):
    """(a, b, size_a, size_b, differ) of the pairs that parities do not refute."""

    def run(batches):
        for batch in batches:
            a, b = (T.column(batch, c) for c in ("pa", "pb"))
            sizes = [T.column(batch, c).to_numpy().astype(np.int64) for c in ("size_a", "size_b")]
            most = (sizes[0] + sizes[1]) * (denom - numer) // (numer + denom)
            differ = np.zeros(len(a), np.int64)
            for i, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist(), strict=True)):
                n = min(len(x), len(y))
                differ[i] = np.bitwise_count(_fold(x, n) ^ _fold(y, n)).sum(dtype=np.int64)
            keep = pa.array(differ <= most)
            yield pa.RecordBatch.from_arrays([T.column(batch, c).filter(keep) for c in ("a", "b", "size_a", "size_b")] + [pa.array(differ).filter(keep)], ["a", "b", "size_a", "size_b", "differ"])

    return run


def _links(checked: DataFrame, numer, denom) -> DataFrame:
    return checked.filter(F.col("overlap") * (numer + denom) >= numer * (F.col("size_a") + F.col("size_b"))).select(F.col("a").alias("u"), F.col("b").alias("v"))


def jaccard_components(
    docs: DataFrame, id_col="doc_id", text_col="text", n: int = N, numer: int = NUMER, denom: int = DENOM, common: int = COMMON, common_cells: int = COMMON_CELLS, route_keys: int = ROUTE_KEYS, list_chunk: int = LIST_CHUNK, split_level: int = SPLIT_LEVEL
) -> DataFrame:
    """id_col, n_shingles, component_id: the smallest id reachable over links, its own included.

    Words are runs without [\\x20\\x09-\\x0D], A-Z lower-cased.  Two documents link when
    denom * |intersection| >= numer * |union|.  A text of fewer than n words, but one, has
    them all as its only n-gram; null and wordless texts have no n-grams and no links.
    Rows with equal ids are separate documents; null ids never name a component unless all
    its ids are null.  Other columns are ignored; no rows give no rows.

    Hashes: n-grams in one set collide with a chance of size**2 / 2**60, different sets
    share a signature with a chance of 1 in 2**64 for a pair.
    """
    spark = ship(docs.sparkSession)
    give_back(spark)
    docs = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(text_col)
    found = cut(docs.mapInArrow(_describe(id_col, text_col, n), f"id {kind}, size int, key long, parities binary, cells binary, gram long, n long"))
    own = found.filter("gram is null").select("id", "size", "key", "parities")
    levels = spark.sparkContext.broadcast(_levels(found.filter("gram is not null").select("gram", "n"), common, common_cells))

    give_back(spark)
    listed = texts.mapInArrow(_list_entries(text_col, n, numer, denom, levels), "gram long, place long, key long")
    lists_at, sets_at = new_folder(spark, "lists"), new_folder(spark, "sets")
    entries = _led(listed, numer, denom, split_level, lists_at)

    described = own.filter("parities is not null").groupBy("key").agg(F.first("size").cast("long").alias("size"), F.first("parities").alias("p"))
    cells = found.filter("cells is not null").groupBy("key").agg(F.first("cells").alias("cells"))

    def refuted(pairs):
        """pairs (a, b) that parities leave, with sizes and differing parities"""
        for x in "ab":
            pairs = pairs.join(described.select(F.col("key").alias(x), F.col("size").alias(f"size_{x}"), F.col("p").alias(f"p{x}")), x)
        return cut(pairs.mapInArrow(_refute(numer, denom), "a long, b long, size_a long, size_b long, differ long"))

    # a class and, of the leaders and neighbours it met, the one that its parities are nearest to
    met = entries.filter("leader is not null").select(F.col("key").alias("b"), F.explode(F.array("leader", "before")).alias("a")).filter("a is not null").distinct()
    first = refuted(met).groupBy("b").agg(F.min(F.struct("differ", "a")).alias("m")).select("m.a", "b")
    kept = []  # keys, sets

    def compared(pairs, of=None):
        """overlaps of the class pairs (a, b); of: pairs whose classes' sets are stored first,
        where not yet.  Most classes are in no pair that parities leave."""
        if of is not None:
            wanted = of.select(F.col("a").alias("key")).unionByName(of.select(F.col("b").alias("key"))).distinct()
            for keys, _ in kept:
                wanted = wanted.join(keys, "key", "left_anti")
            wanted = cut(wanted)
            if not wanted.isEmpty():
                kept.append((wanted, _stored_sets(texts, wanted, text_col, n, route_keys, f"{sets_at}/{len(kept)}")))
        none = spark.createDataFrame([], "key long, members binary")
        return _overlaps(reduce(DataFrame.unionByName, [sets for _, sets in kept], none), pairs, route_keys)

    first = cut(first)
    near = compared(first, first)

    def joined(edges, comps, checked):
        """edges and components with the links among checked pairs; and whether there were any"""
        new = cut(_links(checked, numer, denom))
        if new.isEmpty():
            return edges, comps, False
        edges = edges.unionByName(new)
        return edges, cut(components(edges).select(F.col("node").alias("key"), F.col("component").alias("comp"))), True

    edges, comps, _ = joined(spark.createDataFrame([], "u long, v long"), spark.createDataFrame([], "key long, comp long"), near)

    # of common n-grams' lists each class is checked against its nearest in another component
    lists = entries.select(*_ENTRY)
    for _ in range(NEAREST_ROUNDS):
        close = refuted(_between(lists, comps, cells, numer, denom, list_chunk, common, True))
        close = close.select("a", "b", "differ", F.col("a").alias("of")).unionByName(close.select("a", "b", "differ", F.col("b").alias("of")))
        close = close.groupBy("of").agg(F.min(F.struct("differ", "a", "b")).alias("m")).select("m.a", "m.b").distinct()
        edges, comps, some = joined(edges, comps, compared(close, close))
        if not some:
            break
    # the distance to the leader serves where the leader is no member of another one
    linked = near.join(_links(near, numer, denom).select(F.col("u").alias("a"), F.col("v").alias("b")), ["a", "b"], "left_semi")
    tops = linked.select("a").distinct().join(linked.select(F.col("b").alias("a")), "a", "left_anti")
    roots = linked.join(tops, "a").select(F.col("b").alias("key"), F.col("a").alias("root"), (F.col("size_a") + F.col("size_b") - 2 * F.col("overlap")).alias("far"))
    labels = cut(comps.join(roots, "key", "left").select("key", "comp", F.coalesce("root", "key").alias("root"), F.coalesce("far", F.lit(0)).alias("far")))

    pairs = refuted(_between(lists, labels, cells, numer, denom, list_chunk, common))
    remove_folder(spark, lists_at)

    # of these, each class is checked against the one that its parities are nearest to
    ends = pairs.select("a", "b", "differ", F.col("a").alias("of"), F.col("b").alias("to")).unionByName(pairs.select("a", "b", "differ", F.col("b").alias("of"), F.col("a").alias("to")))
    nearest = ends.groupBy("of").agg(F.min(F.struct("differ", "to", "a", "b")).alias("m")).select("m.a", "m.b").distinct()
    beside = compared(nearest, pairs)
    edges, comps, _ = joined(edges, comps, beside)

    def apart_in(comps, pairs):
        """pairs in different components"""
        for x in "ab":
            pairs = pairs.join(comps.select(F.col("key").alias(x), F.col("comp").alias(f"c_{x}")), x, "left")
        return pairs.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).drop("c_a", "c_b")

    pairs = apart_in(comps, pairs).join(beside.select("a", "b"), ["a", "b"], "left_anti")

    # and of those still between components the leaders
    at = lambda end: labels.select(F.col("key").alias(end), F.col("root").alias(f"root_{end}"), F.col("far").alias(f"far_{end}"))
    pairs = pairs.join(at("a"), "a", "left").join(at("b"), "b", "left")
    pairs = pairs.select("a", "b", *(F.coalesce(f"root_{x}", x).alias(f"root_{x}") for x in "ab"), (F.coalesce("far_a", F.lit(0)) + F.coalesce("far_b", F.lit(0))).alias("far"), (F.col("size_a") + F.col("size_b")).alias("total"))
    pairs = pairs.select("a", "b", F.least("root_a", "root_b").alias("ra"), F.greatest("root_a", "root_b").alias("rb"), "far", F.floor(F.col("total") * (denom - numer) / (numer + denom)).alias("most"))
    apart = compared(pairs.select(F.col("ra").alias("a"), F.col("rb").alias("b")).filter("a <> b").distinct())
    edges, comps, _ = joined(edges, comps, apart)

    # what the leaders' distance says of the pairs that are still in different components
    known = apart.select(F.least("a", "b").alias("ra"), F.greatest("a", "b").alias("rb"), (F.col("size_a") + F.col("size_b") - 2 * F.col("overlap")).alias("between"))
    open_ = apart_in(comps, pairs).join(known, ["ra", "rb"], "left")
    themselves = (F.col("ra") == F.least("a", "b")) & (F.col("rb") == F.greatest("a", "b"))
    sure = F.coalesce(F.col("between") + F.col("far") <= F.col("most"), F.lit(False))
    refuted = F.coalesce((F.col("between") - F.col("far") > F.col("most")) | (themselves & F.col("between").isNotNull()), F.lit(False))
    open_ = cut(open_.withColumn("sure", sure).filter(F.col("sure") | ~refuted).select("a", "b", "sure").distinct())
    last = compared(open_.filter("not sure").select("a", "b"))
    remove_folder(spark, sets_at)
    sure = open_.filter("sure").select("a", "b", F.lit(1).cast("long").alias("size_a"), F.lit(1).cast("long").alias("size_b"), F.lit(1).cast("long").alias("overlap"))
    edges, comps, _ = joined(edges, comps, last.unionByName(sure))

    placed = own.filter("key is not null").join(comps, "key", "left").select("id", "size", F.coalesce("comp", "key").alias("c"))
    placed = cut(placed)
    # stored, so that both sides of the join are dealt anew and a large component can be split
    least = cut(placed.groupBy("c").agg(F.min("id").alias("component_id")))
    alone = own.filter("key is null").select("id", "size", F.col("id").alias("component_id"))
    out = placed.join(least, "c").select("id", "size", "component_id").unionByName(alone)
    return out.select(F.col("id").alias(id_col), F.col("size").cast("long").alias("n_shingles"), "component_id")


DROP_IDS = 500_000


def keep_one(docs: DataFrame, id_col="doc_id", text_col="text", drop_ids: int = DROP_IDS, **options) -> DataFrame:
    """The rows of docs, all columns, that stand for their component: those of its smallest id.

    Rows with a null id cannot be told apart and all stay.  Rows are known by their id and a
    64-bit hash of their text: of rows with equal ids and texts one stays if it stands for its
    component, and rows with equal ids and other texts are judged each by its own text; of
    those in one component that with the smallest hash may stand for it.  Up to `drop_ids`
    rows to drop (counted first) go to the texts; beyond, the join is shuffled.
    """
    work, own = with_places(docs), f"_{docs.columns.index(id_col)}"
    text = F.col(f"_{docs.columns.index(text_col)}").cast("string")
    keyed = work.withColumn("_key", F.when(F.col(own).isNotNull(), F.struct(F.col(own).alias("id"), F.xxhash64(text).alias("text"))))
    found = jaccard_components(keyed.select("_key", text.alias("_text")), "_key", "_text", **options)
    found = cut(found.select(F.col("_key").alias("_own"), "component_id").filter("_own is not null"))
    gone = cut(found.filter("_own <> component_id").select("_own").distinct())
    if gone.count() <= drop_ids:
        gone = F.broadcast(gone)
    out = keyed.join(gone, keyed["_key"] == gone["_own"], "left_anti")
    if found.groupBy("_own").count().filter("count > 1").limit(1).count():
        # rows of equal ids and texts: one of each
        out = out.filter("_key is null").unionByName(out.filter("_key is not null").dropDuplicates(["_key"]))
    return out.select(*work.columns).toDF(*docs.columns)
