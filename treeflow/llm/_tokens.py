"""Token ids of whole texts by the tokenizers library, with a cache by part.

A tokenizer that splits its input before merging gives each part the same ids wherever the
part stands, so parts are encoded once and looked up afterwards.  Which cuts are safe
depends on the tokenizer and is named by `splitting`:

* "words": white space is dropped, so every run of ASCII white space is a safe cut;
* "byte_level": a word takes one space before it; a text is cut before each single space and
  around each single line break.  Texts with other white space are encoded whole;
* "none": every text is encoded whole.

Both kinds of tokenizers also split between a letter and a mark behind it, so that "end" and
"end," share a part.  Texts that hold one of the tokenizer's added tokens are encoded whole.

Parts are known by 64-bit hashes.  The cache is a sorted array of hashes with places in a
pool of ids, some 40 bytes a part, and starts anew when full.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from . import _text as T

CACHE_PARTS = 1_000_000
GROUP = 2 << 20
_WIDE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
#: white space that "byte_level" cuts cannot handle
_ODD = np.zeros(256, bool)
_ODD[[9, 11, 12, 13]] = True


class Encoder:
    """Encodes UTF-8 texts to unsigned 32-bit ids."""

    def __init__(self, path: str, splitting: str, special: bool = True):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        if not special:
            self.tokenizer.encode_special_tokens = True
        if splitting not in ("words", "byte_level", "none"):
            raise ValueError(f"unknown splitting: {splitting}")
        self.splitting = splitting
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)

    def whole(self, texts: list[bytes]) -> list[np.ndarray]:
        made = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in made]

    def _parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts end to end, and the number of each part's."""
        ids, sizes = [], np.zeros(len(parts), np.int64)
        for i in range(0, len(parts), 5000):
            made = self.tokenizer.encode_batch([parts[i : i + 5000]], is_pretokenized=True, add_special_tokens=False)[0]
            ids.append(np.array(made.ids, np.uint32))
            word = made.word_ids
            sizes[i : i + 5000] = np.bincount(np.array(word, np.int64), minlength=len(parts[i : i + 5000])) if word else 0
        return np.concatenate([*ids, np.zeros(0, np.uint32)]), sizes

    def _odd(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Whether each text must be encoded whole."""
        n = len(offsets) - 1
        odd = np.zeros(n, bool)
        raw = data.tobytes()
        if any(a in raw for a in self.added):
            for i in range(n):
                odd[i] = any(a in raw[offsets[i] : offsets[i + 1]] for a in self.added)
        if self.splitting == "byte_level" and len(data):
            space = (data == 32) | (data == 10)
            bad = _ODD[data]
            twice = space[1:] & space[:-1]
            bad[1:] |= twice
            full = np.flatnonzero(offsets[1:] > offsets[:-1])
            edges = np.concatenate([offsets[:-1][full], offsets[1:][full] - 1])
            bad[edges] |= space[edges]
            # two white spaces that meet across texts are seen at the texts' ends anyway
            odd |= np.diff(T.starts_of(bad.astype(np.int64))[offsets]) > 0
            if any(w in raw for w in _WIDE):
                for m in _WIDE_SPACE.finditer(raw):
                    odd[np.searchsorted(offsets, m.start(), "right") - 1] = True
        return odd

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every part."""
        begin = np.zeros(len(data), bool)
        begin[1:] = _MARK[data[1:]] & _LETTER[data[:-1]]
        begin[offsets[:-1][offsets[:-1] < len(data)]] = True
        if self.splitting == "byte_level":
            line = data == 10
            begin |= (data == 32) | line
            begin[1:] |= line[:-1]
            start = np.flatnonzero(begin)
            return start, np.append(start[1:], len(data))
        white = T.SPACE[data]
        begin[1:] |= white[:-1]
        begin &= ~white
        start = np.flatnonzero(begin)
        stop = np.ones(len(data) + 1, bool)
        stop[:-1] = begin | white
        ends = np.flatnonzero(stop)
        return start, ends[np.searchsorted(ends, start, "right")]

    def _learn(self, keys: np.ndarray, parts: list[str]) -> None:
        """Adds parts by their sorted new keys."""
        if len(self.keys) + len(keys) > CACHE_PARTS:
            self._clear()
        ids, sizes = self._parts(parts)
        where = np.searchsorted(self.keys, keys)
        self.at = np.insert(self.at, where, len(self.pool) + T.starts_of(sizes)[:-1])
        self.size = np.insert(self.size, where, sizes.astype(np.int32))
        self.keys = np.insert(self.keys, where, keys)
        self.pool = np.concatenate([self.pool, ids])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of each text's; a null has none."""
        if self.splitting == "none":
            made = self.whole([t.encode() for t in texts.fill_null("").to_pylist()])
            return np.concatenate([*made, np.zeros(0, np.uint32)]), np.array([len(m) for m in made], np.int64)
        keys, counts, odd, whole, blocks = [], [], [], [], []
        for _, _, data, offsets in T.blocks(texts):
            bad = self._odd(data, offsets)
            whole += [data[offsets[i] : offsets[i + 1]].tobytes() for i in np.flatnonzero(bad)]
            start, end = self._cuts(data, offsets)
            if bad.any():
                text = np.searchsorted(offsets, start, "right") - 1
                good = ~bad[text]
                start, end = start[good], end[good]
            odd.append(bad)
            keys.append(T.Spans(data, fold=False).hash(start, end))
            counts.append(np.diff(np.searchsorted(start, offsets)))
            blocks.append((data, start, end))
        if not keys:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        key, count, odd = np.concatenate(keys), np.concatenate(counts), np.concatenate(odd)
        order = np.argsort(key)
        ranked = key[order]
        new = np.ones(len(key), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        some = ranked[new]  # distinct, sorted
        for _ in range(2):  # again if the cache was emptied
            where = np.searchsorted(self.keys, some)
            have = np.zeros(len(some), bool)
            inside = where < len(self.keys)
            have[inside] = self.keys[where[inside]] == some[inside]
            if have.all():
                break
            place = order[new][~have]
            first = T.starts_of(np.array([len(k) for k in keys], np.int64))
            block = np.searchsorted(first, place, "right") - 1
            parts = [blocks[b][0][blocks[b][1][i] : blocks[b][2][i]].tobytes().decode() for b, i in zip(block.tolist(), (place - first[block]).tolist(), strict=True)]
            if len(self.keys) + len(parts) > CACHE_PARTS and len(self.keys):
                self._clear()
                continue
            self._learn(some[~have], parts)
        where = np.searchsorted(self.keys, some)
        of = np.empty(len(key), np.int64)
        of[order] = where[np.cumsum(new) - 1]
        sizes = self.size[of].astype(np.int64)
        ids = self.pool[T.ragged(self.at[of], sizes)]
        n = np.diff(T.starts_of(sizes)[T.starts_of(count)])
        if odd.any():
            ids, n = _splice(ids, n, np.flatnonzero(odd), self.whole(whole))
        return ids, n


def _splice(ids, n, rows, made):
    """Puts the ids of the texts encoded whole in their places."""
    first, out, last = T.starts_of(n), [], 0
    n = n.copy()
    for r, m in zip(rows.tolist(), made, strict=True):
        out += [ids[last : first[r]], m]
        last, n[r] = first[r], len(m)
    return np.concatenate([*out, ids[last:]]), n


_made: dict[tuple, Encoder] = {}


def encoder(path: str, splitting: str, special: bool = True) -> Encoder:
    """The encoder of this worker; kept from task to task."""
    key = (path, splitting, special)
    if key not in _made:
        T.release()
        _made.clear()
        _made[key] = Encoder(*key)
        T.hold("tokens", _made.clear)
    return _made[key]


def encoded(enc: Encoder, texts: pa.Array, end_id: int):
    """(first row, number of ids of each text, ids of all) in groups of some MiB; every text
    is closed by end_id."""
    for lo, hi, _, _ in T.blocks(texts, GROUP):
        ids, n = enc.encode(texts.slice(lo, hi - lo))
        last = np.cumsum(n)
        yield lo, n + 1, np.insert(ids, last, np.uint32(end_id))
