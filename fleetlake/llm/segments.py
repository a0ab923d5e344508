"""Encoding whole texts segment by segment, each distinct segment once while a Python worker remembers it.

The byte-level pattern of both vocabularies lets a token reach over white space only to take one space as the
first byte of the word behind it, never reaches from a letter to a punctuation mark behind it, and looks ahead
only from white space. So a text may be cut, without changing its ids,

* before white space with something else in front of it;
* before the last of several white spaces, and behind one that is no space, if a word follows;
* before ``.,:;!?`` behind a Latin letter.

White space is here the space, tab, line feed and carriage return; next to control characters and any other
character that some notion calls white space no cut is made, nor behind white space before ``<``, where a special
token may begin (one that holds neither white space nor those marks is never cut).

Segments are found and looked up by the batch, on the column's bytes: by a 64-bit hash, then compared byte by byte.
A worker remembers at most ``CACHE_WORDS`` of them and ``CACHE_BYTES`` of their bytes and ids, then keeps those met
again since; that changes no result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from fleetlake.llm.common import byte_hashes, ranges, utf8

CACHE_WORDS = 600_000
CACHE_BYTES = 24_000_000
_OTHER, _WHITE, _SOLID = 0, 1, 2
_KIND = np.full(256, _SOLID, np.uint8)
_KIND[:32] = _KIND[127] = _OTHER
_KIND[[0x20, 9, 10, 13]] = _WHITE
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,:;!?")] = True
# leads of characters of white space, and the ranges of the bytes behind them
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
_SPACES = [(0xC285, 0xC285), (0xC2A0, 0xC2A0), (0xE19A80, 0xE19A80), (0xE1A08E, 0xE1A08E), (0xE28080, 0xE2808F), (0xE280A8, 0xE280AF),
           (0xE2819F, 0xE281AF), (0xE38080, 0xE38080), (0xEFBBBF, 0xEFBBBF)]


def _kinds(raw: np.ndarray) -> np.ndarray:
    kind = _KIND[raw]
    lead = np.flatnonzero(_LEADS[raw])
    if len(lead):
        wide = np.append(raw, [0, 0]).astype(np.int32)
        two = wide[lead] << 8 | wide[lead + 1]
        code = np.where(wide[lead] == 0xC2, two, two << 8 | wide[lead + 2])
        for lo, hi in _SPACES:
            at = lead[(code >= lo) & (code <= hi)]
            for k in range(2 if hi < 0x10000 else 3):
                kind[at + k] = _OTHER
    return kind


def segments(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """First bytes of the segments of texts that lie one behind the other in ``raw``, text i from off[i] to off[i + 1]."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64)
    kind = np.full(n + 2, _OTHER, np.uint8)  # one place ahead
    kind[1:-1] = _kinds(raw)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    white, solid = kind == _WHITE, kind == _SOLID
    here, inner, last = white[1:-1], ~edge[:-1], edge[1:]
    after_white, after_solid = white[:-2] & inner, solid[:-2] & inner
    word = solid[2:] & ~last
    word[:-1] &= raw[1:] != 0x3C
    start = edge[:-1] | here & (after_solid | after_white & word)
    start[1:] |= (here & word & (raw != 0x20) & (after_white | after_solid | ~inner))[:-1]
    letter = _LETTER[raw]
    letter[1:] |= (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    start[1:] |= _MARK[raw[1:]] & letter[:-1]
    return np.flatnonzero(start)


class _Grown:
    """An array that grows at its end."""

    def __init__(self, dtype, values=()):
        self.a, self.n = np.array(values, dtype), len(values)

    def add(self, x: np.ndarray) -> None:
        if self.n + len(x) > len(self.a):
            a = np.empty((self.n + len(x)) * 5 // 4 + 1024, self.a.dtype)
            a[:self.n] = self.a[:self.n]
            self.a = a
        self.a[self.n:self.n + len(x)] = x
        self.n += len(x)

    def get(self) -> np.ndarray:
        return self.a[:self.n]


class WordCache:
    """``encode(segments) -> ids of each as 4-byte integers`` behind a bounded cache of segments."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode = encode
        self._clear()

    def _clear(self) -> None:
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes in order, and the entry of each
        self.data, self.ids = _Grown(np.uint8), _Grown(np.int32)
        self.data_end, self.ids_end = _Grown(np.int32, [0]), _Grown(np.int32, [0])  # entry i ends at [i + 1]
        self.again = _Grown(bool)

    def _shrink(self) -> None:
        """Keeps the entries that were met again; all go if those are still too many."""
        again, keys, place = self.again.get(), self.keys, self.place
        kept = np.flatnonzero(again)
        data, ids = ((x.get(), e.get()) for x, e in ((self.data, self.data_end), (self.ids, self.ids_end)))
        self._clear()
        sizes = [np.diff(e)[kept] for _, e in (data, ids)]
        if len(kept) * 2 > CACHE_WORDS or (sizes[0].sum() + 4 * sizes[1].sum()) * 2 > CACHE_BYTES:
            return
        for (values, ends), size, to, end in zip((data, ids), sizes, (self.data, self.ids), (self.data_end, self.ids_end)):
            to.add(values[ranges(ends[kept], size)])
            end.add(np.cumsum(size))
        self.again.add(np.zeros(len(kept), bool))
        renamed = np.full(len(again), -1, np.int32)
        renamed[kept] = np.arange(len(kept))
        renamed = renamed[place]
        self.keys, self.place = keys[renamed >= 0], renamed[renamed >= 0]

    def _entries(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of each segment's hash; what isn't known yet is encoded."""
        keys, which = np.unique(byte_hashes(raw, start, end), return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        entry = np.empty(len(keys), np.int32)
        entry[known] = self.place[at[known]]
        self.again.a[entry[known]] = True
        new = np.flatnonzero(~known)
        if len(new):
            first = np.empty(len(keys), np.int64)
            first[which] = np.arange(len(which))
            first = first[new]
            data = [raw[a:b].tobytes() for a, b in zip(start[first].tolist(), end[first].tolist())]
            ids = self.encode([x.decode() for x in data])
            entry[new] = np.arange(self.again.n, self.again.n + len(new))
            for values, dtype, size, to, ends in ((data, np.uint8, 1, self.data, self.data_end), (ids, np.int32, 4, self.ids, self.ids_end)):
                ends.add(to.n + np.cumsum([len(x) // size for x in values]))
                to.add(np.frombuffer(b"".join(values), dtype))
            self.again.add(np.zeros(len(new), bool))
            self.keys, self.place = np.insert(self.keys, at[new], keys[new]), np.insert(self.place, at[new], entry[new])
        return entry[which]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts of a string column; a null has none."""
        raw, off = utf8(column)
        start = segments(raw, off)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        end = np.append(start[1:], len(raw))
        entry = self._entries(raw, start, end)
        known, known_end = self.data_end.get()[entry], self.data_end.get()[entry + 1]
        # segments cover the texts, so this compares every byte
        if (known_end - known == end - start).all() and (self.data.get()[ranges(known, end - start)] == raw).all():
            first = self.ids_end.get()[entry]
            size = self.ids_end.get()[entry + 1] - first
            ids = self.ids.get()[ranges(first, size)]
        else:  # two segments of one hash
            own = self.encode([raw[a:b].tobytes().decode() for a, b in zip(start.tolist(), end.tolist())])
            size, ids = np.array([len(x) // 4 for x in own]), np.frombuffer(b"".join(own), np.int32)
        ends = np.append(0, np.cumsum(size))
        if self.again.n > CACHE_WORDS or self.data.n + 4 * self.ids.n > CACHE_BYTES:
            self._shrink()
        return ids, ends[np.searchsorted(start, off)]
