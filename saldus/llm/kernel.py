"""Vectorised text primitives: words, lines and 64-bit hashes of byte ranges, over Arrow string columns.

A whole block of texts is handled as one byte buffer, so no Python code runs per word.
Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, which in UTF-8 equals `[^\\x20\\x09-\\x0D]+`
over code points. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64
#: Text bytes handled at once; a longer text is handled alone, whole.
BLOCK_BYTES = 1 << 20


def mixed(z: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the output."""
    return _mix(z.astype(U, copy=True))


def _mix(z: np.ndarray) -> np.ndarray:
    """mixed, in place."""
    part = z >> U(30)
    z ^= part
    z *= U(0xBF58476D1CE4E5B9)
    np.right_shift(z, U(27), out=part)
    z ^= part
    z *= U(0x94D049BB133111EB)
    np.right_shift(z, U(31), out=part)
    z ^= part
    return z


BASE = 0x9E3779B97F4A7C15 | 1
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Byte ranges longer than this are hashed one by one; shorter ones side by side, eight bytes at a time.
LONG = 256
#: The low bytes of a word of eight.
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], U)
#: A key of 128 bits; fixed, so that results are repeatable.
_KEY = np.frombuffer(b"saldus: words' k", U)
#: Fixed values of SipHash: where its state starts, with the key and the mark of 128 bits in it.
_SIP = np.array([0x736F6D6570736575, 0x646F72616E646F6D, 0x6C7967656E657261, 0x7465646279746573], U) ^ np.tile(_KEY, 2) ^ np.array([0, 0xEE, 0, 0], U)
_SEEDS = mixed(np.arange(LONG + 2, dtype=U) * U(BASE))


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets into the bytes) of runs of rows of about `most` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    if not (wide or pa.types.is_string(column.type)):
        column, wide = column.cast(pa.large_string()), True
    n = len(column)
    if not n:
        return
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind, count=column.offset + n + 1)[column.offset :].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


class Text:
    """Words and lines of one block of texts."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.raw, self.offsets, self.n = raw, offsets, len(offsets) - 1
        self.data = LOWER[raw] if lower else raw
        size = len(raw)
        self.word_byte = ~SPACE[raw]
        if size:
            before = np.empty(size, bool)
            before[0] = False
            before[1:] = self.word_byte[:-1]
            before[offsets[:-1][offsets[:-1] < size]] = False
            after = np.zeros(size, bool)
            after[:-1] = self.word_byte[1:]
            ends = offsets[1:]
            after[ends[ends > 0] - 1] = False
            self.start, self.end = np.flatnonzero(self.word_byte & ~before), np.flatnonzero(self.word_byte & ~after) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.n_words = np.diff(np.searchsorted(self.start, offsets))
        self.doc = np.repeat(np.arange(self.n), self.n_words)
        self._eights: np.ndarray | None = None

    def eights(self) -> np.ndarray:
        """The eight bytes from each place on, as one number."""
        if self._eights is None:
            padded = np.zeros(len(self.data) + 8, np.uint8)
            padded[: len(self.data)] = self.data
            self._eights = np.ndarray((len(self.data) + 1,), "<u8", padded, 0, (1,))
        return self._eights

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes from start to end, wherever they stand: for finding candidates fast.

        Texts that collide can be made on purpose, so what must be exact compares bytes (`classes`) or uses `word_keys`.
        """
        length = end - start
        eights, shown = self.eights(), np.minimum(length, LONG + 1)
        out = eights[start]
        out &= _LOW[np.minimum(shown, 8)]
        out ^= _SEEDS[shown]
        _mix(out)
        live = np.flatnonzero((length > 8) & (length <= LONG))
        at, left, h = start[live] + 8, length[live] - 8, out[live]
        while len(live):
            h ^= eights[at] & _LOW[np.minimum(left, 8)]
            h *= U(BASE)
            _mix(h)
            done = left <= 8
            if done.any():
                out[live[done]] = h[done]
                more = ~done
                live, at, left, h = live[more], at[more], left[more], h[more]
            at, left = at + 8, left - 8
        data = memoryview(np.ascontiguousarray(self.data))
        for i in np.flatnonzero(length > LONG):
            out[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]])
        return out

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.start, self.end)

    def differ(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the size bytes from a on differ from those from b on, place by place."""
        eights, data = self.eights(), self.data
        out = np.zeros(len(a), bool)
        for i in np.flatnonzero(size > LONG):
            out[i] = not np.array_equal(data[a[i] : a[i] + size[i]], data[b[i] : b[i] + size[i]])
        live = np.flatnonzero(size <= LONG)
        at = 0
        while len(live):
            left = size[live] - at
            other = ((eights[a[live] + at] ^ eights[b[live] + at]) & _LOW[np.minimum(left, 8)]) != 0
            out[live[other]] = True
            live, at = live[~other & (left > 8)], at + 8
        return out

    def classes(self, start: np.ndarray, end: np.ndarray, doc: np.ndarray | None = None) -> np.ndarray:
        """A number for each byte range, equal where the bytes are equal (and the text too, if doc is given): found by hashes, decided by the bytes."""
        found = self.hashes(start, end)
        size = end - start

        def unlike(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            bad = size[i] != size[j]
            if doc is not None:
                bad |= doc[i] != doc[j]
            alike = np.flatnonzero(~bad)
            bad[alike] = self.differ(start[i[alike]], start[j[alike]], size[i[alike]])
            return bad

        data = self.data
        return classes(found if doc is None else by_text(found, doc), unlike, lambda i: (0 if doc is None else int(doc[i]), data[start[i] : end[i]].tobytes()))

    def word_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of a keyed hash (SipHash-2-4) of each word, as two columns; equal words of up to 15 bytes are hashed once."""
        which, of = self._distinct_words()
        some_one, some_two = np.empty(len(which), U), np.empty(len(which), U)
        for lo in range(0, len(which), 1 << 14):  # as much as a processor's cache holds
            part = which[lo : lo + (1 << 14)]
            some_one[lo : lo + (1 << 14)], some_two[lo : lo + (1 << 14)] = self._siphash(self.start[part], self.end[part] - self.start[part])
        one, two = some_one[of], some_two[of]
        data = memoryview(np.ascontiguousarray(self.data))
        for i in np.flatnonzero(self.end - self.start > 16 * LONG):  # not eight bytes at a time
            one[i], two[i] = np.frombuffer(blake2b(data[self.start[i] : self.end[i]], digest_size=16, key=_KEY.tobytes()).digest(), U)
        return one, two

    def _distinct_words(self) -> tuple[np.ndarray, np.ndarray]:
        """(words, for each word the place among them of one with the same bytes). Words of 16 bytes and more all stand for themselves."""
        eights, size = self.eights(), self.end - self.start
        code = lambda x: pa.array(x).dictionary_encode().indices.to_numpy().astype(U)
        # The last block of a word holds its length too, so that blocks tell words apart.
        last = lambda at, k: eights[self.start[at] + 8 * k] & _LOW[size[at] - 8 * k] | size[at].astype(U) << U(56)
        which, of, n = [], np.empty(len(size), np.int64), 0
        blocks = np.minimum(size >> 3, 2)
        for k in range(3):
            at = np.flatnonzero(blocks == k)
            own = np.arange(len(at))
            if k == 0:
                own = code(last(at, 0)).astype(np.int64)
            elif k == 1:
                own = code(code(eights[self.start[at]]) << U(32) | code(last(at, 1))).astype(np.int64)
            one = np.empty(int(own.max(initial=-1)) + 1, np.int64)
            one[own] = at
            which.append(one)
            of[at] = own + n
            n += len(one)
        return np.concatenate(which), of

    def _siphash(self, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """SipHash-2-4 with 128 bits of the size bytes from start on; ranges of more than 16 * LONG bytes are left out."""
        eights, size = self.eights(), np.where(size > 16 * LONG, 0, size)
        blocks = size >> 3
        out = np.empty((4, len(size)), U)
        out[:] = _SIP[:, None]
        live, v = np.arange(len(size)), out
        for k in range(int(blocks.max(initial=0)) + 1):
            final = blocks[live] == k
            m = eights[start[live] + 8 * k] & _LOW[np.minimum(size[live] - 8 * k, 8)]
            m |= np.where(final, size[live].astype(U) << U(56), U(0))
            v[3] ^= m
            _sip_rounds(v, 2)
            v[0] ^= m
            if k or not final.all():
                out[:, live[final]] = v[:, final]
                live, v = live[~final], v[:, ~final]
        out[2] ^= U(0xEE)
        _sip_rounds(out, 4)
        first = out[0] ^ out[1] ^ out[2] ^ out[3]
        out[1] ^= U(0xDD)
        _sip_rounds(out, 4)
        return first, out[0] ^ out[1] ^ out[2] ^ out[3]

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text) of each line; a text without line feeds is one line, an empty text too."""
        feeds = np.flatnonzero(self.raw == 10)
        start = np.concatenate([self.offsets[:-1], feeds + 1])
        doc = np.concatenate([np.arange(self.n), np.searchsorted(self.offsets, feeds, "right") - 1])
        order = np.lexsort((start, doc))
        start, doc = start[order], doc[order]
        end = np.empty(len(start), np.int64)
        end[:-1] = start[1:] - 1
        final = np.ones(len(start), bool)
        final[:-1] = doc[1:] != doc[:-1]
        end[final] = self.offsets[1:][doc[final]]
        return start, end, doc

    def per_text(self, doc: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        """Sums of weight (or counts) by text."""
        if weight is None:
            return np.bincount(doc, minlength=self.n).astype(np.int64)
        return np.rint(np.bincount(doc, weights=weight, minlength=self.n)).astype(np.int64)


def _sip_rounds(v: np.ndarray, n: int) -> None:
    """n rounds on the four rows of v, in place."""
    part = np.empty(v.shape[1], U)

    def turned(x: np.ndarray, bits: int) -> None:
        np.right_shift(x, U(64 - bits), out=part)
        x <<= U(bits)
        x |= part

    a, b, c, d = v
    for _ in range(n):
        for one, two, other, left, right in ((a, b, c, 13, 16), (c, b, a, 17, 21)):
            one += two
            turned(two, left)
            two ^= one
            turned(one, 32)
            other += d
            turned(d, right)
            d ^= other


def windows(keys: tuple[np.ndarray, np.ndarray], doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every run of k words inside one text, from the words' 128-bit keys.

    Each word's key goes into a state of 128 bits, which is mixed before the next one comes; 64 bits of the last state are the run's hash. What a word adds can't be
    chosen freely, since it is a cryptographic hash, so nobody makes runs that collide short of trying some 2**32 of them.
    """
    n = len(keys[0]) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    plain = 2 * len(at) > n  # where most places begin a run, all are worked out: reading in order is faster than picking
    out = np.empty(n if plain else len(at), U)
    for lo in range(0, len(out), 1 << 14):  # as much as a processor's cache holds
        size = min(1 << 14, len(out) - lo)
        one, two = np.full(size, k, U), np.full(size, BASE, U)
        for j in range(k):
            some = slice(lo + j, lo + j + size) if plain else at[lo : lo + size] + j
            one ^= keys[0][some]
            two ^= keys[1][some]
            _mix(one)
            two += one
            _mix(two)
            one += two
        out[lo : lo + size] = one
    return out[at] if len(out) > len(at) else out, at


def run_classes(kind: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(number, first word) of every run of k words inside one text: equal numbers mean equal runs of kinds of words in one text."""
    n = len(kind) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    found = np.zeros(len(at), U)
    for j in range(k):
        found ^= kind[at + j].astype(U)
        found *= U(BASE)
        _mix(found)

    def unlike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        bad = doc[at[a]] != doc[at[b]]
        for j in range(k):
            bad |= kind[at[a] + j] != kind[at[b] + j]
        return bad

    return classes(by_text(found, doc[at]), unlike, lambda i: (int(doc[at[i]]), kind[at[i] : at[i] + k].tobytes())), at


def classes(found: np.ndarray, unlike: Callable[[np.ndarray, np.ndarray], np.ndarray], exact: Callable[[int], object]) -> np.ndarray:
    """A number for each item, equal for items that are the same, whose hashes are `found`: neighbours in the order of hashes are compared, and hashes of several different items are told apart by their exact values."""
    n = len(found)
    order = np.argsort(found, kind="stable")
    first = np.ones(n, bool)
    first[1:] = found[order[1:]] != found[order[:-1]]
    out = np.empty(n, np.int64)
    out[order] = np.cumsum(first) - 1
    again = np.flatnonzero(~first)
    bad = again[unlike(order[again - 1], order[again])] if len(again) else again
    if len(bad):
        runs = np.cumsum(first) - 1
        free = n
        for run in np.unique(runs[bad]).tolist():
            lo, hi = np.searchsorted(runs, [run, run + 1])
            seen: dict[object, int] = {}
            for i in order[lo:hi].tolist():
                out[i] = seen.setdefault(exact(i), free + len(seen))
            free += len(seen)
        out = np.unique(out, return_inverse=True)[1]
    return out


def by_text(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes made distinct between texts, so that equal values mean equal hashes in one text."""
    return mixed(hashes ^ mixed((doc.astype(U) + U(1)) * U(0xA24BAED4963EE407)))


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key occurs more than once, an equal key stands before) for each place."""
    n = len(keys)
    again = np.zeros(n, bool)
    many = np.zeros(n, bool)
    if n:
        order = np.argsort(keys, kind="stable")
        same = np.zeros(n, bool)
        same[1:] = keys[order][1:] == keys[order][:-1]
        again[order] = same
        both = same.copy()
        both[:-1] |= same[1:]
        many[order] = both
    return many, again
