"""N-gram Jaccard join: grouped prefix join over word shingles.

Every text becomes its set of 64-bit shingle hashes. Texts with equal sets are one set. Shingles are ordered
rare first, by the counts of a sketch of fixed size and then by hash; two sets that link share a shingle
among the first of either (the prefix). Sets with identical prefixes and size form a group. Groups that share
a prefix shingle are paired and filtered by size, by place and by what the two prefixes prove about their
overlap; the pairs that are left are expand to members and verified on the whole sets.

A group carries the parities of its shingles by 512 hash slots (for a group of several, the slots on which its members agree). Two sets' parities differ
in no more slots than the sets differ in shingles, so the list of a shingle is filtered by size, place and parities while it is read, before a pair is made.

No list of all pairs of a shingle's groups is made. The first round makes of each list only the edges of a forest: a group that an edge has joined to others is
not paired with them again (lists longer than BLOCK are dealt into blocks, whose most central groups are paired in turn). The edges are verified on the whole sets, which
gives components. A list of up to FEW groups gives all its pairs in the first round; if none of its groups has several members, it is not read again.
The rounds after it pair groups of different components only, all those that pass the filters: a list gives a bounded number of
pairs in a round, those of the next range of a hash of the pair, until the hash's whole range is done. In a list longer than a block, groups outside its largest component
are taken as pivots, paired with all groups of other components and taken off the list, a share of the list in each round, until one component is left. Links inside a
component that is already known are not needed for membership: no link between components is lost.

Defined cases: a null or empty text, or one of spaces, has no shingles and is its own component; a text with fewer
words than a shingle is one shingle, its whole sequence; repeated rows are equal sets and link; an empty table gives no rows;
a row without doc_id gets the component of its equals or neighbours, if any of them has a doc_id; a text of any length is taken whole, with memory in
proportion to the longest text; only doc_id and text are read, so other columns clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldus.llm import kernel, scratch
from saldus.llm.components import stars

SKETCH_BITS = 21
CHUNK_BITS = 13
#: Slots of the parities.
PARITIES = 512
#: Members of a group at most; equal prefixes beyond that are several groups.
GROUP_MEMBERS = 64
#: Groups of a list that are held at once.
BLOCK = 4096
#: Postings of a bucket, about, and of a batch of groups that are dealt into buckets at once.
BUCKET = 1 << 19
#: Columns of postings; a set has up to 2**28 shingles.
POSTINGS = {"token": np.uint64, "part": np.int32, "gid": np.int64, "n": np.int32, "pos": np.int32, "rank": np.int32}
#: A list of up to FEW groups gives all its pairs that pass the filters. In the later rounds a longer one gives about so many pairs a round for each of its groups.
FEW, PAIRS = 16, 16
#: Of a list longer than a block, this share are pivots in a round, and no fewer than LEAST_PIVOTS.
PIVOTS, LEAST_PIVOTS = 1 / 16, 1024


@dataclass(frozen=True)
class Join:
    """Words of a shingle, and the least similarity as a ratio of whole numbers."""

    words: int = 5
    num: int = 80
    den: int = 100

    def prefix(self, n: np.ndarray | int):
        return n - -(-self.num * n // self.den) + 1

    def overlap(self, n):
        """Least intersection of two sets of n elements together."""
        return -(-self.num * n // (self.num + self.den))

    def near(self, n1: np.ndarray, pos1: np.ndarray, n2: np.ndarray, pos2: np.ndarray) -> np.ndarray:
        """Whether sets of n1 and n2 elements can link whose first shared one stands at pos1 and pos2."""
        return (np.minimum(n1, n2) * self.den >= np.maximum(n1, n2) * self.num) & (1 + np.minimum(n1 - 1 - pos1, n2 - 1 - pos2) >= self.overlap(n1 + n2))


def shingle_blocks(column: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, words of each text, sorted distinct shingle hashes of text after text, where those of each text begin and the last ones end), a block of texts at a time."""
    for lo, hi, raw, offsets in kernel.blocks(column):
        t = kernel.Text(raw, offsets, lower=True)
        keys = t.word_keys()
        grams, at = kernel.windows(keys, t.doc, words)
        place = np.searchsorted(t.doc[at], np.arange(hi - lo + 1))
        short = np.flatnonzero((place[1:] == place[:-1]) & (t.n_words > 0))
        if len(short):
            first = np.searchsorted(t.doc, short)
            few = [kernel.windows(tuple(key[f : f + n] for key in keys), np.zeros(n, np.int64), n)[0][0] for f, n in zip(first.tolist(), t.n_words[short].tolist(), strict=True)]
            grams = np.insert(grams, place[short], few)
            place[1:] += np.cumsum(np.bincount(short, minlength=hi - lo))
        for i, j in zip(place[:-1].tolist(), place[1:].tolist(), strict=True):
            grams[i:j].sort()
        other = np.ones(len(grams), bool)
        other[1:] = grams[1:] != grams[:-1]
        other[place[:-1][place[:-1] < len(grams)]] = True
        if not other.all():
            place = np.concatenate([[0], np.cumsum(other)])[place]
            grams = grams[other]
        yield lo, hi, t.n_words, grams, place


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, sorted distinct shingle hashes) of each text."""
    for lo, hi, n_words, grams, place in shingle_blocks(column, words):
        for i in range(hi - lo):
            yield int(n_words[i]), grams[place[i] : place[i + 1]]


def _signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a cryptographic hash of a set in order."""
    one, two = np.frombuffer(blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
    return int(one), int(two)


def _flat(column: pa.Array, kind: type = np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """What the binary values of a column without nulls hold, one after another as numbers, and where each begins and the last one ends."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, count=column.offset + len(column) + 1)[column.offset :].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind) if data is not None else np.zeros(0, kind), (offsets - offsets[0]) // np.dtype(kind).itemsize


def _binary(values: np.ndarray, place: np.ndarray, width: int = 8) -> pa.Array:
    """Numbers of `width` bytes as binary values, which begin and end at the places given."""
    return pa.Array.from_buffers(pa.binary(), len(place) - 1, [None, pa.py_buffer(np.ascontiguousarray(place * width, np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _shingled(docs: DataFrame, words: int, keep: tuple[str, ...]) -> DataFrame:
    """doc_id, hash of the text and columns to keep of each row, with its words' number and its set (shingles: sorted hashes), of up to 2**28 shingles.

    Made once for the sketch and the prefixes: words are hashed for most of the time that either takes.
    """
    kept = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), *(F.col(k).alias(f"keep_{k}") for k in keep))
    schema = T.StructType([*kept.schema.fields[1:], T.StructField("n_words", T.LongType()), T.StructField("shingles", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, n_words, grams, place in shingle_blocks(batch.column(0), words):
                part = batch.slice(lo, hi - lo)
                if place[-1] >= 1 << 28:
                    raise ValueError("a text has more than 2**28 shingles")
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(n_words, pa.int64()), _binary(grams, place)], names=schema.names)

    return kept.mapInArrow(run, schema)


def sketch(shingled: DataFrame) -> np.ndarray:
    """Counts of documents by the top SKETCH_BITS bits of their shingles: 8 MB, whatever the input."""
    size, chunk = 1 << SKETCH_BITS, 1 << CHUNK_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.uint32)
        for batch in batches:
            grams, _ = _flat(batch.column(0))
            for lo in range(0, len(grams), 1 << 16):
                np.add.at(total, (grams[lo : lo + (1 << 16)] >> kernel.U(64 - SKETCH_BITS)).astype(np.intp), np.uint32(1))
        yield from out(total.reshape(-1, chunk))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size // chunk, chunk), np.uint32)
        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[k] += np.frombuffer(c, np.uint32)
        yield from out(total)

    def out(parts: np.ndarray) -> Iterator[pa.RecordBatch]:
        some = [k for k in range(len(parts)) if parts[k].any()]
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([parts[k].tobytes() for k in some], pa.binary())], names=["k", "c"])

    parts = shingled.select("shingles").mapInArrow(count, "k int, c binary").repartition(16, "k").mapInArrow(add, "k int, c binary")
    parts = scratch.stored(parts, "join-sketch")  # its shuffle's files go before the prefixes are written
    total = np.zeros((size // chunk, chunk), np.uint32)
    for row in parts.collect():
        total[row["k"]] = np.frombuffer(row["c"], np.uint32)
    scratch.drop(parts)
    return total.reshape(-1)  # counts beyond 2**32 wrap around; any order is right


def _ranked(grams: np.ndarray, place: np.ndarray, counts: np.ndarray, join: Join, noise: int) -> list[np.ndarray | pa.Array]:
    """Columns n, s1, s2, parts, parity and prefix of sets, given one after another as by _flat."""
    n = np.diff(place)
    often = counts[grams >> kernel.U(64 - SKETCH_BITS)].astype(np.uint64)
    often <<= kernel.U(32)
    ranked = often | (np.arange(len(grams)) - np.repeat(place[:-1], n)).astype(np.uint64)  # a set is in order of hash
    ends = list(zip(place[:-1].tolist(), place[1:].tolist(), strict=True))
    for i, j in ends:
        ranked[i:j].sort()
    prefix = np.where(n > 0, join.prefix(n), 0)
    upto = np.concatenate([[0], np.cumsum(prefix)])
    begin = np.repeat(place[:-1], prefix)
    first = ranked[begin + np.arange(upto[-1]) - np.repeat(upto[:-1], prefix)]
    tokens = grams[(first & kernel.U(0xFFFFFFFF)).astype(np.int64) + begin]
    # No more sets can have this prefix than have its rarest shingle.
    parts, some = np.ones(len(n), np.int64), np.flatnonzero(n)
    parts[some] += np.maximum(0, (ranked[place[some]] >> kernel.U(32)).astype(np.int64) - noise) // (1 << 16)
    data = memoryview(np.ascontiguousarray(grams)).cast("B")
    signed = np.frombuffer(b"".join(blake2b(data[8 * i : 8 * j], digest_size=16).digest() for i, j in ends), np.int64).reshape(-1, 2)
    slots = np.repeat(np.arange(len(n)) * PARITIES, n) + (grams & kernel.U(PARITIES - 1)).astype(np.int64)
    odd = np.packbits(np.bincount(slots, minlength=len(n) * PARITIES).astype(np.uint8) & 1).view(np.int64)
    return [n, signed[:, 0], signed[:, 1], parts.astype(np.int32), _binary(odd, np.arange(len(n) + 1) * (PARITIES // 64)), _binary(tokens, upto)]


def _prefixes(shingled: DataFrame, join: Join, shared, noise: int) -> DataFrame:
    """The rows of _shingled with size, signature, parities and prefix (hashes, rare first) in place of the set; parts: into how many its group is dealt."""
    kept = shingled.select("shingles", *(c for c in shingled.columns if c != "shingles"))
    more = [("n", T.LongType()), ("s1", T.LongType()), ("s2", T.LongType()), ("parts", T.IntegerType()), ("parity", T.BinaryType()), ("prefix", T.BinaryType())]
    schema = T.StructType([*kept.schema.fields[1:], *(T.StructField(k, kind) for k, kind in more)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                own = _ranked(*_flat(part.column(0)), counts, join, noise)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *(x if isinstance(x, pa.Array) else pa.array(x) for x in own)], names=schema.names)

    return kept.mapInArrow(run, schema)


GROUPS = "gid long, n long, prefix binary, ids array<long>, value binary, mask binary"


def _groups(wide: DataFrame) -> DataFrame:
    """Sets of equal prefix and size, up to GROUP_MEMBERS in a group. value: parities of the first; mask: slots on which all agree, null for all slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []
        for batch in batches:
            for n, part, prefix, i, parity in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if (n, part, prefix) != key or len(held) == GROUP_MEMBERS:
                    if held:
                        out.append(grouped(key, held))
                    key, held = (n, part, prefix), []
                held.append((i, parity))
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if held:
            out.append(grouped(key, held))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    def grouped(key: tuple, held: list[tuple[int, bytes]]) -> dict:
        value, mask = held[0][1], None
        if len(held) > 1:
            each = np.array([np.frombuffer(p, np.uint8) for _, p in held])
            mask = (~np.bitwise_or.reduce(each ^ each[0], axis=0)).tobytes()
        return {"gid": held[0][0], "n": key[0], "prefix": key[2], "ids": [i for i, _ in held], "value": value, "mask": mask}

    schema = pa.schema([("gid", pa.int64()), ("n", pa.int64()), ("prefix", pa.binary()), ("ids", pa.list_(pa.int64())), ("value", pa.binary()), ("mask", pa.binary())])
    dealt = wide.select("n", F.pmod("s1", "parts").alias("part"), "prefix", "id", "parity")
    return dealt.repartition("n", "part", "prefix").sortWithinPartitions("n", "part", "prefix", "id").mapInArrow(run, GROUPS)


def _postings(groups: DataFrame, shared, noise: int, buckets: int) -> DataFrame:
    """Rows of POSTINGS for all prefix shingles of all groups, those of a bucket in a row for each batch of groups, one array a column.

    part: where a frequent shingle's list is dealt, else -1. rank: less for groups whose rarest shingles are more frequent, which are the ones that
    the rest of a family of near copies is closest to; it is the same in all lists, so that few groups become central.
    A bucket is a range of a hash of shingle and part, so it has whole lists or parts of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            grams, place = _flat(batch.column(2))
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(place, place[lo] + BUCKET, "right")) - 1)
                yield dealt(batch.column(0).to_numpy()[lo:hi], batch.column(1).to_numpy()[lo:hi], grams[place[lo] : place[hi]], np.diff(place[lo : hi + 1]), counts)
                lo = hi

    def dealt(gid: np.ndarray, n: np.ndarray, token: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        often = counts[token >> kernel.U(64 - SKETCH_BITS)].astype(np.int64)
        first = np.cumsum(lengths) - lengths
        rank = -1000 * np.add.reduceat(np.log2(1.0 + often), first) / lengths
        pos = np.arange(len(token)) - np.repeat(first, lengths)
        gid, n, rank = (np.repeat(x, lengths) for x in (gid, n.astype(np.int32), rank.astype(np.int32)))
        part, several = np.full(len(token), -1), np.flatnonzero(often - noise >= 4 * BLOCK)
        part[several] = kernel.mixed(gid[several]) % (1 + (often[several] - noise) // (4 * BLOCK)).astype(np.uint64)
        bucket = (kernel.mixed(token + part.view(np.uint64)) >> kernel.U(32)) * kernel.U(buckets) >> kernel.U(32)
        bucket = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int32)  # numbers of two bytes are sorted faster
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        place = np.append(start, len(order))
        columns = (x[order].astype(kind) for x, kind in zip((token, part, gid, n, pos, rank), POSTINGS.values(), strict=True))
        return pa.RecordBatch.from_arrays([pa.array(bucket[start].astype(np.int32)), *(_binary(x, place, x.itemsize) for x in columns)], names=["bucket", *POSTINGS])

    return groups.select("gid", "n", "prefix").mapInArrow(run, ", ".join(["bucket int", *(f"{k} binary" for k in POSTINGS)]))


def _lists(postings: DataFrame, join: Join) -> DataFrame:
    """The postings of shingles that more than one group has, with their block of the list; top: first of a block of a list that has or may have several; over: the one of a list's rows that makes it longer than FEW.

    One shuffle; a bucket is held at once. Of lists of up to FEW groups only those rows are left that another row fits by size and place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
            for lo, hi in zip(start, np.append(start, len(bucket))[1:], strict=True):
                if held and held[0].column(0)[0].as_py() != bucket[lo]:
                    yield done(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield done(held)

    def done(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        token, *rest = (np.concatenate([_flat(b.column(k), kind)[0] for b in held]) for k, kind in enumerate(POSTINGS.values(), 1))
        order = np.argsort(token)
        ordered = token[order]
        same = ordered[1:] == ordered[:-1]
        order = order[np.append(same, False) | np.append(False, same) | (rest[0][order] >= 0)]
        token, part, gid, n, pos, rank = (x[order] for x in (token.view(np.int64), *(c.astype(np.int64) for c in rest)))
        order = np.lexsort((gid, rank, part, token))
        token, part, gid, n, pos, rank = (x[order] for x in (token, part, gid, n, pos, rank))
        first = np.ones(len(token), bool)
        first[1:] = (token[1:] != token[:-1]) | (part[1:] != part[:-1])
        start = np.flatnonzero(first)
        length = np.diff(np.append(start, len(first)))
        at = np.arange(len(first)) - np.repeat(start, length)
        stays = np.repeat((length > FEW) | (part[start] >= 0), length)
        for k in np.unique(length[(length > 1) & (length <= FEW)]):
            x, y = np.triu_indices(int(k), 1)
            own = start[(length == k) & (part[start] < 0)]
            step = max(1, (1 << 17) // len(x))
            for lo in range(0, len(own), step):
                i, j = ((own[lo : lo + step, None] + p).reshape(-1) for p in (x, y))
                fits = join.near(n[i], pos[i], n[j], pos[j])
                stays[i[fits]] = stays[j[fits]] = True
        several = (part >= 0) | (at >= BLOCK)
        columns = [token, (part + 1) << 32 | at // BLOCK, gid, n, pos, rank, several & (at % BLOCK == 0), at == FEW]
        return pa.RecordBatch.from_arrays([pa.array(x[stays]) for x in columns], names=["token", "block", "gid", "n", "pos", "rank", "top", "over"])

    dealt = postings.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "token long, block long, gid long, n long, pos long, rank long, top boolean, over boolean")


PAIRS_SCHEMA = "g1 long, g2 long, token long, block long, upto long"


def _bytes(column: pa.Array) -> np.ndarray:
    """Parities as rows of eight numbers; all ones for null."""
    out = np.full((len(column), PARITIES // 64), ~kernel.U(0), np.uint64)
    there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False)) if column.null_count else np.arange(len(column))
    if len(there):
        out[there] = np.frombuffer(b"".join(column.drop_null().to_pylist()), np.uint64).reshape(len(there), -1)
    return out


class _Block:
    """One batch of whole blocks of lists, as columns, and the filters over two of its rows."""

    def __init__(self, columns: list[np.ndarray], join: Join):
        self.gid, self.n, self.pos, self.c, self.value, self.mask = columns
        self.join = join

    def fits(self, i: np.ndarray | int, j: np.ndarray) -> np.ndarray:
        """Whether a shared shingle of rows i and j can be the first of two sets that link."""
        at = np.flatnonzero((self.c[i] != self.c[j]) & self.join.near(self.n[i], self.pos[i], self.n[j], self.pos[j]))
        if not len(at):
            return at
        a, b = (i, j[at]) if np.ndim(i) == 0 else (i[at], j[at])
        both = self.n[a] + self.n[b]
        differ = (self.value[a] ^ self.value[b]) & self.mask[a] & self.mask[b]
        return at[np.bitwise_count(differ).sum(axis=1, dtype=np.int64) <= both - 2 * self.join.overlap(both)]

    def few(self, start: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of lists of one short length that pass."""
        x, y = np.triu_indices(length, 1)
        step = max(1, (1 << 17) // max(1, len(x)))  # as many pairs at once, whatever the length
        for lo in range(0, len(start), step):
            i, j = ((start[lo : lo + step, None] + k).reshape(-1) for k in (x, y))
            at = self.fits(i, j)
            yield i[at], j[at]

    def forest(self, lo: int, hi: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows lo to hi that pass, until those that can be joined are."""
        cluster = np.arange(lo, hi)
        for i in range(lo, hi - 1):
            j = lo + np.flatnonzero(cluster[i - lo :] != cluster[i - lo]) + i - lo
            if len(j):
                j = j[self.fits(i, j)]
                if len(j):
                    joined, one = np.unique(cluster[j - lo], return_index=True)
                    cluster[np.isin(cluster, joined)] = cluster[i - lo]
                    yield np.full(len(one), i), j[one]

    def across(self, lo: int, hi: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of rows lo to hi of different components that pass; the largest component comes last."""
        names, of, size = np.unique(self.c[lo:hi], return_inverse=True, return_counts=True)
        order = lo + np.lexsort((of, size[of]))
        for k in range(hi - lo - int(size.max())):
            j = order[k + 1 :]
            j = j[self.fits(int(order[k]), j)]
            if len(j):
                yield np.full(len(j), order[k]), j


def _share(g1: np.ndarray, g2: np.ndarray) -> np.ndarray:
    return (kernel.mixed(g1.astype(np.uint64) * kernel.U(kernel.BASE) + g2.astype(np.uint64)) >> kernel.U(32)).astype(np.int64)


def _least(pairs: Iterator[tuple[np.ndarray, np.ndarray]], gid: np.ndarray, begin: int, some: int) -> tuple[np.ndarray, np.ndarray, int | None]:
    """Of pairs of rows those whose hash is at least begin: all, if there are no more than twice `some`, else about `some`, namely those whose hash is below a bound, and that bound. No more than some multiple of `some` is held at once."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n, upto = 0, None

    def cut() -> None:
        nonlocal held, n, upto
        i, j, share = (np.concatenate(x) for x in zip(*held, strict=True))
        upto = int(np.partition(share, some)[some])
        low = share < upto
        held = [(i[low], j[low], share[low])]
        n = int(low.sum())

    for i, j in pairs:
        share = _share(np.minimum(gid[i], gid[j]), np.maximum(gid[i], gid[j]))
        own = share >= begin if upto is None else (share >= begin) & (share < upto)
        held.append((i[own], j[own], share[own]))
        n += len(held[-1][0])
        if n > 4 * some:
            cut()
    if n > 2 * some:
        cut()
    none = np.zeros(0, np.int64)
    i, j = (np.concatenate([none, *(x[k] for x in held)]) for k in (0, 1))
    return i, j, upto


def _paired(lists: DataFrame, join: Join, turn: int) -> DataFrame:
    """Pairs (g1, g2) of the lists (token, block, gid, n, pos, rank, c, value, mask).

    turn 0: forests. Later: all pairs of different components, by ranges of a hash where they are many; a row (token, block, upto)
    says how far a list has come if it isn't done, and is given back as a row with pos = -1 and c = upto. From turn 2 on, only lists with such a row are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            token, block = now.column(0).to_numpy(), now.column(1).to_numpy()
            if not len(token):
                continue
            cut = np.flatnonzero((token != token[-1]) | (block != block[-1]))
            whole = int(cut[-1]) + 1 if len(cut) else 0
            held = now.slice(whole)
            if whole:
                yield from done(now.slice(0, whole))
        if held is not None and held.num_rows:
            yield from done(held)

    def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
        token, block, gid, n, pos, c = (table.column(k).to_numpy() for k in range(6))
        first = np.ones(len(token), bool)
        first[1:] = (token[1:] != token[:-1]) | (block[1:] != block[:-1])
        start = np.flatnonzero(first)
        length = np.diff(np.append(start, len(token)))
        state = pos[start] < 0  # the state stands first
        low = np.where(state, c[start], 0)
        if turn > 1:
            start, length, low, state = start[state], length[state], low[state], state[state]
        start, length = start + state, length - state
        rows = _Block([gid, n, pos, c, *(_bytes(table.column(k).combine_chunks()) for k in (6, 7))], join)
        found = []
        for k in np.unique(length[(length > 1) & (length <= FEW)]):
            found += rows.few(start[length == k], int(k))
        left = []
        for lo, k, begin in zip(*(x[length > FEW].tolist() for x in (start, length, low)), strict=True):
            if turn == 0:
                found += rows.forest(lo, lo + k)
                continue
            i, j, upto = _least(rows.across(lo, lo + k), gid, begin, PAIRS * k)
            if upto is not None:
                left.append((int(token[lo]), int(block[lo]), upto))
            found.append((i, j))
        found = [x for x in found if len(x[0])]
        if found:
            i, j = (np.concatenate(x) for x in zip(*found, strict=True))
            none = pa.nulls(len(i), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(gid[i], gid[j])), pa.array(np.maximum(gid[i], gid[j])), none, none, none], names=["g1", "g2", "token", "block", "upto"])
        if left:
            none = pa.nulls(len(left), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, *(pa.array(x) for x in zip(*left, strict=True))], names=["g1", "g2", "token", "block", "upto"])

    columns = ["token", "block", "gid", "n", "pos", "c", "value", "mask"]
    return lists.select(*columns, "rank").repartition("token", "block").sortWithinPartitions("token", "block", F.col("pos") >= 0, "rank", "gid").select(*columns).mapInArrow(run, PAIRS_SCHEMA)


def _bits(keys: DataFrame) -> np.ndarray:
    """A bitmap of hashed keys for skipping rows that are in no pair: 4 MB at most, and only a filter."""
    size = min(1 << 25, max(1 << 16, 1 << (16 * keys.count()).bit_length()))
    slot = F.pmod(F.xxhash64("fetch"), F.lit(size))
    rows = keys.groupBy((slot / (1 << 15)).cast("long").alias("k")).agg(F.bitmap_construct_agg(F.pmod(slot, F.lit(1 << 15))).alias("b"))
    table = np.zeros(size // 8, np.uint8)
    for r in rows.collect():
        table[r["k"] * 4096 : (r["k"] + 1) * 4096] = np.frombuffer(r["b"], np.uint8)
    return table


def _fetch(doc_id: Column, text_hash: Column) -> Column:
    """What the row that stands for a set is found again by: its doc_id, or its text's hash where all rows of the set have none."""
    return F.coalesce(doc_id, text_hash)


def _whole_sets(docs: DataFrame, wanted: DataFrame, join: Join) -> DataFrame:
    """(id, as_a, as_b, whole) of the sets wanted (id, as_a, as_b, doc_id, text_hash, n, s1, s2), built again from the texts, once for all rounds."""
    spark = docs.sparkSession
    keys = scratch.stored(wanted.withColumn("fetch", _fetch(F.col("doc_id"), F.col("text_hash"))), "join-wanted")
    shared = spark.sparkContext.broadcast(_bits(keys.select("fetch")))
    size = 8 * len(shared.value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            slots = batch.column(1).to_numpy(zero_copy_only=False)
            texts = batch.column(0).take(pa.array(np.flatnonzero((table[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1)))
            for lo in range(0, len(texts), 200):
                n, s1, s2, whole = [], [], [], []
                for _, s in shingle_sets(texts.slice(lo, 200), join.words):
                    a, b = _signature(s)
                    n.append(len(s))
                    s1.append(a)
                    s2.append(b)
                    whole.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(whole, pa.binary())], names=["n", "s1", "s2", "whole"])

    slot = F.pmod(F.xxhash64(_fetch(F.col("doc_id").cast("long"), F.xxhash64("text"))), F.lit(size))
    built = docs.select("text", slot.alias("slot")).mapInArrow(run, "n long, s1 long, s2 long, whole binary")
    # Repeated rows build a set again.
    built = built.groupBy("n", "s1", "s2").agg(F.first("whole").alias("whole"))
    out = scratch.stored(built.join(keys.select("id", "as_a", "as_b", "n", "s1", "s2"), ["n", "s1", "s2"]).select("id", "as_a", "as_b", "whole"), "join-whole")
    scratch.drop(keys)
    shared.destroy()
    return out


def _verified(pairs: DataFrame, one: DataFrame, two: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) of set ids whose whole sets, in one and two, are similar enough, as edges (u, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([a, b]), kind="stable")
                inter = int((both[1:] == both[:-1]).sum())
                if join.den * inter >= join.num * (len(a) + len(b) - inter):
                    ok.append(i)
            rows = pa.array(ok, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], names=["u", "v"])

    one = one.select(F.col("id").alias("a"), F.col("whole").alias("wa"))
    two = two.select(F.col("id").alias("b"), F.col("whole").alias("wb"))
    return scratch.stored(pairs.join(two, "b").join(one, "a").select("a", "b", "wa", "wb").mapInArrow(run, "u long, v long"), "join-links")


def classes(docs: DataFrame, join: Join = Join(), keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows: doc_id, text_hash, n, s1, s2, n_words of each row, and its columns to keep as keep_<name>; sets: id, doc_id, text_hash, n, s1, s2; node, component of set ids not their component's least)."""
    shingled = scratch.stored(_shingled(docs, join.words, keep), "join-shingles")
    counts = sketch(shingled)
    # What shingles that fall together by chance add to a count: only more than that says that a shingle is frequent.
    usual = int(np.median(counts))
    noise = usual + 8 * int(usual**0.5)
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    wide_rows = scratch.stored(_prefixes(shingled, join, shared, noise), "join-rows")
    scratch.drop(shingled)
    rows = scratch.stored(wide_rows.drop("parts", "parity", "prefix"), "join-rows")
    # Parities and prefix follow from the set; as keys they let rows be summed up before they are sent.
    wide = wide_rows.where("n > 0").groupBy("n", "s1", "s2", "parts", "parity", "prefix").agg(F.min("doc_id").alias("doc_id"), F.min("text_hash").alias("text_hash"))
    wide = scratch.stored(wide.withColumn("id", F.monotonically_increasing_id()), "join-sets")
    scratch.drop(wide_rows)
    sets = scratch.stored(wide.select("id", "doc_id", "text_hash", "n", "s1", "s2"), "join-sets")
    groups = scratch.stored(_groups(wide), "join-groups")
    scratch.drop(wide)
    # The first of a group stands for it: gid is its id.
    more = scratch.stored(groups.where(F.size("ids") > 1).select("gid", F.explode("ids").alias("id")), "join-members")

    # Of all shingles, this share are in prefixes, and one more of each set. Several buckets go to a task, so that tasks are even.
    buckets = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(counts.sum(dtype=np.int64)) * (join.den - join.num) // join.den // BUCKET + 1)
    bare = scratch.stored(_lists(_postings(groups, shared, noise, buckets), join), "join-lists")
    lists = scratch.stored(bare.drop("top", "over").join(groups.select("gid", "value", "mask"), "gid"), "join-lists")
    tops = bare.where("top").select("token", "rank", "gid").withColumn("least", F.min(F.struct("rank", "gid")).over(Window.partitionBy("token")))
    ties = tops.where("gid <> least.gid").select(F.least("gid", "least.gid").alias("g1"), F.greatest("gid", "least.gid").alias("g2"))
    first = _paired(lists.withColumn("c", F.col("gid")), join, 0).select("g1", "g2").union(ties).distinct()
    first = scratch.stored(first, "join-pairs")
    # A list of up to FEW groups of one member each has given all its pairs by now.
    unsettled = bare.where("over").select("token").union(lists.where("mask is not null").select("token"))
    unsettled = scratch.stored(unsettled.union(bare.where("top").select("token")).distinct(), "join-open")
    again = scratch.stored(lists.join(unsettled, "token", "left_semi"), "join-lists")
    for table in (bare, unsettled, lists):
        scratch.drop(table)
    lists = again
    scratch.drop(groups)
    shared.destroy()
    # Of two groups the first of one meets all of the other; inside a group the first meets the rest.
    inside = more.where("gid <> id").select(F.col("gid").alias("a"), F.col("id").alias("b"))
    expanded = first.join(more.select(F.col("gid").alias("g2"), F.col("id").alias("b")), "g2", "left").select(F.col("g1").alias("a"), F.coalesce("b", "g2").alias("b")).union(inside)
    expanded = scratch.stored(expanded, "join-expanded")
    scratch.drop(first)

    long = scratch.stored(lists.groupBy("token").agg(F.min("block").alias("lo"), F.max("block").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo <> hi").select("token", "m"), "join-long")
    several = not long.isEmpty()
    no = F.lit(False)
    ids = expanded.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(True).alias("as_a"), no.alias("as_b")), F.struct(F.col("b").alias("id"), no.alias("as_a"), F.lit(True).alias("as_b")))).alias("x")).select("x.*")
    ids = ids.union(more.select("id", no, no))
    if several:  # groups of lists that are dealt may meet for the first time later
        ids = ids.union(lists.join(long, "token", "left_semi").select("gid", no, no))
    whole = _whole_sets(docs, ids.groupBy("id").agg(F.max("as_a").alias("as_a"), F.max("as_b").alias("as_b")).join(sets, "id"), join)
    links = _verified(expanded, whole.where("as_a"), whole.where("as_b"), join)
    scratch.drop(expanded)
    known = _rounds(links, lists, long if several else None, more, whole, join)
    for table in (links, lists, long, more, whole):
        scratch.drop(table)
    return rows, sets, known


def _labelled(lists: DataFrame, more: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lists with the component c of each group, members gid, id, c of groups of several); a group of several components is of none and differs from all."""
    members = more.join(known, more["id"] == known["node"], "left").select("gid", "id", F.coalesce("component", "id").alias("c"))
    spread = members.groupBy("gid").agg(F.when(F.min("c") == F.max("c"), F.min("c")).otherwise(-1 - F.col("gid")).alias("of"))
    alone = lists.join(known, lists["gid"] == known["node"], "left").drop("node")
    return alone.join(spread, "gid", "left").withColumn("c", F.coalesce("of", "component", "gid")).drop("of", "component"), members


def _rounds(links: DataFrame, lists: DataFrame, long: DataFrame | None, more: DataFrame, whole: DataFrame, join: Join) -> DataFrame:
    """The components, when no list has two of them left that may link."""
    known, turn, state, now = stars(links), 1, None, None
    if long is not None:
        short, now = lists.join(long, "token", "left_anti"), scratch.stored(lists.join(long, "token"), "join-lists")
    else:
        short = lists
    while state is not None or turn == 1 or now is not None:
        pairs = known.select(F.lit(0).cast("long").alias("g1"), F.lit(0).cast("long").alias("g2")).where("false")
        members = None
        if turn == 1 or state is not None:
            own, members = _labelled(short, more, known)
            if state is not None:
                nothing = F.lit(None).cast("binary")
                own = own.unionByName(state.select("token", "block", F.lit(-1).cast("long").alias("gid"), F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("pos"), F.lit(0).cast("long").alias("rank"), F.col("upto").alias("c"), nothing.alias("value"), nothing.alias("mask")))
            found = scratch.stored(_paired(own, join, turn), "join-pairs")
            pairs = found.where("g1 is not null").select("g1", "g2")
            if turn == 1:  # groups whose own members are of several components
                pairs = pairs.union(members.groupBy("gid").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select(F.col("gid").alias("g1"), F.col("gid").alias("g2")))
            state = found.where("token is not null").select("token", "block", "upto")
            state = None if state.isEmpty() else state
        if now is not None:
            own, members = _labelled(now, more, known)
            wide, now, old = *_pivoted(own, join), now
            pairs = pairs.union(wide)
        some = scratch.stored(pairs.distinct(), "join-pairs")
        if now is not None:
            scratch.drop(old)
            now = None if now.isEmpty() else now
        turn += 1
        if some.isEmpty():
            continue
        # A group of one is its own only member.
        one = members.select(F.col("gid").alias("g1"), F.col("id").alias("a"))
        two = members.select(F.col("gid").alias("g2"), F.col("id").alias("b"))
        expanded = some.join(one, "g1", "left").join(two, "g2", "left").select(F.coalesce("a", "g1").alias("a"), F.coalesce("b", "g2").alias("b")).where("a <> b")
        label = known.withColumnsRenamed({"node": "x", "component": "y"})
        for end in ("a", "b"):
            expanded = expanded.join(label.select(F.col("x").alias(end), F.col("y").alias(f"c{end}")), end, "left")
        expanded = expanded.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        expanded = scratch.stored(expanded, "join-expanded")  # its size is known then: where it is small, it goes to the sets
        # Only the sets of these pairs are dealt out.
        one, two = (whole.join(expanded.select(F.col(end).alias("id")), "id", "left_semi") for end in ("a", "b"))
        found = None if expanded.isEmpty() else _verified(expanded, one, two, join)
        scratch.drop(expanded)
        scratch.drop(some)
        if found is not None and not found.isEmpty():
            before = known
            known = stars(known.select(F.col("node").alias("u"), F.col("component").alias("v")).union(found))
            scratch.drop(before)
    return known


def _pivoted(own: DataFrame, join: Join) -> tuple[DataFrame, DataFrame]:
    """(pairs of pivots with groups of other components, what is left of the long lists) of lists with c and m, their length."""
    own = scratch.stored(own, "join-lists")
    sizes = own.groupBy("token", "c").agg(F.count(F.lit(1)).alias("k"))
    # All but the largest component of a list are pivots, in turn.
    largest = sizes.groupBy("token").agg(F.max(F.struct("k", "c")).alias("l"), F.count(F.lit(1)).alias("of")).select("token", F.col("l.c").alias("big"), "of")
    rest = own.join(largest.where("of > 1"), "token").where("c <> big")
    order = Window.partitionBy("token").orderBy("rank", "gid")
    pivots = scratch.stored(rest.withColumn("at", F.row_number().over(order)).where(F.col("at") <= F.greatest(F.lit(LEAST_PIVOTS), F.col("m") * PIVOTS)), "join-pivots")
    one = pivots.select("token", F.col("gid").alias("g1"), F.col("n").alias("n1"), F.col("pos").alias("pos1"), F.col("c").alias("c1"), F.col("value").alias("v1"), F.col("mask").alias("m1"), F.col("at").alias("at1"))
    two = own.join(pivots.select("token", "gid", "at"), ["token", "gid"], "left").select("token", F.col("gid").alias("g2"), F.col("n").alias("n2"), F.col("pos").alias("pos2"), F.col("c").alias("c2"), F.col("value").alias("v2"), F.col("mask").alias("m2"), F.col("at").alias("at2"))
    need = F.ceil(join.num * (F.col("n1") + F.col("n2")) / F.lit(join.num + join.den) - F.lit(1e-9))
    near = (F.least("n1", "n2") * join.den >= F.greatest("n1", "n2") * join.num) & (1 + F.least(F.col("n1") - 1 - F.col("pos1"), F.col("n2") - 1 - F.col("pos2")) >= need)
    met = two.join(one, "token").where((F.col("c1") != F.col("c2")) & (F.col("at2").isNull() | (F.col("at1") < F.col("at2"))) & near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v1, m1, v2, m2 = (_bytes(batch.column(k)) for k in range(2, 6))
            differ = np.bitwise_count((v1 ^ v2) & m1 & m2).sum(axis=1, dtype=np.int64)
            rows = pa.array(np.flatnonzero(differ <= batch.column(6).to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], names=["g1", "g2"])

    most = (F.col("n1") + F.col("n2") - 2 * need).cast("long").alias("most")
    pairs = met.select(F.least("g1", "g2").alias("g1"), F.greatest("g1", "g2").alias("g2"), "v1", "m1", "v2", "m2", most).mapInArrow(run, "g1 long, g2 long")
    pairs = scratch.stored(pairs.distinct(), "join-pairs")
    left = own.join(largest.where("of > 1"), "token", "left_semi").join(pivots.select("token", "gid"), ["token", "gid"], "left_anti").drop("c")
    left = scratch.stored(left.select("token", "block", "gid", "n", "pos", "rank", "value", "mask", "m"), "join-lists")
    scratch.drop(pivots)
    scratch.drop(own)
    return pairs, left


def _named(sets: DataFrame, known: DataFrame) -> DataFrame:
    """sets with their component c."""
    return sets.join(known, sets["id"] == known["node"], "left").select("n", "s1", "s2", "doc_id", F.coalesce("component", "id").alias("c"))


def linked(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of docs (doc_id, text)."""
    rows, sets, known = classes(docs, join)
    named = _named(sets, known)
    least = named.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    named = named.drop("doc_id").join(least, "c").drop("c")
    out = rows.select("doc_id", "n", "s1", "s2").join(named, ["n", "s1", "s2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def members(docs: DataFrame, join: Join = Join(), keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text_hash, cluster, n_words and the columns to keep (as keep_<name>) of every row of docs (doc_id, text); cluster: null for a text without words."""
    rows, sets, known = classes(docs, join, keep)
    named = _named(sets, known).drop("doc_id").withColumnRenamed("c", "cluster")
    return rows.join(named, ["n", "s1", "s2"], "left").drop("n", "s1", "s2")


def deduplicated(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id. Rows without words are linked with nothing and stay."""
    rows, sets, known = classes(docs, join)
    own = rows.where("n > 0").join(_named(sets, known).drop("doc_id"), ["n", "s1", "s2"])
    stays = own.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("k")).select(F.col("k.doc_id").alias("stays_id"), F.col("k.text_hash").alias("stays_hash"))
    filled = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    free = max(map(len, docs.columns)) * "_"  # longer than any name of the input with what follows
    hash_, row = free + "hash", free + "row"
    keyed = docs.where(filled).withColumn(hash_, F.xxhash64("text"))
    one = Window.partitionBy("doc_id", hash_).orderBy("doc_id")
    kept = keyed.join(stays, keyed["doc_id"].eqNullSafe(stays["stays_id"]) & (keyed[hash_] == stays["stays_hash"]), "left_semi").withColumn(row, F.row_number().over(one)).where(F.col(row) == 1)
    return kept.select(docs.columns).union(docs.where(~filled))
