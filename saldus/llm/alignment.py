"""Alignment of two tokenizers: which tokens of one overlap which of the other, and how often over the whole corpus.

A task encodes its documents with both libraries and lays the tokens' ends side by side as byte offsets. Offsets where both have an end cut them into groups; tokens
whose bytes overlap are linked. The pairs of ids that a document links, with how often it does (its multiplicities), are the postings.

The corpus-wide counts come by a cogroup of postings: they are shuffled by the second tokenizer's id, in blocks, next to the counts of that id's pairs, and each partition is read as a
stream that Spark has sorted (and spilled where it had to): the counts of an id first, which give its highest, then its postings, each of which becomes a contribution to its document.
What a task holds is the counts of one id (as many as the first tokenizer has ids) and a batch. Contributions are shuffled once more, by the block of their documents, and summed there.
An id that many postings have is dealt to several partitions, by blocks; its counts, summed up before, go to each of them. How many there are follows from its number of postings, and changes no result.

Defined cases: a null or empty text, or one whose tokens' bytes don't join to space + text, has no tokens: zeros and ''; special tokens' strings in texts are plain text; repeated rows are
rows of their own, each counted; rows without doc_id are counted like any other; an empty table gives no rows; a text of any length is aligned whole, with memory in proportion to it;
only doc_id and text are read, so other columns clash with nothing.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldus.llm import kernel, scratch

#: Text bytes of a block of postings, and its documents at most: places in a block are 16-bit numbers.
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 1 << 15
#: Texts that a library gets at once.
CALL_BYTES = 1 << 18
#: Postings of an id that go to one partition together; an id with more is dealt.
SHARD = 1 << 18

#: kind 0: a document; kind 1: postings of an id in a block, in order of `a`; kind 2: counts of an id's pairs in a block.
SCHEMA = "kind int, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, b int, a array<int>, at array<smallint>, times array<long>"


@dataclass
class Side:
    """One tokenizer: texts to ids, and the bytes of each id. splits: whether a text, with the space before it, can be cut before every space that follows a sign that isn't white space, its parts encoded as texts of their own, and nothing changes."""

    encode: Callable[[list[str]], list[list[int]]]
    bytes_of: list[bytes]
    splits: bool = False

    def __post_init__(self):
        self.lengths = np.array([len(x) for x in self.bytes_of], np.int64)


def byte_letters() -> dict[str, int]:
    """The letters that a byte-level vocabulary writes bytes as: printable Latin-1 ones stand for themselves, the others for those from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(others)}


def byte_level(path: str) -> Side:
    """A byte-level BPE file of `tokenizers`; a space goes before each text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    letters = byte_letters()
    table = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        # An added token is written as it is.
        table[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    # Its pattern ends a piece before white space, and a space goes with what follows it.
    return Side(lambda texts: [e.ids for e in tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], table, splits=True)


def pieces(path: str) -> Side:
    """A `sentencepiece` model, which puts a space before each text itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        table.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    # Pieces with the sign for a space behind another sign would reach over a cut.
    splits = not any("▁" in piece.lstrip("▁") for piece in map(model.id_to_piece, range(model.get_piece_size())))
    return Side(lambda texts: model.encode(texts, num_threads=1), table, splits)


def encoded(side: Side, texts: list[str], parts: Parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all texts, how many each has, whether a text's bytes join to space + text)."""
    if not side.splits:
        return _whole(side, texts)
    ids, n, bad = _by_parts(side, parts)
    whole = np.array([bool(t) for t in texts], bool)
    if bad.any():  # texts whose parts don't give back their bytes are encoded as they stand
        rows = np.flatnonzero(bad)
        own, n[rows], whole[rows] = _whole(side, [texts[i] for i in rows])
        of_bad = np.repeat(bad, n)
        out = np.empty(len(of_bad), np.int64)
        out[~of_bad], out[of_bad] = ids, own
        ids = out
    return ids, n, whole


def _whole(side: Side, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, whole, lo, size = [], [], 0, 0
    join, get = b"".join, side.bytes_of.__getitem__
    for hi, text in enumerate(texts, 1):
        size += len(text)
        if size < CALL_BYTES and hi < len(texts):
            continue
        for own, t in zip(side.encode(texts[lo:hi]), texts[lo:hi], strict=True):
            whole.append(bool(t) and join(map(get, own)) == b" " + t.encode())
            ids.append(np.array(own, np.int64))
        lo, size = hi, 0
    return np.concatenate([np.zeros(0, np.int64), *ids]), np.array([len(x) for x in ids], np.int64), np.array(whole, bool)


def _solid(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the sign that ends at each byte is surely no white space: an ASCII sign, or one of two bytes but for those that begin with 0xC2."""
    last, lead = data[at], data[np.maximum(at - 1, 0)]
    return ((last > 0x20) & (last < 0x7F)) | ((last >= 0x80) & (lead >= 0xC3) & (lead <= 0xDF))


class Parts:
    """The parts of a block of texts, with the spaces before them, at the places where a side that `splits` can be cut; equal ones are of one kind."""

    def __init__(self, texts: list[str]):
        raw = [b" " + t.encode() if t else b"" for t in texts]
        self.texts, self.bytes = len(texts), b"".join(raw)
        data = np.frombuffer(self.bytes, np.uint8)
        offsets = np.concatenate([[0], np.cumsum(np.array([len(x) for x in raw], np.int64))])
        begins = np.zeros(len(data) + 1, bool)
        spaces = np.flatnonzero(data == 0x20)
        begins[spaces[_solid(data, np.maximum(spaces - 1, 0)) & (spaces > 0)]] = True
        begins[offsets] = True
        start = np.flatnonzero(begins)
        self.start, self.end = start[:-1], start[1:]
        self.text = np.searchsorted(offsets, self.start, "right") - 1
        # The last part of a text that may end in white space is encoded by itself: what follows would change it.
        apart = ~_solid(data, self.end - 1)
        self.kind = kernel.Text(data, offsets).classes(self.start, self.end, apart.astype(np.int64))
        self.one = np.zeros(int(self.kind.max(initial=-1)) + 1, np.int64)
        self.one[self.kind] = np.arange(len(self.kind))
        self.apart = apart[self.one]


def _by_parts(side: Side, parts: Parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of the texts, how many each has, whether it is left out since the tokens of one of its parts don't join to the part's bytes): each kind of part is encoded once, as words repeat."""
    if not len(parts.kind):
        return np.zeros(0, np.int64), np.zeros(parts.texts, np.int64), np.zeros(parts.texts, bool)
    view, start, end, kind, one, lone, text = parts.bytes, parts.start, parts.end, parts.kind, parts.one, parts.apart, parts.text
    # Kinds are joined to texts of a call's size, and cut again where their bytes end.
    ids, count = [], np.zeros(len(one), np.int64)
    order = np.concatenate([np.flatnonzero(~lone), np.flatnonzero(lone)])
    sizes = (end - start)[one[order]]
    n_joined = int((~lone).sum())
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes[:n_joined]) // CALL_BYTES, prepend=-1)).tolist() if n_joined else []
    bad = np.zeros(len(one), bool)

    def encode(group: np.ndarray, apart: bool) -> np.ndarray:
        spelt = [view[x:y] for x, y in zip(start[one[group]].tolist(), end[one[group]].tolist(), strict=True)]
        if not apart:
            said = b"".join(spelt)
            own = side.encode([said[1:].decode()])[0]
            if b"".join(map(get, own)) == said:
                own = np.array(own, np.int64)
                count[group] = np.diff(np.searchsorted(np.cumsum(side.lengths[own]), np.cumsum((end - start)[one[group]]), "right"), prepend=0)
                return own
        each = side.encode([x[1:].decode() for x in spelt])
        bad[group] = [b"".join(map(get, own)) != said for own, said in zip(each, spelt, strict=True)]
        count[group] = [len(own) for own in each]
        return np.array([i for own in each for i in own], np.int64)

    get = side.bytes_of.__getitem__
    ids += [encode(order[lo:hi], False) for lo, hi in pairwise([*cuts, n_joined])]
    ids.append(encode(order[n_joined:], True))
    ids = np.concatenate(ids)
    first = np.zeros(len(one), np.int64)
    first[order] = np.cumsum(count[order]) - count[order]
    out = np.zeros(parts.texts, bool)
    out[text[bad[kind]]] = True
    each = np.where(out[text], 0, count[kind])
    at = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + np.repeat(first[kind], each)
    return ids[at], np.rint(np.bincount(text, weights=each, minlength=parts.texts)).astype(np.int64), out


def _only(ids: np.ndarray, n: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts to keep, and how many each of all texts has then."""
    return ids[np.repeat(keep, n)], np.where(keep, n, 0)


@dataclass
class Aligned:
    """A block of texts: tokens and groups of each, and its links as (text, id of one side, id of the other)."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    hashes: list[str]
    doc: np.ndarray
    a: np.ndarray
    b: np.ndarray


def aligned(texts: list[str], one: Side, two: Side, words: list[bytes]) -> Aligned:
    """words: what `spelling` gives for the two."""
    parts = Parts(texts)
    (a, n_a, whole_a), (b, n_b, whole_b) = encoded(one, texts, parts), encoded(two, texts, parts)
    keep = whole_a & whole_b
    (a, n_a), (b, n_b) = _only(a, n_a, keep), _only(b, n_b, keep)
    doc_a, doc_b = np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)
    # Texts stand one after another, each with the same bytes on either side, so ends of texts are ends of both. Counts of ends up to each byte say which tokens are where.
    end_a, end_b = np.cumsum(one.lengths[a]), np.cumsum(two.lengths[b])
    start_a = end_a - one.lengths[a]
    size = int(end_a[-1]) + 1 if len(a) else 1
    is_end = np.zeros((2, size), bool)
    is_end[0, end_a] = is_end[1, end_b] = True
    both = is_end[0] & is_end[1]
    ends_b, cuts = np.cumsum(is_end[1]), np.cumsum(both)
    group_a, group_b = cuts[end_a] - both[end_a], cuts[end_b] - both[end_b]
    n_groups = np.bincount(doc_a[both[end_a]], minlength=len(texts))

    first, last = ends_b[start_a], ends_b[end_a - 1] + 1
    n = last - first
    link_a = np.repeat(np.arange(len(a)), n)
    link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    n_links = np.bincount(doc_a[link_a], minlength=len(texts))
    # Tokens in the order in which groups are said, each with what stands behind it.
    last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
    size_a, size_b = len(one.bytes_of), len(two.bytes_of)
    said = np.concatenate([a + size_a * last_a, 2 * size_a + b + size_b * last_b])
    said = said[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")]
    return Aligned(n_a, n_b, n_groups, n_links, _hashes(said, n_a + n_b, words), doc_a[link_a], a[link_a], b[link_b])


def spelling(one: Side, two: Side) -> list[bytes]:
    """Ids as text with what stands behind them: 'a,' and 'a|' of one side, then 'b,' and 'b;' of the other."""
    n, m = len(one.bytes_of), len(two.bytes_of)
    return [b"%d," % i for i in range(n)] + [b"%d|" % i for i in range(n)] + [b"%d," % i for i in range(m)] + [b"%d;" % i for i in range(m)]


def _hashes(said: np.ndarray, n: np.ndarray, words: list[bytes]) -> list[str]:
    """SHA-256 of each text's groups as text, without the last sign; '' for a text without tokens. n: tokens of each text."""
    out, lo, get, join = [], 0, words.__getitem__, b"".join
    for hi in np.cumsum(n).tolist():
        out.append(hashlib.sha256(join(map(get, said[lo:hi].tolist()))[:-1]).hexdigest() if hi > lo else "")
        lo = hi
    return out


def _lists(stops: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(values, kind))


def _batch(kind: int, n: int, **given: pa.Array) -> pa.RecordBatch:
    types = {"row": pa.int64(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "b": pa.int32(), "a": pa.list_(pa.int32()), "at": pa.list_(pa.int16()), "times": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *(given.get(k, pa.nulls(n, t)) for k, t in types.items())], names=["kind", *types])


def postings(docs: DataFrame, one: Callable[[], Side], two: Callable[[], Side]) -> DataFrame:
    """SCHEMA: the documents, their postings by id and block, and each block's counts, from one pass over the texts. A block's first row is its base: postings say places from there on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = one(), two()
        words = spelling(*sides)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            lo, size, texts = 0, 0, [t or "" for t in batch.column(1).to_pylist()]
            for hi, text in enumerate(texts, 1):
                size += len(text)
                if size < BLOCK_BYTES and hi - lo < BLOCK_ROWS and hi < len(texts):
                    continue
                yield from block(aligned(texts[lo:hi], *sides, words), batch.column(0).slice(lo, hi - lo).cast(pa.int64()), row, len(sides[0].bytes_of))
                row, lo, size = row + hi - lo, hi, 0

    def block(x: Aligned, doc_id: pa.Array, row: int, ids: int) -> Iterator[pa.RecordBatch]:
        n = len(x.n_a)
        counted = {k: pa.array(getattr(x, k), pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")}
        yield _batch(0, n, row=pa.array(np.arange(row, row + n)), doc_id=doc_id, groups_sha256=pa.array(x.hashes), **counted)
        if not len(x.a):
            return
        key, times = np.unique((x.b * ids + x.a) * n + x.doc, return_counts=True)
        pair, at = key // n, key % n
        b, a = pair // ids, pair % ids
        new_pair, new_b = (np.append(True, v[1:] != v[:-1]) for v in (pair, b))
        starts = np.flatnonzero(new_b)
        m = len(starts)
        yield _batch(1, m, row=pa.array(np.full(m, row)), b=pa.array(b[starts], pa.int32()), a=_lists(np.append(starts, len(b)), a, pa.int32()), at=_lists(np.append(starts, len(b)), at, pa.int16()), times=_lists(np.append(starts, len(b)), times, pa.int64()))
        begin = np.flatnonzero(new_pair)
        total, b, a = np.add.reduceat(times, begin), b[begin], a[begin]
        starts = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
        yield _batch(2, m, b=pa.array(b[starts], pa.int32()), a=_lists(np.append(starts, len(b)), a, pa.int32()), times=_lists(np.append(starts, len(b)), total, pa.int64()))

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def _pack(at: np.ndarray, best: np.ndarray, total: np.ndarray, squeeze: zstandard.ZstdCompressor) -> bytes:
    """Contributions to documents of a block. Bytes of like weight stand together, since most are zero."""
    columns = (at.astype("<i2"), best.astype("<i8"), total.astype("<i8"))
    return squeeze.compress(b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(at), -1).T).tobytes() for c in columns))


def _unpack(data: bytes, loose: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = np.frombuffer(loose.decompress(data), np.uint8).reshape(18, -1)
    at, best, total = (np.ascontiguousarray(flat[lo:hi].T).view(kind).reshape(-1) for lo, hi, kind in ((0, 2, "<i2"), (2, 10, "<i8"), (10, 18, "<i8")))
    return at, best, total


def contributions(stream: DataFrame) -> DataFrame:
    """row and packed: for each row of postings what they contribute to the documents of their block, of partitions that hold ids (b, part) in order, the counts of each (kind 0) before its postings (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = 1 << 32  # ids are below it
        squeeze = zstandard.ZstdCompressor(level=1, write_content_size=True)
        known = counts = most = np.zeros(0, np.int64)  # of the ids of this batch and the last one before it: pair, count; and whether it is the highest of its b
        for batch in batches:
            if not batch.num_rows:
                continue
            b, kind, row = (batch.column(k).to_numpy() for k in range(3))
            stops, a, times = np.asarray(batch.column(3).offsets), _flat(batch.column(3)), _flat(batch.column(5))
            n = np.diff(stops)
            pair = np.repeat(b, n).astype(np.int64) * span + a
            mine = np.repeat(kind, n) == 0
            if mine.any():
                # An id that is dealt comes once in each of its parts: equal rows of the table.
                again = known // span == b[0] if len(known) else np.zeros(0, bool)
                table, where = np.unique(np.concatenate([known[again], pair[mine]]), return_index=True)
                count = np.concatenate([counts[again], times[mine]])[where]
                begin = np.flatnonzero(np.append(True, table[1:] // span != table[:-1] // span))
                highest = np.repeat(np.maximum.reduceat(count, begin), np.diff(np.append(begin, len(table))))
                known, counts, most = table, count, count == highest
            if not mine.all():
                post = np.flatnonzero(kind == 1)
                where = np.searchsorted(known, pair[~mine])
                m, c, best = times[~mine], counts[where], most[where]
                key = np.repeat(np.arange(len(post)), n[post]) * BLOCK_ROWS + _flat(batch.column(4))
                order = np.argsort(key, kind="stable")
                begin = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
                of, at = np.divmod(key[order][begin], BLOCK_ROWS)
                best, total = np.add.reduceat(np.where(best, m, 0)[order], begin), np.add.reduceat((m * c)[order], begin)
                cut = np.searchsorted(of, np.arange(len(post) + 1)).tolist()
                packed = [_pack(at[lo:hi], best[lo:hi], total[lo:hi], squeeze) for lo, hi in pairwise(cut)]
                yield pa.RecordBatch.from_arrays([pa.array(row[post]), pa.array(packed, pa.binary())], names=["row", "packed"])
            last = known // span == b[-1]
            known, counts, most = known[last], counts[last], most[last]

    return stream.mapInArrow(run, "row long, packed binary")


def _flat(lists: pa.ListArray) -> np.ndarray:
    """The values of all lists, one after another."""
    stops = np.asarray(lists.offsets)
    return lists.values.to_numpy(zero_copy_only=False)[stops[0] : stops[-1]].astype(np.int64)


def by_document(contributed: DataFrame) -> DataFrame:
    """row, n_best and count_sum of each document that has links: blocks are streams of contributions, summed at their documents' places. A task holds the sums of one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loose = zstandard.ZstdDecompressor()
        base, sums = None, np.zeros((3, BLOCK_ROWS), np.int64)
        for batch in batches:
            for row, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if row != base:
                    if base is not None:
                        yield summed(base, sums)
                    base = row
                    sums[:] = 0
                at, best, total = _unpack(data.as_buffer(), loose)
                sums[0, at] += best
                sums[1, at] += total
                sums[2, at] = 1
        if base is not None:
            yield summed(base, sums)

    def summed(base: int, sums: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(sums[2])
        return pa.RecordBatch.from_arrays([pa.array(base + at), pa.array(sums[0, at]), pa.array(sums[1, at])], names=["row", "n_best", "count_sum"])

    return contributed.repartition("row").sortWithinPartitions("row").mapInArrow(run, "row long, n_best long, count_sum long")


def align(docs: DataFrame, one: Callable[[], Side], two: Callable[[], Side]) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of docs (doc_id, text). one, two: make the two sides, on every worker."""
    table = scratch.stored(postings(docs, one, two), "align-postings")
    totals = table.where("kind = 2").select("b", F.explode(F.arrays_zip("a", "times")).alias("x")).groupBy("b", F.col("x.a").alias("a")).agg(F.sum("x.times").alias("times"))
    # As many rows as the second vocabulary has ids at most, each with as many pairs as the first has.
    totals = scratch.stored(totals.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("a", "times"))).alias("x")).select("b", F.col("x.a").alias("a"), F.col("x.times").alias("times")), "align-counts")
    posted = table.where("kind = 1")
    sizes = posted.groupBy("b").agg(F.sum(F.size("a")).alias("n"))
    # Bounded by the second vocabulary.
    dealt = F.broadcast(scratch.stored(sizes.select("b", (1 + F.floor(F.col("n") / SHARD)).cast("int").alias("parts")).where("parts > 1"), "align-parts"))
    parts = F.coalesce("parts", F.lit(1))
    counted = totals.join(dealt, "b", "left").select("b", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("row"), "a", F.lit(None).cast("array<smallint>").alias("at"), "times")
    streamed = posted.join(dealt, "b", "left").select("b", F.pmod(F.xxhash64("row"), parts).cast("int").alias("part"), F.lit(1).alias("kind"), "row", "a", "at", "times")
    both = counted.unionByName(streamed).repartition("b", "part").sortWithinPartitions("b", "part", "kind").select("b", "kind", "row", "a", "at", "times")
    sums = by_document(contributions(both))
    none = F.lit(0).cast("long")
    out = table.where("kind = 0").select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
