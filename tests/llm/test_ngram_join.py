from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from saldus.llm import components, kernel, ngram_join

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(k)), strict=False))


def brute(docs, join):
    sets = {i: shingles(t, join.words) for i, t in docs}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            inter = len(a & b)
            if a and b and join.den * inter >= join.num * (len(a) + len(b) - inter):
                r, s = find(i), find(j)
                parent[max(r, s)] = min(r, s)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n=160):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 3)))
    bases = [[word() for _ in range(rng.choice([2, 5, 30, 90, 200]))] for _ in range(6)]
    passage = [word() for _ in range(60)]
    docs = [(0, None), (1, ""), (2, " \n\t "), (3, "One"), (4, "one"), (5, "ONE two"), (6, "x" * 5000)]
    for i in range(10, n):
        text = list(rng.choice(bases))
        kind = rng.random()
        if kind < 0.6:
            for _ in range(rng.randint(0, max(1, len(text) // 25))):
                text[rng.randrange(len(text))] = word() + str(i)
        elif kind < 0.75:
            text = [word() for _ in range(rng.randint(1, 150))] + passage
        elif kind < 0.85:
            text = text[: rng.randint(1, len(text))]
        elif kind < 0.95:
            text += [word() for _ in range(rng.randint(1, 10))]
        docs.append((i, " ".join(text)))
    return docs


@pytest.mark.parametrize(("seed", "join", "small"), [(1, ngram_join.Join(3, 90, 100), False), (3, ngram_join.Join(3, 70, 100), True), (5, ngram_join.Join(2, 60, 100), True)])
def test_components_equal_brute_force(spark, monkeypatch, seed, join, small):
    if small:  # groups, blocks, rounds and pivots of a few rows
        for name, value in {"GROUP_MEMBERS": 3, "BLOCK": 5, "FEW": 2, "PAIRS": 1, "LEAST_PIVOTS": 3}.items():
            monkeypatch.setattr(ngram_join, name, value)
    docs = corpus(seed)
    df = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, component_id string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.linked(df, join).collect()}
    assert got == brute(docs, join)


def test_family_of_near_copies(spark, monkeypatch):
    """A hot family whose members are at most a few words apart, some of them only by way of others, and a long text."""
    monkeypatch.setattr(ngram_join, "PAIRS", 2)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(300):
        text = list(base)
        for _ in range(rng.randint(0, 6)):
            text[rng.randrange(len(text))] = f"x{rng.randint(0, 40)}"
        docs.append((i, " ".join(text)))
    long = " ".join(f"v{i}" for i in range(60_000))
    docs += [(400, long), (401, long + " end"), (402, long[: len(long) // 2])]
    join = ngram_join.Join(3, 90, 100)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.linked(df, join).collect()}
    assert got == brute(docs, join)


def test_words_that_hash_alike(spark):
    """A Thue-Morse word and its complement collide under any polynomial hash modulo 2**64; the other pair does in the hash of byte ranges."""
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    docs = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, "78gv\\5$>.@s_j%~#"), (4, "3?f(\"k3>0|$?(j#6")]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.linked(spark.createDataFrame(docs, "doc_id long, text string"), ngram_join.Join(3, 90, 100)).collect()}
    assert got == {i: i for i in range(1, 5)}


def test_rows_without_id(spark):
    docs = [(None, "one two three four five"), (None, "one two three four five"), (None, "six seven eight nine"), (3, "one two three four five"), (None, None)]
    got = ngram_join.linked(spark.createDataFrame(docs, "doc_id long, text string"), ngram_join.Join(3, 90, 100)).collect()
    assert sorted((r["doc_id"] is None, r["n_shingles"], r["component_id"]) for r in got if r["n_shingles"] == 3) == [(False, 3, 3), (True, 3, 3), (True, 3, 3)]
    assert sorted((r["n_shingles"], r["component_id"]) for r in got if r["n_shingles"] != 3) == [(0, None), (2, None)]


def test_one_of_each_component_stays(spark):
    join = ngram_join.Join(5, 80, 100)
    docs = corpus(4, 80)
    rows = [(i, t, "en") for i, t in docs] + [(500, docs[-1][1], "de")] * 2 + [(None, "quite another text than all the others here", "fr")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = ngram_join.deduplicated(df, join)
    assert kept.columns == df.columns
    ids = sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect())
    expected = sorted({c for _, c in brute(docs, join).values()})
    assert ids == expected
    assert kept.where("doc_id is null").count() == 1
    assert ngram_join.deduplicated(df.where("false"), join).count() == 0


def test_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 200), (None, 3)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200}


def plain_siphash(key, data):
    """SipHash-2-4 with 128 bits, word for word from its definition."""
    mask = (1 << 64) - 1
    v = [a ^ b for a, b in zip((0x736F6D6570736575, 0x646F72616E646F6D, 0x6C7967656E657261, 0x7465646279746573), key * 2, strict=True)]
    v[1] ^= 0xEE

    def rounds(n):
        rot = lambda x, b: ((x << b) | (x >> (64 - b))) & mask
        for _ in range(n):
            v[0], v[2] = (v[0] + v[1]) & mask, (v[2] + v[3]) & mask
            v[1], v[3] = rot(v[1], 13) ^ v[0], rot(v[3], 16) ^ v[2]
            v[0] = rot(v[0], 32)
            v[2], v[0] = (v[2] + v[1]) & mask, (v[0] + v[3]) & mask
            v[1], v[3] = rot(v[1], 17) ^ v[2], rot(v[3], 21) ^ v[0]
            v[2] = rot(v[2], 32)

    padded = data + bytes(7 - len(data) % 8) + bytes([len(data) & 255])
    for i in range(0, len(padded), 8):
        m = int.from_bytes(padded[i : i + 8], "little")
        v[3] ^= m
        rounds(2)
        v[0] ^= m
    out = []
    for k, mark in ((2, 0xEE), (1, 0xDD)):
        v[k] ^= mark
        rounds(4)
        out.append(v[0] ^ v[1] ^ v[2] ^ v[3])
    return tuple(out)


def test_word_keys_are_siphash():
    known = plain_siphash((0x0706050403020100, 0x0F0E0D0C0B0A0908), b"")  # the published vector of the empty text
    assert b"".join(x.to_bytes(8, "little") for x in known).hex() == "a3817f04ba25a8e66df67214c7550293"
    words = [b"a" * n for n in range(1, 40)] + [b"abcdefgh", "\u00fcn\u00ef".encode(), b"x" * 300, b"y" * 4096, b"z" * 5000]
    t = kernel.Text(np.frombuffer(b" ".join(words), np.uint8), np.array([0, len(b" ".join(words))]))
    got = list(zip(*(x.tolist() for x in t.word_keys()), strict=True))
    key = tuple(kernel._KEY.tolist())
    assert got[:-1] == [plain_siphash(key, w) for w in words[:-1]] and len(set(got)) == len(words)


def test_ranges_of_pairs_cover_all_of_them():
    """Round by round, each pair comes once, a bounded number at a time."""
    rng = np.random.default_rng(4)
    gid = rng.integers(0, 1 << 60, 300)
    x, y = np.triu_indices(300, 1)
    parts = lambda: ((x[k : k + 97], y[k : k + 97]) for k in range(0, len(x), 97))
    seen, begin, rounds = [], 0, 0
    while begin is not None:
        i, j, begin = ngram_join._least(parts(), gid, begin, 500)
        assert len(i) <= 1000
        seen += zip(i.tolist(), j.tolist(), strict=True)
        rounds += 1
    assert len(seen) == len(set(seen)) == len(x) and rounds > 40
    few = ngram_join._least(iter([(x[:10], y[:10])]), gid, 0, 500)
    assert few[0].tolist() == x[:10].tolist() and few[2] is None and len(ngram_join._least(iter([]), gid, 0, 500)[0]) == 0


def test_equal_words_are_hashed_once(monkeypatch):
    hashed = []
    plain = kernel.Text._siphash
    monkeypatch.setattr(kernel.Text, "_siphash", lambda self, start, size: hashed.append(len(start)) or plain(self, start, size))
    words = ["a", "a\0", "a\0\0", "\0" * 7, "\0" * 8, "abcdefg", "abcdefgh", "abcdefgh\0", "abcdefghi", "h" * 15, "h" * 15 + "\0"]
    column = pa.array([" ".join(words * 50), None, " ".join(reversed(words))])
    keys = {}
    for _, _, raw, offsets in kernel.blocks(column):
        t = kernel.Text(raw, offsets)
        data = np.ascontiguousarray(t.data).tobytes()
        for s, e, *key in zip(t.start, t.end, *t.word_keys(), strict=True):
            assert keys.setdefault(data[s:e], tuple(key)) == tuple(key)
            one, two = plain(t, np.array([s]), np.array([e - s]))
            assert (one[0], two[0]) == tuple(key)
    assert len(keys) == len(set(keys.values())) == len(words)
    # Ten words of up to 15 bytes, and each of the 51 of 16 bytes.
    assert sum(hashed) <= 10 * 2 + 51


def test_texts_are_hashed_once_for_sketch_and_prefixes(spark):
    docs = [(i, t) for i, t in corpus(5) if t]
    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).mapInArrow(read, "doc_id long, text string")
    join = ngram_join.Join(words=3, num=90, den=100)
    rows = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.linked(table, join).collect()}
    assert rows == brute(docs, join)
    # Once for the sets, once for those of them that are verified whole.
    assert seen.value <= 2 * len(docs)


def test_columns_of_a_block_of_sets_are_those_of_each():
    texts = [t for _, t in corpus(6)] + ["a b", None, "c " * 40, "d"]
    join = ngram_join.Join(words=5, num=80, den=100)
    counts = np.random.default_rng(0).integers(0, 300000, 1 << ngram_join.SKETCH_BITS).astype(np.uint32)
    expected = []
    for _, s in ngram_join.shingle_sets(pa.array(texts), join.words):
        often = counts[s >> np.uint64(64 - ngram_join.SKETCH_BITS)]
        order = np.lexsort((s, often))[: join.prefix(len(s)) if len(s) else 0]
        parity = np.bincount((s % np.uint64(512)).astype(int), minlength=512) % 2
        expected.append((len(s), *ngram_join._signature(s), 1 + max(0, int(often[order[0]]) - 7) // 65536 if len(s) else 1, np.packbits(parity.astype(np.uint8)).tobytes(), s[order].tobytes()))
    found = []
    for *_, grams, place in ngram_join.shingle_blocks(pa.array(texts), join.words):
        whole = ngram_join._binary(grams, place)
        for lo in range(0, len(whole), 50):
            columns = ngram_join._ranked(*ngram_join._flat(whole.slice(lo, 50)), counts, join, 7)
            found += zip(*(c.to_pylist() if isinstance(c, pa.Array) else c.tolist() for c in columns), strict=True)
    assert found == expected


def test_pairs_are_verified_once(spark, monkeypatch):
    """Two texts of one size that share their rarest shingles, and too little besides: parities can't tell, so they are verified, but not in every round."""
    words = lambda name, n: [f"{name}{i}" for i in range(n)]
    rare, p, q = words("r", 100), words("p", 2900), words("q", 2900)
    texts = [rare + p, rare + q, *([*common, *words(f"x{k}", 2900)] for k, common in enumerate((p, p, q, q)))]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    seen, plain = [], ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda pairs, *rest: seen.extend(pairs.select("a", "b").collect()) or plain(pairs, *rest))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.linked(spark.createDataFrame(docs, "doc_id long, text string"), ngram_join.Join(3, 90, 100)).collect()}
    assert got == {i: i for i in range(len(docs))}
    assert len(seen) == len(set(seen)) == 1


@pytest.mark.parametrize("buckets", [1, 7, 70_000])
def test_lists_of_buckets_are_those_of_shingles(spark, buckets):
    """Rows of shingles that one group has, and rows that fit no other of a short list, aren't dealt out again; frequent shingles stay in parts."""
    rng, join, noise = np.random.default_rng(9), ngram_join.Join(3, 90, 100), 3
    counts = np.zeros(1 << ngram_join.SKETCH_BITS, np.uint32)
    tokens = rng.integers(1 << 62, (1 << 64) - 1, 900, np.uint64)
    counts[tokens[:3] >> np.uint64(64 - ngram_join.SKETCH_BITS)] = 40_000
    groups = []
    for gid in range(400):
        n = int(rng.choice([20, 21, 90, 100, 400]))
        own = rng.choice(tokens[: 900 if gid % 2 else 60], join.prefix(n), replace=False)
        groups.append((gid, n, own.tobytes()))
    rows = [(int(t), gid, n, pos) for gid, n, own in groups for pos, t in enumerate(np.frombuffer(own, np.uint64))]
    lists = {}
    for t, *row in rows:
        lists.setdefault(t, []).append(row)
    fits = lambda a, b: a is not b and min(a[1], b[1]) * 100 >= max(a[1], b[1]) * 90 and 1 + min(a[1] - 1 - a[2], b[1] - 1 - b[2]) >= -(-90 * (a[1] + b[1]) // 190)
    expected = {(t, *a) for t, x in lists.items() for a in x if t in tokens[:3] or len(x) > ngram_join.FEW or any(fits(a, b) for b in x)}
    shared = spark.sparkContext.broadcast(counts)
    found = ngram_join._lists(ngram_join._postings(spark.createDataFrame(groups, "gid long, n long, prefix binary").repartition(3), shared, noise, buckets), join).collect()
    assert {(r["token"] % (1 << 64), r["gid"], r["n"], r["pos"]) for r in found} == expected and len(found) == len(expected) < len(rows)
    assert {r["token"] % (1 << 64) for r in found if r["block"]} == {int(t) for t in tokens[:3]} == {r["token"] % (1 << 64) for r in found if r["top"]}
    longer = {t for t, x in lists.items() if t not in tokens[:3] and len(x) > ngram_join.FEW}
    assert longer <= {r["token"] % (1 << 64) for r in found if r["over"]} <= longer | {int(t) for t in tokens[:3]} and longer
