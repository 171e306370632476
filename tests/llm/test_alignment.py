from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from saldus.llm import alignment

COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
SCHEMA = "doc_id long, text string, n_a string, row int, kind string, b int"


@pytest.fixture(scope="module")
def libraries():
    """Both libraries, with the bytes of ids from another file for one and from the pieces for the other."""
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    bytes_a = {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    two = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def bytes_b(i):
        p = two.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode()

    return (lambda t: one.encode(" " + t, add_special_tokens=False).ids), bytes_a.__getitem__, (lambda t: two.encode(t)), bytes_b


def brute(docs, libraries):
    """Token by token."""
    encode_a, bytes_a, encode_b, bytes_b = libraries
    rows, counts = [], Counter()
    for i, text in docs:
        text = text or ""
        a, b = encode_a(text), encode_b(text)
        want = b" " + text.encode()
        if not text or b"".join(map(bytes_a, a)) != want or b"".join(map(bytes_b, b)) != want:
            rows.append((i, 0, 0, 0, [], ""))
            continue
        spans = []
        for ids, of in ((a, bytes_a), (b, bytes_b)):
            at, own = 0, []
            for x in ids:
                own.append((at, at + len(of(x)), x))
                at += len(of(x))
            spans.append(own)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]] if len(text) < 3000 else linked(*spans)
        cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        said, low = [], 0
        for cut in cuts:
            said.append("|".join(",".join(str(x[2]) for x in s if low < x[1] <= cut) for s in spans) if len(text) < 3000 else None)
            low = cut
        sha = hashlib.sha256(";".join(said).encode()).hexdigest() if len(text) < 3000 else None
        rows.append((i, len(a), len(b), len(cuts), links, sha))
        counts.update(links)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return Counter((i, na, nb, ng, len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), sha) for i, na, nb, ng, ls, sha in rows)


def linked(one, two):
    """Overlapping pairs of two long rows of spans, by walking along both."""
    out, i, j = [], 0, 0
    while i < len(one) and j < len(two):
        out.append((one[i][2], two[j][2]))
        a, b = one[i][1], two[j][1]
        i, j = i + (a <= b), j + (b <= a)
    return out


def texts():
    rng = random.Random(11)
    word = lambda: rng.choice(("the", "tokenization", "Straße", "naïve", "l'été", "ABC", "x1y2", "日本語", "🙂", "don't", "zzzzz", "и", "1,234.5"))
    out = [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(120)]
    out += ["", None, " ", "  two  spaces ", "tab\tand\nline\n\n", "<|endoftext|> and <s></s><unk> <0x41>", "a▁b", "é ﬁ  nbsp", "\x00nul", "a" * 700, out[0], out[0], "​﻿‮", "½ ② Ａ"]
    return [(i if i % 11 else None, t) for i, t in enumerate(out)] + [(3, out[3]), (3, "another text of one doc_id")]


def sides():
    return (lambda: alignment.byte_level(public_tokenizers.path("byte_bpe_50k.json"))), (lambda: alignment.pieces(public_tokenizers.path("piece_bpe_32k.model")))


def collected(spark, docs, parts):
    df = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in docs], SCHEMA).repartition(parts)
    return Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in alignment.align(df, *sides()).collect())


@pytest.mark.parametrize("shard", [1 << 18, 40])
def test_like_brute_force(spark, libraries, monkeypatch, shard):
    monkeypatch.setattr(alignment, "SHARD", shard)
    docs = texts()
    assert collected(spark, docs, 6) == brute(docs, libraries)


def test_long_texts_and_empty_tables(spark, libraries):
    rng = random.Random(12)
    docs = [(1, " ".join(rng.choice(("lorem", "ipsum", "dolor", "Straße", "antidisestablishmentarianism")) for _ in range(60_000))), (2, "lorem ipsum")]
    got = collected(spark, docs, 2)
    assert Counter((*r[:-1],) for r in got.elements()) == Counter((*r[:-1],) for r in brute(docs, libraries).elements())
    assert alignment.align(spark.createDataFrame([], SCHEMA), *sides()).count() == 0


@pytest.mark.parametrize("which", [0, 1])
def test_parts_give_what_whole_texts_give(which):
    """Whatever white space there is, and wherever; also where the tokens' bytes aren't the text's."""
    side = sides()[which]()
    rng = random.Random(13)
    signs = ["a", "bc", "Zé", "ß", "и", "日本", "🙂", "'s", "don't", "12", ",", "...", " ", "  ", "\t", "\n", " \n ", "\u00a0", "\u2003", "\u3000", "\u0085", "\u1680", "\u200b", "<|endoftext|>", "\x1c", "\x7f", "Ā", "\u0301", "<s>", "▁", "▁x"]
    some = ["", " ", "a ", "a\u00a0", "\u00a0 a", *("".join(rng.choice(signs) for _ in range(rng.randint(1, 30))) for _ in range(2000))]
    assert side.splits
    for texts in (some, some[:3], [""], ["▁"], ["one word", "one word again"]):
        (ids, n, whole), (want, m, right) = alignment.encoded(side, texts, alignment.Parts(texts)), alignment._whole(side, texts)
        assert (n[whole].tolist(), whole.tolist()) == (m[right].tolist(), right.tolist())
        assert ids[whole.repeat(n)].tolist() == want[right.repeat(m)].tolist()


def test_bytes_of_ids():
    one, two = (make() for make in sides())
    assert len(alignment.byte_letters()) == 256 and sorted(alignment.byte_letters().values()) == list(range(256))
    text = "Grüße, <|endoftext|> 🙂!"
    for side in (one, two):
        assert b"".join(side.bytes_of[i] for i in side.encode([text])[0]) == b" " + text.encode()
