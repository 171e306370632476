from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from saldus.llm import token_counts, transducer  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


def expected(texts):
    return [len(x.ids) for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def counted(texts, merges=None):
    own, special = transducer.load(PATH)
    data = [x.encode() for x in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    return token_counts.counted(np.frombuffer(b"".join(data), np.uint8), offsets, merges or own, special).tolist()


HARD = ["", " ", "  a", "a  ", "\n\n a\t b", "'s's ''s 're 'reach 'l 'll 'lla 'r", "it's we'll I'D x'Ve", "1234 ½ ²a", "a b　　c  ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b<|endoftext|", "日本語のテキスト é́ 🤝🏽", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "=" * 300, " " * 500 + "x", "'", "\x00\x01\x7f", "don't'", "can''t", "r're"]


def test_hard_texts():
    assert counted(HARD) == expected(HARD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text(alphabet="abest '\n\t.1lvr "), st.text(alphabet="thereandof ing", max_size=200)), min_size=1, max_size=5))
def test_any_text(texts):
    assert counted(texts) == expected(texts)


def test_forgets_states_and_goes_on():
    merges, _ = transducer.load.__wrapped__(PATH)
    merges.MOST = 64
    merges.forget()
    texts = ["thereuponwithoutinternationalisation" * 5, "some words and more of them, quite ordinary ones", "x" * 100]
    assert counted(texts, merges) == expected(texts)


def test_states_compose_as_chunks_do():
    rng = np.random.default_rng(1)
    _, goes, _ = transducer.tables()
    classes = rng.integers(0, transducer.CLASSES, (37, transducer.CHUNK)).astype(np.uint8)
    scanned = transducer.composed(transducer.chunk_maps(classes, goes))
    for s in range(transducer.STATES):
        state = s
        for i, row in enumerate(classes):
            for c in row:
                state = goes[state * transducer.CLASSES + c]
            assert scanned[i, s] == state


def test_rows(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "hello world", "x"), (1, "hello world", "y"), (2, None, "z"), (None, "word " * 600, "w")], "doc_id long, text string, n_tokens string")
    got = {tuple(r) for r in token_counts.counts(docs, PATH).collect()}
    assert got == {(1, 11, 2, False), (2, 0, 0, False), (None, 3000, expected(["word " * 600])[0], True)}
    assert token_counts.counts(docs.where(F.lit(False)), PATH).count() == 0


def test_long_pretokens_in_chunks(monkeypatch):
    import random

    rng = random.Random(4)
    texts = ["".join(rng.choice(parts) for _ in range(n)) for parts, n in ((["the", "ing", "tion", "re", "xq"], 9000), ("abcdefghijklmnopqrstuvwxyz", 20_000), ("0123456789", 9000), ("éàüß", 9000), ("=", 30_000))]
    assert counted([*texts, "short", " ".join(texts)]) == expected([*texts, "short", " ".join(texts)])
    # Entry states that are guessed wrong are put right by the composition.
    monkeypatch.setattr(transducer, "LONG", 16)
    monkeypatch.setattr(transducer, "LEAD", 0)
    assert counted(texts) == expected(texts)


def test_texts_beyond_a_block():
    texts = ["several words of a text that is longer than a block " * 40_000, "and another"]
    assert counted(texts) == expected(texts)
