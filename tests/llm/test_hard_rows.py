"""Each operator over one table of hard rows, and over an empty one: nulls, empty and very long texts, ties, repeated rows, columns with clashing names."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from saldus.llm import anisotropic, kernel, languages, mixing, ngram_join, packing, registry, toxicity

#: Names that the operators use for columns of their own.
CLASH = ("score", "predicted", "kept", "n_words", "size", "taken", "cluster", "lot", "bin", "copies", "text_hash", "shard", "tier", "rest", "ids", "n", "s1", "__mix_size", "__mix_sent", "__join_hash", "stays_id")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)


def rows():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n)) + "."
    a, long = prose(60), "\n".join(prose(12) for _ in range(4000))
    texts = [(i, prose(30 + i), "en", f"s{i % 3}") for i in range(40)]
    texts += [(50, a, "en", "s0"), (50, a, "en", "s0"), (51, a, "de", None), (52, a.replace(" ", "\t"), None, "s1"), (53, a + " more", "en", "s1"), (None, a, "en", "s2"), (None, a, "en", "s2"), (None, None, None, None)]
    texts += [(60, None, "en", "s0"), (61, "", "en", "s0"), (62, " \n\t \r\n", "en", None), (63, "one two", "en", "s1"), (64, "One TWO", "en", "s1"), (70, long, "en", "s1"), (71, long + " " + a, "en", "s2"), (72, "x" * 300_000, "en", "s2"), (-5, prose(20), "en", "")]
    return [(*r, len(r[1] or ""), *["clash"] * len(CLASH)) for r in texts]


ROWS = rows()
WORDS = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in ROWS]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Two folders of tables: the hard one and an empty one."""
    out = []
    for name, own in (("hard", ROWS), ("empty", [])):
        at = str(tmp_path_factory.mktemp(name))
        spark.createDataFrame(own, SCHEMA).write.parquet(f"{at}/documents.parquet")
        labels = [(r[0], 1, int(bool(r[0]) and r[0] % 4 == 0), "x") for r in own] + ([(None, None, None, "x")] if own else [])
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int, score string").write.parquet(f"{at}/labels.parquet")
        out.append(at)
    return out


@pytest.mark.parametrize("name", ["op1_quality_rules", "op2_mixing", "op3_license_scan", "op6_toxicity", "op8_ngram_join", "op9_token_counts", "op10_sharding"])
def test_a_result_for_every_row(spark, folders, name):
    query = registry.queries()[name]
    got = [r.asDict() for r in query(spark, folders[0]).collect()]
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ROWS)
    if name == "op1_quality_rules":
        assert Counter((r["doc_id"], r["n_words"]) for r in got) == Counter((r[0], n) for r, n in zip(ROWS, WORDS, strict=True))
        assert all(not r["kept"] for r in got if r["n_words"] < 10)
    if name == "op2_mixing":
        assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], n) for r, n in zip(ROWS, WORDS, strict=True))
    if name == "op6_toxicity":
        assert all(0 <= r["score"] <= 1 for r in got)
    if name == "op8_ngram_join":
        by = {r["doc_id"]: r for r in got}
        assert {by[i]["component_id"] for i in (50, 51, 52, 53)} == {50} and by[64]["component_id"] == 63 and by[71]["component_id"] == 70
        assert [by[i]["n_shingles"] for i in (60, 61, 62, 63, 72)] == [0, 0, 0, 1, 1] and by[61]["component_id"] == 61
    if name == "op9_token_counts":
        assert {(r["doc_id"], r["n_bytes"]) for r in got} == {(r[0], len((r[1] or "").encode())) for r in ROWS}
    empty = query(spark, folders[1])
    assert empty.count() == 0 and set(empty.columns) == set(got[0])


def test_packing_places_every_word(spark, folders):
    got = registry.op4_packing(spark, folders[0]).collect()
    placed = Counter()
    for r in got:
        placed[r["doc_id"]] += r["n_words"]
    assert placed == Counter({i: sum(n for r, n in zip(ROWS, WORDS, strict=True) if r[0] == i) for i in {r[0] for r in ROWS}})
    bins = Counter()
    for r in got:
        bins[r["lot"], r["bin"]] += r["n_words"]
    assert max(bins.values()) <= packing.Setup().capacity
    copies = [(r["lot"], r["bin"]) for r in got if r["doc_id"] in (50, 51, 52)]
    assert len(copies) == 4 and len(set(copies)) == 4
    assert registry.op4_packing(spark, folders[1]).count() == 0


def test_stages_keep_rows_and_columns(spark, folders):
    docs = spark.read.parquet(f"{folders[0]}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folders[0])
        assert out.columns == docs.columns and {tuple(r) for r in out.select(*CLASH).distinct().collect()} == {("clash",) * len(CLASH)}
        assert stage(spark, docs.limit(0), folders[0]).count() == 0
    near = Counter(r["doc_id"] for r in ngram_join.deduplicated(docs, ngram_join.Join(words=5, num=80, den=100)).select("doc_id").collect())
    assert near[50] == 1 and not {51, 52, 53, 71} & set(near) and {60, 61, 62, 70, 72} <= set(near) and near[None] == 1
    assert corpus_pipeline.run(spark, folders[1]).count() == 0


def test_mix_equals_a_plain_sort_and_cut(spark, folders):
    docs = spark.read.parquet(f"{folders[0]}/documents.parquet")
    keyed = mixing.keyed(docs.select("doc_id", "source", "text"), mixing.word_count(F.col("text"))).drop("text").collect()
    sources = sorted({r["source"] for r in keyed if r["source"] is not None}) + [None]
    copies = []
    for at, s in enumerate(sources):
        sent, queue = 0, sorted((r for r in keyed if r["source"] == s), key=lambda r: r["__mix_order"] % (1 << 64))
        for epoch in range(mixing.REPEATS):
            for r in queue:
                sent += r["__mix_size"]
                copies.append((sent / mixing.WEIGHTS[at % 3], r["__mix_order"], epoch, r))
    left, plain = sum(r["__mix_size"] for r in keyed), Counter()
    for _, _, _, r in sorted(copies, key=lambda x: x[:3]):
        left -= r["__mix_size"]
        if left < 0:
            break
        plain[r["doc_id"], r["source"]] += r["__mix_size"]
    got = Counter()
    for r in mixing.allotted(docs).collect():
        got[r["doc_id"], r["source"]] += r["taken"]
    assert +got == +plain


def test_repeated_and_spoilt_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.0, 0.0]), (0, [1.0, 0.0, 0.0]), (1, [1.0, 0.1, 0.0]), (2, [1.0, 0.1, 0.0]), (3, [0.0, 0.0, 0.0]), (4, None), (5, [nan, 1.0, 0.0]), (6, [inf, 1.0, 0.0]), (7, [1.0, None, 0.0]), (8, []), (None, [1.0, 0.0, 0.0]), (9, [-1.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*v, "x", 1) for v in vectors], "vec_id long, embedding array<double>, score string, rank int")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in anisotropic.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 9)]
    assert anisotropic.nearest(df.limit(0), F.lit(True)).count() == 0


def test_spoilt_pages(spark):
    docs = spark.createDataFrame([(1, "the and of that with from", "en"), (2, "der die und das mit von", "de"), (None, None, None)], "doc_id long, text string, lang string")
    html = "<p>" + "der die und das " * 50_000
    pages = spark.createDataFrame([(1, None, None, "x", "y"), (1, None, None, "x", "y"), (None, "", "", "x", "y"), (2, "http://a.de/", html, "x", "y"), (3, "://", "<", "x", "y")], "page_id long, url string, html string, lang string, host string")
    got = languages.identify(pages, docs).collect()
    assert Counter(r["page_id"] for r in got) == {1: 2, None: 1, 2: 1, 3: 1} and {r["lang"] for r in got if r["page_id"] == 2} == {"de"}
    assert languages.identify(pages.limit(0), docs).count() == 0


def test_scores_do_not_depend_on_the_block():
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["good", "bad", "vilezz", "day", "tree"]) + rng.choice(["", "s"]) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    model = toxicity.train(texts, np.array([int("vilezz" in t) for t in texts]), ["en"] * len(texts))
    alone = [model.score(kernel.Text(*block(t), lower=True))[0] for t in texts[:20]]
    assert np.allclose(alone, model.score(kernel.Text(*block(*texts[:20]), lower=True)), atol=1e-6)


def block(*texts):
    import pyarrow as pa

    (one,) = kernel.blocks(pa.array(texts))
    return one[2], one[3]
