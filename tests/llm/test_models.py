from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from saldus.llm import anisotropic, languages, toxicity

EN = "the and of that with from this which their would about other these could after where those being under".split()
DE = "der die und das mit von dem nicht eine auch sich auf wird sind oder nach einem durch noch über".split()


def text(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "", "x", "ing"]) for _ in range(n))


def test_toxic_stems_are_found_in_long_texts(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        bad, words = i % 4 == 0, (EN if i % 2 else DE)
        t = text(rng, words, rng.randint(5, 60)).split()
        if bad:
            t.insert(rng.randrange(len(t)), rng.choice(["vilezz", "grotmux"]) + rng.choice(["a", "en", "ish", "o", "um"]))
        rows.append((i, " ".join(t), "en" if i % 2 else "de"))
        labels.append((i, int(bad)))
    rows += [(900, text(rng, EN, 6000) + " Vilezzard! " + text(rng, EN, 3000), "en"), (901, text(rng, EN, 9000), "en"), (902, None, None), (903, "", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = toxicity.fitted(docs, spark.createDataFrame([*labels, (None, 1)], "doc_id long, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    held = [i for i, _ in labels if got[i]["held_out"]]
    right = np.mean([got[i]["predicted"] == dict(labels)[i] for i in held])
    assert 100 < len(held) < 200 and right > 0.95
    assert (got[900]["predicted"], got[901]["predicted"], got[902]["predicted"], got[903]["predicted"]) == (1, 0, 0, 0)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    assert {r["doc_id"] for r in toxicity.filtered(docs, model).collect()} == {i for i, r in got.items() if not r["predicted"]}
    assert toxicity.scored(docs.limit(0), model).count() == 0 and toxicity.fitted(docs, spark.createDataFrame([], "doc_id long, toxic int")) is None
    assert {r["score"] for r in toxicity.scored(docs.limit(3), None).collect()} == {0.0}


def test_evidence_is_fused(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, text(rng, EN if i % 2 else DE, 60), "en" if i % 2 else "de") for i in range(80)], "doc_id long, text string, lang string")
    page = lambda body, lang="": f"<html{lang}><head><script>der die das</script></head><body><p>{body}</p></body></html>"
    rows = [(i, f"http://www.site{i % 4}.de/{i}", page(text(rng, DE, 40), ' lang="de-AT"')) for i in range(40)] + [(100 + i, f"https://blog.other.com/{i}", page(text(rng, EN, 40), " lang='en'")) for i in range(40)]
    rows += [(200, "http://www.site1.de/x", page("")), (201, None, None), (202, "http://blog.other.com/y", page("", ' lang="fr"')), (203, "not an address", page(text(rng, DE, 40)))]
    got = {r["page_id"]: r for r in languages.identify(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lang", F.lit("clash")), docs).collect()}
    assert all(got[i]["lang"] == "de" and got[100 + i]["lang"] == "en" for i in range(40)) and len(got) == len(rows)
    assert (got[200]["lang"], got[202]["lang"], got[202]["declared"], got[203]["lang"], got[200]["suffix"]) == ("de", "en", "other", "de", "de")
    assert got[201]["host"] is None and 0 < got[201]["confidence"] < 1
    assert languages.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), docs.limit(0)).count() == 0


def test_nearest_like_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 33))
    x[700:760] = x[50]  # copies
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)] + [(5000, None), (5050, [0.0] * 33), (5100, [float("nan")] * 33), (5150, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = anisotropic.nearest(df, F.col("vec_id") % 50 == 0).collect()
    own = x.astype(np.float32).astype(np.float64)
    own /= np.linalg.norm(own, axis=1)[:, None]
    hit = 0
    for q in range(0, 1500, 50):
        s = own @ own[q]
        s[q] = -2
        best = np.lexsort((np.arange(1500), -np.round(s, 12)))[:5]
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5] and all(abs(r["score"] - s[r["vec_id"]]) < 1e-12 for r in mine)
        hit += len({r["vec_id"] for r in mine} & set(best.tolist()))
        if q == 50:
            assert [r["vec_id"] for r in mine] == [700, 701, 702, 703, 704]
    assert hit / (5 * 30) >= 0.9 and {r["query_id"] for r in got} == set(range(0, 1500, 50))
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r)[:3] for r in anisotropic.nearest(few, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1)]
    assert anisotropic.nearest(few.limit(0), F.lit(True)).count() == 0


def test_nearest_in_a_family_of_near_copies(spark):
    rng = np.random.default_rng(7)
    x = anisotropic.unit(rng.normal(size=(4000, 64)))
    family = np.arange(0, 4000, 3)
    noise = anisotropic.unit(rng.normal(size=(len(family), 64)))
    x[family] = x[0] + np.where(np.arange(len(family)) % 2, 0.02, 0.0005)[:, None] * noise
    rows = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<float>").coalesce(1)
    got = {}
    for r in anisotropic.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    own = anisotropic.unit(rows.astype(np.float64))
    for q in range(0, 4000, 50):
        s = anisotropic.cosine(own[q], own)
        s[q] = -2
        assert got[q] == np.lexsort((np.arange(4000), -s))[:5].tolist()


def test_rows_are_coded_once_for_all_blocks_of_queries(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(900, 9)).astype(np.float32))] + [(900, None), (910, [0.0] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(2)
    ranked = lambda setup: sorted(map(tuple, anisotropic.nearest(df, F.col("vec_id") % 10 == 0, setup=setup).collect()))
    written, stored = [], anisotropic.scratch.stored
    monkeypatch.setattr(anisotropic.scratch, "stored", lambda df, name: (written.append(name), stored(df, name))[1])
    whole = ranked(anisotropic.Setup(block=128))
    assert not written and len(whole) == 5 * 90
    assert ranked(anisotropic.Setup(block=128, queries=13)) == whole and written.count("ann-codes") == 1


def test_parallel_residual_is_smaller_with_weight():
    rng = np.random.default_rng(3)
    x = anisotropic.unit(rng.normal(size=(3000, 16))).astype(np.float32)
    gap = []
    for t in (0.05, 0.6):
        codec = anisotropic.fit(x, anisotropic.Setup(threshold=t))
        gap.append(float((codec.parallel(codec.split(x), codec.encode(x)).sum(axis=1) ** 2).mean()))
    assert gap[1] < gap[0]


def test_unclosed_head_and_nav_hide_no_text():
    shown = lambda html: languages.visible(html).split()
    assert shown("<html><head><meta charset=x><title>a b</title><body><p>one two</p></html>") == ["one", "two"]
    assert shown("<head><script>'</head><p>'</script>\n<link href=x><p>one <script>'</head>'</script>two") == ["'", "one", "two"]
    assert shown("<HEAD><title>t</title>one <body>two <script>'</head>'</script>three") == ["one", "two", "three"]
    assert shown("<body><nav><a>menu</a><p>one<template>two") == ["menu", "one", "two"]
    assert shown("<head><title>t</title></head><body><nav>menu</nav>one<!-- x --><style>s</style><header>two</header><script>rest") == ["one", "two"]


def test_registered_domains(spark):
    hosts = {"www.site1.de": "site1.de", "blog.site1.de": "site1.de", "a.b.shop.co.uk": "shop.co.uk", "shop.co.uk": "shop.co.uk", "x.example.net": "example.net", "localhost": None}
    rows = spark.createDataFrame([(h,) for h in hosts], "host string").select("host", languages.domain(F.split("host", r"\.")).alias("d")).collect()
    assert {r["host"]: r["d"] for r in rows} == hosts


def test_long_and_hostile_pages_are_read_in_time():
    import time

    for part in ("<meta ", "<html ", "<head><title>", "<head ", "<meta content-language ", "<!--", "<script>", "<nav>", "<body "):
        page = part * (1_000_000 // len(part))
        began = time.perf_counter()
        languages.declared(page)
        languages.visible(page)
        assert time.perf_counter() - began < 5, part
    assert languages.declared('<html data-lang="xx" xml:lang="de">') == "de" and languages.declared('<meta http-equiv="content-language" content="fr"><body lang="es">') == "fr"


def test_a_page_is_no_part_of_its_own_prior(spark):
    """Of two pages of one host, a page without text goes with the other; alone on its host it has the suffix's prior."""
    words = {"de": "der die das und nicht mit auch sich auf für", "en": "the and of with not also that for from this"}
    docs = spark.createDataFrame([(i, " ".join([words[x]] * 4), x) for i, x in enumerate(["de", "en"] * 20)], "doc_id long, text string, lang string")
    pages = [(0, "http://one.example.de/a", f"<html><body>{words['de'] * 30}</body></html>"), (1, "http://one.example.de/b", None), (2, "http://two.other.com/", f"<html><body>{words['en'] * 30}</body></html>"), (3, "http://three.third.com/", "")]
    got = {r["page_id"]: r["lang"] for r in languages.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()}
    assert got == {0: "de", 1: "de", 2: "en", 3: "en"}
