from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from saldus.llm import audit, kernel

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, bad in zip("ABCD", (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), re.search(r"[#$%&*|]", text)), strict=True) if bad}


def brute(docs, labels):
    """Every order applied to every document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failing = []
    for i, text, lang in docs:
        own = fails(text)
        if i is not None and any(j is not None and j < i and (u or "") == (text or "") for j, u, _ in docs):
            own.add("E")
        failing.append((i, lang or "", own))
    out, shapley = {}, Counter()
    for part in {p for _, p, _ in failing}:
        rows = [(i, f) for i, p, f in failing if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                removed = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                failed = [x for x in rows if f in x[1]]
                out[part, order, step] = [len(left), len(removed), len(failed) - len(removed), sum(x[1] == {f} for x in rows), sum(x[0] in good for x in removed), sum(x[0] in toxic for x in removed)]
                shapley[part, f] += len(removed)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def texts():
    rng = random.Random(5)
    prose = lambda n, more: " ".join(f"{rng.choice(more)}{rng.randint(0, 400)}" for _ in range(n))
    out = []
    for i in range(120):
        t = prose(rng.choice((20, 99, 100, 101, 150)), rng.choice((["w"], ["W", "XYZ"], ["w", "w#"], ["é", "ß"])))
        out.append((i, t if rng.random() < 0.8 else " ".join(["same"] * 30 + t.split()), rng.choice(("en", "de", None, ""))))
    out += [(200 + i, out[i % 7][1], "en") for i in range(30)] + [(out[3][0], out[3][1], "en"), (-4, out[9][1], "fr")]
    return out + [(None, out[3][1], "en"), (None, None, None), (300, None, "fr"), (301, "", "fr"), (302, " \n", "fr"), (303, "", "en"), (304, "\n".join(f"w{i}" for i in range(60_000)), "en")]


def test_every_order_like_brute_force(spark):
    docs = texts()
    labels = [(i, i % 2 if i % 5 else None, int(i % 3 == 0)) for i in range(0, 260)] + [(None, 1, 1), (7, 1, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, lang string, mask string, part int").repartition(5)
    got = audit.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = got.collect()
    want = brute(docs, labels)
    assert len(rows) == len(want) == 600 * 4
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COUNTS) for r in rows} == want
    assert all(kind == "bigint" for name, kind in got.dtypes if name in COUNTS)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "a", "en")], docs.schema)
    assert audit.audit(one, labels).count() == 600


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=80), st.text(alphabet="aB #é\n", max_size=300), st.none()), min_size=1, max_size=6))
def test_masks_like_plain_code(some):
    data = [(x or "").encode() for x in some]
    raw, offsets = np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    assert audit.masks(raw, offsets).tolist() == [sum(1 << "ABCD".index(f) for f in fails(x)) for x in some]
    assert audit.distinct_words(kernel.Text(raw, offsets)).tolist() == [len(set(re.findall(r"[^\x20\x09-\x0D]+", x or ""))) for x in some]


def test_words_that_hash_alike_are_distinct():
    raw = rb"SW(|dn>|xD$Nz>yM FwA]vehL\u7%Sa,z SW(|dn>|xD$Nz>yM"
    assert audit.distinct_words(kernel.Text(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))).tolist() == [2]
