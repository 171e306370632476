from __future__ import annotations

import random
from collections import Counter, defaultdict

from saldus.llm import mixing, packing, registry


def docs(spark, n=400, seed=5):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w%d" % rng.randrange(50)] * rng.randint(1, 40)), rng.choice(["a", "a", "a", "b", "c", "d", None]), "clash") for i in range(n)]
    rows += [(n, None, "a", "x"), (n + 1, "", "zero", "x"), (5, rows[5][1], rows[5][2], "x"), (None, "one two three", "b", "x")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, __mix string")


def filled(caps, weights, total):
    """Shares by weight, with what is above a cap shared again until none is."""
    target, open_ = dict.fromkeys(caps, 0.0), set(caps)
    while True:
        rest = total - sum(target[s] for s in caps if s not in open_)
        weight = sum(weights[s] for s in open_)
        over = {s for s in open_ if rest * weights[s] / weight > caps[s]}
        if not over:
            return target | {s: rest * weights[s] / weight for s in open_}
        for s in over:
            target[s] = caps[s]
        open_ -= over


def test_mix_meets_targets(spark):
    rows, df = docs(spark)
    size = defaultdict(int)
    for _, t, s, _ in rows:
        size[s] += len((t or "").split())
    order = sorted((s for s in size if s is not None)) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    targets = filled({s: 3 * n for s, n in size.items()}, weights, sum(size.values()))
    got = mixing.allotted(df).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]] and abs(r["target"] - targets[r["source"]]) < 1e-6 and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 60 for s in size) and sum(taken.values()) <= sum(size.values())
    again = sorted(map(tuple, mixing.allotted(df.repartition(7)).collect()), key=str)
    assert again == sorted(map(tuple, got), key=str)
    times = Counter(r["doc_id"] for r in mixing.mix(df).collect())
    assert times[3] == next(r["taken"] // r["size"] for r in got if r["doc_id"] == 3)
    assert mixing.mix(df).columns == df.columns and mixing.allotted(df.limit(0)).count() == 0


def test_tightest_compatible_bin():
    setup = packing.Setup(capacity=10, per_source=1)
    items = [(7, 1, "a"), (6, 2, "b"), (3, 1, "c"), (3, 9, "a"), (3, 8, "c"), (1, 7, "d"), (0, 6, "e")]
    bins, at = [], []
    for size, cluster, source in items:  # every bin is looked at
        fit = [(b["room"] - size, i) for i, b in enumerate(bins) if b["room"] >= size and cluster not in b["clusters"] and source not in b["sources"]]
        if fit:
            i = min(fit)[1]
        else:
            i = len(bins)
            bins.append({"room": 10, "clusters": set(), "sources": set()})
        bins[i]["room"] -= size
        bins[i]["clusters"].add(cluster)
        bins[i]["sources"].add(source)
        at.append(i)
    assert packing.packed(items, setup) == at


def test_rows_without_or_with_equal_ids_spread(spark):
    rows = [(None, "one two three", "a")] * 900 + [(7, f"w{i}", "b") for i in range(900)]
    lots = packing.lots(packing.items(spark.createDataFrame(rows, "doc_id long, text string, source string")), packing.Setup(lot=100)).groupBy("lot").sum("copies").collect()
    assert sum(r[1] for r in lots) == len(rows) and max(r[1] for r in lots) <= 600
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), setup=packing.Setup(lot=100)).groupBy("doc_id").sum("n_words").collect()
    assert {r[0]: r[1] for r in got} == {None: 2700, 7: 900}


def test_packing_equals_looking_at_every_bin(spark):
    rng = random.Random(2)
    setup = packing.Setup(capacity=100, per_source=3)
    items = sorted(((rng.randint(0, 100), rng.randrange(150), rng.randrange(12)) for _ in range(400)), reverse=True)
    bins, at = [], []
    for size, cluster, source in items:
        fit = [(b["room"] - size, i) for i, b in enumerate(bins) if b["room"] >= size and cluster not in b["clusters"] and b["sources"][source] < 3]
        i = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append({"room": 100, "clusters": set(), "sources": Counter()})
        bins[i]["room"] -= size
        bins[i]["clusters"].add(cluster)
        bins[i]["sources"][source] += 1
        at.append(i)
    assert packing.packed(items, setup) == at


def test_packing_is_whole_and_without_conflicts(spark):
    rows, df = docs(spark)
    setup = packing.Setup(capacity=32, per_source=2, lot=64)
    got = packing.pack(df, setup=setup).collect()
    words, bins = Counter(), defaultdict(list)
    by_id = {r[0]: r for r in rows}
    for r in got:
        words[r["doc_id"]] += r["n_words"]
        bins[r["lot"], r["bin"]].append(r)
    assert words == Counter({**{i: len((t or "").split()) for i, t, _, _ in rows if i != 5}, 5: 2 * len(rows[5][1].split())})
    for own in bins.values():
        assert sum(r["n_words"] for r in own) == own[0]["bin_words"] <= 32 and len(own) == own[0]["bin_documents"]
        texts = Counter(by_id[r["doc_id"]][1] or "" for r in own)
        assert max(texts.values()) == 1
        assert max(Counter(by_id[r["doc_id"]][2] for r in own).values()) <= 2
    assert sorted(map(tuple, packing.pack(df.repartition(5), setup=setup).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert packing.pack(df.limit(0)).count() == 0


def test_near_copies_are_kept_apart(spark, tmp_path):
    words = [f"w{i}" for i in range(60)]
    family = [" ".join(words[:i] + ["other"] + words[i + 1 :]) for i in (0, 1, 58, 59)] + [" ".join(words), " ".join(words).upper()]
    rows = [(i, t, f"s{i}") for i, t in enumerate(family)] + [(10 + i, " ".join(f"x{i}y{j}" for j in range(20)), "t") for i in range(6)] + [(20, "", "u"), (21, None, "u")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.op4_packing(spark, str(tmp_path)).collect()
    bins = {r["doc_id"]: (r["lot"], r["bin"]) for r in got}
    assert len(got) == len(rows) and len({bins[i] for i in range(6)}) == 6 and {bins[20], bins[21]} <= {bins[i] for i in range(16) if i in bins}


def test_rows_without_words_open_no_bins(spark):
    setup = packing.Setup(capacity=2000, per_source=20)
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(100))
    rows = [(i, text(i), "a") for i in range(2000)] + [(2000 + i, ("", None, " \n")[i % 3], "a") for i in range(2000)]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), setup=setup)
    assert packed.count() == 4000 and packed.select("lot", "bin").distinct().count() == 100
