from __future__ import annotations

import random

import corpus_pipeline


def test_stages_in_turn(spark, tmp_path):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n)) + "."
    rows = [(i, prose(40) + ("\n" + prose(20) + " hatezz. " if i % 5 == 0 else ""), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, rows[1][1], "en", "s1") for i in range(5)] + [(200, "x | y | z | w", "en", "s0"), (201, None, None, None)]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept[-1], str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        kept.append(spark.read.parquet(f"{tmp_path}/{name}"))
        assert kept[-1].columns == docs.columns
    ids = [{r["doc_id"] for r in x.collect()} for x in kept]
    assert ids[1] == ids[0] - {200, 201}
    assert not {i for i in ids[2] if i % 5 == 0 and i < 100} and {i for i in range(60) if i % 5} <= ids[2]
    assert ids[3] == {i for i in range(60) if i % 5}
    assert ids[4] <= ids[3]
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == len(ids[4])
