from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from saldus.llm import compaction, licenses, registry

MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions.\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'


def test_sentences_and_rules(spark):
    rows = [(1, "Prose.\nLicensed under the Apache License, Version 2.0.\nMore."), (2, MIT), (3, None), (4, ""), (5, "Released under the MIT License. Licensed under CC BY-NC 4.0."), (6, "A license to thrill. Permission denied."), (7, "See the License for the specific language governing permissions and limitations under the License."), (1, "Released under the MIT License.")]
    got = sorted((r["doc_id"], r["licenses"], r["n_sentences"], r["n_unmatched"]) for r in licenses.scan(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, licenses string")).collect())
    assert got == [(1, "Apache-2.0", 1, 0), (1, "MIT", 1, 0), (2, "MIT", 2, 0), (3, "", 0, 0), (4, "", 0, 0), (5, "MIT AND CC-BY-NC-4.0", 2, 0), (6, "", 0, 0), (7, "", 1, 1)]


def found(text):
    return licenses.joined(licenses.matched(licenses.identifiers(text))[0])


def test_triggers_cover_the_catalogue():
    assert all(licenses._TRIGGER.search(s) for s in licenses.SENTENCES)
    assert all(x in set(licenses.SENTENCES.values()) or x.partition(":")[0] in ("notice", "title") for run, _ in licenses.RULES for x in run.split())


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("This software is not licensed under the MIT License.", ""), ("It is no longer distributed under the GPL v2.", ""), ("Distributed under the MIT Press label.", ""), ("A warranty of the boost group.", ""),
        ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"), ("// SPDX-License-Identifier: Apache-2.0 OR MIT", "Apache-2.0 OR MIT"), ("/* spdx-license-identifier: gpl-2.0-or-later */", "GPL-2.0-or-later"), ("<!-- SPDX-License-Identifier: (mit) -->", "MIT"),
        ("# SPDX-License-Identifier: (MIT AND BSD-2-Clause) OR GPL-2.0-only WITH Classpath-exception-2.0", "(MIT AND BSD-2-Clause) OR GPL-2.0-only WITH Classpath-exception-2.0"), ("SPDX-License-Identifier: MIT OR", ""), ("SPDX-License-Identifier: NoSuch-1.0", ""), ("SPDX-License-Identifier: LicenseRef-own-1", "LicenseRef-own-1"),
        ("This crate is dual-licensed under MIT and Apache 2.0.", "MIT OR Apache-2.0"), ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", "Apache-2.0 OR MIT"), ("Licensed under the MIT and BSD 3-Clause licenses.", "MIT AND BSD-3-Clause"),
        ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007", "GPL-3.0"), ("                                 Apache License\n                           Version 2.0, January 2004\n", "Apache-2.0"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"), ("Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License", "CC-BY-NC-SA-3.0"), ("Licensed under MIT.", "MIT"), ("This package is MIT licensed.", "MIT"),
        ("CC0 1.0 Universal", "CC0-1.0"), ("Eclipse Public License - v 2.0", "EPL-2.0"), ("Boost Software License - Version 1.0 - August 17th, 2003", "BSL-1.0"), ("EUROPEAN UNION PUBLIC LICENCE v. 1.2", "EUPL-1.2"), ("Licensed under GPLv3.", "GPL-3.0"),
        ("Distributed under the GNU Lesser General Public License v2.1 or later.", "LGPL-2.1-or-later"), ("Released under the MIT License.\nSPDX-License-Identifier: Apache-2.0 OR ISC", "MIT AND (Apache-2.0 OR ISC)"), ("The license plate. All warranties. Licensed drivers under stress.", ""),
    ],
)
def test_what_texts_say(text, want):
    assert found(text) == want


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
BSD = """Copyright (c) 2020, Somebody Inc.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

* Redistributions of source code must retain the above copyright notice, this
  list of conditions and the following disclaimer.

* Redistributions in binary form must reproduce the above copyright notice,
  this list of conditions and the following disclaimer in the documentation
  and/or other materials provided with the distribution.
"""
ENDORSE = "\nNeither the name of Somebody Inc. nor the names of its contributors may be used to endorse or promote products derived from\nthis software without specific prior written permission.\n"
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""


def test_published_texts():
    """As files carry them: behind comment marks or none, wrapped, with a holder's name."""
    for text, want in ((APACHE, "Apache-2.0"), (BSD, "BSD-2-Clause"), (BSD + ENDORSE, "BSD-3-Clause"), (GPL, "GPL-3.0-or-later"), ("MIT License\n\nCopyright (c) 2024 X\n\n" + MIT, "MIT")):
        assert found(text) == want
        assert found("\n".join("# " + line for line in text.split("\n"))) == want
    assert licenses.matched(licenses.identifiers(APACHE)) == (["Apache-2.0"], 0)


def test_expressions_mean_what_they_say():
    """Random expressions, spelt in odd cases and with needless parentheses, against a plain evaluation under every choice of licenses."""
    import itertools
    import random

    rng, names = random.Random(6), ("MIT", "ISC", "GPL-2.0-only", "Apache-2.0")

    def tree(depth):
        return rng.choice(names) if depth == 0 or rng.random() < 0.3 else (rng.choice(("AND", "OR")), tree(depth - 1), tree(depth - 1))

    def spelt(t):
        if isinstance(t, str):
            return rng.choice((t, t.lower(), t.upper(), f"( {t} )"))
        return f"({spelt(t[1])} {rng.choice((t[0], t[0].lower()))} {spelt(t[2])})"

    def value(t, have):
        return t in have if isinstance(t, str) else (all, any)[t[0] == "OR"]((value(t[1], have), value(t[2], have)))

    for _ in range(200):
        t = tree(3)
        said = licenses.expression(spelt(t))
        for n in range(5):
            for have in itertools.combinations(names, n):
                as_python = " ".join({"AND": "and", "OR": "or"}.get(x, x if x in "()" else str(x in have)) for x in said.replace("(", "( ").replace(")", " )").split())
                assert eval(as_python) == value(t, have)  # noqa: S307
        assert licenses.expression(said) == said
    assert [licenses.expression(x) for x in ("", "MIT MIT", "(MIT", "MIT)", "AND", "MIT WITH nothing", "GPL-2.0+", "gpl-3.0-ONLY with gcc-exception-3.1")] == [None] * 6 + ["GPL-2.0+", "GPL-3.0-only WITH GCC-exception-3.1"]


def test_hard_texts(spark):
    long = "word " * 400_000 + "licensed under the MIT License " + "x" * 100_000 + " licen" * 1000
    rows = [(1, long), (1, long), (None, "Licensed under MIT."), (2, None), (3, "licensed under " * 20_000), (4, "license\n" * 50_000), (5, "neither the name of " * 5_000)]
    got = sorted((r["doc_id"] or 0, r["licenses"]) for r in licenses.scan(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rest int")).collect())
    assert got == [(0, "MIT"), (1, "MIT"), (1, "MIT"), (2, ""), (3, ""), (4, ""), (5, "")]
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_store(spark, tmp_path):
    setup = compaction.Setup(arrival_rows=50, target_bytes=64 << 10, fanout=3)
    store = compaction.Store(spark, f"file://{tmp_path}/store", setup)
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"), F.lit(None).cast("string").alias("shard")).repartition(2)
    assert store.append(rows) == 1
    before = store.manifest().count()
    after = store.compact()
    assert before >= 20 and store.manifest().count() < before and after > 1
    assert store.read(1).exceptAll(store.read(after)).count() == 0 and store.read(after).count() == 1000
    assert store.append(rows.limit(0)) == after + 1 and store.compact() == after + 1
    store.vacuum(versions=1, hours=0)
    assert store.read().exceptAll(rows).count() == 0 and store.read().count() == 1000
    named = {r["shard"] for r in store.manifest().collect()}
    assert {f"{f.parent.name}/{f.name}" for f in (tmp_path / "store/data").glob("*/*.parquet")} == named
    out = compaction.compacted(rows.drop("shard"), setup)
    assert out.count() == 1000 and out.select("doc_id").distinct().count() == 1000


def test_writers_at_once_and_readers_of_old_versions(spark, tmp_path, monkeypatch):
    setup = compaction.Setup(arrival_rows=10, target_bytes=64 << 10, fanout=3, whole=2)
    one, two = (compaction.Store(spark, f"file://{tmp_path}/store", setup) for _ in range(2))
    rows = lambda lo: spark.range(lo, lo + 60).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    one.append(rows(0))
    seen = iter([0])  # the second writer has looked before the first committed
    monkeypatch.setattr(two, "version", lambda: next(seen, one.version()))
    assert two.append(rows(100)) == 2 and one.read().count() == 120
    old = one.read(2)
    shards = [(r["shard"], r["bytes"]) for r in one.manifest().collect()]
    aside = two._write(rows(200))  # written, not committed yet
    merged = one._merge(shards)
    with pytest.raises(compaction.Conflict):
        two._merge(shards[:3])
    one.vacuum(versions=5)
    assert old.count() == 120 and one.read(2).count() == 120
    one.vacuum(versions=1)
    assert old.count() == 120  # younger than the age
    two._commit(two._aside(two._added(aside)), merged)
    assert sorted(r["doc_id"] for r in one.read().collect()) == [*range(60), *range(100, 160), *range(200, 260)]
    one.vacuum(versions=1, hours=0)
    assert one.read().count() == 180 and one._versions() == [merged + 1]
    assert one.append(rows(300).limit(0)) == merged + 2 and one.read().count() == 180


def test_a_merge_goes_over_an_arrival(spark, tmp_path, monkeypatch):
    store, other = (compaction.Store(spark, f"file://{tmp_path}/store", compaction.Setup(arrival_rows=10, fanout=3)) for _ in range(2))
    rows = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    store.append(rows)
    write = store._write
    monkeypatch.setattr(store, "_write", lambda df, rows_=0: (write(df, rows_), other.append(rows))[0])
    store._merge([(r["shard"], r["bytes"]) for r in store.manifest().collect()])
    assert store.version() == 3 and store.read().count() == 100


def test_query_runs_with_the_default_setup(spark, tmp_path, monkeypatch):
    spark.range(10).select(F.col("id").alias("doc_id")).write.parquet(f"{tmp_path}/documents.parquet")
    used = []
    monkeypatch.setattr(compaction, "compacted", lambda docs, setup=compaction.Setup(): used.append(setup))
    registry.op10_sharding(spark, str(tmp_path))
    assert used == [compaction.Setup()]


#: Texts as files carry them: wrapped, behind comment marks, with holders' names.
REAL = {
    "Apache-2.0": '''# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.''',
    "MIT": "MIT License\n\nCopyright (c) 2020 Someone\n\n" + MIT.replace(" conditions.", " conditions:") + '\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "BSD-3-Clause": '''Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of Example Industries, Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.''',
    "GPL-3.0-or-later": '''This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.''',
    "LGPL-2.1-or-later": '''This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.''',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def test_texts_as_files_carry_them(spark):
    rows = [(i, t) for i, t in enumerate(REAL.values())] + [(100, "This file is licensed under the MIT License, see below."), (101, "Portions are distributed under the terms of the 3-Clause BSD License")]
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(REAL))] == list(REAL)
    assert got[100] == "MIT" and got[101] == "BSD-3-Clause"
