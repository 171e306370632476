"""How filters interact: what each of five filters removes, alone, after others and over all orders.

Texts are scanned as Arrow buffers: byte classes mark words, capitals and symbols, running sums over them count each text's share, and the
sorted hashes of a text's words, compared by their bytes where they agree, count its distinct words. A text becomes a mask of the filters that
it fails, with a cryptographic hash of itself; the filter of equal texts is settled by a grouped minimum of doc_id over those hashes. Rows are then counted by part and mask,
and every order of the filters is read off those counts: 32 masks stand for all rows of a part.

Defined cases: a null text counts as empty, which fails A (and not B: 0 distinct of 0 words is enough); equal rows of one doc_id are each kept by E, as no doc_id
is smaller; a row without doc_id isn't compared by E, neither removed nor a reason to remove, and has no labels; a document with several
labels counts as good or toxic if one says so; a null lang is the part '', together with an empty one; an empty table gives no rows; a text of any length is taken whole, with memory in proportion to
the longest text; only doc_id, text and lang are read, so other columns clash with nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldus.llm import kernel, scratch

FILTERS = "ABCDE"
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*|")] = True
_CONTINUES = (np.arange(256) & 0xC0) == 0x80

SCHEMA = "doc_id long, part string, mask int, h1 long, h2 long"


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flags up by text, from one running sum."""
    before = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=before[1:])
    return before[offsets[1:]] - before[offsets[:-1]]


def distinct_words(t: kernel.Text) -> np.ndarray:
    """Distinct words of each text of a block, case-sensitive."""
    kind = t.classes(t.start, t.end, t.doc)
    one = np.zeros(int(kind.max(initial=-1)) + 1, np.int64)
    one[kind] = t.doc  # a kind is of one text
    return np.bincount(one, minlength=t.n)


def masks(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The filters A to D that each text of a block fails, as bits 0 to 3."""
    t = kernel.Text(raw, offsets)
    fails = (
        t.n_words < 100,
        100 * distinct_words(t) < 80 * t.n_words,
        100 * _sums(_CAPITAL[raw], offsets) > 10 * _sums(~_CONTINUES[raw], offsets),
        _sums(_SYMBOL[raw], offsets) > 0,
    )
    return sum((f.astype(np.int32) << i for i, f in enumerate(fails)), np.zeros(t.n, np.int32))


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask of A to D and a 128-bit hash of the text, of every row of docs (doc_id, text, lang)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offsets in kernel.blocks(batch.column(1)):
                data = memoryview(raw)
                digests = b"".join(hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
                h = np.frombuffer(digests, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(pa.int64()), batch.column(2).slice(lo, hi - lo), pa.array(masks(raw, offsets)), pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1]))],
                    names=["doc_id", "part", "mask", "h1", "h2"],
                )

    return docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("part")).mapInArrow(run, SCHEMA)


def counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bits 0 to 4 for A to E), n, good and toxic: rows by what they fail.

    A text's smallest doc_id comes from a grouped minimum, which is combined before it is sent. Rows find it, and their labels, by doc_id, so a text that a third of
    all rows share isn't gathered anywhere.
    """
    rows = scratch.stored(scanned(docs), "audit-rows")
    first = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").select("doc_id", "h1", "h2", F.lit(True).alias("_first"))
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("_good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_toxic"))
    named, bare = rows.where("doc_id is not null"), rows.where("doc_id is null")
    told = named.join(said, "doc_id", "left").join(first, ["doc_id", "h1", "h2"], "left")
    mask = F.col("mask") + F.when(F.col("_first").isNull(), F.lit(1 << 4)).otherwise(F.lit(0))
    no = F.lit(False)
    every = told.select("part", mask.alias("mask"), F.coalesce("_good", no).alias("_good"), F.coalesce("_toxic", no).alias("_toxic")).union(bare.select("part", "mask", no, no))
    out = scratch.stored(every.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("_good").alias("good"), F.count_if("_toxic").alias("toxic")), "audit-counts")
    scratch.drop(rows)
    return out


def interactions(by_mask: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step of it, from counts().

    What a step does depends on its filter and on the set of those before it: 80 such cases are summed up for each part, and the 600 steps look theirs up. No row of the documents is touched again.
    """
    spark = by_mask.sparkSession
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for i, f in enumerate(order, 1):
            steps.append(("".join(order), i, bit[f], before))
            before |= bit[f]
    steps = spark.createDataFrame(steps, "filter_order string, step int, own int, before int")
    cases = [(own, before) for own in bit.values() for before in range(32) if not before & own]

    def removed(own: int, before: int):
        return (F.col("mask").bitwiseAND(own) != 0) & (F.col("mask").bitwiseAND(before) == 0)

    def total(when, value="n"):
        return F.coalesce(F.sum(F.when(when, F.col(value))), F.lit(0)).cast("long")

    sums = by_mask.groupBy("part").agg(
        total(F.lit(True)).alias("_all"),
        F.array(*(F.struct(F.lit(o).alias("own"), F.lit(b).alias("before"), total(removed(o, b)).alias("removed"), total(removed(o, b), "good").alias("good_lost"), total(removed(o, b), "toxic").alias("toxic_lost"), total(F.col("mask").bitwiseAND(b | o) == 0).alias("kept"), total(F.col("mask").bitwiseAND(o) != 0).alias("fails")) for o, b in cases)).alias("_cases"),
    )
    each = sums.select("part", F.explode("_cases").alias("x")).select("part", "x.*")
    # How many orders put exactly these filters before that one: k! (4 - k)! for k of them.
    orders = F.element_at(F.array(*map(F.lit, (24, 6, 4, 6, 24))), F.bit_count("before") + 1)
    shapley = each.groupBy("part", "own").agg(F.sum(F.col("removed") * orders).alias("shapley"), F.max(F.when(F.col("before") == 31 - F.col("own"), F.col("removed"))).alias("unique_fails"))
    out = each.join(shapley, ["part", "own"]).join(F.broadcast(steps), ["own", "before"])
    return out.select("part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of that step, for every part of docs (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    return interactions(counts(docs, labels))


def oracle() -> str:
    """The same from plain counts over every document, order and step."""
    return r"""
WITH words AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
failing AS (
  SELECT doc_id, part,
    [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f
  FROM words),
told AS (SELECT f.*, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS bad FROM failing f LEFT JOIN labels l USING (doc_id)),
one AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
orders AS (
  SELECT [a.k, b.k, c.k, d.k, e.k] AS o, concat(chr(64 + a.k), chr(64 + b.k), chr(64 + c.k), chr(64 + d.k), chr(64 + e.k)) AS filter_order
  FROM one a, one b, one c, one d, one e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
same AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM told GROUP BY ALL),
gone AS (SELECT s.*, filter_order, o, list_position(list_transform(o, lambda x: f[x]), true) AS hit FROM same s, orders),
steps AS (
  SELECT part, filter_order, k AS step, o[k] AS own,
    sum(n) FILTER (hit IS NULL OR hit > k) AS kept, sum(n) FILTER (hit = k) AS removed, sum(n) FILTER (f[o[k]] AND hit < k) AS redundant,
    sum(n) FILTER (f[o[k]] AND len(list_filter(f, lambda x: x)) = 1) AS unique_fails, sum(good) FILTER (hit = k) AS good_lost, sum(bad) FILTER (hit = k) AS toxic_lost
  FROM gone, one GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM steps"""
