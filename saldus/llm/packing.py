"""Best-fit packing under conflicts.

Documents go into bins of a fixed capacity in words. A bin takes no two documents of a duplicate cluster and at most
`Setup.per_source` documents of a source. Bins stand in order of their residual capacity and carry bitmaps of the clusters and sources
they hold; a document goes to the tightest bin that is compatible: the search starts at the least residual that fits and goes on to
the next larger until one has no conflict, and opens a new bin if none has. Larger documents go first.

A document longer than a bin is cut into pieces; all but its last piece fill bins of their own. Documents are dealt into lots of half to all of
`Setup.lot` rows and each lot is packed alone, so work is even whatever cluster or source is frequent, memory is bounded, a lost
task is packed again to the same bins, and only ids and sizes are shuffled. A lot is a range of a hash of the row; ranges are halved when the table has doubled, so a table that grows by
less keeps its lots. Repeated rows are summed up before they are dealt, and dealt by the lot where they are many.

Defined cases: a null or empty text, or one of spaces, has size 0, takes no room, conflicts with nothing and so goes to the tightest bin there is; equal rows are a cluster and are
kept apart (rows without a cluster conflict by their source alone), as are near copies where the items name their clusters; a null source is a source of its own; a row without doc_id is packed like any other; a text of any length is counted whole
and cut into pieces; an empty table gives no rows; other columns are not read, unless one is named as the cluster.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldus.llm.mixing import word_count

SCHEMA = "doc_id long, piece long, n_words long, start long, lot long, bin long, bin_words long, bin_documents long"


@dataclass(frozen=True)
class Setup:
    capacity: int = 2048
    per_source: int = 4
    lot: int = 8192


def text_cluster(text: Column) -> Column:
    """Documents with the same words, but for ASCII case and white space, are a cluster."""
    words = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x20\x09-\x0D]++", " "))
    return F.xxhash64(words)


class Bins:
    """Open bins in order of residual capacity, with what they hold as bitmaps."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []  # (residual, bin)
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []  # planes: plane i has the sources of which there are more than i

    def put(self, size: int, cluster: int, source: int, planes: int) -> int:
        """The bin a document goes to. cluster: a bit, or 0 for a document without another of its cluster; source: a bit."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            residual, b = self.order[at]
            if not self.clusters[b] & cluster and not self.sources[b][-1] & source:
                break
            at += 1
        else:
            b = len(self.clusters)
            self.clusters.append(0)
            self.sources.append([0] * planes)
            at, residual = None, self.capacity
        if at is not None:
            del self.order[at]
        self.clusters[b] |= cluster
        own = self.sources[b]
        for i, plane in enumerate(own):
            if not plane & source:
                own[i] = plane | source
                break
        insort(self.order, (residual - size, b))
        return b


def packed(items: list[tuple[int, int | None, int]], setup: Setup) -> list[int]:
    """The bin of each (size, cluster, source), in the order given; sizes fit a bin. A cluster of None, or a size of 0, conflicts with nothing."""
    many = {c: 1 << i for i, c in enumerate(sorted(c for c, n in Counter(c for _, c, _ in items if c is not None).items() if n > 1))}
    sources = {s: 1 << i for i, s in enumerate(dict.fromkeys(s for _, _, s in items))}
    bins = Bins(setup.capacity)
    return [bins.put(size, many.get(cluster, 0) if size else 0, sources[source] if size else 0, setup.per_source) for size, cluster, source in items]


def items(docs: DataFrame, cluster: Column | None = None) -> DataFrame:
    """doc_id, source, size, cluster and text_hash of every row of docs (doc_id, text, source)."""
    cluster = text_cluster(F.col("text")) if cluster is None else cluster
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), cluster.alias("cluster"), F.xxhash64("text").alias("text_hash"))


def lots(items: DataFrame, setup: Setup) -> DataFrame:
    """Items of distinct rows, with `copies` of each, and the lot they go to."""
    same = items.groupBy("doc_id", "source", "size", "cluster", "text_hash").agg(F.count(F.lit(1)).alias("all"))
    bits = max(0, (-(-items.count() // setup.lot) - 1).bit_length())
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("all") - 1) / setup.lot))).alias("part")
    dealt = same.select("*", part).withColumn("copies", F.least(F.lit(setup.lot).cast("long"), F.col("all") - F.col("part") * setup.lot))
    place = F.xxhash64(F.lit("lot"), "doc_id", "text_hash", "source", "part")
    return dealt.withColumn("lot", F.shiftrightunsigned(place, 64 - bits) if bits else F.lit(0).cast("long")).drop("all", "part")


def pack(docs: DataFrame, cluster: Column | None = None, setup: Setup = Setup()) -> DataFrame:
    """A row for each piece of each row of docs (doc_id, text, source): its words from `start` on are `n_words` in the bin (lot, bin)."""
    return pack_items(items(docs, cluster), setup)


def pack_items(items: DataFrame, setup: Setup = Setup()) -> DataFrame:
    """As pack, of rows (doc_id, source, size, cluster, text_hash)."""

    def run(lot: pd.DataFrame) -> pd.DataFrame:
        lot = lot.loc[lot.index.repeat(lot["copies"])].reset_index(drop=True)
        names = {x: i for i, x in enumerate(sorted({x for x in lot["source"] if x is not None}))}
        order = lot.assign(source=[names.get(x, -1) for x in lot["source"]], cluster=pd.Series([None if c is None else int(c) for c in lot["cluster"]], dtype=object))
        order = order.assign(whole=order["size"] // setup.capacity, last=order["size"] % setup.capacity, id=order["doc_id"].fillna(-(1 << 62)))
        order.loc[(order["whole"] > 0) & (order["last"] == 0), ["whole", "last"]] += [-1, setup.capacity]
        order = order.sort_values(["last", "id", "text_hash", "source"], ascending=[False, True, True, True], kind="stable")
        at = packed(list(zip(order["last"].tolist(), order["cluster"].tolist(), order["source"].tolist(), strict=True)), setup)
        rows, free = [], max(at, default=-1) + 1
        for doc, whole, last, b in zip(order["doc_id"].tolist(), order["whole"].tolist(), order["last"].tolist(), at, strict=True):
            for i in range(whole):
                rows.append((doc, i, setup.capacity, i * setup.capacity, free))
                free += 1
            rows.append((doc, whole, last, whole * setup.capacity, b))
        out = pd.DataFrame(rows, columns=["doc_id", "piece", "n_words", "start", "bin"])
        out["lot"] = lot["lot"].iloc[0]
        held = out.groupby("bin")["n_words"]
        out["bin_words"], out["bin_documents"] = held.transform("sum"), held.transform("count")
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out[["doc_id", "piece", "n_words", "start", "lot", "bin", "bin_words", "bin_documents"]]

    # Python gets ids as text: pandas would make floats of a column with nulls.
    dealt = lots(items, setup).withColumns({"doc_id": F.col("doc_id").cast("string"), "cluster": F.when(F.col("size") > 0, F.col("cluster")).cast("string")})

    def exact(lot: pd.DataFrame) -> pd.DataFrame:
        return run(lot.assign(doc_id=pd.array([None if x is None else int(x) for x in lot["doc_id"]], "Int64")))

    return dealt.groupBy("lot").applyInPandas(exact, SCHEMA)
