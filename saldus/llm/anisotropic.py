"""Approximate nearest neighbours by score-aware anisotropic quantisation.

Vectors of unit length are coded as 4 bits for each pair of dimensions. Codebooks and codes minimise a loss that weighs the part of
the residual parallel to the vector more than the rest, because that part changes the largest inner products. Queries scan the
codes with tables of partial products (two codes to a table of 256). Rows are reranked exactly, in double precision, on the original
vectors: first the best of a block by approximate score, then every row whose codes leave room for the k-th exact score met so far. A row's
angle to what its codes stand for is kept beside them, so by the triangle inequality of angles no row that is left out can be among the k
nearest: the cut follows the data, and near copies with equal codes are all reranked. A block sends only its exact best on.

The codebooks are fitted on a sample of a documented bound (`Setup.sample`); every row is coded and scanned. Queries go in blocks
of a fixed number, each against all rows, whose codes are written once where there are several blocks; no table of queries and rows is made and no cell
of an index can overflow.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold null or non-finite components take no part, as
queries or candidates; equal scores are ordered by id; a query meets every row with another id; with fewer rows than asked for, all are
returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saldus.llm import scratch

SCHEMA = "query_id long, vec_id long, score double"
RANKED = "query_id long, rank int, vec_id long, score double"


@dataclass(frozen=True)
class Setup:
    sample: int = 20_000  # rows that codebooks are fitted on
    rounds: int = 8
    threshold: float = 0.2  # the inner product from which scores matter
    block: int = 4096  # rows scanned at once
    rerank: int = 64  # of each block, reranked first to raise the k-th score; the bound decides on the rest
    queries: int = 4096  # scanned in one job


def usable(column: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(places, float64 vectors) of the rows that take part."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    if dims is None:
        dims = int(np.bincount(lengths).argmax()) if lengths.any() else 0
    at = np.flatnonzero((lengths == dims) & (dims > 0))
    flat = column.take(pa.array(at)).flatten()
    x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, max(dims, 1))  # nulls become NaN
    fine = np.isfinite(x).all(axis=1) & (np.abs(x) > 0).any(axis=1)
    return at[fine], x[fine]


def unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True) if len(x) else np.ones((0, 1))
    scaled = x / np.where(top > 0, top, 1)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cosine(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines of a query with rows, in double precision: the same two vectors give the same result in any block."""
    return np.einsum("ij,ij->i", np.broadcast_to(queries, rows.shape), rows)


@dataclass
class Codec:
    """books: (pairs of dimensions, 16, 2); weight: what a parallel residual counts more than another."""

    books: np.ndarray
    dims: int
    weight: float

    def split(self, x: np.ndarray) -> np.ndarray:
        m = len(self.books)
        wide = np.zeros((len(x), 2 * m), np.float32)
        wide[:, : self.dims] = x
        return wide.reshape(len(x), m, 2)

    def encode(self, x: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """Codes of unit vectors: nearest first, then each code in turn is chosen again to lower the whole loss."""
        parts = self.split(x)
        codes = np.stack([((parts[:, m, None] - self.books[m][None]) ** 2).sum(axis=2).argmin(axis=1) for m in range(len(self.books))], axis=1)
        for _ in range(sweeps):
            along = self.parallel(parts, codes)
            total = along.sum(axis=1)
            for m, book in enumerate(self.books):
                rest = total - along[:, m]
                residual = parts[:, m, None] - book[None]
                side = (residual * parts[:, m, None]).sum(axis=2)
                codes[:, m] = ((residual**2).sum(axis=2) + self.weight * (rest[:, None] + side) ** 2).argmin(axis=1)
                along[:, m] = side[np.arange(len(x)), codes[:, m]]
                total = rest + along[:, m]
        return codes

    def parallel(self, parts: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Each pair's part of the inner product of residual and vector."""
        return np.stack([((parts[:, m] - self.books[m][codes[:, m]]) * parts[:, m]).sum(axis=1) for m in range(len(self.books))], axis=1)

    def spread(self, x: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of what each row's codes stand for, the length along the unit vector and the length across it."""
        stands = self.books[np.arange(len(self.books)), codes].reshape(len(x), -1)[:, : self.dims].astype(np.float64)
        along = np.einsum("ij,ij->i", stands, x)
        return along, np.linalg.norm(stands - along[:, None] * x, axis=1)

    def packed(self, codes: np.ndarray) -> np.ndarray:
        """Two codes to a byte."""
        if codes.shape[1] % 2:
            codes = np.concatenate([codes, np.zeros((len(codes), 1), codes.dtype)], axis=1)
        return np.ascontiguousarray((codes[:, ::2] * 16 + codes[:, 1::2]).astype(np.uint8).T)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """(query, byte, 256): partial inner products of a query with what a byte of codes stands for."""
        parts = self.split(queries)
        one = np.einsum("qmd,mkd->qmk", parts, self.books)
        if one.shape[1] % 2:
            one = np.concatenate([one, np.zeros((len(one), 1, 16), one.dtype)], axis=1)
        return (one[:, ::2, :, None] + one[:, 1::2, None, :]).reshape(len(queries), -1, 256).astype(np.float32)


def fit(x: np.ndarray, setup: Setup = Setup()) -> Codec:
    """Codebooks of unit vectors: codes by the loss, then each book by its normal equations, in turn."""
    dims = x.shape[1]
    t = setup.threshold
    codec = Codec(np.zeros((-(-dims // 2), 16, 2), np.float32), dims, max(0.0, (dims - 1) * t * t / (1 - t * t) - 1))
    parts = codec.split(x)
    rng = np.random.default_rng(11)
    for m in range(len(codec.books)):
        codec.books[m] = parts[rng.choice(len(x), 16, replace=len(x) < 16), m]
    for _ in range(setup.rounds):
        codes = codec.encode(x, 1)
        along = codec.parallel(parts, codes)
        total = along.sum(axis=1)
        for m in range(len(codec.books)):
            own = parts[:, m].astype(np.float64)
            aim = total - along[:, m] + (own**2).sum(axis=1)
            for k in range(16):
                rows = codes[:, m] == k
                if rows.any():
                    v = own[rows]
                    left = np.eye(2) * len(v) + codec.weight * v.T @ v
                    codec.books[m, k] = np.linalg.solve(left, v.sum(axis=0) + codec.weight * aim[rows] @ v)
            along[:, m] = ((parts[:, m] - codec.books[m][codes[:, m]]) * parts[:, m]).sum(axis=1)
            total = along.sum(axis=1)
    return codec


def _select(scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the n best; among equals at the edge, those that stand first."""
    if len(scores) <= n:
        return np.arange(len(scores))
    edge = np.partition(scores, len(scores) - n)[len(scores) - n]
    above = np.flatnonzero(scores > edge)
    return np.sort(np.concatenate([above, np.flatnonzero(scores == edge)[: n - len(above)]]))


def least(t: float, along: np.ndarray, across: np.ndarray, terms: int) -> np.ndarray:
    """The least approximate score that each row can have if its exact score is t or more.

    A query at an angle a to a row is at most a + b from what the row's codes stand for, where b is the row's own angle to that.
    """
    t = min(max(t, -1.0), 1.0)
    length = np.hypot(along, across)
    low = t * along - np.sqrt(1 - t * t) * across
    low[t * length < -along] = -np.inf  # a + b beyond a half turn
    return low - (terms + 8) * 2.0**-22 * (length + 1)  # sums of single precision


def scan(ids: np.ndarray, x: np.ndarray, codes: np.ndarray, spread: tuple[np.ndarray, np.ndarray], query_ids: np.ndarray, queries: np.ndarray, tables: np.ndarray, top: np.ndarray, setup: Setup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of the k best rows of a block, for each query. top: each query's k best exact scores so far, brought up to date."""
    k = top.shape[1]
    out = ([], [], [])
    for i, q in enumerate(query_ids):
        scores = tables[i, 0][codes[0]]
        for j in range(1, len(codes)):
            scores += tables[i, j][codes[j]]
        at = _select(scores, setup.rerank + 1)
        at = at[ids[at] != q]
        t = np.sort(np.concatenate([top[i], cosine(queries[i], x[at])]))[-k]
        at = np.flatnonzero(scores >= least(t, *spread, len(codes))) if t > -np.inf else np.arange(len(ids))
        at = at[ids[at] != q]
        exact = cosine(queries[i], x[at])
        best = np.lexsort((ids[at], -exact))[:k]
        out[0].append(np.full(len(best), q))
        out[1].append(ids[at][best])
        out[2].append(exact[best])
        top[i] = np.sort(np.concatenate([top[i], exact[best]]))[-k:]
    return tuple(np.concatenate(c) if c else np.zeros(0) for c in out)


def nearest(vectors: DataFrame, query: F.Column, k: int = 5, column: str = "embedding", setup: Setup = Setup()) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest rows by cosine of every row for which query holds."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("v"), query.alias("q")).where("vec_id is not null")
    spark = vectors.sparkSession
    drawn = rows.where("v is not null").orderBy(F.xxhash64("vec_id"), "vec_id").limit(setup.sample).select("v").toArrow().column(0)
    _, x = usable(drawn)
    if not len(x):
        return spark.createDataFrame([], RANKED)
    codec = fit(unit(x).astype(np.float32), setup)
    asked, rows = rows.where("q").select("vec_id", "v"), rows.select("vec_id", "v")
    parts = max(1, -(-asked.count() // setup.queries))
    if parts == 1:
        return _ranked(_found(rows, spark.sparkContext.broadcast((codec, *_queries(asked, codec))), k, setup), k)
    # Rows are coded once, whatever the number of queries; each part's results are ranked before they are written, since no query is in two parts.
    kind = rows.schema["v"].dataType.simpleString()
    coded = scratch.stored(rows.mapInArrow(lambda batches: _coded(batches, codec, setup), f"vec_id long, v {kind}, codes binary, along double, across double"), "ann-codes")
    asked = scratch.stored(asked, "ann-queries")
    path = scratch.folder(spark, "ann")
    for part in range(parts):
        shared = spark.sparkContext.broadcast((codec, *_queries(asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part), codec)))
        _ranked(_found(coded, shared, k, setup), k).write.parquet(f"{path}/part-{part}")
        shared.destroy()
    scratch.drop(coded)
    scratch.drop(asked)
    return spark.read.schema(RANKED).parquet(f"{path}/part-*")


def _queries(asked: DataFrame, codec: Codec) -> tuple[np.ndarray, np.ndarray]:
    """(ids, unit vectors) of the queries that take part."""
    got = asked.toArrow()
    at, x = usable(got.column(1), codec.dims)
    ids, first = np.unique(got.column(0).to_numpy()[at], return_index=True)
    return ids, unit(x[first])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _found(rows: DataFrame, shared: Broadcast, k: int, setup: Setup) -> DataFrame:
    """The best of each block of rows, coded or not yet, for the queries of (codec, ids, unit vectors)."""
    fresh = "codes" not in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, query_ids, queries = shared.value
        return _scanned(_coded(batches, codec, setup) if fresh else batches, codec, query_ids, queries, k, setup)

    return rows.mapInArrow(run, SCHEMA)


def _coded(batches: Iterator[pa.RecordBatch], codec: Codec, setup: Setup) -> Iterator[pa.RecordBatch]:
    """The rows that take part, by id in each block, with their codes and spread."""
    for batch in batches:
        at, x = usable(batch.column(1), codec.dims)
        order = np.argsort(batch.column(0).to_numpy()[at], kind="stable")
        at, x = at[order], unit(x[order])
        for lo in range(0, len(at), setup.block):
            own = x[lo : lo + setup.block]
            codes = codec.encode(own.astype(np.float32))
            along, across = codec.spread(own, codes)
            part = batch.take(pa.array(at[lo : lo + setup.block]))
            code = pa.array([c.tobytes() for c in codec.packed(codes).T], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), code, pa.array(along), pa.array(across)], names=["vec_id", "v", "codes", "along", "across"])


def _scanned(batches: Iterator[pa.RecordBatch], codec: Codec, query_ids: np.ndarray, queries: np.ndarray, k: int, setup: Setup) -> Iterator[pa.RecordBatch]:
    """(query, id, score) of the best coded rows of each block, for each query."""
    top = np.full((len(query_ids), k), -np.inf)
    for batch in batches:
        for lo in range(0, batch.num_rows, setup.block):
            part = batch.slice(lo, setup.block)
            ids, x = part.column(0).to_numpy(), unit(usable(part.column(1), codec.dims)[1])
            codes = np.ascontiguousarray(np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(len(ids), -1).T)
            spread = part.column(3).to_numpy(), part.column(4).to_numpy()
            for some in range(0, len(query_ids), 256):  # tables of 4 MB at a time
                own = slice(some, some + 256)
                tables = codec.tables(queries[own].astype(np.float32))
                q, v, s = scan(ids, x, codes, spread, query_ids[own], queries[own], tables, top[own], setup)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "vec_id", "score"])
