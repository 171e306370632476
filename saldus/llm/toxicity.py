"""Toxicity: a convolutional text classifier trained in numpy.

A word's embedding is the sum of hashed embeddings of the word and of its beginnings, so unseen forms of a seen
stem are recognised. Filters of several widths slide over the words; each filter's largest response in the text
(max pooling) goes into a logistic score, so a single passage counts in a text of any length. Thresholds are
calibrated by language, as guessed from the text alone, and folded into the score: the threshold is 0.3 everywhere.

Training takes labelled rows of a documented bound (`Setup.positives`, `negatives`, `train_bytes`), chosen by hash of doc_id,
never a held-out row; scoring takes every whole text in one pass without a shuffle.

Defined cases: a null or empty text has no words and gets the score of all filters silent; with no labelled rows of
both classes all scores are 0; repeated rows score alike; an empty table gives no rows; a row without doc_id isn't held out;
other columns pass through `filtered` untouched and are not read by `scored`.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldus.llm import kernel

BEGINNINGS = (3, 4, 5, 6)
CUT = 0.3
#: Words scored at once take about 0.5 kB each; blocks of text are kept small for that.
SCORE_BLOCK = 1 << 20
_EDGE = np.zeros(256, bool)
_EDGE[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


@dataclass(frozen=True)
class Setup:
    positives: int = 2500
    negatives: int = 5000
    train_bytes: int = 8192  # longest text that is trained on
    bits: int = 18  # of an embedding's hash
    dims: int = 8
    filters: int = 8  # of each width
    widths: tuple[int, ...] = (1, 2, 3)
    epochs: int = 4
    batch: int = 64
    rate: float = 0.05
    language_bits: int = 14
    language_least: int = 30  # labelled rows of a language, for a threshold of its own


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def words(t: kernel.Text, bits: int) -> np.ndarray:
    """Embedding rows of each word: of the whole and of its beginnings (0 where it is shorter), without marks at its ends."""
    start, end = t.start.copy(), t.end.copy()
    for _ in range(2):
        start += _EDGE[t.data[start]] & (end - start > 1)
        end -= _EDGE[t.data[end - 1]] & (end - start > 1)
    out = np.zeros((len(start), 1 + len(BEGINNINGS)), np.int32)
    shift = kernel.U(64 - bits)
    out[:, 0] = t.hashes(start, end) >> shift
    for j, k in enumerate(BEGINNINGS):
        enough = np.flatnonzero(end - start >= k)
        salted = kernel.mixed(t.hashes(start[enough], start[enough] + k) + kernel.U(k))
        out[enough, j + 1] = salted >> shift
    return out


@dataclass
class Model:
    setup: Setup
    embedding: np.ndarray  # row 0 stays 0
    kernels: list[np.ndarray]  # of each width: (width, dims, filters)
    biases: list[np.ndarray]
    head: np.ndarray
    offset: float
    language: np.ndarray  # (rows, languages): log-likelihoods
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def responses(self, x: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
        """Filter responses at each place; below any other where the filter would leave the text."""
        k = self.kernels[self.setup.widths.index(width)]
        n = len(x) - width + 1
        if n <= 0:
            return np.full((len(x), self.setup.filters), -np.inf, np.float32)
        z = np.full((len(x), self.setup.filters), -np.inf, np.float32)
        z[:n] = x[:n] @ k[0]
        for j in range(1, width):
            z[:n] += x[j : n + j] @ k[j]
            z[:n][doc[:n] != doc[j : n + j]] = -np.inf
        return z + self.biases[self.setup.widths.index(width)]

    def logits(self, t: kernel.Text) -> tuple[np.ndarray, np.ndarray]:
        """(uncalibrated logit, guessed language) of each text of a block."""
        rows = words(t, self.setup.bits)
        x = self.embedding[rows].sum(axis=1)
        filled = np.flatnonzero(t.n_words)
        first = np.searchsorted(t.doc, filled)
        pooled = np.zeros((t.n, len(self.head)), np.float32)
        for i, w in enumerate(self.setup.widths):
            if len(filled):
                best = np.maximum.reduceat(self.responses(x, t.doc, w), first, axis=0)
                pooled[filled, i * self.setup.filters : (i + 1) * self.setup.filters] = np.maximum(best, 0)
        like = np.zeros((t.n, self.language.shape[1]), np.float32)
        if len(filled):
            like[filled] = np.add.reduceat(self.language[rows[:, 0] >> (self.setup.bits - self.setup.language_bits)], first, axis=0)
        return pooled @ self.head + self.offset, like.argmax(axis=1)

    def score(self, t: kernel.Text) -> np.ndarray:
        z, lang = self.logits(t)
        shifted = z.astype(np.float64) - self.thresholds[lang] + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(shifted, -50, 50)))


def _texts(texts: list[str]) -> Iterator[tuple[int, kernel.Text]]:
    """(first text, block) of small blocks."""
    for lo, _, raw, offsets in kernel.blocks(pa.array(texts, pa.large_string()), SCORE_BLOCK):
        yield lo, kernel.Text(raw, offsets, lower=True)


def train(texts: list[str], toxic: np.ndarray, languages: list[str | None], setup: Setup = Setup()) -> Model | None:
    """A model of labelled texts; None where a class is missing. The same rows give the same model."""
    toxic = np.asarray(toxic).astype(np.float32)
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    rng = np.random.default_rng(7)
    order = rng.permutation(len(texts))
    parts = [(words(t, setup.bits), t.doc + lo) for lo, t in _texts(texts)]
    rows, doc = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    names = sorted({x for x in languages if x is not None})
    names = [x for x in names if languages.count(x) >= setup.language_least] or [""]
    seen = np.full((1 << setup.language_bits, len(names)), 0.1)
    of = np.array([names.index(x) if x in names else -1 for x in languages])
    for k in range(len(names)):
        seen[:, k] += np.bincount(rows[of[doc] == k, 0] >> (setup.bits - setup.language_bits), minlength=1 << setup.language_bits)
    pos, neg = np.zeros(1 << setup.bits, np.int64), np.zeros(1 << setup.bits, np.int64)
    for x, d in parts:
        own = np.unique((d[:, None] << setup.bits | x).reshape(-1))
        row, is_toxic = own & ((1 << setup.bits) - 1), toxic[own >> setup.bits] > 0
        pos += np.bincount(row[is_toxic], minlength=len(pos))
        neg += np.bincount(row[~is_toxic], minlength=len(neg))
    model = _start(pos, neg, toxic, setup, np.log(seen / seen.sum(axis=0)).astype(np.float32), rng)
    fit, check = order[: -(len(order) // 5) or None], order[-(len(order) // 5) or len(order) :]
    _descend(model, rows, first, toxic, fit, rng)
    z, lang = (np.concatenate(x) for x in zip(*(model.logits(t) for _, t in _texts(texts)), strict=True))
    model.thresholds = np.array([_threshold(z, toxic, lang, check, fit, k) for k in range(len(names))])
    return model


def _start(pos: np.ndarray, neg: np.ndarray, toxic: np.ndarray, setup: Setup, language: np.ndarray, rng: np.random.Generator) -> Model:
    """Small random weights, but for one dimension that starts from each embedding row's log-odds and one filter that reads it.

    pos, neg: how many texts of either class an embedding row occurs in.
    """
    size = len(pos)
    odds = np.log((pos + 0.5) / (toxic.sum() + 1)) - np.log((neg + 0.5) / ((1 - toxic).sum() + 1))
    embedding = rng.normal(0, 0.02, (size, setup.dims)).astype(np.float32)
    embedding[:, 0] += np.where(pos + neg >= 4, np.clip(odds, -3, 6), 0).astype(np.float32) / 4
    embedding[0] = 0
    kernels = [rng.normal(0, 0.2, (w, setup.dims, setup.filters)).astype(np.float32) for w in setup.widths]
    for k in kernels:
        k[0, 0, 0] = 1.0
    head = np.zeros(setup.filters * len(setup.widths), np.float32)
    head[:: setup.filters] = 1.0
    head += rng.normal(0, 0.05, len(head)).astype(np.float32)
    return Model(setup, embedding, kernels, [np.zeros(setup.filters, np.float32) for _ in setup.widths], head, -2.0, language)


def _descend(model: Model, rows: np.ndarray, first: np.ndarray, toxic: np.ndarray, fit: np.ndarray, rng: np.random.Generator) -> None:
    """Stochastic gradient steps with a rate that falls where gradients have been large (Adagrad)."""
    setup, eps = model.setup, 1e-6
    past = {"e": np.full(len(model.embedding), eps, np.float32), "h": np.full_like(model.head, eps), "o": eps, "k": [np.full_like(k, eps) for k in model.kernels], "b": [np.full_like(b, eps) for b in model.biases]}
    weight = np.where(toxic > 0, 0.5 / max(toxic[fit].mean(), 1e-3), 0.5 / max(1 - toxic[fit].mean(), 1e-3)).astype(np.float32)
    f = setup.filters
    for _ in range(setup.epochs):
        for part in np.array_split(rng.permutation(fit), max(1, len(fit) // setup.batch)):
            part = part[first[part + 1] > first[part]]
            if not len(part):
                continue
            lengths = first[part + 1] - first[part]
            at = np.concatenate([np.arange(first[d], first[d + 1]) for d in part])
            doc = np.repeat(np.arange(len(part)), lengths)
            edge = np.concatenate([[0], np.cumsum(lengths)])
            own = rows[at]
            x = model.embedding[own].sum(axis=1)
            pooled = np.zeros((len(part), len(model.head)), np.float32)
            where = np.zeros((len(part), len(model.head)), np.int64)
            for i, w in enumerate(setup.widths):
                z = model.responses(x, doc, w)
                for d in range(len(part)):
                    best = z[edge[d] : edge[d + 1]].argmax(axis=0)
                    where[d, i * f : (i + 1) * f] = best + edge[d]
                    pooled[d, i * f : (i + 1) * f] = np.maximum(z[edge[d] + best, np.arange(f)], 0)
            p = 1 / (1 + np.exp(-(pooled @ model.head + model.offset)))
            g = ((p - toxic[part]) * weight[part] / len(part)).astype(np.float32)
            back = np.where(pooled > 0, g[:, None] * model.head, 0).astype(np.float32)
            gh, go = pooled.T @ g, g.sum()
            dx = np.zeros_like(x)
            for i, w in enumerate(setup.widths):
                own_back, own_where = back[:, i * f : (i + 1) * f], where[:, i * f : (i + 1) * f]
                gk = np.zeros_like(model.kernels[i])
                live = own_back != 0
                for j in range(w):
                    place = np.minimum(own_where + j, len(x) - 1)
                    gk[j] = np.einsum("df,dfe->ef", own_back, x[place] * live[:, :, None])
                    d, k = np.nonzero(live)
                    np.add.at(dx, place[d, k], own_back[d, k][:, None] * model.kernels[i][j].T[k])
                past["k"][i] += gk**2
                model.kernels[i] -= setup.rate * gk / np.sqrt(past["k"][i])
                gb = own_back.sum(axis=0)
                past["b"][i] += gb**2
                model.biases[i] -= setup.rate * gb / np.sqrt(past["b"][i])
            past["h"] += gh**2
            model.head -= setup.rate * gh / np.sqrt(past["h"])
            past["o"] += go**2
            model.offset -= float(setup.rate * go / np.sqrt(past["o"]))
            touched = np.flatnonzero(dx.any(axis=1))
            ids, inverse = np.unique(own[touched].reshape(-1), return_inverse=True)
            ge = np.zeros((len(ids), setup.dims), np.float32)
            np.add.at(ge, inverse.reshape(-1), np.repeat(dx[touched], own.shape[1], axis=0))
            past["e"][ids] += (ge**2).mean(axis=1)
            model.embedding[ids] -= setup.rate * ge / np.sqrt(past["e"][ids])[:, None]
            model.embedding[0] = 0


def _threshold(z: np.ndarray, toxic: np.ndarray, lang: np.ndarray, check: np.ndarray, fit: np.ndarray, k: int) -> float:
    """A cut best by F1, nearer to the scores below than to those above, on rows of the language that weren't fitted; on all of its rows, or all, where those lack a class."""
    for rows in (check[lang[check] == k], np.concatenate([check, fit])[lang[np.concatenate([check, fit])] == k], np.concatenate([check, fit])):
        y = toxic[rows] > 0
        if y.any() and not y.all():
            order = np.argsort(-z[rows], kind="stable")
            s, hit = z[rows][order].astype(np.float64), np.cumsum(y[order])
            f1 = 2 * hit / (np.arange(1, len(rows) + 1) + y.sum())
            f1[:-1][s[:-1] == s[1:]] = 0  # no cut between equal scores
            i = int(f1.argmax())
            return float(s[i] - 1e-6 if i + 1 == len(s) else s[i + 1] + 0.3 * (s[i] - s[i + 1]))
    return 0.0


def fitted(docs: DataFrame, labels: DataFrame, setup: Setup = Setup()) -> Model | None:
    """A model of the labelled rows of docs that aren't held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(setup.positives).union(known.where("toxic = 0").orderBy(*order).limit(setup.negatives))
    fits = docs.where(F.octet_length("text") <= setup.train_bytes).select("doc_id", "text", "lang")
    # Of rows that share a doc_id the smallest text counts, so reruns train the same model.
    rows = fits.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("x"), F.min("toxic").alias("toxic")).select("doc_id", "x.text", "x.lang", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if sum(x.num_rows for x in held):
            table = pa.Table.from_batches(held).to_pydict()
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(table["text"], np.array(table["toxic"]), table["lang"], setup))], pa.binary())], names=["model"])

    # A task trains on the sample, which is bounded by setup; the driver gets the model alone.
    made = rows.repartition(1).sortWithinPartitions("doc_id").mapInArrow(run, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else None


def _scores(column: pa.Array, model: Model | None) -> np.ndarray:
    if model is None:
        return np.zeros(len(column))
    return np.concatenate([np.zeros(0), *(model.score(kernel.Text(raw, offsets, lower=True)) for _, _, raw, offsets in kernel.blocks(column, SCORE_BLOCK))])


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _scores(batch.column(2), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(s), pa.array((s >= CUT).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def filtered(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of docs, with all their columns, that aren't predicted to be toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.schema.names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(at), shared.value) < CUT))

    return docs.mapInArrow(run, docs.schema)
