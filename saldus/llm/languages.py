"""Language ID of web pages by Bayesian evidence fusion.

The visible text of a page has a likelihood under each language (hashed words and their beginnings, naive Bayes, tempered because words aren't
independent; how much, the agreement with all pages' declarations tells). It is fused with what the page declares in its markup, with its address suffix, and with a prior of its host. The host prior is smoothed
by that of its registered domain, the domain's by that of its suffix, and the suffix's by all pages'; a page's own posterior is left out of the counts that make its prior. Priors and the reliability of declarations are
counted over all pages by grouped aggregation of the text posteriors, with partial sums, so a frequent host is no burden.

Word likelihoods are fitted on labelled documents of a documented bound (`Setup.sample`, `train_bytes`); all counts are over all pages.

Defined cases: a null or empty page has no text evidence and is decided by the rest; a page without a host, suffix or declaration lacks that evidence; a declaration of
a language that isn't among those fitted is one value, `other`; a page of any length is read whole, in time that grows with its length; without labelled documents there are no rows; repeated rows are counted and judged each; an
empty table gives no rows; only page_id, url and html are read. Equal posteriors go to the first language by name.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldus.llm import kernel, scratch
from saldus.llm.toxicity import words

BITS = 16
_OPENS = re.compile(r"(?i)<!--|<(script|style|noscript|template|head|nav)\b")
_CLOSES = re.compile(r"(?i)</(script|style|noscript|template|head|nav)\s*>|<(body)\b")
#: The rest of a head's tag and what can stand in a head, as far as it goes.
_HEAD = re.compile(r"(?is)[^>]*>(?:\s+|<!--.*?-->|<(script|style|noscript|template|title)\b.*?</\1\s*>|</?(?:meta|link|base|basefont|bgsound)\b[^>]*>)*+")
_TAG = re.compile(r"(?s)<[^>]*>?")
#: Each is linear: a tag is found first, up to the next bracket of either kind, and then looked into.
_BODY = re.compile(r"(?i)<body\b")
_ROOT = re.compile(r"(?i)<html\b([^<>]*)>")
_META = re.compile(r"(?i)<meta\b([^<>]*)>")
_LANG = re.compile(r"""(?i)(?<![\w-])(?:xml:)?lang\s*=\s*["']?\s*([a-z]{2,3})""")
_CONTENT = re.compile(r"""(?i)(?<![\w-])content\s*=\s*["']?\s*([a-z]{2,3})""")
#: Second labels that stand before a country's label in the suffix under which names are registered.
SECOND_LABELS = ("ac", "co", "com", "edu", "gob", "gov", "net", "or", "org")


@dataclass(frozen=True)
class Setup:
    sample: int = 4000  # labelled documents that likelihoods are fitted on
    train_bytes: int = 8192  # of the longest of them
    temper: float = 0.25  # of a word's log-likelihood
    strength: float = 10.0  # pages that a level of the host hierarchy counts as


@dataclass
class Likelihoods:
    names: list[str]
    table: np.ndarray  # (hashed features, languages)

    def of(self, texts: list[str], setup: Setup) -> np.ndarray:
        """(text, language): tempered log-likelihoods; their largest is 0."""
        out = np.zeros((len(texts), len(self.names)))
        for lo, _, raw, offsets in kernel.blocks(pa.array(texts, pa.large_string()), 1 << 20):
            t = kernel.Text(raw, offsets, lower=True)
            filled = np.flatnonzero(t.n_words)
            if len(filled):
                each = self.table[words(t, BITS)].sum(axis=1)
                out[lo + filled] = np.add.reduceat(each, np.searchsorted(t.doc, filled), axis=0)
        out *= setup.temper
        return out - out.max(axis=1, keepdims=True)


def fit(texts: list[str], languages: list[str]) -> Likelihoods:
    names = sorted(set(languages))
    of = np.array([names.index(x) for x in languages])
    seen = np.zeros((1 << BITS, len(names)))
    for lo, _, raw, offsets in kernel.blocks(pa.array(texts, pa.large_string()), 1 << 20):
        t = kernel.Text(raw, offsets, lower=True)
        rows = words(t, BITS)
        for k in range(len(names)):
            seen[:, k] += np.bincount(rows[of[t.doc + lo] == k].reshape(-1), minlength=1 << BITS)
    seen[0] = 0  # features that short words lack
    table = np.log(seen + 0.5) - np.log(seen.sum(axis=0) + 0.5 * len(seen))
    table[0] = 0
    return Likelihoods(names, table.astype(np.float32))


def _shown(html: str) -> str:
    """html without comments and hidden elements. A head that isn't closed ends where its content does; of an unclosed nav or template only the tag is hidden."""
    closes: dict[str, list[tuple[int, int]]] = {}
    for m in _CLOSES.finditer(html):
        closes.setdefault((m[1] or m[2]).lower(), []).append(m.span())

    def after(name: str, place: int) -> tuple[int, int] | None:
        own = closes.get(name, [])
        i = bisect_left(own, (place, 0))
        return own[i] if i < len(own) else None

    out, kept, headed, m = [], 0, False, _OPENS.search(html)
    while m:
        name, end = (m[1] or "").lower(), None
        if not name:
            at = html.find("-->", m.end())
            end = at + 3 if at >= 0 else len(html)
        elif name == "head":
            close, body = after(name, m.end()), after("body", m.end())
            if close and (body is None or close < body):
                end = close[1]
            elif not headed:  # a page has one head; of another that isn't closed only the tag is hidden
                headed, own = True, _HEAD.match(html, m.end())
                end = own.end() if own else len(html)
        elif close := after(name, m.end()):
            end = close[1]
        elif name not in ("nav", "template"):
            end = len(html)
        if end is not None:
            out.append(html[kept : m.start()])
            kept = end
        m = _OPENS.search(html, m.end() if end is None else end)
    return " ".join([*out, html[kept:]])


def visible(html: str) -> str:
    return unescape(_TAG.sub(" ", _shown(html)))


def declared(html: str) -> str | None:
    body = _BODY.search(html)
    head = html[: body.start()] if body else html
    root = _ROOT.search(head)
    m = _LANG.search(root[1]) if root else None
    if not m:
        own = next((x[1] for x in _META.finditer(head) if "content-language" in x[1].lower()), None)
        m = _CONTENT.search(own) if own else None
    return m[1].lower() if m else None


def _evidence(pages: DataFrame, model: Likelihoods, setup: Setup) -> DataFrame:
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                html = [x or "" for x in part.column(2).to_pylist()]
                said = [declared(x) for x in html]
                said = [x if x is None or x in model.names else "other" for x in said]
                like = model.of([visible(x) for x in html], setup)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(1), pa.array(said, pa.string()), pa.array(list(like), pa.list_(pa.float64()))], names=["page_id", "host", "declared", "like"])

    host = F.lower(F.nullif(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))
    found = pages.select("page_id", host.alias("host"), "html").mapInArrow(run, "page_id long, host string, declared string, like array<double>")
    labels = F.split("host", r"\.")
    return found.withColumns({"suffix": F.when(F.size(labels) > 1, F.element_at(labels, -1)), "domain": domain(labels)})


def domain(labels: Column) -> Column:
    """The registered domain of a host's labels: the last two, or three where a country's label stands behind a general one; null for a host of one label."""
    country = (F.length(F.element_at(labels, -1)) == 2) & F.try_element_at(labels, F.lit(-2)).isin(*SECOND_LABELS)
    n = F.least(F.size(labels), F.when(country, 3).otherwise(2))
    return F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -n, n), "."))


def _posterior(logs: Column) -> Column:
    top = F.array_max(logs)
    odds = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(odds, lambda x: x / F.aggregate(odds, F.lit(0.0), lambda a, y: a + y))


#: Scales of the text evidence that are tried.
SCALES = (1.0, 0.5, 0.25, 0.125, 0.0625, 0.03125)


def _scale(found: DataFrame, names: list[str]) -> float:
    """The scale of log-likelihoods that agrees best with what pages declare: the one under which the declared languages are likeliest, over all pages.

    Words aren't independent and a page may hold passages of other languages, so their sum says too much; how much too much, the declarations tell.
    """
    place = F.array_position(F.array(*(F.lit(x) for x in names)), F.col("declared"))
    known = found.where(F.col("declared").isin(*names)).select("like", place.cast("int").alias("at"))
    tried = known.agg(*(F.sum(F.element_at("like", F.col("at")) * g - F.ln(F.aggregate("like", F.lit(0.0), lambda a, x: a + F.exp(x * g)))).alias(f"g{i}") for i, g in enumerate(SCALES))).first()
    return max(zip((x if x is not None else 0.0 for x in tried), SCALES, strict=True))[1]


def _counts(rows: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """Sums of posteriors by key."""
    sums = rows.where(F.col(key).isNotNull()).groupBy(key).agg(*(F.sum(F.col("soft")[i]).alias(f"s{i}") for i in range(n)))
    return sums.select(F.col(key), F.array(*(F.col(f"s{i}") for i in range(n))).alias(name))


def _smoothed(counts: Column, parent: Column, strength: float) -> Column:
    """Shares of the counts of all other pages, with the parent's shares counted as `strength` pages; the parent's where there are none."""
    own = F.zip_with(counts, F.col("soft"), lambda x, y: F.greatest(x - y, F.lit(0.0)))
    total = F.aggregate(own, F.lit(0.0), lambda a, y: a + y)
    return F.when(own.isNull(), parent).otherwise(F.zip_with(own, parent, lambda x, p: (x + strength * p) / (total + strength)))


def identify(pages: DataFrame, documents: DataFrame, setup: Setup = Setup()) -> DataFrame:
    """page_id, lang, confidence, text_lang, declared, host and suffix of every row of pages."""
    chosen = documents.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.octet_length("text") <= setup.train_bytes))
    ids = chosen.select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(setup.sample).select("doc_id").distinct()
    rows = chosen.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    schema = "page_id long, lang string, confidence double, text_lang string, declared string, host string, suffix string"
    if not rows:
        return pages.sparkSession.createDataFrame([], schema)
    model = fit([r["text"] for r in rows], [r["lang"] for r in rows])
    n = len(model.names)
    found = scratch.stored(_evidence(pages, model, setup), "pages")
    scale = _scale(found, model.names)
    found = found.withColumn("like", F.transform("like", lambda x: x * scale)).withColumn("soft", _posterior(F.col("like")))
    total = [x or 0.0 for x in found.agg(*(F.sum(F.col("soft")[i]) for i in range(n))).first()]
    shares = F.array(*(F.lit((x + 1) / (sum(total) + n)) for x in total))

    def trust(column: str) -> Column:
        """For each value of a column, the log-probability of the value under each language: a map of as many entries as languages."""
        seen = found.where(F.col(column).isNotNull()).groupBy(column).agg(*(F.sum(F.col("soft")[i]).alias(f"s{i}") for i in range(n)))
        values = [x.asDict() for x in seen.where(F.col(column).isin([*model.names, "other"])).collect()]
        entries = []
        for x in values:
            entries += [F.lit(x[column]), F.array(*(F.lit(float(np.log((x[f"s{i}"] + 1) / (total[i] + n + 1)))) for i in range(n)))]
        return F.create_map(*entries) if entries else F.lit(None).cast("map<string,array<double>>")

    zero = F.array(*(F.lit(0.0) for _ in range(n)))
    said = F.coalesce(F.try_element_at(trust("declared"), F.col("declared")), zero)
    out = found
    for key in ("suffix", "domain", "host"):
        out = out.join(_counts(found, key, n, f"by_{key}"), key, "left")
    suffix = _smoothed(F.col("by_suffix"), shares, setup.strength)
    out = out.withColumn("p_suffix", suffix).withColumn("p_domain", _smoothed(F.col("by_domain"), F.col("p_suffix"), setup.strength)).withColumn("prior", _smoothed(F.col("by_host"), F.col("p_domain"), setup.strength))
    fused = F.zip_with(F.zip_with(F.col("like"), said, lambda a, b: a + b), F.col("prior"), lambda a, p: a + F.ln(p))
    names = F.array(*(F.lit(x) for x in model.names))
    best = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    out = out.withColumn("fused", _posterior(fused))
    return out.select("page_id", best(F.col("fused")).alias("lang"), F.array_max("fused").alias("confidence"), best(F.col("like")).alias("text_lang"), "declared", "host", "suffix")
