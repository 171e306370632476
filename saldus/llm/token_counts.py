"""Token counts by a compiled finite-state tokenizer (see transducer).

Defined cases: a null text counts as empty and has no tokens; an empty table gives no rows; repeated rows are counted one by
one; a text of any length is counted whole, with memory in proportion to the longest text. Special strings of the tokenizer inside a
text are one token each and split it, as its library does by default. Only doc_id and text are read, so other columns clash with nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from saldus.llm import kernel, transducer

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def counted(raw: np.ndarray, offsets: np.ndarray, merges: transducer.Merges, special: list[str]) -> np.ndarray:
    """Tokens of each text of a block."""
    n = np.zeros(len(offsets) - 1, np.int64)
    stops = offsets[1:]
    if special:
        pattern = re.compile(b"|".join(re.escape(x.encode()) for x in sorted(special, key=len, reverse=True)))
        found = []
        data = raw.tobytes()
        if pattern.search(data):
            found = [(lo + m.start(), lo + m.end()) for lo, hi in zip(offsets, offsets[1:], strict=False) for m in pattern.finditer(data[lo:hi])]
        if found:
            a, b = np.array(found).T
            n += np.bincount(np.searchsorted(offsets, a, "right") - 1, minlength=len(n))
            own = np.ones(len(raw), bool)
            for lo, hi in found:
                own[lo:hi] = False
            before = np.concatenate([[0], np.cumsum(own)])
            stops = np.sort(np.concatenate([before[stops], before[a]]))
            raw, offsets = raw[own], before[offsets]
    points = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    at = np.concatenate([[0], np.cumsum(width)])
    begins = transducer.boundaries(points, np.searchsorted(at, stops))
    start = at[:-1][begins]
    tokens = merges.counts(raw, start, np.diff(np.append(start, len(raw))))
    doc = np.searchsorted(offsets, start, "right") - 1
    return n + np.rint(np.bincount(doc, weights=tokens, minlength=len(n))).astype(np.int64)


def counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of docs (doc_id, text); tokenizer: path of its file on every worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, special = transducer.load(tokenizer)
        for batch in batches:
            for lo, hi, raw, offsets in kernel.blocks(batch.column(1)):
                n = counted(raw, offsets, merges, special)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).cast(pa.int64()), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
