"""Quality rules: line-first cleaning.

Every line of a text is held against punctuation, navigation and boilerplate rules; lines that fail are
removed, and a text that loses too much of its words goes. One pass over whole texts, without a shuffle.

Defined cases: a null text counts as empty, has no words and fails; an empty table gives no rows; repeated
rows are judged one by one; a text of any length is judged whole, with memory in proportion to the longest; other columns pass through untouched, and clash with nothing because results of
`clean` keep the input's columns and those of `measure` are doc_id and the measures alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from saldus.llm import kernel

#: Phrases of site furniture in the languages of the corpus, in lower case.
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "click here to",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "this site uses cookies",
    "alle cookies akzeptieren",
    "alle rechte vorbehalten",
    "allgemeine geschäftsbedingungen",
    "datenschutzerklärung",
    "diese website verwendet cookies",
    "klicken sie hier",
    "newsletter abonnieren",
    "accepter tous les cookies",
    "ce site utilise des cookies",
    "cliquez ici pour",
    "conditions générales d'utilisation",
    "inscrivez-vous à notre newsletter",
    "politique de confidentialité",
    "tous droits réservés",
    "aceptar todas las cookies",
    "este sitio utiliza cookies",
    "haga clic aquí",
    "política de cookies",
    "política de privacidad",
    "suscríbase a nuestro boletín",
    "todos los derechos reservados",
    "términos y condiciones",
)


@dataclass(frozen=True)
class Rules:
    """Thresholds of the line rules and of the verdict on the text."""

    decorated_share: float = 0.2  # of a line's words that carry runs of marks, at most
    separator_share: float = 0.15  # of a line's words that are bare separators, at most
    least_unpunctuated: int = 4  # words of a line without a final mark, at least
    kept_share: float = 0.5  # of a text's words in kept lines, at least


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lines_removed", "n_words_kept")
MEASURE_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType())] + [T.StructField(m, T.LongType()) for m in MEASURES] + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?#*$%&|<>=~^_+@")] = True
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(b"|<>/\\*~=")] = True
_FINAL = np.zeros(256, bool)
_FINAL[list(b".!?:;\"')]}")] = True
#: Full stops, ellipses, question and exclamation marks, colons, closing quotes and brackets beyond ASCII.
_FINAL_WIDE = np.array(sorted(map(ord, "»«’”“‘›‹…‥‼‽⁇⁈⁉。．｡！？：；）］｝」』】〉》〕〗〙〛｣՜՝՞։׃؟؛۔܀܁܂।॥၊။።፧፨។៕᠃᠉꓿⸮")), np.uint32)
_CONTINUES = (np.arange(256) & 0xC0) == 0x80


def _before(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _ends_final(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the code point whose last byte stands at each place is a final mark."""
    out = _FINAL[raw[at]]
    wide = np.flatnonzero(raw[at] >= 0x80)
    place = at[wide]
    code = np.zeros(len(wide), np.uint32)
    open_ = np.ones(len(wide), bool)
    for i in range(4):  # from the last byte to the first
        byte = raw[np.maximum(place - i, 0)].astype(np.uint32)
        lead = open_ & ((byte & 0xC0) != 0x80)
        own = np.where(lead, byte & (0xFF >> (i + 2)), byte & 0x3F)
        code |= np.where(open_, own << np.uint32(6 * i), 0).astype(np.uint32)
        open_ &= ~lead
    out[wide] = np.isin(code, _FINAL_WIDE)
    return out


def judged(raw: np.ndarray, offsets: np.ndarray, rules: Rules) -> dict[str, np.ndarray]:
    """The measures of each text of a block, and the place and verdict of each line."""
    t = kernel.Text(raw, offsets)
    out = {"n_words": t.n_words}
    chars = _before(t.word_byte & ~_CONTINUES[raw])
    symbols = _before(_SYMBOL[raw])
    out["word_chars"] = chars[offsets[1:]] - chars[offsets[:-1]]
    out["n_symbols"] = symbols[offsets[1:]] - symbols[offsets[:-1]]

    grams, at = kernel.run_classes(t.classes(t.start, t.end), t.doc, 5)
    many, _ = kernel.repeats(grams)
    n = len(t.start) + 6
    cover = np.bincount(at[many], minlength=n) - np.bincount(at[many] + 5, minlength=n)
    covered = np.cumsum(cover)[: len(t.start)] > 0
    out["n_repeat_words"] = t.per_text(t.doc[covered])

    start, end, doc = t.lines()
    first, last = np.searchsorted(t.start, start), np.searchsorted(t.start, end)
    words = last - first
    filled = words > 0
    _, again = kernel.repeats(t.classes(start, end, doc))
    again &= filled
    out["n_dup_lines"] = t.per_text(doc[again])

    tail = t.end - 1
    marked = _MARK[raw]
    pair = np.zeros(len(raw) + 1, bool)
    pair[1:-1] = marked[1:] & marked[:-1]  # a mark after a mark
    runs = _before(pair[: len(raw)])
    decorated = _before(runs[t.end] > runs[t.start + 1]) if len(tail) else np.zeros(1, np.int64)
    single = _before((t.end - t.start == 1) & _SEPARATOR[raw[t.start]]) if len(tail) else np.zeros(1, np.int64)
    n_decorated, n_single = decorated[last] - decorated[first], single[last] - single[first]
    final = np.zeros(len(start), bool)
    final[filled] = _ends_final(raw, tail[last[filled] - 1])

    punctuation = n_decorated > rules.decorated_share * words
    navigation = ((n_single > rules.separator_share * words) & (n_single >= 2)) | ((words < rules.least_unpunctuated) & ~final)
    boilerplate = again.copy()
    low = kernel.LOWER[raw].tobytes()
    for phrase in BOILERPLATE:
        p = phrase.encode()
        i = low.find(p)
        while i >= 0:
            j = int(np.searchsorted(start, i, "right")) - 1
            if i + len(p) <= end[j]:
                boilerplate[j] = True
            i = low.find(p, i + 1)
    failed = filled & (punctuation | navigation | boilerplate)

    out["n_lines"] = t.per_text(doc[filled])
    out["n_lines_removed"] = t.per_text(doc[failed])
    out["n_words_kept"] = t.n_words - t.per_text(doc, words * failed)
    out["base_failed"] = (t.n_words < 10) | (100 * out["n_repeat_words"] > 20 * t.n_words)
    out["kept"] = ~out["base_failed"] & (out["n_words_kept"] >= rules.kept_share * t.n_words)
    return out | {"line_start": start, "line_end": end, "line_doc": doc, "line_failed": failed}


def measure(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, the measures, base_failed and kept of every row of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offsets in kernel.blocks(batch.column(1)):
                x = judged(raw, offsets, rules)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).cast(pa.int64()), *(pa.array(x[f.name]) for f in MEASURE_SCHEMA[1:])], names=MEASURE_SCHEMA.names)

    return docs.select("doc_id", "text").mapInArrow(run, MEASURE_SCHEMA)


def clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The kept rows of docs, with all their columns; failed lines are gone from text, and n_chars, if there is one, is the new length."""
    schema = docs.schema
    at = schema.names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offsets in kernel.blocks(batch.column(at)):
                x = judged(raw, offsets, rules)
                rows = np.flatnonzero(x["kept"])
                if not len(rows):
                    continue
                part = batch.slice(lo, hi - lo).take(pa.array(rows))
                texts = part.column(at).to_pylist()
                line = np.searchsorted(x["line_doc"], np.arange(hi - lo + 1))
                data = raw.tobytes()
                for i, row in enumerate(rows):
                    own = slice(line[row], line[row + 1])
                    if x["line_failed"][own].any():
                        texts[i] = b"\n".join(data[a:b] for a, b, bad in zip(x["line_start"][own], x["line_end"][own], x["line_failed"][own], strict=True) if not bad).decode()
                columns = [part.column(k) for k in range(part.num_columns)]
                columns[at] = pa.array(texts, columns[at].type)
                if "n_chars" in schema.names:
                    k = schema.names.index("n_chars")
                    columns[k] = pa.array([len(x) for x in texts], columns[k].type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, schema)
