"""A byte-level BPE tokenizer compiled to deterministic transducers that count tokens.

Two transducers in a row. The first runs over character classes and marks where pretokens begin; it has a dozen
states, so a chunk of text is a map from entry state to exit state, and chunk maps compose in a parallel prefix
scan. The second runs over the bytes of a pretoken and starts anew at each; its transitions are annotated with the
change in the number of tokens. A long pretoken is cut into chunks, whose maps from entry state to exit state and count compose in the same way. Its states are compiled when a text first needs them, from the merge list.

A state of the second transducer stands for all prefixes of a pretoken that behave alike from here on. It keeps
the longest suffix that a token can begin with, and for each such suffix the last token before it and how many
tokens have come since. A run of tokens is what the merges yield exactly when each neighbouring pair is, so the
last token of the prefix made longer by a byte is the one whose pair with the token before it stands.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np

LETTER, NUMBER, SPACE, BLANK, OTHER, QUOTE, END = range(7)
C_D, C_E, C_L, C_M, C_R, C_S, C_T, C_V = range(7, 15)
CLASSES = 15
(START, WORD, DIGITS, MARKS, QUOTED, AFTER_R, AFTER_V, AFTER_L, SPACE_1, BLANK_1, SPACE_N, BLANK_N) = range(12)
STATES = 12
CHUNK = 64
#: Bytes of a pretoken that is cut into chunks of half as many, and bytes before a chunk that its likely entry state is found from.
LONG, LEAD = 4096, 256
#: Marks: a pretoken begins at this character, or at the one before it.
HERE, BEFORE = 1, 2


def _classes() -> np.ndarray:
    """The class of each code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
    # White space as Unicode has it.
    for c in [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]:
        table[c] = BLANK
    table[0x20], table[0x27] = SPACE, QUOTE
    for c, k in zip("delmrstv", range(C_D, C_V + 1), strict=True):
        table[ord(c)] = k
    return table


def _pretokens() -> tuple[np.ndarray, np.ndarray]:
    """(next state, marks) by state and class: contractions, words, numbers and marks with a space before them, white space."""
    goes, marks = np.zeros((STATES, CLASSES), np.uint8), np.zeros((STATES, CLASSES), np.uint8)
    letters = {LETTER, *range(C_D, C_V + 1)}
    enter = {c: WORD for c in letters} | {NUMBER: DIGITS, SPACE: SPACE_1, BLANK: BLANK_1, OTHER: MARKS, QUOTE: QUOTED, END: START}

    def put(state: int, c: int, to: int, mark: int) -> None:
        goes[state, c], marks[state, c] = to, mark

    for c in range(CLASSES):
        fresh = (enter[c], HERE if c != END else 0)
        for state in (START, WORD, DIGITS, MARKS, QUOTED, BLANK_1):
            put(state, c, *fresh)
        for state in (AFTER_R, AFTER_V, AFTER_L):  # no contraction after all: the letter begins a word
            put(state, c, *((WORD, BEFORE) if c in letters else (fresh[0], fresh[1] | BEFORE)))
        for state, tail in ((SPACE_1, 0), (SPACE_N, BEFORE)):  # a space goes with what follows it
            put(state, c, *((START, 0) if c == END else (MARKS if c in (OTHER, QUOTE) else enter[c], tail)))
        put(BLANK_N, c, *((START, 0) if c == END else (enter[c], HERE | BEFORE)))
        if c in letters:
            put(WORD, c, WORD, 0)
    put(DIGITS, NUMBER, DIGITS, 0)
    for c in (OTHER, QUOTE):
        put(MARKS, c, MARKS, 0)
        put(QUOTED, c, MARKS, 0)
    for c in (C_S, C_T, C_M, C_D):
        put(QUOTED, c, START, 0)
    for c, state, end in ((C_R, AFTER_R, C_E), (C_V, AFTER_V, C_E), (C_L, AFTER_L, C_L)):
        put(QUOTED, c, state, 0)
        put(state, end, START, 0)
    for state in (SPACE_1, BLANK_1, SPACE_N, BLANK_N):
        put(state, SPACE, SPACE_N, 0)
        put(state, BLANK, BLANK_N, 0)
    return goes, marks


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    goes, marks = _pretokens()
    return _classes(), goes.reshape(-1), marks.reshape(-1)


def chunk_maps(classes: np.ndarray, goes: np.ndarray) -> np.ndarray:
    """For each chunk (a row of classes), the state it ends in from each state."""
    maps = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (len(classes), STATES)).copy()
    for column in np.ascontiguousarray(classes.T):
        maps = goes[maps.astype(np.uint16) * np.uint16(CLASSES) + column[:, None]]
    return maps


def composed(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan of the chunk maps: in round k each takes in the 2**k maps before it."""
    step = 1
    while step < len(maps):
        out = maps.copy()
        out[step:] = np.take_along_axis(maps[step:], maps[:-step], axis=1)
        maps, step = out, 2 * step
    return maps


def boundaries(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a pretoken begins at each code point; ends: places where a text ends, at which runs stop.

    A stop is a character of its own between texts, so chunks may straddle texts.
    """
    kinds, goes, marks = tables()
    n = len(points) + len(ends)
    stop = ends + np.arange(len(ends))
    own = np.ones(n, bool)
    own[stop] = False
    classes = np.full(-(-(n + 1) // CHUNK) * CHUNK, END, np.uint8)
    classes[:n][own] = kinds[points]
    grid = classes.reshape(-1, CHUNK)
    after = composed(chunk_maps(grid, goes))
    state = np.concatenate([[START], after[:-1, START]]).astype(np.uint16)
    mark = np.empty_like(grid)
    for t, column in enumerate(np.ascontiguousarray(grid.T)):
        at = state * np.uint16(CLASSES) + column
        mark[:, t], state = marks[at], goes[at].astype(np.uint16)
    flat = mark.reshape(-1)
    begins = (flat & HERE) > 0
    begins[:-1] |= (flat[1:] & BEFORE) > 0
    return begins[:n][own]


class Full(Exception):
    """No room for another state."""


class Merges:
    """The second transducer, compiled on demand from a tokenizer file's vocabulary and merges."""

    #: States kept. When a block needs more, all are forgotten and compiled again as texts need them.
    MOST = 1 << 18

    def __init__(self, model: dict):
        # The customary names of bytes: printable ones are themselves, the rest follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        named = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(plain))}
        self.token = {bytes(named[c] for c in name): i for name, i in model["vocab"].items()}
        name_of = {i: b for b, i in self.token.items()}
        self.name = [name_of.get(i, b"") for i in range(max(name_of) + 1)]
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = (bytes(named[c] for c in x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.rank[self.token[a], self.token[b]] = (r, self.token[a + b])
        self.begins = {t[:k] for t in self.token for k in range(1, len(t) + 1)}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.forget()

    def forget(self) -> None:
        """Back to the start state alone. State 0 means a transition that isn't compiled; memory is taken as it is touched."""
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = [()]
        self.goes = np.zeros((256, self.MOST), np.int32)
        self.adds = np.zeros((256, self.MOST), np.int8)
        self.first = self._state((b"", ((0, -1, 0),)))

    def merged(self, data: bytes) -> list[int]:
        """The tokens of a string of bytes, by merging the pair of least rank until none is left."""
        parts = [self.token[bytes([b])] for b in data]
        while len(parts) > 1:
            best = min(((self.rank[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in self.rank), default=None)
            if best is None:
                break
            (_, new), i = best
            parts[i : i + 2] = [new]
        return parts

    def stands(self, a: int, b: int) -> bool:
        """Whether a and b side by side stay as they are; a of -1: nothing before b."""
        known = self.pairs.get((a, b))
        if known is None:
            known = self.pairs[a, b] = self.merged(self.name[b]) == [b] if a < 0 else self.merged(self.name[a] + self.name[b]) == [a, b]
        return known

    def _state(self, key: tuple) -> int:
        i = self.ids.get(key)
        if i is None:
            if len(self.states) == self.MOST:
                raise Full
            i = self.ids[key] = len(self.states)
            self.states.append(key)
        return i

    def compile(self, state: int, byte: int) -> None:
        """Adds the transition of a state on a byte. Entries of a state: (length of suffix, last token before it, tokens since)."""
        suffix, entries = self.states[state]
        longer = suffix + bytes([byte])
        for length, last, since in entries:  # longest first
            new = self.token.get(longer[len(suffix) - length :])
            if new is not None and self.stands(last, new):
                change = 1 - since
                break
        else:
            raise ValueError("no token ends here: the merges don't cover all bytes")
        kept = [(length + 1, last, since + change) for length, last, since in entries if longer[len(suffix) - length :] in self.begins]
        kept.append((0, new, 0))
        to = self._state((longer[len(longer) - kept[0][0] :], tuple(kept)))
        self.goes[byte, state], self.adds[byte, state] = to, change

    def counts(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Tokens of each pretoken, given as places in data."""
        long = np.flatnonzero(length > LONG)
        if len(long):
            out = np.zeros(len(start), np.int64)
            rest = np.flatnonzero(length <= LONG)
            out[rest] = self.counts(data, start[rest], length[rest])
            for i in long.tolist():
                out[i] = self._chunked(data[start[i] : start[i] + length[i]])
            return out
        try:
            return self._side_by_side(data, start, length)[0]
        except Full:
            self.forget()
        if len(start) == 1:
            return np.array([self._alone(data[start[0] : start[0] + length[0]].tolist())])
        half = len(start) // 2
        return np.concatenate([self.counts(data, start[:half], length[:half]), self.counts(data, start[half:], length[half:])])

    def _chunked(self, data: np.ndarray) -> int:
        """Tokens of one long pretoken: a chunk is a map from entry state to (exit state, change in tokens), and the maps compose from left to right.

        There are too many states for whole maps, so a chunk's map is worked out where it is likely to be asked: at the state that the bytes before the chunk
        lead to from the start. All chunks run side by side. Where the state that the composition arrives with is another, the map is worked out there too,
        for all such chunks side by side, until every chunk has been entered with the exit state of the one before.
        """
        start = np.arange(0, len(data), LONG // 2)
        length = np.minimum(LONG // 2, len(data) - start)
        try:
            before = np.minimum(start, LEAD)
            entry = self._side_by_side(data, start - before, before)[1]
            total, end = self._side_by_side(data, start, length, entry)
            while True:
                wrong = np.flatnonzero(entry[1:] != end[:-1]) + 1
                if not len(wrong):
                    return int(total.sum())
                entry[wrong] = end[wrong - 1]
                total[wrong], end[wrong] = self._side_by_side(data, start[wrong], length[wrong], entry[wrong])
        except Full:
            self.forget()
            return self._alone(data.tolist())

    def _side_by_side(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, entry: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(change in tokens, last state) of runs of bytes from an entry state each, or from the start: all take a byte at a time, the longest first in line."""
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        state = np.full(len(start), self.first, np.int64) if entry is None else entry[order].astype(np.int64)
        total = np.zeros(len(start), np.int64)
        live = np.searchsorted(-length, -np.arange(1, (int(length[0]) if len(length) else 0) + 1), "right")
        goes, adds = self.goes.reshape(-1), self.adds.reshape(-1)
        for t, k in enumerate(live):
            at = data[start[:k] + t].astype(np.int64) * self.MOST + state[:k]
            to = goes[at]
            if not to.all():
                for x in np.unique(at[to == 0]).tolist():
                    self.compile(x % self.MOST, x // self.MOST)
                to = goes[at]
            total[:k] += adds[at]
            state[:k] = to
        out, last = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
        out[order], last[order] = total, state
        return out, last

    def _alone(self, data: list[int]) -> int:
        """One pretoken that needs more states than are kept: where they run out, only the present one is taken over."""
        state, total = self.first, 0
        for byte in data:
            if not self.goes[byte, state]:
                try:
                    self.compile(state, byte)
                except Full:
                    key = self.states[state]
                    self.forget()
                    state = self._state(key)
                    self.compile(state, byte)
            total += int(self.adds[byte, state])
            state = int(self.goes[byte, state])
        return total


@lru_cache(maxsize=4)
def load(path: str) -> tuple[Merges, list[str]]:
    """The transducer of a tokenizer file, and the special strings that stand for one token each."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    pre = said["pre_tokenizer"]
    if said["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True) or said["normalizer"]:
        raise ValueError("only byte-level BPE with the usual pretokens is compiled")
    return Merges(said["model"]), [x["content"] for x in said["added_tokens"]]
