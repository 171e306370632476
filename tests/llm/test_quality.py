from __future__ import annotations

import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from saldus.llm import kernel, quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(grams)
    covered = {j for i, g in enumerate(grams) if many[g] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
        seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


TEXT = st.one_of(st.text(max_size=60), st.text(alphabet="ab \n\t|é#", max_size=200), st.none())


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_measures_like_plain_code(texts):
    data = [(x or "").encode() for x in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    x = quality.judged(np.frombuffer(b"".join(data), np.uint8), offsets, quality.Rules())
    got = list(zip(*(x[m].tolist() for m in (*quality.MEASURES[:5], "base_failed")), strict=True))
    assert got == [plain(t) for t in texts]


GOOD = "The quick brown fox jumps over the lazy dog near the river bank.\nA second line of ordinary prose follows it here, plainly."
NAV = "Home | News | Sport | Weather | Travel | Money | Help | More\nAbout\nContact\nThis is the only real sentence of the page, you see."


def test_lines_are_judged_first(spark):
    rows = [(1, GOOD, "x"), (2, NAV, "x"), (3, None, "x"), (4, GOOD + "\nAccept all cookies to go on with this site.", "x"), (5, "BUY!! NOW!! THIS!! IS!! GREAT!! STUFF!! FOR!! YOU!! AND!! ME!! TODAY!!", "x")]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, kept string, n_chars long")
    assert {r["doc_id"]: r["kept"] for r in quality.measure(df).collect()} == {1: True, 2: False, 3: False, 4: True, 5: False}
    kept = {r["doc_id"]: (r["text"], r["n_chars"], r["kept"]) for r in quality.clean(df).collect()}
    assert kept == {1: (GOOD, len(GOOD), "x"), 4: (GOOD, len(GOOD), "x")}
    assert quality.clean(df.limit(0)).count() == 0 and quality.measure(df.limit(0)).count() == 0


def test_furniture_in_each_language():
    lines = ["Copyright Muster GmbH, alle Rechte vorbehalten.", "Pour en savoir plus, lisez notre politique de confidentialité.", "Al seguir acepta nuestra política de privacidad, por favor.", "This is one of the lines that stay, after all."]
    raw = "\n".join(lines).encode()
    x = quality.judged(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), quality.Rules())
    assert x["line_failed"].tolist() == [True, True, True, False]


def test_a_long_text_is_judged_whole():
    words = [f"word{i}" for i in range(300_000)]
    raw = (" ".join(words) + ".\nMenu\n" + " ".join(words[-6:-1])).encode()
    x = quality.judged(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), quality.Rules())
    assert (x["n_words"][0], x["n_repeat_words"][0], x["n_lines_removed"][0], x["n_words_kept"][0], x["kept"][0]) == (300_006, 10, 1, 300_005, True)


def test_hashes_don_t_depend_on_place():
    raw = np.frombuffer(b"abc xyz abc\nabc", np.uint8)
    t = kernel.Text(raw, np.array([0, 11, 15]))
    h = t.word_hashes()
    assert len(set(h.tolist())) == 2 and h[0] == h[2] == h[3]


def test_final_marks_and_runs_of_marks():
    long = "one two three four five six seven eight nine ten."
    bad = ["Menü", "Société", "Главная страница", "Αρχική", "首页", "go 😀", "***sale now and here.", "one a!!!b three."]
    good = ["Ende…", "他来了。", "sagte „ja“", "«Oui»", "क्या।", "Fin.", "a!b one two three four.", "one* *two three four five."]
    data = ("\n".join([long, *bad, *good])).encode()
    x = quality.judged(np.frombuffer(data, np.uint8), np.array([0, len(data)], np.int64), quality.Rules())
    assert x["line_failed"].tolist() == [False] + [True] * len(bad) + [False] * len(good)


def test_texts_that_hash_alike_and_long_texts(spark):
    """A Thue-Morse word and its complement collide under any polynomial hash modulo 2**64; repeated rows are judged one by one."""
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    long = " ".join(f"w{i}" for i in range(400_000)) + "."
    rows = [(1, f"{word}\n{other}"), (2, f"{word}\n{word}"), (3, long), (4, f"{long}\n{long}"), (2, f"{word}\n{word}")]
    got = sorted((r["doc_id"], r["n_words"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in quality.measure(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 2, 0, 0, True), (2, 2, 1, 0, True), (2, 2, 1, 0, True), (3, 400_000, 0, 0, False), (4, 800_000, 1, 800_000, True)]


#: Pairs that the 64-bit hash of byte ranges takes for one.
ALIKE = ("SW(|dn>|xD$Nz>yM", "FwA]vehL\\u7%Sa,z"), ("78gv\\5$>.@s_j%~#", "3?f(\"k3>0|$?(j#6")


def test_lines_and_runs_are_compared_by_their_bytes():
    for a, b in ALIKE:
        for text, dup, again in ((f"{a}\n{b}", 0, 0), (f"{a}\n{b}\n{a}\n{b}\n{b}", 3, 0), (f"x y {a} z w . x y {b} z w", 0, 0), (f"x y {a} z w . x y {a} z w", 0, 10)):
            raw = text.encode()
            x = quality.judged(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), quality.Rules())
            assert (x["n_dup_lines"][0], x["n_repeat_words"][0]) == (dup, again) == (plain(text)[3], plain(text)[4])


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_classes_hold_where_all_hashes_collide(texts):
    data = [(x or "").encode() for x in texts]
    t = kernel.Text(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64))
    exact = [(d, t.data[a:b].tobytes()) for d, a, b in zip(t.doc, t.start, t.end, strict=True)]
    same = lambda kinds: [[x == y for y in kinds] for x in kinds]
    assert same(t.classes(t.start, t.end, t.doc).tolist()) == same(exact)
    for found in (np.zeros(len(exact), np.uint64), np.arange(len(exact), dtype=np.uint64) % 2):
        # Equal items have equal hashes: a hash of their length at most.
        found = np.array([len(x[1]) % 2 for x in exact], np.uint64) * found.max(initial=0)
        kinds = kernel.classes(found, lambda i, j: np.array([exact[a] != exact[b] for a, b in zip(i, j, strict=True)], bool), exact.__getitem__)
        assert same(kinds.tolist()) == same(exact)
