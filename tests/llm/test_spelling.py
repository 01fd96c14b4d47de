"""Spelling variants against a comparison of every two words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdcast.llm import common, spelling

SCHEMA = "doc_id long, text string, word string, n int, bucket string, form string"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def _rows():
    rng = np.random.default_rng(6)
    stems = ["".join(rng.choice(list("abcdeé"), int(rng.integers(6, 12)))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "abcabcabcabc"]
    words = []
    for i, stem in enumerate(stems):
        words += [stem] * int(rng.integers(5, 400))
        for _ in range(4):
            at = int(rng.integers(0, len(stem)))
            edit = [stem[:at] + stem[at + 1:], stem[:at] + "z" + stem[at + 1:], stem[:at] + "É" + stem[at:]][int(rng.integers(0, 3))]
            words += [edit] * int(rng.integers(4, 12))
    words += ["x" * 3000] * 5 + ["x" * 3001] * 30 + ["x" * 1500 + "y" + "x" * 1500] * 6
    rng.shuffle(words)
    texts = [" ".join(words[i:i + 40]).upper() if i % 3 else "0.".join(words[i:i + 40]) for i in range(0, len(words), 40)]
    texts += [None, "", " \n", "tiny", "aaaaaa " * 60, "12345", "日本語 abcdeé\U0001f600abcdeé " * 6, "q" * 50]
    rows = [(None if i % 29 == 0 else i * 5 - 100, t) for i, t in enumerate(texts)]
    return [(*r, "w", 3, "b", "f") for r in [*rows, rows[3], rows[3]]]


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + (len(a) == len(b)):] == b[p + 1:]


def _plain(rows):
    count = Counter()
    for doc, text, *_ in rows:
        for run in map(_lower, RUN.findall(text or "")):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if n >= 5 and len(w) >= 6}
    near = {w: [v for v in words if _one_edit(w, v)] for w in words}
    best = {w: min(v, key=lambda x: (-words[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if words[b] >= 5 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted(((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()), key=str)


def _got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    common.prepare(spark)
    return spark.createDataFrame(_rows(), SCHEMA).repartition(4)


def test_equals_all_pairs(docs):
    want = _plain([tuple(r) for r in docs.collect()])
    assert sum(r[1] is not None for r in want) > 20 and sum(r[4] for r in want) > 100
    assert _got(spelling.op12_spelling(docs)) == want


def test_groups_of_many_tiles(docs, monkeypatch):
    """Tiles of three words: most groups have several, which meet in pairs."""
    monkeypatch.setattr(spelling, "TILE", 3)
    assert _got(spelling.op12_spelling(docs)) == _plain([tuple(r) for r in docs.collect()])


def test_empty_table_and_no_words(spark):
    assert _got(spelling.op12_spelling(spark.createDataFrame([], SCHEMA))) == []
    assert _got(spelling.op12_spelling(spark.createDataFrame([(1, "a b c", "", 0, "", "")], SCHEMA))) == []


def test_roots_follow_long_ways(spark):
    way = [(f"w{i}", f"w{i + 1}") for i in range(27)] + [("a", "w20"), ("b", "a")]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(way, "word string, form string")).collect()}
    assert got == {w: "w27" for w, _ in way}


def test_pieces_cut_no_run():
    text = ("ab" * 10 + " ").encode() * 200_000 + b"z" * 3_000_000
    pieces = list(spelling._pieces(text))
    assert b"".join(pieces) == text and len(pieces) > 2
    assert Counter(w for p in pieces for w in spelling.RUN.findall(p)) == Counter(spelling.RUN.findall(text))


def test_near_is_one_edit():
    rng = np.random.default_rng(2)
    words = list({"".join(rng.choice(list("ab"), int(rng.integers(1, 8)))) for _ in range(200)})
    latin = [w.encode("latin-1") for w in words]
    every = np.ones((len(words), len(words)), bool)
    found = np.zeros_like(every)
    for m in range(1, 9):
        for head in (True, False):
            found |= spelling.near(latin, latin, np.full(len(words), m), np.full(len(words), head), every)
    assert {(a, b) for a, b in zip(*np.nonzero(found))} == {
        (i, j) for i, a in enumerate(words) for j, b in enumerate(words) if _one_edit(a, b)}
