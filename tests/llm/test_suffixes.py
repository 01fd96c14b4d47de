"""Suffix-array dedup against a scan of every 100-byte string."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdcast.llm import common, suffixes

SCHEMA = "doc_id long, text string, bucket int, context string, ats string, rid string"


def _texts():
    rng = np.random.default_rng(11)
    make = lambda n: "".join(rng.choice(list("abcdefgh é"), n))
    line, passage, long = make(60), make(260), make(5000)
    near = list(make(900))
    variants = []
    for at in (200, 450, 451, 899, 0):
        near[at] = "Z"
        variants.append("".join(near))
    return [None, "", "short", "x" * 99, "x" * 100, "x" * 350, "ab" * 150, long, long, long[1000:3000] + make(300), *variants,
            *[make(80) + line + make(80) for _ in range(12)], passage, make(30) + passage, passage + make(30) + passage,
            make(150), "é" * 120, "aé" * 40, make(99) + "é" * 100]


def _rows():
    texts = _texts()
    order = np.random.default_rng(2).permutation(len(texts))
    rows = [(int(i) * 7 - 30, texts[i]) for i in order]
    rows += [rows[3], rows[3], (None, texts[7]), (None, texts[7][:500]), (None, None), (rows[5][0], texts[10]), (rows[5][0], texts[11])]
    return [(*r, 1, "x", "y", "z") for r in rows]


def _brute(rows, hashes, window=100):
    """Rows in order: NULL ids last, then by hash; a string's later starts are removed."""
    keyed = sorted({(d is None, d or 0, *hashes[d, t], t) for d, t, *_ in rows}, key=lambda k: k[:-1])
    seen, result = set(), {}
    for unknown, doc, a, b, text in keyed:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - window + 1):
            s = data[i:i + window]
            if s in seen:
                gone[i:i + window] = True
            seen.add(s)
        spans = int(np.count_nonzero(np.diff(np.append(0, gone.astype(np.int8))) == 1))
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        result[None if unknown else doc, text] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((d, *result[d, t]) for d, t, *_ in rows), key=str)


def _hashes(docs):
    found = docs.select("doc_id", "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("a"),
                        F.xxhash64(F.coalesce("text", F.lit("")), F.lit(1)).alias("b")).collect()
    return {(r["doc_id"], r["text"]): (r["a"], r["b"]) for r in found}


def _got(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    common.prepare(spark)
    return spark.createDataFrame(_rows(), SCHEMA).repartition(4)


# One bucket; several; and so many that most leads lie on a boundary between buckets.
@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 16), (120, 60), (8, 3)])
def test_every_repeat_goes(docs, sizes):
    rows = [tuple(r) for r in docs.collect()]
    got = _got(suffixes.remove_repeats(docs, *sizes))
    want = _brute(rows, _hashes(docs))
    assert got == want and sum(r[2] for r in want) > 5000


def test_contract_query_and_table_order(spark, docs):
    one = suffixes.op13_suffixes(docs.orderBy(F.desc("text")).coalesce(1))
    assert one.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert _got(one) == _got(suffixes.op13_suffixes(docs))


def test_empty_table(spark):
    assert suffixes.op13_suffixes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_text_is_read_in_segments(spark, docs, monkeypatch):
    """Segments of 64 windows find the windows of every anchor that whole texts have."""
    data = np.frombuffer((_texts()[7] + "é" * 200).encode(), np.uint8)
    bounds = np.array([0, 10, 10, 4000, len(data)])
    whole = {(int(a), w) for at, first, last, _ in suffixes.anchors(data, bounds) for a, f, l in zip(at, first, last) for w in range(f, l + 1)}
    monkeypatch.setattr(suffixes, "SEGMENT", 64)
    cut = {(int(a), w) for at, first, last, _ in suffixes.anchors(data, bounds) for a, f, l in zip(at, first, last) for w in range(f, l + 1)}
    inside = {i for a, b in zip(bounds[:-1], bounds[1:]) for i in range(a, b - 99)}
    assert {w for _, w in whole} == inside == {w for _, w in cut}
    assert len(whole) == len(inside) and whole == cut


def test_equal_windows_have_their_anchor_at_one_place():
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 100, 100).astype(np.uint8)
    places = set()
    for _ in range(30):
        left = rng.integers(97, 100, int(rng.integers(0, 50))).astype(np.uint8)
        data = np.concatenate([left, shared, rng.integers(97, 100, 40).astype(np.uint8)])
        for at, first, last, _ in suffixes.anchors(data, np.array([0, len(data)])):
            places |= {int(a) - len(left) for a, f, l in zip(at, first, last) if f <= len(left) <= l}
    assert len(places) == 1


def test_multikey_sort_orders_and_joins_equal_strings():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 2, (500, 4)).astype(np.uint64)
    groups = rng.integers(0, 3, 500)
    order, run = suffixes.multikey_sort(groups, lambda r, level: words[r, level], 4)
    keys = [(int(groups[i]), *words[i].tolist()) for i in order]
    assert keys == sorted(keys)
    assert [a == b for a, b in zip(keys, keys[1:])] == [x == y for x, y in zip(run, run[1:])]
    assert all(i < j for (i, j), x, y in zip(zip(order, order[1:]), keys, keys[1:]) if x == y)
