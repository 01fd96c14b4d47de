"""Centroid clustering against plain rounds over all pairs."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdcast.llm import clustering, common

SCHEMA = "vec_id long, embedding array<double>, cluster int, distance long, vector string, mark string"


def _rows(n=400):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(n, 64)).round(2).tolist()
    vectors[5], vectors[6], vectors[9] = vectors[4], vectors[4], [0.0] * 64
    rows = [(i * 3, v) for i, v in enumerate(vectors)]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [1.0] * 63 + [None], [1.0] * 63 + [math.nan], [1.0] * 63 + [math.inf]]
    rows += [(10_000 + i, v) for i, v in enumerate(bad)] + [rows[7]] * 40 + [(None, vectors[11])]
    return [(*r, 1, 2, "a", "b") for r in rows]


def _plain(rows, k=40, rounds=5, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    mark = lambda i: (i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest())
    centres = [v for _, v in sorted(kept, key=lambda r: (mark(r[0]), r[1]))[:k]]

    def assign():
        at = []
        for _, v in kept:
            at.append(min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres)))
        return at

    for _ in range(rounds):
        at = assign()
        for c in range(len(centres)):
            own = [v for (_, v), (_, j) in zip(kept, at) if j == c]
            if own:
                centres[c] = [sum(x) // len(own) for x in zip(*own)]
    at = assign()
    by = {c: sum(d for d, j in at if j == c) for c in range(len(centres))}
    shown = lambda x: min(x, (1 << 63) - 1)
    total = sum(shown(d) for d, _ in at)
    return sorted(((i, c, shown(d), shown(by[c]), shown(total), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, at)), key=str)


def _got(df):
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_plain_rounds(spark):
    rows = _rows()
    common.prepare(spark)
    assert _got(clustering.op11_centroids(spark.createDataFrame(rows, SCHEMA).repartition(5))) == _plain(rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = _rows(17)[:17]
    assert _got(clustering.op11_centroids(spark.createDataFrame(rows, SCHEMA))) == _plain(rows)
    empty = clustering.op11_centroids(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and _got(empty) == []
    assert clustering.op11_centroids(spark.createDataFrame([(1, None, 0, 0, "", "")], SCHEMA)).count() == 0


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(3)
    big = [(int(i), (rng.normal(size=64) * 10.0 ** int(rng.integers(0, 30))).tolist(), 0, 0, "", "") for i in range(90)]
    assert _got(clustering.op11_centroids(spark.createDataFrame(big, SCHEMA).repartition(3))) == _plain(big)


@pytest.mark.parametrize("spread", [1, 3, 1000])
def test_nearest_finds_ties(spread):
    """Few distinct places: many equal distances and equal centroids."""
    rng = np.random.default_rng(spread)
    centres = rng.integers(0, spread + 1, (30, 4)).tolist()
    vectors = rng.integers(0, spread + 1, (500, 4))
    at, best = clustering.Centroids(centres).nearest(vectors)
    want = [min((int(((v - np.array(c)) ** 2).sum()), j) for j, c in enumerate(centres)) for v in vectors]
    assert list(zip(best.tolist(), at.tolist())) == want


def test_sums_pass_in_parts():
    for value in (0, -1, 5, -(1 << 40), (1 << 40) - 1, 1 << 40, -(1 << 90) - 7, 3 << 200):
        assert sum(p << clustering.LIMB * i for i, p in enumerate(clustering._limbs(value))) == value


def test_result_does_not_depend_on_the_table_order(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    assert _got(clustering.op11_centroids(df.orderBy(F.desc("vec_id")).coalesce(1))) == _got(clustering.op11_centroids(df.repartition(7)))
