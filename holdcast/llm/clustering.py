"""Centroid clustering (Lloyd's rounds) with Orchard's search for the nearest centroid.

Every centroid has a list of the others, nearest first. A vector begins at a
centroid and walks that centroid's list; a closer centroid found on the way
becomes the current one and its list is walked instead. Centroids already
compared are marked. The walk ends where the list's next entry lies strictly
beyond twice the current distance: by the triangle inequality nothing further
on can be as close, so ties are found as well. All vectors of an Arrow batch
walk in step.

A round is one pass over the stored vectors. A task returns sums and counts of
its clusters, at most k * (dim + 1) numbers, which Spark adds up; only those
sums and the centroids (k rows, a parameter) pass through the driver. There is
no shuffle of vectors, so a vector that makes up a third of all rows or a
cluster that holds all of them is only a number in a sum.

Defined cases: vectors that are NULL, have another length or hold a NULL or
non-finite component take no part and have no row. Repeated rows each count and
each have a row. Rows without an id take part, and start a centroid only when no
others are left; rows of one id start centroids in the order of their components.
With fewer vectors than centroids every vector starts one; an empty table gives an
empty result. Components of any size are exact (Python's integers where a
distance might not fit a BIGINT); distance and inertia beyond a BIGINT show its border.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdcast.llm.common import prepare, stash

DIM = 64
SCALE = 256
K = 40
ROUNDS = 5
SEED = 2
NARROW = 1 << 26        # components below this have distances below 2**60, in 64 dimensions
LIMB = 40               # sums pass through Spark in parts of this many bits
BORDER = (1 << 63) - 1


def usable(embeddings: DataFrame, dim: int = DIM) -> DataFrame:
    """(vec_id, vector): the rows with exactly ``dim`` components, none NULL or non-finite."""
    vector = F.col("embedding").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return embeddings.filter(F.col("embedding").isNotNull() & (F.size("embedding") == dim) & F.forall(vector, finite)).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector"))


def integers(flat: np.ndarray, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x), a row per vector: 64-bit integers, or Python's where they are large."""
    x = np.floor(flat * float(scale))
    if np.abs(x).max(initial=0) < NARROW:
        return x.astype(np.int64).reshape(-1, dim)
    whole = [int(v) if np.isfinite(v) else int(u) * scale for u, v in zip(flat.tolist(), x.tolist())]
    return np.array(whole, object).reshape(-1, dim)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = a - b
    return (apart * apart).sum(axis=-1)


class Centroids:
    """Integer centroids, their distances from one another, and each one's list of the others."""

    def __init__(self, rows: list[list[int]]):
        self.rows = rows
        widest = max((abs(x) for row in rows for x in row), default=0)
        self.exact = np.array(rows, np.int64 if widest < NARROW else object)
        self.between = np.stack([squared(self.exact, c) for c in self.exact])
        self.lists = np.array([sorted(range(len(rows)), key=lambda j, i=i: (j != i, self.between[i, j], j)) for i in range(len(rows))])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (ties: the smaller) and the squared distance, for every vector."""
        kind = object if object in (vectors.dtype, self.exact.dtype) else np.int64
        vectors, centres, between = vectors.astype(kind), self.exact.astype(kind), self.between.astype(kind)
        n, k = len(vectors), len(centres)
        at = np.zeros(n, np.int64)
        best = squared(vectors, centres[at])
        place = np.ones(n, np.int64)                  # the list's first entry is the centroid itself
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        live = np.arange(n)
        while len(live):
            live = live[place[live] < k]
            other = self.lists[at[live], place[live]]
            within = (between[at[live], other] <= 4 * best[live]).astype(bool)
            live, other = live[within], other[within]
            place[live] += 1
            new = ~seen[live, other]
            who, candidate = live[new], other[new]
            seen[who, candidate] = True
            distance = squared(vectors[who], centres[candidate])
            closer = ((distance < best[who]) | (distance == best[who]) & (candidate < at[who])).astype(bool)
            who, candidate = who[closer], candidate[closer]
            at[who], best[who], place[who] = candidate, distance[closer], 1
        return at, best


def _vectors(batch: pa.RecordBatch, dim: int, scale: int) -> np.ndarray:
    return integers(batch.column("vector").flatten().to_numpy(zero_copy_only=False), dim, scale)


def _limbs(value: int) -> list[int]:
    """``value`` in parts of LIMB bits, least first; the last one has the sign."""
    parts = []
    while not -(1 << LIMB) <= value < 1 << LIMB:
        parts.append(value & (1 << LIMB) - 1)
        value >>= LIMB
    return [*parts, value]


def _sums(rows: DataFrame, centroids: Centroids, dim: int, scale: int) -> dict[tuple[int, int], int]:
    """Exact sums by (cluster, component) after one assignment of all rows; component -1 counts them."""
    k = len(centroids.rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        large: dict[int, np.ndarray] = {}             # sums of vectors beyond 64-bit integers
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch, dim, scale)
            at, _ = centroids.nearest(vectors)
            count += np.bincount(at, minlength=k)
            if vectors.dtype != object:
                np.add.at(total, at, vectors)
            else:
                for c in set(at.tolist()):
                    large[c] = large.get(c, 0) + vectors[at == c].sum(axis=0)
        out = []
        for c in np.flatnonzero(count).tolist():
            sums = total[c].astype(object) + large.get(c, 0)
            out += [(c, i, p, part) for i, v in [(-1, int(count[c])), *enumerate(sums)] for p, part in enumerate(_limbs(int(v)))]
        if out:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)],
                                             names=["cluster", "component", "part", "value"])

    parts = rows.mapInArrow(run, "cluster int, component int, part int, value bigint").groupBy(
        "cluster", "component", "part").agg(F.sum("value").alias("value"))
    found: dict[tuple[int, int], int] = {}
    for r in parts.collect():                         # at most k * (dim + 1) sums, in a few parts each
        key = (r["cluster"], r["component"])
        found[key] = found.get(key, 0) + (r["value"] << LIMB * r["part"])
    return found


def first_centroids(rows: DataFrame, k: int, seed: int, dim: int = DIM, scale: int = SCALE) -> list[list[int]]:
    """The k vectors whose ids have the smallest hashes, in the order of their hashes."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    drawn = rows.withColumn("mark", mark).orderBy(F.asc_nulls_last("mark"), "vector").limit(k).collect()
    return [[int(x) for x in integers(np.array(r["vector"]), dim, scale)[0]] for r in drawn]


def cluster(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM,
            scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every usable vector, and the final centroids."""
    spark = prepare(embeddings.sparkSession)
    rows = stash(usable(embeddings, dim), "cluster-vectors")
    start = first_centroids(rows, k, seed, dim, scale)
    if not start:
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), []
    centroids = Centroids(start)
    for _ in range(rounds):
        sums = _sums(rows, centroids, dim, scale)
        centroids = Centroids([[sums[c, i] // sums[c, -1] for i in range(dim)] if (c, -1) in sums else old
                               for c, old in enumerate(centroids.rows)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, distance = centroids.nearest(_vectors(batch, dim, scale))
                shown = [min(int(d), BORDER) for d in distance] if distance.dtype == object else distance
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(at.astype(np.int32)), pa.array(shown, pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])

    found = rows.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")
    return stash(found, "cluster-assigned"), centroids.rows


def op11_centroids(embeddings: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every usable vector."""
    spark = prepare(embeddings.sparkSession)
    assigned, centroids = cluster(embeddings)
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total"))
    inertia = {r["cluster"]: int(r["total"]) for r in sums.collect()}          # a number for each centroid
    digest = lambda row: hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()
    known = [(c, min(total, BORDER), min(sum(inertia.values()), BORDER), digest(centroids[c])) for c, total in inertia.items()]
    facts = spark.createDataFrame(known, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # At most K rows.
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _rounds_sql(rounds: int) -> str:
    """Assignment and new centroids of each round, then the last assignment."""
    text = ""
    for r in range(rounds + 1):
        text += f""",
assigned{r} AS MATERIALIZED (
  SELECT k.row, k.vec_id, k.v, c.cluster, list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM kept k, centroids{r} c
  QUALIFY row_number() OVER (PARTITION BY k.row ORDER BY d, c.cluster) = 1)"""
        if r < rounds:
            text += f""",
centroids{r + 1} AS MATERIALIZED (
  SELECT o.cluster, coalesce(n.v, o.v) AS v FROM centroids{r} o LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v
    FROM (SELECT cluster, i, sum(x) AS s, count(*) AS n
      FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM assigned{r}) GROUP BY cluster, i)
    GROUP BY cluster) n ON n.cluster = o.cluster)"""
    return text


OP11_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
centroids0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS INTEGER) AS cluster, v FROM kept
  ORDER BY sha256('{SEED}:' || vec_id) LIMIT {K}){_rounds_sql(ROUNDS)}
SELECT a.vec_id, a.cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM assigned{ROUNDS} a JOIN centroids{ROUNDS} c ON c.cluster = a.cluster"""
