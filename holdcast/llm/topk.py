"""Exact top-k inner products over a vector-approximation file.

Vectors are integers (scale * x, rounded down). The approximation file has one
byte per component, the number of its cell between the least and greatest value
of that component over all rows, beside the exact vector. A query block scans
the cells first: the bounds of a cell bound the score from both sides. Rows
whose upper bound reaches the k-th best lower bound so far are visited in the
order of their upper bounds, reading exact vectors until no unread row can
reach the k-th exact score. Tasks keep k rows per query; a grouped limit merges them.

Queries go to the tasks in blocks of at most QUERY_BLOCK rows, one broadcast
and one scan of the file per block. Of identical vectors only the k + 1 least
ids can be an answer (ties go to the smaller id, one may be the query itself),
so a vector that makes up a third of all rows is scanned k + 1 times.

Defined cases: vectors that are NULL or empty, hold a NULL or a non-finite component, or
whose id is NULL take no part; vectors meet only those of their own length;
rows that repeat id and vector count once, and a query never meets rows of its own
id; components are BIGINTs, scores and ranks are exact, and only the score
column shows a score beyond a BIGINT as the border of BIGINT. Fewer than k candidates give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdcast.llm.common import prepare, stash

SCALE = 1024
K = 10
CELLS = 256
QUERY_BLOCK = 1 << 15
AT_ONCE = 256          # queries compared with one batch of rows at a time
LIMB = 62              # bits of the parts in which scores beyond a BIGINT are merged
NONE = -1 << 190       # less than any score


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, as an array of BIGINT."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)


def approximation_file(rows: DataFrame, k: int = K) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """(vec_id, dim, vector, cells): exact integers beside a byte per component; and the ranges by length.

    ``rows`` has vec_id and vector (array of BIGINT). Cells are equal parts of
    a component's range over all rows of its length.
    """
    spread = rows.select(F.size("vector").alias("dim"), F.posexplode("vector").alias("component", "x")).groupBy(
        "dim", "component").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    ranges = spread.groupBy("dim").agg(F.transform(F.sort_array(F.collect_list(
        F.struct("component", "low", "high"))), lambda r: F.struct(r["low"].alias("low"), r["high"].alias("high"))).alias("ranges"))
    same = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.distinct().withColumn("place", F.row_number().over(same)).filter(F.col("place") <= k + 1)
    far = lambda x, r: x.cast("double") - r["low"].cast("double")  # noqa: E731  (differences may exceed a BIGINT)
    cell = lambda x, r: F.least(F.floor(far(x, r) * CELLS / (far(r["high"], r) + 1)), F.lit(CELLS - 1)).cast("smallint")
    file = few.withColumn("dim", F.size("vector")).join(ranges, "dim").select(
        "vec_id", "dim", "vector", F.zip_with("vector", "ranges", cell).alias("cells"))
    # One row per vector length.
    return file, {r["dim"]: np.array([tuple(x) for x in r["ranges"]], float) for r in ranges.collect()}


def _matrix(column: pa.Array, dim: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)


class Best:
    """The k best (score, id) of every query so far; ties to the smaller id."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, largest: np.ndarray):
        """``largest`` has the greatest size of every component over all rows."""
        self.ids, self.queries, self.k = ids, queries, k
        wide = (np.abs(queries.astype(float)) @ largest).max(initial=0)
        self.kind = np.int64 if wide < 2 ** 62 else object         # else Python's integers, which are exact
        self.none = np.iinfo(np.int64).min if self.kind is np.int64 else NONE
        self.score = np.full((len(ids), k), self.none, self.kind)
        self.vec = np.full((len(ids), k), np.iinfo(np.int64).max, np.int64)

    def _add(self, who: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        """Merge new (query row, score, id) entries, a matrix per query with absent entries at the least score."""
        score = np.concatenate([self.score[who], score], axis=1)
        vec = np.concatenate([self.vec[who], vec], axis=1)
        if self.kind is object:
            order = np.argsort(vec, axis=1, kind="stable")
            order = np.take_along_axis(order, np.argsort(-np.take_along_axis(score, order, 1), axis=1, kind="stable"), 1)[:, :self.k]
        else:
            order = np.lexsort((vec, np.bitwise_not(score)), axis=1)[:, :self.k]
        self.score[who] = np.take_along_axis(score, order, 1)
        self.vec[who] = np.take_along_axis(vec, order, 1)

    def meet(self, vec_ids: np.ndarray, vectors: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> None:
        for at in range(0, len(self.ids), AT_ONCE):
            self._meet(np.arange(at, min(at + AT_ONCE, len(self.ids))), vec_ids, vectors, cells, low, width)

    def _meet(self, who, vec_ids, vectors, cells, low, width) -> None:
        q = self.queries[who].astype(float)
        least = low + cells * width                    # bounds of every component of every row
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        slack = 1e-9 * (np.abs(q) @ (np.abs(low) + CELLS * width))[:, None] + 1e-6
        # A component lies in [least, least + width]; negative weights meet the lower end.
        floor = q @ least.T
        upper = floor + (up @ width)[:, None] + slack
        lower = floor + (down @ width)[:, None] - slack
        own = vec_ids[None, :] == self.ids[who][:, None]
        upper[own], lower[own] = -np.inf, -np.inf
        known = self.score[who, -1].astype(float)
        if upper.shape[1] > self.k:
            known = np.maximum(known, -np.partition(-lower, self.k - 1, axis=1)[:, self.k - 1])
        step = 2 * self.k
        left = (upper >= known[:, None]).sum(axis=1)
        go = np.flatnonzero(left)
        if not len(go):
            return
        # Exact vectors in the order of their upper bounds, until none unread can reach the k-th score.
        most = int(left.max())
        order = np.argpartition(-upper[go], most - 1, axis=1)[:, :most] if most < upper.shape[1] else np.argsort(-upper[go], axis=1)
        order = np.take_along_axis(order, np.argsort(-np.take_along_axis(upper[go], order, 1), axis=1), 1)
        for begin in range(0, most, step):
            part = order[:, begin:begin + step]
            bound = np.take_along_axis(upper[go], part, 1)
            more = bound[:, 0] >= np.maximum(known[go], self.score[who[go], -1].astype(float))
            more &= bound[:, 0] > -np.inf
            go, order, part, bound = go[more], order[more], part[more], bound[more]
            if not len(go):
                break
            exact = np.einsum("qd,qcd->qc", self.queries[who[go]].astype(self.kind), vectors[part].astype(self.kind))
            ids = vec_ids[part]
            absent = bound == -np.inf
            exact[absent], ids[absent] = self.none, np.iinfo(np.int64).max
            self._add(who[go], exact, ids)


def _parts(score: np.ndarray) -> list[pa.Array]:
    """Scores as three BIGINTs that compare like them, and as a BIGINT (its border where they are beyond)."""
    mask, whole = (1 << LIMB) - 1, np.iinfo(np.int64)
    if score.dtype == object:
        score = score.tolist()
        return [pa.array([x >> 2 * LIMB for x in score], pa.int64()), pa.array([x >> LIMB & mask for x in score], pa.int64()),
                pa.array([x & mask for x in score], pa.int64()),
                pa.array([min(max(x, whole.min), whole.max) for x in score], pa.int64())]
    return [pa.array(score >> 63), pa.array(score >> LIMB & mask), pa.array(score & mask), pa.array(score)]


FOUND = "query_id bigint, vec_id bigint, high bigint, middle bigint, low bigint, score bigint"


def top_k(rows: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query row.

    ``rows`` has vec_id and vector (array of BIGINT). Every row is a candidate
    for every query of another id.
    """
    spark = rows.sparkSession
    rows = stash(rows, "topk-rows")
    file, ranges = approximation_file(rows, k)
    file = stash(file, "topk-file")
    queries = stash(rows.filter(is_query).distinct(), "topk-queries")
    blocks = -(-queries.count() * 5 // (QUERY_BLOCK * 4))       # a hash block stays below the limit
    # Each block's answers are written before the next block is read, so one block at a time is in memory.
    found = [_scan(file, ranges, queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b), k)
             for b in range(blocks)]
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.desc("high"), F.desc("middle"), F.desc("low"), "vec_id")
    return best.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _scan(file: DataFrame, ranges: dict[int, np.ndarray], block: DataFrame, k: int) -> DataFrame:
    """One scan of the approximation file for one block of queries; k rows per query and task, written."""
    held = block.select("vec_id", F.size("vector").alias("dim"), "vector").toArrow().combine_chunks()   # at most QUERY_BLOCK rows
    dims = held["dim"].to_numpy()
    by_dim = {}
    for dim in set(dims.tolist()):
        part = held.filter(pa.array(dims == dim)).combine_chunks()
        by_dim[dim] = (part["vec_id"].to_numpy(), _matrix(pa.concat_arrays(part["vector"].chunks), dim, np.int64))
    shared = file.sparkSession.sparkContext.broadcast(by_dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dim: Best(ids, vectors, k, np.abs(ranges[dim]).max(axis=1)) for dim, (ids, vectors) in shared.value.items()}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in set(dims.tolist()) & set(best):
                part = batch.filter(pa.array(dims == dim))
                low = ranges[dim][:, 0]
                width = (ranges[dim][:, 1] - low + 1) / CELLS
                best[dim].meet(part.column(0).to_numpy(), _matrix(part.column(2), dim, np.int64),
                               _matrix(part.column(3), dim, float), low, width)
        for b in best.values():
            row, place = np.nonzero(b.vec != np.iinfo(np.int64).max)
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.ids[row]), pa.array(b.vec[row, place]), *_parts(b.score[row, place])],
                names=[c.split()[0] for c in FOUND.split(", ")])

    answers = stash(file.select("vec_id", "dim", "vector", "cells").mapInArrow(run, FOUND), "topk-answers")
    shared.destroy()
    return answers


def op9_topk(embeddings: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score: queries are the rows whose vec_id is divisible by 100."""
    prepare(embeddings.sparkSession)
    vector = F.col("embedding")
    rows = embeddings.filter(F.col("vec_id").isNotNull() & usable(vector)).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), integers(vector).alias("vector"))
    return top_k(rows, F.col("vec_id") % 100 == 0)


OP9_SQL = """
WITH raw AS (
  SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i
  FROM embeddings WHERE embedding IS NOT NULL),
parts AS (
  SELECT vec_id, i, CAST(floor(1024 * x) AS BIGINT) AS x FROM raw
  QUALIFY bool_and(x IS NOT NULL AND isfinite(x)) OVER (PARTITION BY vec_id)),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM scores QUALIFY rank <= 10"""
