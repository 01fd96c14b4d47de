"""Connected components of an undirected graph, as Spark jobs.

Alternates two steps over an edge table until it stops changing (large-star and
small-star, Kiveris et al., "Connected Components in MapReduce and Beyond").
Every step is a pre-aggregated minimum per node and a join with it. Minima are
written to the shared checkpoint folder first, so both sides of a join are dealt
for that join alone and Spark may split a hot node, such as the root of a large
component. The driver sees two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdcast.llm.common import stash


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "near"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the least node reachable.

    ``edges`` has two BIGINT columns (a, b). Loops and repeats are allowed; an
    empty table gives an empty result. Roots themselves are not listed.
    """
    now = stash(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("near")).distinct(), "edges")
    before = None
    while before != (state := _state(now)):
        before = state
        both = now.unionByName(now.select(F.col("near").alias("node"), F.col("node").alias("near")))
        least = stash(both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("low")), "least")
        large = stash(both.filter("near > node").join(least, "node").select(
            F.col("near").alias("node"), F.col("low").alias("near")), "large")
        lows = stash(large.groupBy("node").agg(F.min("near").alias("low")), "lows")
        small = large.join(lows, "node").filter("near <> low").select(
            F.col("near").alias("node"), F.col("low").alias("near"))
        now = stash(small.unionByName(lows.withColumnRenamed("low", "near")).distinct(), "edges")
    return now.select("node", F.col("near").alias("root"))
