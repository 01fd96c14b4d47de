"""Sharding over fixed virtual slots.

Records hash into a fixed number of virtual slots by their text, so equal texts
share a slot. Rows and bytes are aggregated per slot, and a small versioned
table maps slots to shards. Rebalancing edits that map: it moves as few slots
as it needs until shard sizes are near equal and stores the result as the next
version; records never change their slot.

A group of equal texts stays in one slot unless shards of near equal bytes need it
in parts. Only groups above 1 / PIECES of all bytes can be in the way. Each of these, fewer than PIECES, is
dealt into pieces by doc_id and number of the copy, and pieces are weighed; then parts
of at most a whole shard's mean, a half, a quarter, an eighth are tried, and the
largest parts stay whose shards are as near to equal as those of the smallest.

Nothing depends on the input's layout: equal rows are counted, then numbered. A slot's rows get their places in
buckets of about BUCKET rows, so no task holds a slot of any number of rows. The slot map has SLOTS rows,
which bounds what the driver sees.

Defined cases: NULL text has no bytes and CRC 0; a record's size is its bytes
plus OVERHEAD; a NULL doc_id is a record like any other; repeated rows are
separate records; an empty table gives an empty result. Only doc_id and text
are read.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdcast.llm.common import prepare, stash, text_bytes
from holdcast.session import checkpoint_dir

SLOTS = 1 << 14
OVERHEAD = 16
PIECES = 320
SHARDS = 40
BUCKET = 1 << 18       # rows, about, that are put in order together
COPIES = 1 << 16       # rows that one repeated row is written out to at a time
NEAR = 0.01            # of the mean: shards within it are near equal
MAP_SCHEMA = "version int, virtual_slot int, shard int"


def records(docs: DataFrame) -> DataFrame:
    """Slim rows: doc_id, copy (number among equal rows), size, text_crc32, group (digest of the text)."""
    text = text_bytes()
    slim = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("group"))
    keys = ["doc_id", "size", "text_crc32", "group"]
    # A row that comes very often is written out by many tasks. Counts are stored, so texts are read once.
    parts = stash(slim.groupBy(*keys).agg(F.count("*").alias("n")), "shard-counts").withColumn(
        "start", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(COPIES))))
    many = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    often = parts.filter(F.col("n") > COPIES).repartition(many, "group", "doc_id", "start")
    return stash(parts.filter(F.col("n") <= COPIES).unionByName(often).withColumn(
        "copy", F.explode(F.sequence("start", F.least(F.col("n"), F.col("start") + COPIES) - 1))).select(*keys, "copy"),
        "shard-records")


def with_virtual_slots(recs: DataFrame, slots: int = SLOTS, pieces: int = PIECES, shards: int | None = None) -> DataFrame:
    """``recs`` with virtual_slot: the text's hash, or several for groups in parts.

    Groups are cut no more than ``shards`` of near equal bytes need; without ``shards``, as finely as ``pieces``.
    """
    spark = recs.sparkSession
    whole = recs.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()["bytes"]
    share = F.col("bytes") * pieces / F.lit(max(1, whole))
    large = stash(recs.groupBy("group").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).filter(share > 1).select(
        "group", F.least(F.ceil(share), F.col("rows")).alias("pieces")), "shard-large")        # fewer than ``pieces`` rows
    cut = F.pmod(F.xxhash64(F.lit("piece"), "doc_id", "copy"), F.col("pieces")).cast("int")
    tagged = recs.join(F.broadcast(large), "group", "left").withColumn(
        "home", F.pmod(F.xxhash64("group"), F.lit(slots)).cast("int")).withColumn("piece", cut)
    # At most one row a slot, and fewer than 2 * ``pieces`` pieces.
    found = tagged.groupBy("home", F.when(F.col("pieces").isNotNull(), F.col("group")).alias("group"), "pieces", "piece").agg(
        F.sum("size").alias("bytes")).collect()
    base = np.zeros(slots)
    for r in found:
        if r["group"] is None:
            base[r["home"]] += r["bytes"]
    cuts = sorted((bytes(r["group"]), r["piece"], r["pieces"], r["home"], r["bytes"]) for r in found if r["group"] is not None)
    size = {}
    for group, _, _, _, weight in cuts:
        size[group] = size.get(group, 0) + weight

    def spread(parts_of: int | None) -> tuple[list[int], float]:
        """Slots of all pieces when no part exceeds a shard's mean / parts_of, and how far shards then are from equal."""
        at, weight = [], base.copy()
        for group, piece, count, home, load in cuts:
            parts = count if parts_of is None else min(count, -(-size[group] * shards * parts_of // whole))
            at.append((home + piece * parts // count * 25) % slots)
            weight[at[-1]] += load
        if shards is None:
            return at, 0.0
        loads = np.bincount(rebalance(np.arange(slots) * shards // slots, weight, shards), weights=weight, minlength=shards)
        return at, float(loads.max() - loads.min())

    at, least = spread(None)
    if shards is not None:
        for parts_of in (1, 2, 4):
            coarse, far = spread(parts_of)
            if far <= max(least, NEAR * whole / shards):
                at = coarse
                break
    plan = spark.createDataFrame([(bytearray(c[0]), c[1], int(slot)) for c, slot in zip(cuts, at)],
                                 "group binary, piece int, planned int")
    return tagged.join(F.broadcast(plan), ["group", "piece"], "left").withColumn(
        "virtual_slot", F.coalesce("planned", "home")).drop("pieces", "piece", "home", "planned")


def rebalance(shard_of: np.ndarray, weight: np.ndarray, shards: int) -> np.ndarray:
    """An edited slot map whose shard weights are near equal, with few slots moved.

    Takes a slot from the heaviest shard to the lightest, the one whose weight
    comes nearest to half their difference, until no move brings them closer.
    """
    shard_of = shard_of.copy()
    load = np.bincount(shard_of, weights=weight, minlength=shards)
    for _ in range(50 * len(shard_of)):
        high, low = int(load.argmax()), int(load.argmin())
        gap = load[high] - load[low]
        own = np.flatnonzero((shard_of == high) & (weight > 0) & (weight < gap))
        if not len(own):
            break
        slot = own[np.abs(weight[own] - gap / 2).argmin()]
        shard_of[slot] = low
        load[high] -= weight[slot]
        load[low] += weight[slot]
    return shard_of


class SlotMap:
    """Versions of a slot-to-shard map, one folder each, never overwritten."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def store(self, version: int, shard_of: np.ndarray) -> None:
        rows = [(version, slot, int(shard)) for slot, shard in enumerate(shard_of)]
        self.spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.parquet(f"{self.folder}/{version:06d}")

    def version(self, version: int) -> DataFrame:
        return self.spark.read.schema(MAP_SCHEMA).parquet(f"{self.folder}/{version:06d}")

    def shards(self, version: int) -> np.ndarray:
        rows = self.version(version).orderBy("virtual_slot").collect()      # one row per slot: a fixed number
        return np.array([r["shard"] for r in rows], dtype=np.int64)

    def edit(self, version: int, weight: np.ndarray, shards: int) -> int:
        """Rebalance the given version for ``shards`` shards into the next one."""
        self.store(version + 1, rebalance(self.shards(version), weight, shards))
        return version + 1


def shard(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (place in its shard, from 0), virtual_slot, map_version.

    Shards have near equal bytes.
    """
    spark = prepare(docs.sparkSession)
    placed = stash(with_virtual_slots(records(docs), slots, shards=shards), "shard-placed")
    totals = placed.groupBy("virtual_slot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    weight, rows = np.zeros(slots), np.zeros(slots, np.int64)
    for r in totals.collect():                                               # at most ``slots`` rows
        weight[r["virtual_slot"]], rows[r["virtual_slot"]] = r["bytes"], r["rows"]
    slot_map = SlotMap(spark, folder or f"{checkpoint_dir(spark).rstrip('/')}/slot-map-{uuid.uuid4().hex}")
    slot_map.store(0, np.arange(slots) * shards // slots)
    version = slot_map.edit(0, weight, shards)
    shard_of = slot_map.shards(version)
    # Where each virtual slot's rows begin within its shard.
    order = np.lexsort((np.arange(slots), shard_of))
    ends = np.cumsum(rows[order])
    begin = np.zeros(slots, np.int64)
    begin[order] = ends - rows[order]
    of_shard = np.bincount(shard_of, weights=rows, minlength=shards).astype(np.int64)
    begin -= (np.cumsum(of_shard) - of_shard)[shard_of]
    plan = spark.createDataFrame(
        [(s, int(shard_of[s]), int(begin[s]), int(rows[s] // BUCKET + 1)) for s in range(slots)],
        "virtual_slot int, shard int, begin long, buckets int")
    key = ["virtual_slot", "bucket"]
    rows_of = placed.join(F.broadcast(plan), "virtual_slot").withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit("place"), "group", "doc_id", "copy"), F.col("buckets")).cast("int"))
    order = Window.partitionBy(*key).orderBy("doc_id", "copy", "group")
    # Rows of a slot's earlier buckets: the window holds one row for each BUCKET rows of the slot.
    before = Window.partitionBy("virtual_slot").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = rows_of.groupBy(*key).agg(F.count("*").alias("n")).select(
        *key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return rows_of.withColumn("place", F.row_number().over(order) - 1).join(first, key).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("begin") + F.col("first") + F.col("place")).alias("slot"),
        "virtual_slot", F.lit(version).alias("map_version"))


def op3_sharding(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the virtual slot. The law is ``bytes``."""
    return shard(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")
