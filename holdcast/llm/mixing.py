"""Mixing sources to target weights, in fixed-length token blocks.

Every source's documents form one stream of words that is packed into blocks of
BLOCK words (the last may be shorter). Output shards draw their numbers of
blocks per source from a multinomial over what is left of the targets, so
shards are random mixes and totals still meet the targets. A source's slots are
numbered over all shards; slot j stands for epoch j // blocks, and within it a
pseudorandom permutation of the source's block indices (a Feistel network, new
keys for every epoch) says which block it takes. Blocks and slots then meet in
a join by (source, block index). A source's last slot takes only as many words
as its target still needs.

Word offsets come from sums in two levels (a hash bucket of documents, then the
documents of a bucket), so a source with a third of all rows is spread over
its buckets. Per-source figures go through the driver; there is one row for each distinct
source and nothing else is collected.

Defined cases: a NULL text has no words; documents without words are listed
with taken 0; NULL is a source of its own, ordered last; a NULL doc_id is a
document like any other; of rows repeated with doc_id and text, each is a
document of its own. An empty table gives an empty result. Only doc_id, source
and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdcast.llm.common import located, mix64, prepare, ranges, stash, text_bytes

BLOCK = 256
SHARDS = 64
MOST = 3               # times a source may be repeated
WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 200_000
CHUNK = 1 << 14        # slots that one row of the slot plan stands for
TASK_SLOTS = 4 * CHUNK
MOST_TASKS = 10_000
SEED = 20240607


def weights(n: int) -> np.ndarray:
    """1, 2, 3 repeating, for sources in code point order."""
    return np.arange(n) % 3 + 1.0


def fill(sizes: np.ndarray, weight: np.ndarray, total: float, most: float = MOST) -> np.ndarray:
    """Shares of ``total`` by weight; none above ``most`` times its size, excess reshared by weight."""
    target, limit = np.zeros(len(sizes)), most * sizes.astype(float)
    open_, left = np.ones(len(sizes), bool), float(total)
    while open_.any():
        share = left * weight / weight[open_].sum()
        above = open_ & (share > limit)
        if not above.any():
            target[open_] = share[open_]
            break
        target[above] = limit[above]
        left -= float(limit[above].sum())
        open_ &= ~above
    return target


def _round_keys(seed: int, source: int, epoch: np.ndarray, rounds: int = 4) -> list[np.ndarray]:
    base = mix64(np.uint64(seed) + mix64(np.asarray(source, np.uint64).reshape(1)) + mix64(epoch.astype(np.uint64)))
    return [mix64(base + np.uint64(k)) for k in range(1, rounds + 1)]


def permute(position: np.ndarray, n: int, source: int, epoch: np.ndarray, seed: int = SEED,
            inverse: bool = False) -> np.ndarray:
    """A pseudorandom permutation of 0 .. n - 1 for every (source, epoch): image of each position.

    A Feistel network over the least even number of bits that holds n; values
    outside 0 .. n - 1 are run through it again until they fall inside.
    """
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = _round_keys(seed, source, epoch)
    if inverse:
        keys = keys[::-1]
    x = position.astype(np.uint64)
    todo = np.ones(len(x), bool)
    while todo.any():
        left, right = x[todo] >> shift, x[todo] & mask
        if inverse:
            left, right = right, left
        for key in keys:
            left, right = right, left ^ (mix64(right + key[todo]) & mask)
        if inverse:
            left, right = right, left
        x[todo] = left << shift | right
        todo = x >= np.uint64(n)
    return x.astype(np.int64)


@dataclass(frozen=True)
class Share:
    """What the mix takes of one source."""

    size: int           # words
    blocks: int
    target: float
    epochs: int         # whole passes
    slots: int
    last: int           # words that the last slot takes


def share_of(source: int, size: int, target: float, block: int = BLOCK, seed: int = SEED) -> Share:
    blocks, goal = -(-size // block), round(target)
    if not size or not goal:
        return Share(size, blocks, target, 0, 0, 0)
    epochs, rest = divmod(goal, size)
    short = blocks * block - size
    length = lambda at: block - short * (at == blocks - 1)
    if not rest:
        end = permute(np.array([blocks - 1]), blocks, source, np.array([epochs - 1]), seed)[0]
        return Share(size, blocks, target, epochs, epochs * blocks, length(end))
    tail = permute(np.array([blocks - 1]), blocks, source, np.array([epochs]), seed, inverse=True)[0]
    part = -(-rest // block)
    words = part * block - short * int(tail < part)
    if words < rest:
        part, words = part + 1, (part + 1) * block - short
    end = permute(np.array([part - 1]), blocks, source, np.array([epochs]), seed)[0]
    return Share(size, blocks, target, epochs, epochs * blocks + part, length(end) - (words - rest))


def draw(quota: np.ndarray, shards: int, seed: int = SEED) -> Iterator[np.ndarray]:
    """Slots of every source in each shard: multinomial over what is left of the quotas."""
    rng, left = np.random.default_rng(seed), quota.astype(np.int64)
    for shard in range(shards):
        need, got = int(left.sum()) // (shards - shard), np.zeros(len(left), np.int64)
        while (more := need - int(got.sum())) > 0:
            open_ = left - got
            got += np.minimum(rng.multinomial(more, open_ / open_.sum()), open_)
        left -= got
        yield got


def records(places: DataFrame) -> DataFrame:
    """Slim rows of located documents: id, doc_id, source, size (words), and the content locator."""
    text = text_bytes("row.text")
    slim = places.select(
        F.col("row.doc_id").cast("bigint").alias("doc_id"), F.col("row.source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"), F.xxhash64(text).alias("content"),
        "file", "position")
    return stash(slim.withColumn("id", F.monotonically_increasing_id()), "mix-records")


def plan(recs: DataFrame, block: int = BLOCK, most: float = MOST) -> tuple[list[str | None], list[Share]]:
    """The sources in code point order (NULL last) and what the mix takes of each."""
    found = {r["source"]: r["size"] for r in recs.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    names = sorted(found, key=lambda s: (s is None, s or ""))
    sizes = np.array([found[s] for s in names], dtype=np.int64)
    goal = fill(sizes, weights(len(names)), float(sizes.sum()), most)
    return names, [share_of(i, int(n), float(t), block) for i, (n, t) in enumerate(zip(sizes, goal))]


def slots(spark, shares: list[Share], block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """shard, source_no, slot, block, words: the blocks of the mix, by output shard."""
    quota, first, draws = np.array([s.slots for s in shares], dtype=np.int64), np.zeros(len(shares), np.int64), []
    for shard, got in enumerate(draw(quota, shards)):
        draws += [(shard, i, int(first[i]), int(first[i] + got[i])) for i in np.flatnonzero(got).tolist()]
        first += got
    facts = {i: (s.blocks, s.size, s.slots, s.last) for i, s in enumerate(shares)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, source, start, n in zip(*(c.to_pylist() for c in batch.columns)):
                blocks, size, count, last = facts[source]
                slot = np.arange(start, start + n)
                at = permute(slot % blocks, blocks, source, slot // blocks)
                words = np.minimum(block, size - at * block)
                words[slot == count - 1] = last
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, shard, np.int32)), pa.array(np.full(n, source, np.int32)),
                     pa.array(slot), pa.array(at), pa.array(words)],
                    names=["shard", "source_no", "slot", "block", "words"])

    # A row for each shard and source; the chunks they stand for are made and dealt out by Spark, into
    # tasks counted by slots, as the plan's own bytes say nothing of what it becomes.
    chunks = spark.createDataFrame(draws, "shard int, source_no int, begin bigint, end bigint").select(
        "shard", "source_no", "end", F.explode(F.sequence("begin", F.col("end") - 1, F.lit(CHUNK).cast("bigint"))).alias("start"))
    return chunks.select("shard", "source_no", "start", F.least(F.lit(CHUNK), F.col("end") - F.col("start")).alias("n")).repartition(
        slot_tasks(int(quota.sum())), "source_no", "start").mapInArrow(
        run, "shard int, source_no int, slot bigint, block bigint, words bigint")


def slot_tasks(slots: int) -> int:
    """Tasks that list the slots: TASK_SLOTS each, more only beyond MOST_TASKS tasks (they stream by CHUNK)."""
    return min(MOST_TASKS, max(1, -(-slots // TASK_SLOTS)))


def segments(recs: DataFrame, names: list[str | None], block: int = BLOCK) -> DataFrame:
    """id, source_no, block, at, n, begin: the words of each document that lie in each block of its source.

    ``at`` is the segment's place in the block, ``begin`` its place in the document.
    """
    spark = recs.sparkSession
    numbered = spark.createDataFrame([(i, s) for i, s in enumerate(names)], "source_no int, __name string")
    buckets = max(64, recs.count() // BUCKET_ROWS)
    own = recs.filter("size > 0").join(numbered, F.col("source").eqNullSafe(F.col("__name"))).select(
        "id", "doc_id", "content", "size", "source_no",
        F.pmod(F.xxhash64("doc_id", "content"), F.lit(buckets)).alias("bucket"))
    sums = own.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("source_no", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("source_no", "bucket").orderBy("doc_id", "content", "id").rowsBetween(
        Window.unboundedPreceding, -1)
    offset = own.withColumn("inside", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(
        base, ["source_no", "bucket"]).select("id", "source_no", "size", (F.col("base") + F.col("inside")).alias("off"))
    cut = offset.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("off") / block).cast("bigint"), F.floor((F.col("off") + F.col("size") - 1) / block).cast("bigint"))))
    low = F.greatest(F.col("off"), F.col("block") * block)
    high = F.least(F.col("off") + F.col("size"), (F.col("block") + 1) * block)
    return cut.select("id", "source_no", "block", (low - F.col("block") * block).alias("at"),
                      (high - low).alias("n"), (low - F.col("off")).alias("begin"))


def taken_segments(recs: DataFrame, names: list[str | None], shares: list[Share], block: int = BLOCK,
                   shards: int = SHARDS) -> DataFrame:
    """Segments joined by block index with the slots that take them: id, begin, n, times, part.

    ``times`` slots take the whole segment and one more takes its first ``part`` words.
    """
    used = slots(recs.sparkSession, shares, block, shards).groupBy("source_no", "block").agg(
        F.count("*").alias("times"), F.min("words").alias("words"))
    part = F.greatest(F.lit(0), F.least(F.col("n"), F.col("words") - F.col("at")))
    # Spark takes the slots for as small as the plan they are made from; they grow with the corpus.
    return segments(recs, names, block).join(used.hint("merge"), ["source_no", "block"]).select(
        "id", "source_no", "begin", "n", (F.col("times") - 1).alias("times"), part.alias("part"))


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``."""
    spark = prepare(docs.sparkSession)
    recs = records(located(docs.select("doc_id", "source", "text")))
    names, shares = plan(recs, block)
    taken = taken_segments(recs, names, shares, block).groupBy("id").agg(
        F.sum(F.col("times") * F.col("n") + F.col("part")).alias("taken"))
    facts = spark.createDataFrame([(s, x.size, x.target) for s, x in zip(names, shares)],
                                  "__name string, source_size bigint, target double")
    return (recs.join(taken, "id", "left").join(facts, F.col("source").eqNullSafe(F.col("__name")))
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))


def mixed_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as rows with the columns of ``docs``: what each pass takes of each document.

    A pass that takes a whole document gives its row unchanged. A pass that takes
    part of it gives its taken words joined by single spaces; n_chars then
    counts that text if the column has a number or string type. Documents of which nothing is taken are not listed.
    """
    prepare(docs.sparkSession)
    places = located(docs)
    recs = records(places)
    names, shares = plan(recs, block)
    epochs = places.sparkSession.createDataFrame([(i, s.epochs) for i, s in enumerate(shares)],
                                               "source_no int, epochs int")
    found = taken_segments(recs, names, shares, block).join(epochs, "source_no")
    # Of a segment, ``epochs`` slots are whole passes; what is beyond them is the last pass.
    last = F.col("times") * F.col("n") + F.col("part") - F.col("epochs") * F.col("n")
    per_doc = found.groupBy("id").agg(
        F.first("epochs").alias("epochs"), F.sum(last).alias("rest"),
        F.sort_array(F.collect_list(F.when(last > 0, F.struct("begin", last.alias("n"))))).alias("pieces"))
    chosen = recs.join(per_doc, "id").select("file", "position", "size", "epochs", "rest", "pieces")
    whole = F.col("epochs") + F.when(F.col("rest") == F.col("size"), 1).otherwise(0)
    has_part = (F.col("rest") > 0) & (F.col("rest") < F.col("size"))
    rows = places.join(chosen, ["file", "position"]).withColumn("partly", F.explode(F.concat(
        F.array_repeat(F.lit(False), whole.cast("int")), F.array_repeat(F.lit(True), has_part.cast("int")))))
    rows = rows.withColumn("words", F.when(F.col("partly"), F.regexp_extract_all(text_bytes("row.text"), F.lit(WORD), F.lit(0))))
    taken = F.array_join(F.flatten(F.transform("pieces", lambda p: F.slice(
        F.col("words"), (p["begin"] + 1).cast("int"), p["n"].cast("int")))), " ")
    rows = rows.withColumn("taken", F.when(F.col("partly"), taken))
    out = []
    for name, kind in ((f.name, f.dataType) for f in docs.schema.fields):
        value = F.col("row").getField(name)
        if name == "text":
            value = F.when(F.col("partly"), F.col("taken")).otherwise(value)
        elif name == "n_chars" and isinstance(kind, (T.NumericType, T.StringType)):
            value = F.when(F.col("partly"), F.length("taken").try_cast(kind)).otherwise(value)
        out.append(value.alias(name))
    return rows.select(*out)


def op10_mixing(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    return mix(docs)
