"""SimHash near-duplicates with bit-sliced comparison.

A document's fingerprint has a bit set where more than half of its shingle
hashes have it. Fingerprints link when they differ in at most ``radius`` bits;
a document's component is the least doc_id reachable over links.

Search. The fingerprint is cut into eight bytes. Two fingerprints that differ
in at most two bits agree in at least six of the eight, so every link lies
inside a bucket of fingerprints that agree in some six bytes. A bucket leaves 16 bits
free and fingerprints are distinct by then, so it never holds more than 65,536
rows, however many copies or near-copies the corpus has; nothing is capped.
Inside a bucket, fingerprints are stored as vertical bit planes, 64 lanes to a
word. Distances of 64 lanes grow together in carry-save counters, two planes at
a time, and a block of lanes is abandoned once all of them exceed the radius.

Defined cases: a NULL or empty text (or one without words) has fingerprint
zero and links like any other; a text of fewer words than a shingle is one
shingle; repeated rows each get their row back; a NULL doc_id gets a row and
never names a component unless all doc_ids of it are NULL. Only doc_id
and text are read, so extra columns are never touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdcast.llm.common import located, prepare, slices, spaced, stash, text_bytes
from holdcast.llm.components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
PARTS = 8          # bytes of a fingerprint
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_COUNT_ROWS = 1 << 17


def fingerprints_of(data: np.ndarray, bounds: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """uint64 fingerprint of every text of a slice."""
    text, starts, ends, firsts = spaced(_LOWER[data], bounds)
    words = firsts[1:] - firsts[:-1]
    count = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    # The last word of the shingle that begins at each word, within its document.
    begin = np.repeat(firsts[:-1] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    last = np.minimum(begin + shingle, np.repeat(firsts[1:], count)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(text[s:e], SEED) for s, e in zip(starts[begin].tolist(), ends[last].tolist())],
                      dtype=np.uint64)
    owner = np.repeat(np.arange(len(count)), count)
    ones = np.zeros((len(count), 64), np.int64)
    for at in range(0, len(hashes), _COUNT_ROWS):
        part, who = hashes[at:at + _COUNT_ROWS], owner[at:at + _COUNT_ROWS]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        heads = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        ones[who[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    set_bits = (ones * 2 > count[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; fp is the fingerprint's bits as BIGINT."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, 1):
            fp = fingerprints_of(data, bounds, shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), text_bytes().alias("text")).mapInArrow(
        run, "doc_id bigint, fp bigint")


def _planes(fps: np.ndarray, lane: np.ndarray, heads: np.ndarray) -> list[np.ndarray]:
    one = np.uint64(1)
    return [np.bitwise_or.reduceat(((fps >> np.uint64(k)) & one) << lane, heads) for k in range(64)]


def _beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is greater than ``radius`` (a bitwise comparison)."""
    above, level = np.zeros_like(counters[0]), np.full_like(counters[0], _FULL)
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            level &= counters[k]
        else:
            above |= level & counters[k]
            level &= ~counters[k]
    return above


def near_pairs(fps: np.ndarray, heads: np.ndarray, radius: int = RADIUS,
               at_once: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j, of one bucket each, at most ``radius`` bits apart.

    ``heads`` has the first index of every bucket; buckets are contiguous.
    """
    n = len(fps)
    if n < 2:
        return
    size = np.diff(np.r_[heads, n])
    bucket = np.repeat(np.arange(len(heads)), size)
    rank = np.arange(n) - heads[bucket]
    words = (size + 63) // 64
    word_of = np.cumsum(words) - words                       # first word of each bucket
    lane = (rank % 64).astype(np.uint64)
    planes = _planes(fps, lane, np.flatnonzero(rank % 64 == 0))
    filled = np.bitwise_or.reduceat(np.uint64(1) << lane, np.flatnonzero(rank % 64 == 0))
    todo = words[bucket] - rank // 64                        # words at or after a row's own
    first = word_of[bucket] + rank // 64
    edges = np.r_[0, np.cumsum(todo)]
    width = max(1, radius.bit_length())
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + at_once, side="right")) - 1)
        row = np.repeat(np.arange(lo, hi), todo[lo:hi])
        word = np.repeat(first[lo:hi] - (edges[lo:hi] - edges[lo]), todo[lo:hi]) + np.arange(len(row))
        own = word == first[row]
        over = ~filled[word]
        over[own] |= (np.uint64(2) << lane[row[own]]) - np.uint64(1)   # itself and lanes before it
        counters = [np.zeros(len(row), np.uint64) for _ in range(width)]
        for k in range(0, 64, 2):
            value = fps[row]
            a = planes[k][word] ^ -(value >> np.uint64(k) & np.uint64(1))
            b = planes[k + 1][word] ^ -(value >> np.uint64(k + 1) & np.uint64(1))
            low = counters[0]
            carry = (low & a) | (low & b) | (a & b)           # carry-save: three bits to sum and carry
            counters[0] = low ^ a ^ b
            for c in range(1, width):
                counters[c], carry = counters[c] ^ carry, counters[c] & carry
            over |= carry
            if k % 16 == 14:
                over |= _beyond(counters, radius)
                open_ = over != _FULL
                if not open_.any():
                    break
                if not open_.all():
                    row, word, over = row[open_], word[open_], over[open_]
                    counters = [c[open_] for c in counters]
        else:
            over |= _beyond(counters, radius)
            bits = np.unpackbits(np.ascontiguousarray(~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            at, hit = np.nonzero(bits)
            if len(at):
                base = word[at] - word_of[bucket[row[at]]]
                yield row[at], heads[bucket[row[at]]] + base * 64 + hit
        lo = hi


def _keys(fp: Column, radius: int) -> Column:
    """(table, masked fingerprint) under which a fingerprint can meet its links."""
    masks = []
    for kept in combinations(range(PARTS), PARTS - radius):
        mask = sum(0xFF << 8 * part for part in kept)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.array(*[F.struct(F.lit(i).alias("table"), fp.bitwiseAND(F.lit(m).cast("bigint")).alias("masked"))
                     for i, m in enumerate(masks)])


def links(distinct_fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): pairs of distinct fingerprints at most ``radius`` bits apart.

    ``distinct_fps`` has the column fp, each value once. A pair may be listed
    once for each table in which it meets. At most 16 + 120 others lie within
    two bits of a fingerprint inside a bucket, so links are linear in rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3

        def pairs(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            table, masked, fp = parts
            new = np.r_[True, (table[1:] != table[:-1]) | (masked[1:] != masked[:-1])]
            heads = np.flatnonzero(new)
            size = np.diff(np.r_[heads, len(fp)])
            several = np.repeat(size > 1, size)
            fp = fp[several].view(np.uint64)
            size = size[size > 1]
            for i, j in near_pairs(fp, np.cumsum(size) - size, radius):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[i].view(np.int64)), pa.array(fp[j].view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held = [np.concatenate([h, batch.column(k).to_numpy().astype(np.int64)]) for k, h in enumerate(held)]
            last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
            if len(last):                                    # the last bucket may go on in the next batch
                cut = last[-1] + 1
                yield from pairs([h[:cut] for h in held])
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield from pairs(held)

    keyed = distinct_fps.select("fp", F.explode(_keys(F.col("fp"), radius)).alias("k")).select(
        "k.table", "k.masked", "fp")
    return (keyed.repartition("table", "masked").sortWithinPartitions("table", "masked")
            .mapInArrow(run, "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    prepare(docs.sparkSession)
    if not 0 <= radius < PARTS:
        raise ValueError(f"radius must be from 0 to {PARTS - 1}")
    prints = stash(fingerprints(docs, shingle), "simhash-prints")
    groups = stash(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-groups")
    roots = components(links(groups.select("fp"), radius))
    rooted = groups.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = stash(rooted.join(named, "root").select("fp", "component_id"), "simhash-labels")
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` without near-duplicates: of every component the document with the least doc_id.

    Rows that repeat one doc_id stay or go together; rows without a doc_id stay.
    """
    found = near_duplicates(docs.filter("doc_id is not null"), shingle, radius)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of every component, all columns as they were.

    The row with the least doc_id stays, of several the first by content locator; a NULL doc_id is greater than any other.
    """
    prepare(docs.sparkSession)
    places = located(docs)
    # Rows are told apart by a number of their own, so that nulls and repeated ids are rows like any other.
    numbered = stash(places.select(F.monotonically_increasing_id().alias("doc_id"), "row.text", F.struct(
        F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").cast("bigint").alias("doc_id"),
        "file", "position").alias("row")), "simhash-numbered")
    found = near_duplicates(numbered.select("doc_id", "text"), shingle, radius).select("doc_id", "component_id")
    first = found.join(numbered.select("doc_id", "row"), "doc_id").groupBy("component_id").agg(F.min("row").alias("row"))
    kept = first.select("row.file", "row.position")
    return places.join(kept, ["file", "position"], "left_semi").select("row.*")


def op1_simhash(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
