"""Suffix-array dedup: every byte that a 100-byte string covers which also starts earlier is removed.

Sorting every suffix of a corpus would move it a hundred times over. A string of
WINDOW bytes holds a GRAM-byte string whose hash is the least of its
WINDOW - GRAM + 1 ones, its anchor; equal strings have their anchors at the same place.
So only the suffixes at anchors (one in about 39) are sorted, by their leading GRAM bytes:

1. Splitters are drawn from a sample of all texts and cut the suffixes into ranges of
   leading bytes, one range a bucket. A bucket sorts its suffixes by a multikey sort
   (eight bytes a symbol, going on only with what is still equal) and keeps those
   whose leading bytes are not alone.
2. What is left meets its text again (one shuffle of the texts) and is sent, with the
   bytes of the strings that have this anchor, to ranges in the same way. A bucket first
   takes equal contexts together: all strings of a later one are repeats. The strings of
   different contexts are then sorted by all their bytes, for each place of the anchor.
3. Leading bytes that equal a splitter may lie on both sides of a boundary between
   buckets, as those of any hot group do. Their rows go to all buckets alike; each answers for
   all but its earliest row of a context. Those earliest rows are then compared across
   the buckets: by a grouped minimum, and, for different contexts, by sorting their strings in
   as many shards as they ask for.

Memory of a task depends on BUCKET and CONTEXTS, not on the data: the buckets are as
many as the texts ask for. One splitter a bucket, SAMPLES sampled ones before, pass
through the driver.

Defined cases: a NULL text is empty; texts below WINDOW bytes keep all. A NULL doc_id
is larger than all others. Rows of one doc_id are one document in the order of their texts'
hashes; no string crosses from one to the next, and rows that repeat id and
text are the same row, with equal results. Long texts are read in pieces of windows. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdcast.llm.common import mix64, prepare, ranges, slices, stash, text_bytes

WINDOW = 100
GRAM = 24
SPAN = WINDOW - GRAM + 1
BUCKET = 1 << 20        # suffixes that a task sorts, about
CONTEXTS = 1 << 16      # contexts that a task sorts, about
SAMPLES = 32            # sampled suffixes for each splitter
SEGMENT = 1 << 20       # windows of a long text worked on at a time
PLACE = np.uint64((1 << 31) - 1)
FACTORS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


# ---- bytes, windows and anchors ----

def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one big-endian number."""
    x = data.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] << np.uint64(8 * step) | x[step:]
    return x


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x, done = np.minimum(x[:-done], x[done:]), 2 * done
    return np.minimum(x[:len(x) - (width - done)], x[width - done:]) if done < width else x


def anchors(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(at, first, last, lead): anchors of the texts in ``data``, and the windows that have each.

    ``first`` to ``last`` are the starts of those windows, ``lead`` the GRAM bytes at the anchor as three
    numbers. A long buffer is cut into segments; an anchor whose windows lie in two of them comes twice.
    """
    for begin in range(0, len(data) - WINDOW + 1, SEGMENT):
        stop = min(begin + SEGMENT, len(data) - WINDOW + 1)
        words = eights(data[begin:stop + WINDOW - 1])
        n = stop - begin + SPAN - 1
        hashed = mix64(words[:n] * FACTORS[0] ^ words[8:n + 8] * FACTORS[1] ^ words[16:n + 16] * FACTORS[2])
        at = (_least(hashed & ~PLACE | np.arange(n, dtype=np.uint64), SPAN) & PLACE).astype(np.int64)
        crossing = np.zeros(stop - begin + 1, np.int64)       # texts that end inside a window
        np.add.at(crossing, np.clip(bounds - WINDOW + 1 - begin, 0, stop - begin), 1)
        np.add.at(crossing, np.clip(bounds - begin, 0, stop - begin), -1)
        whole = np.cumsum(crossing)[:-1] == 0
        change = at[1:] != at[:-1]
        first = np.flatnonzero(whole & np.append(True, change | ~whole[:-1]))
        last = np.flatnonzero(whole & np.append(change | ~whole[1:], True))
        place = at[first]
        yield place + begin, first + begin, last + begin, np.stack([words[place], words[place + 8], words[place + 16]], axis=1)


def as_text(lead: np.ndarray) -> np.ndarray:
    """Leads as byte strings that compare in their order."""
    return np.ascontiguousarray(lead.astype(">u8")).view(f"S{GRAM}").ravel()


def multikey_sort(groups: np.ndarray, symbol, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, run): sorts strings within groups, one symbol at a time and only those still equal to another.

    ``symbol(rows, level)`` gives the symbols of some strings. Equal strings get one run and keep their order.
    """
    order = np.argsort(groups, kind="stable")
    begins = np.append(True, groups[order][1:] != groups[order][:-1])[:len(order)]
    for level in range(levels):
        alone = begins & np.append(begins[1:], True)
        left = np.flatnonzero(~alone)
        if not len(left):
            break
        rows, run = order[left], np.cumsum(begins)[left]
        key = symbol(rows, level)
        sort = np.lexsort((key, run))
        order[left], key = rows[sort], key[sort]
        begins[left[1:]] |= (run[1:] == run[:-1]) & (key[1:] != key[:-1])
    return order, np.cumsum(begins) - 1


# ---- sampled splitters ----

def _sampled(docs: DataFrame, rate: float) -> np.ndarray:
    """Leads of the anchors of windows drawn from all texts, ``rate`` of them a byte."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, bounds in slices(batches, 0):
            draw = np.random.default_rng(len(data))
            start = draw.integers(0, max(len(data), 1), draw.poisson(len(data) * rate))
            end = bounds[np.searchsorted(bounds, start, side="right").clip(max=len(bounds) - 1)]
            start = start[end - start >= WINDOW]
            windows = data[(start[:, None] + np.arange(WINDOW)).ravel()]
            for *_, lead in anchors(windows, np.arange(len(start) + 1) * WINDOW):
                yield _batch(lead=list(lead.astype(">u8").tobytes()[i:i + GRAM] for i in range(0, len(lead) * GRAM, GRAM)))

    return np.array([bytes(r["lead"]) for r in docs.select("text").mapInArrow(run, "lead binary").collect()], f"S{GRAM}")


def splitters(sample: np.ndarray, buckets: int) -> np.ndarray:
    """Up to ``buckets`` - 1 different leads that cut the sample into equal parts."""
    sample = np.sort(sample)
    places = np.arange(1, buckets) * len(sample) // buckets
    return np.unique(sample[places]) if len(sample) else sample


def deal(lead: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every lead, and whether it equals a splitter and so belongs to none."""
    if not len(cuts):
        return np.zeros(len(lead), np.int64), np.zeros(len(lead), bool)
    text = as_text(lead)
    bucket = np.searchsorted(cuts, text)
    return bucket, cuts[bucket.clip(max=len(cuts) - 1)] == text


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns))


LEAD = "l0 bigint, l1 bigint, l2 bigint"


def _leads(lead: np.ndarray) -> dict[str, np.ndarray]:
    return {f"l{i}": np.ascontiguousarray(lead[:, i]).view(np.int64) for i in range(3)}


def _lead(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    return np.stack([batch.column(f"l{i}").to_numpy().view(np.uint64) for i in range(3)], axis=1)


def _all(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """All rows of a bucket: as many as its range holds, BUCKET or CONTEXTS about."""
    found = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(found).combine_chunks() if found else None


# ---- first sort: leading bytes that are not alone ----

SUFFIX = f"bucket int, hot boolean, {LEAD}, rid bigint, at int"


def suffixes(docs: DataFrame, cuts: np.ndarray, buckets: int) -> DataFrame:
    """A row per anchor of every text (rid, text), with its bucket; hot ones are spread over all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in slices(batches, 1):
            rid = part.column(0).to_numpy()
            for at, first, _, lead in anchors(data, bounds):
                doc = np.searchsorted(bounds, first, side="right") - 1
                bucket, hot = deal(lead, cuts)
                bucket = np.where(hot, (rid[doc] + at) % buckets, bucket)
                yield _batch(bucket=bucket.astype(np.int32), hot=hot, **_leads(lead), rid=rid[doc], at=(at - bounds[doc]).astype(np.int32))

    return docs.select("rid", "text").mapInArrow(run, SUFFIX)


def repeated(found: DataFrame, buckets: int) -> DataFrame:
    """The suffixes whose leading bytes occur again, or lie on a boundary between buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _all(batches)
        if rows is None:
            return
        lead, hot = _lead(rows), rows.column("hot").to_numpy()
        order, run = multikey_sort(np.zeros(len(lead), np.int8), lambda r, level: lead[r, level], 3)
        keep = np.zeros(len(lead), bool)
        keep[order] = np.bincount(run)[run] > 1
        yield from rows.filter(pa.array(keep | hot)).select(["l0", "l1", "l2", "rid", "at"]).to_batches(1 << 16)

    return found.repartitionById(buckets, "bucket").mapInArrow(run, f"{LEAD}, rid bigint, at int")


# ---- second sort: the strings around them ----

CONTEXT = f"bucket int, hot boolean, {LEAD}, before int, context binary, unknown boolean, doc_id bigint, rid bigint, text_id bigint, first int"
RANGE = "rid bigint, text_id bigint, first int, last int"
# Ranges of repeated windows; and, with a context, the earliest rows that a bucket has seen of it.
FOUND = f"{RANGE}, unknown boolean, doc_id bigint, before int, context binary"
# What counts as earlier: NULL ids last, rows of one id by their texts' hashes, then places.
ORDER = ("unknown", "doc_id", "rid", "text_id", "first")
STEPS = [*range(0, WINDOW - 8, 8), WINDOW - 8]     # a window's bytes as symbols of eight


def contexts(texts: DataFrame, cuts: np.ndarray, buckets: int) -> DataFrame:
    """The bytes of all windows of every kept anchor, ``before`` of them ahead of it, with a bucket.

    Those whose lead lies on a boundary between buckets are ``hot`` and dealt by row, over all buckets.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in slices(batches, 0):
            kept = part.column("ats")
            doc_ids, rids, text_ids = (part.column(c) for c in ("doc_id", "rid", "text_id"))
            wanted = np.unique(np.concatenate([np.asarray(kept[i].values, np.int64) + bounds[i] for i in range(len(kept))]))
            for at, first, last, lead in anchors(data, bounds):
                use = np.flatnonzero(np.isin(at, wanted))
                if not len(use):
                    continue
                at, first, last, lead = at[use], first[use], last[use], lead[use]
                bucket, hot = deal(lead, cuts)
                doc = np.searchsorted(bounds, first, side="right") - 1
                size = last - first + WINDOW
                ends = np.append(0, np.cumsum(size))
                context = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.astype(np.int32)),
                                                                         pa.py_buffer(data[ranges(first, size)].tobytes())])
                place = pa.array(doc)
                ids, rid = doc_ids.take(place), rids.take(place)
                bucket = np.where(hot, rid.to_numpy() % buckets, bucket)
                yield _batch(bucket=bucket.astype(np.int32), hot=hot, **_leads(lead), before=(at - first).astype(np.int32), context=context,
                             unknown=ids.is_null(), doc_id=ids.fill_null(0), rid=rid, text_id=text_ids.take(place),
                             first=(first - bounds[doc]).astype(np.int32))

    return texts.select("text", "doc_id", "rid", "text_id", "ats").mapInArrow(run, CONTEXT)


def _in_order(rows: pa.Table) -> pa.Table:
    return rows.take(pa.array(np.lexsort([rows.column(c).to_numpy() for c in reversed(ORDER)])))


def _ranges(rid, text_id, first, last, **leaders) -> pa.RecordBatch:
    """Rows of FOUND."""
    kinds = {"unknown": pa.bool_(), "doc_id": pa.int64(), "before": pa.int32(), "context": pa.binary()}
    rest = {c: leaders.get(c, pa.nulls(len(rid), kind)) for c, kind in kinds.items()}
    return _batch(rid=rid, text_id=text_id, first=first.astype(np.int32), last=last.astype(np.int32), **rest)


def _windows(begin: np.ndarray, before: np.ndarray, most: np.ndarray, ahead: int) -> tuple[np.ndarray, np.ndarray]:
    """Which contexts have a window that begins ``ahead`` bytes before the anchor, and where in all bytes."""
    use = np.flatnonzero((before >= ahead) & (before - ahead <= most))
    return use, (begin + before - ahead)[use]


def _string_hash(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    found = np.zeros(len(at), np.uint64)
    for step in STEPS:
        found = mix64(found ^ words[at + step] * FACTORS[0])
    return found


def _bytes_of(context: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All contexts as numbers of eight bytes, where each begins, and its last window."""
    size = np.array([len(c) for c in context], np.int64)
    return eights(np.frombuffer(b"".join(context), np.uint8)), np.cumsum(size) - size, size - WINDOW


def repeated_strings(group: np.ndarray, before: np.ndarray, context: list[bytes], shard: np.ndarray | None = None,
                     shards: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last): runs of windows that a row of the same group, earlier in the table, has as well.

    Strings are sorted by all their bytes, for each number of bytes ahead of the anchor. With ``shards``
    a row answers only for the windows of its shard.
    """
    words, begin, most = _bytes_of(context)
    removed = np.zeros((len(context), SPAN), bool)
    for ahead in range(SPAN):
        use, at = _windows(begin, before, most, ahead)
        if shards is not None and len(use):
            mine = (shards[use] == 1) | (_string_hash(words, at) % shards[use].astype(np.uint64) == shard[use].astype(np.uint64))
            use, at = use[mine], at[mine]
        if len(use) < 2:
            continue
        order, run = multikey_sort(group[use], lambda r, level: words[at[r] + STEPS[level]], len(STEPS))
        which = use[order[np.append(False, run[1:] == run[:-1])]]
        removed[which, before[which] - ahead] = True
    edge = np.diff(np.pad(removed, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


def _groups(lead: np.ndarray) -> np.ndarray:
    order, run = multikey_sort(np.zeros(len(lead), np.int8), lambda r, level: lead[r, level], 3)
    group = np.zeros(len(lead), np.int64)
    group[order] = run
    return group


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of a bucket's contexts that an earlier text, or place of the same text, has as well.

    Of hot contexts a bucket has only some rows: it answers for all but the earliest, which it hands on.
    """
    rows = _all(batches)
    if rows is None:
        return
    rows = _in_order(rows)
    rids, text_ids, first, hot = (rows.column(c).to_numpy() for c in ("rid", "text_id", "first", "hot"))
    before, context = rows.column("before").to_numpy(), rows.column("context").to_pylist()
    known: dict[tuple[int, bytes], int] = {}
    leader = np.array([known.setdefault(key, i) for i, key in enumerate(zip(before.tolist(), context))])
    same_row = (rids == rids[leader]) & (text_ids == text_ids[leader]) & (first == first[leader])
    later = np.flatnonzero(~same_row)
    windows = np.array([len(c) for c in context], np.int64) - WINDOW
    yield _ranges(rids[later], text_ids[later], first[later], first[later] + windows[later])

    leads = leader == np.arange(len(leader))
    ahead = rows.filter(pa.array(leads & hot))
    yield _ranges(*(ahead.column(c).to_numpy() for c in ("rid", "text_id", "first", "first")),
                  **{c: ahead.column(c).combine_chunks() for c in ("unknown", "doc_id", "before", "context")})

    # Different contexts with one lead.
    group = _groups(_lead(rows))
    own = np.flatnonzero(leads & ~hot)
    own = own[np.bincount(group[own], minlength=1)[group[own]] > 1]
    if len(own):
        row, start, end = repeated_strings(group[own], before[own], [context[i] for i in own.tolist()])
        row, base = own[row], first[own[row]]
        yield _ranges(rids[row], text_ids[row], base + start, base + end)


def _across(leaders: DataFrame, buckets: int) -> DataFrame:
    """Ranges of the hot contexts' earliest rows, one for each bucket and context, compared across the buckets.

    A lead with more than ``buckets``' share of contexts is cut into shards by the hash of its strings.
    """
    row = F.struct(*ORDER)
    least = stash(leaders.groupBy("before", "context").agg(F.min(row).alias("least")), "suffix-leaders")
    later = leaders.join(least, ["before", "context"]).filter(row != F.col("least")).select(
        "rid", "text_id", "first", (F.col("first") + F.length("context") - WINDOW).cast("int").alias("last"))
    lead = F.substring("context", F.col("before") + 1, F.lit(GRAM))
    sizes = {bytes(r["lead"]): r["n"] for r in least.groupBy(lead.alias("lead")).agg(F.count(F.lit(1)).alias("n")).collect()}  # splitters at most
    share = max(1, -(-sum(sizes.values()) // buckets))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            before, context = batch.column("before").to_numpy(), batch.column("context").to_pylist()
            words, begin, most = _bytes_of(context)
            lead = np.stack([words[begin + before + 8 * i] for i in range(3)], axis=1)
            shards = np.array([-(-sizes[c[b:b + GRAM]] // share) for c, b in zip(context, before.tolist())])
            found = [np.flatnonzero(shards == 1)], [np.zeros(int((shards == 1).sum()), np.int64)]
            for ahead in range(SPAN):
                use, at = _windows(begin, before, most, ahead)
                use, at = use[shards[use] > 1], at[shards[use] > 1]
                found[0].append(use)
                found[1].append((_string_hash(words, at) % shards[use].astype(np.uint64)).astype(np.int64))
            index, shard = np.unique(np.stack([np.concatenate(x) for x in found], axis=1), axis=0).T
            bucket = mix64(lead[index] @ np.array(FACTORS) + shard.astype(np.uint64)) % np.uint64(buckets)
            part = batch.take(pa.array(index))
            yield _batch(bucket=bucket.astype(np.int32), shard=shard.astype(np.int32), shards=shards[index].astype(np.int32), **_leads(lead[index]),
                         **{c: part.column(c) for c in ("before", "context", *ORDER)})

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _all(batches)
        if rows is None:
            return
        rows = _in_order(rows)
        rids, text_ids, first, shard, shards = (rows.column(c).to_numpy() for c in ("rid", "text_id", "first", "shard", "shards"))
        row, start, end = repeated_strings(_groups(_lead(rows)), rows.column("before").to_numpy(), rows.column("context").to_pylist(), shard, shards)
        yield _batch(rid=rids[row], text_id=text_ids[row], first=(first[row] + start).astype(np.int32), last=(first[row] + end).astype(np.int32))

    dealt = least.select("before", "context", "least.*").mapInArrow(
        spread, f"bucket int, shard int, shards int, {LEAD}, before int, context binary, unknown boolean, doc_id bigint, "
                "rid bigint, text_id bigint, first int")
    return later.unionByName(dealt.repartitionById(buckets, "bucket").mapInArrow(strings, RANGE))


# ---- what is left of every text ----

RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the windows of their ranges."""
    for part, data, bounds in slices(batches, 0):
        text, out = memoryview(data), []
        for i, removed in enumerate(part.column("ranges")):
            base, end = int(bounds[i]), int(bounds[i + 1])
            spans: list[list[int]] = []
            if removed.is_valid and len(removed.values):
                first, last = (np.asarray(removed.values.field(c), np.int64) for c in ("first", "last"))
                order = np.argsort(first, kind="stable")
                first, reach = first[order], np.maximum.accumulate(last[order] + WINDOW)
                new = np.append(True, first[1:] > reach[:-1])
                ends = reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]
                spans = [[int(a), int(b)] for a, b in zip(first[new], ends)]
            kept, place = hashlib.sha256(), base
            for a, b in spans:
                kept.update(text[place:base + a])
                place = base + b
            kept.update(text[place:end])
            out.append((end - base, sum(b - a for a, b in spans), len(spans), kept.hexdigest()))
        n, gone, spans, digest = zip(*out)
        yield _batch(doc_id=part.column("doc_id"), n_bytes=pa.array(n, pa.int64()), n_removed=pa.array(gone, pa.int64()),
                     n_spans=pa.array(spans, pa.int64()), kept_sha256=list(digest))


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Each finished write frees its shuffle files, so that disk holds those of one step at a time."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def remove_repeats(documents: DataFrame, bucket: int = BUCKET, bucket_contexts: int = CONTEXTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``documents``."""
    spark = prepare(documents.sparkSession)
    text = text_bytes()
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"),
                            F.xxhash64(F.col("doc_id").cast("bigint"), text).alias("rid"), F.xxhash64(text, F.lit(1)).alias("text_id"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    with _shuffles_dropped(spark):
        buckets = total * 2 // (SPAN * bucket) + 1
        cuts = splitters(_sampled(docs, SAMPLES * buckets / max(total, 1)), buckets) if buckets > 1 else np.array([], f"S{GRAM}")
        kept = stash(repeated(suffixes(docs, cuts, buckets), buckets), "suffix-repeated")

        many = kept.count()
        parts = many // bucket_contexts + 1
        drawn = kept.sample(min(1.0, SAMPLES * parts / max(many, 1)), seed=1).select("l0", "l1", "l2").toArrow() if parts > 1 else None
        cuts = splitters(as_text(_lead(drawn.combine_chunks())), parts) if drawn is not None and drawn.num_rows else np.array([], f"S{GRAM}")

        places = kept.groupBy("rid").agg(F.collect_list("at").alias("ats"))
        clean = F.when(F.col("ats").isNull(), F.sha2("text", 256))
        rows = stash(docs.join(places, "rid", "left").select(
            "doc_id", "rid", "text_id", F.octet_length("text").cast("bigint").alias("n_bytes"), clean.alias("kept_sha256"),
            F.when(F.col("ats").isNotNull(), F.col("text")).alias("text"), "ats"), "suffix-texts")

        texts = rows.filter(F.col("ats").isNotNull())
        found = stash(contexts(texts, cuts, parts).repartitionById(parts, "bucket").mapInArrow(_later, FOUND), "suffix-found")
        gone = found.filter(F.col("context").isNull()).select("rid", "text_id", "first", "last")
        if len(cuts):
            gone = gone.unionByName(_across(found.filter(F.col("context").isNotNull()), parts))
        gone = stash(gone.groupBy("rid", "text_id").agg(F.collect_list(F.struct("first", "last")).alias("ranges")), "suffix-ranges")
    left = texts.join(gone, ["rid", "text_id"], "left").select("text", "doc_id", "ranges").mapInArrow(_apply, RESULT)
    zero = F.lit(0).cast("bigint")
    return left.unionByName(rows.filter(F.col("ats").isNull()).select(
        "doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), "kept_sha256"))


def op13_suffixes(documents: DataFrame) -> DataFrame:
    """The contract's rows: ``remove_repeats`` with the production parameters."""
    return remove_repeats(documents)


# Bytes as pairs of hexadecimal digits; every window of every text is a row.
OP13_SQL = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT r, doc_id, i, substr(h, 2 * i + 1, {2 * WINDOW}) AS s
  FROM (SELECT r, doc_id, h, unnest(range(0, len(h) // 2 - {WINDOW - 1})) AS i FROM docs)),
later AS (
  SELECT r, i FROM windows QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS LAST, i) > 1),
edges AS (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {WINDOW} THEN 0 ELSE 1 END AS new FROM later),
spans AS (
  SELECT r, min(i) AS a, max(i) + {WINDOW} AS b
  FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM edges) GROUP BY r, g),
pieces AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS start FROM spans),
joined AS (
  SELECT d.r, any_value(d.doc_id) AS doc_id, any_value(d.h) AS h, count(p.a) AS n_spans, coalesce(sum(p.b - p.a), 0) AS n_removed,
    coalesce(string_agg(substr(d.h, 2 * p.start + 1, 2 * (p.a - p.start)), '' ORDER BY p.a), '') AS kept, coalesce(max(p.b), 0) AS last
  FROM docs d LEFT JOIN pieces p ON p.r = d.r GROUP BY d.r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
  sha256(unhex(kept || substr(h, 2 * last + 1))) AS kept_sha256
FROM joined"""
