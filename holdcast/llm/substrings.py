"""Removal of repeated word sequences, found by fixed-block anchors.

A window is WINDOW consecutive words of one document. A word goes if a window
that covers it also starts in a document with a smaller doc_id.

1. Anchors. Every document's non-overlapping blocks of BLOCK = WINDOW / 2 words
   are indexed, and every rolling window of BLOCK words probes the index. A
   repeated window holds a whole block of each document that has it, so it is hit.
   Hashes of a few million words at a time are sorted, cut into slices by their
   leading bits and sent as packed, difference-coded arrays of two to four bytes
   a word. A slice keeps the hashes that are some document's block and occur in
   two documents or more, and answers each document with its hits.
2. Extension. Around each hit, every window of WINDOW words that holds it is
   hashed to 128 bits; slices of these find the least doc_id that has each
   window. Windows that start in a smaller doc_id, joined where they overlap,
   are the maximal exact repeats; their words go.

Exact copies never reach step 2: of equal texts only the least doc_id does,
since the others repeat it from end to end. The number of slices follows the
corpus. Slices of more than HOT entries, where passages are hot, are counted
first: each flush gives a slice one entry for a hash, whatever its occurrences,
and the hashes that count then meet the packed rows again, dealt in pieces of HOT
entries over the tasks. No pairs are made.

Defined cases: NULL text has no words; a document whose doc_id is NULL has no
order, so it neither loses words nor makes others lose them; rows that repeat
a doc_id do not make each other lose words; texts of fewer than WINDOW words
stay whole. Every row gives one row. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdcast.llm.common import (Rolling, flat_text, mix64, prepare, ranges, slices, spaced, stash, text_bytes)

WINDOW = 50
BLOCK = WINDOW // 2
FLUSH_WORDS = 1 << 21        # words whose hashes are sorted and packed at a time
SLICE_WORDS = 1 << 21        # words of the corpus that a slice answers for, about
DOCS = 1 << 16               # documents in one packed array, at most
BUCKET_DOCS = 1 << 12        # documents whose answers travel together, about
HOT = 2 * SLICE_WORDS        # entries beyond which a slice is decided from reduced rows and answered in pieces

# Odd multipliers of the word hashes and of the sequences of words.
_WORD = Rolling(0x9E3779B97F4A7C15), Rolling(0xD6E8FEB86659FD93)
_SEQUENCE = Rolling(0xC2B2AE3D27D4EB4F), Rolling(0xA0761D6478BD642F)


def pack(values: np.ndarray) -> bytes:
    """Integers as differences, one byte plane after another (the planes of small differences are empty)."""
    step = np.diff(values, prepend=values.dtype.type(0))
    return np.ascontiguousarray(step.view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes()


def unpack(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).reshape(-1), dtype=kind)


def word_hashes(data: np.ndarray, bounds: np.ndarray, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of a slice, and the first word of each text."""
    text, starts, ends, firsts = spaced(data, bounds)
    return _WORD[which].of(np.frombuffer(text, np.uint8), starts, ends), firsts


def sequence_hashes(words: np.ndarray, starts: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Hashes of the n words that begin at each start."""
    return _SEQUENCE[which].of(words, starts, starts + n)


def window_starts(firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all runs of n words inside the texts, and their text."""
    counts = np.maximum(0, firsts[1:] - firsts[:-1] - n + 1)
    return ranges(firsts[:-1], counts), np.repeat(np.arange(len(counts)), counts)


def _slice_bits(words: int) -> int:
    """Leading hash bits that name a slice; the number of slices follows the corpus."""
    return max(3, min(30, (max(1, words) // SLICE_WORDS).bit_length()))


def _rest_bits(bits: int) -> int:
    """Hash bits kept within a slice: false hits stay rare, and step 2 checks every hit."""
    return min(32, 47 - bits)


def _anchor_hashes(words: np.ndarray, starts: np.ndarray, bits: int) -> np.ndarray:
    return sequence_hashes(words, starts, BLOCK) >> np.uint64(64 - bits - _rest_bits(bits))


class _Anchors:
    """Hashes of rolling windows, gathered until a flush."""

    def __init__(self, bits: int):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.hashes, self.docs, self.blocks, self.ids, self.n, self.n_docs = [], [], [], [], 0, 0

    def add(self, ids: np.ndarray, words: np.ndarray, firsts: np.ndarray) -> None:
        starts, doc = window_starts(firsts, BLOCK)
        self.hashes.append(_anchor_hashes(words, starts, self.bits))
        self.blocks.append((starts - firsts[doc]) % BLOCK == 0)
        self.docs.append(doc + self.n_docs)
        self.ids.append(ids)
        self.n += len(starts)
        self.n_docs += len(ids)

    def flush(self) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        """(slice, doc ids, documents, hashes, block marks) sorted by hash, one for each slice that has any."""
        if not self.n:
            return
        key = np.concatenate(self.hashes) << np.uint64(17)
        key |= np.concatenate(self.docs).astype(np.uint64) << np.uint64(1)
        key |= ~np.concatenate(self.blocks)                       # a block sorts before its repeats
        ids = np.concatenate(self.ids)
        self.clear()
        key.sort()
        key = key[np.r_[True, key[1:] >> np.uint64(1) != key[:-1] >> np.uint64(1)]]
        rest = _rest_bits(self.bits)
        part = (key >> np.uint64(17 + rest)).astype(np.int64)
        value = (key >> np.uint64(17) & np.uint64((1 << rest) - 1)).astype(np.uint32)
        doc = (key >> np.uint64(1) & np.uint64(DOCS - 1)).astype(np.int64)
        block = key & np.uint64(1) == 0
        edges = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            used, at = np.unique(doc[a:b], return_inverse=True)
            yield (int(part[a]), pack(ids[used]), _planes(at.astype(np.uint16)), pack(value[a:b]),
                   np.packbits(block[a:b]).tobytes())


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes()


def _from_planes(data: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


ANCHORS = "slice int, ids binary, docs binary, hashes binary, blocks binary"


def anchors(docs: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Anchors(bits)

        def out() -> Iterator[pa.RecordBatch]:
            rows = list(held.flush())
            for at in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows[at:at + 64]), [pa.int32(), *[pa.binary()] * 4])],
                    names=[c.split()[0] for c in ANCHORS.split(", ")])

        for rows, data, bounds in slices(batches, 1):
            if held.n >= FLUSH_WORDS or held.n_docs + rows.num_rows > DOCS:
                yield from out()
            words, firsts = word_hashes(data, bounds)
            held.add(rows.column(0).to_numpy(), words, firsts)
        yield from out()

    return docs.mapInArrow(run, ANCHORS)


def _slice_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of one slice at a time, from batches sorted by slice."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != now and held:
                yield now, held
                held = []
            now = row[0]
            held.append(row[1:])
    if held:
        yield now, held


def _bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


ANSWERS = "bucket bigint, ids binary, texts binary, values binary"


def _answers(doc: np.ndarray, text: np.ndarray, values: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """One packed row for each bucket of documents that a slice has answers for."""
    bucket = _bucket(doc, buckets)
    order = np.lexsort((text, doc, bucket))
    bucket, doc, text, values = bucket[order], doc[order], text[order], values[order]
    edges = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)] if len(bucket) else np.zeros(1, np.int64)
    rows = [(int(bucket[a]), pack(doc[a:b]), pack(text[a:b]), values[a:b].tobytes())
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
    for at in range(0, len(rows), 256):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows[at:at + 256]), [pa.int64(), *[pa.binary()] * 3])],
            names=[c.split()[0] for c in ANSWERS.split(", ")])


def _per_text(answers: DataFrame, kind, name: str) -> DataFrame:
    """(doc_id, content, name): the answers of all slices for one text, as one row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _slice_rows(batches):
            doc, text = (np.concatenate([unpack(r[k], np.int64) for r in rows]) for k in (0, 1))
            values = np.concatenate([np.frombuffer(r[2], kind) for r in rows])
            order = np.lexsort((text, doc))
            doc, text, values = doc[order], text[order], values[order]
            heads = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])])
            ends = np.r_[heads[1:], len(doc)]
            for at in range(0, len(heads), 1024):
                h, e = heads[at:at + 1024], ends[at:at + 1024]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[h]), pa.array(text[h]),
                     pa.array([values[a:b].tobytes() for a, b in zip(h.tolist(), e.tolist())], pa.binary())],
                    names=["doc_id", "content", name])

    return answers.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        run, f"doc_id bigint, content bigint, {name} binary")


def _hot_slices(found: DataFrame, entries: Column, most: int) -> DataFrame | None:
    """(slice, pieces) of the slices of more than ``most`` entries; None if there are none."""
    hot = stash(found.groupBy("slice").agg(F.sum(entries).alias("n")).filter(F.col("n") > most).select(
        "slice", F.ceil(F.col("n") / most).cast("int").alias("pieces")), "substring-hot")
    return None if hot.isEmpty() else hot


def _least(first: np.ndarray, second: np.ndarray, least: np.ndarray, greatest: np.ndarray,
           block: np.ndarray) -> tuple[np.ndarray, ...]:
    """One entry of every (first, second): its least and greatest doc_id, and whether any entry is a block."""
    order = np.lexsort((second, first))
    first, second, least, greatest, block = (x[order] for x in (first, second, least, greatest, block))
    if not len(first):
        return first, second, least, greatest, block
    heads = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
    return (first[heads], second[heads], np.minimum.reduceat(least, heads), np.maximum.reduceat(greatest, heads),
            np.maximum.reduceat(block, heads))


_KINDS = np.uint64, np.uint64, np.int64, np.int64, np.uint8
REDUCED = "slice int, first binary, second binary, least binary, greatest binary, block binary"
KNOWN = "slice int, known_first binary, known_second binary, known_least binary"


def _known(rows: Iterator[tuple]) -> tuple[np.ndarray, ...]:
    """One entry of every key of a slice; holds twice as many entries as it has keys, or HOT."""
    state = tuple(np.zeros(0, k) for k in _KINDS)
    held, n = [], 0
    for row in rows:
        held.append(tuple(np.frombuffer(x, k) for x, k in zip(row, _KINDS)))
        n += len(held[-1][0])
        if n > max(HOT, len(state[0])):
            state = _least(*(np.concatenate(x) for x in zip(state, *held)))
            held, n = [], 0
    return _least(*(np.concatenate(x) for x in zip(state, *held)))


def _row_by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield tuple(c[k].as_py() for c in batch.columns)


def _hot_answers(found: DataFrame, hot: DataFrame, columns: str, entries, answer, buckets: int) -> DataFrame:
    """Answers of the slices of ``hot``, however many entries one key has.

    Every packed row is first reduced to one entry of a key, so a key costs a slice one entry for each
    flush. The keys of two documents that have a block then meet the packed rows again, which are dealt over the slice's
    pieces. ``entries`` gives (first, second, doc, block, text, value) of a packed row; ``answer`` says which of those
    that have a known key are answered, by doc and the key's least doc.
    """
    names = [c.split()[0] for c in columns.split(", ")]
    rows = found.join(F.broadcast(hot), "slice")

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _row_by_row(batches):
            first, second, doc, block, _, _ = entries(row)
            got = _least(first, second, doc, doc, block.astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[0]], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in got)],
                names=[c.split()[0] for c in REDUCED.split(", ")])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, slice_rows in groupby(_row_by_row(batches), itemgetter(0)):
            first, second, least, greatest, block = _known(r[1:] for r in slice_rows)
            keep = (least < greatest) & (block > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), *(pa.array([x[keep].tobytes()], pa.binary()) for x in (first, second, least))],
                names=[c.split()[0] for c in KNOWN.split(", ")])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, piece_rows in groupby(_row_by_row(batches), itemgetter(0, 1)):
            first, second, least = (np.frombuffer(x, k) for x, k in zip(next(piece_rows)[3:6], _KINDS))
            heads = np.flatnonzero(np.r_[True, first[1:] != first[:-1]]) if len(first) else np.zeros(0, np.int64)
            longest = int(np.diff(np.r_[heads, len(first)]).max(initial=0))     # 1 unless the first hashes of two keys are equal
            held, n = [], 0
            for row in piece_rows:
                f, s, doc, _, text, value = entries((row[0], *row[6:]))
                at, has, low = np.searchsorted(first, f), np.zeros(len(f), bool), np.zeros(len(f), np.int64)
                for k in range(longest):
                    place = np.minimum(at + k, len(first) - 1)
                    same = (at + k < len(first)) & (first[place] == f) & (second[place] == s)
                    has |= same
                    low[same] = least[place[same]]
                has &= answer(doc, low)
                held.append((doc[has], text[has], value[has]))
                n += int(has.sum())
                if n >= FLUSH_WORDS:
                    yield from _answers(*(np.concatenate(x) for x in zip(*held)), buckets)
                    held, n = [], 0
            if n:
                yield from _answers(*(np.concatenate(x) for x in zip(*held)), buckets)

    by_slice = lambda df: df.repartition("slice").sortWithinPartitions("slice")
    known = by_slice(rows.select(*names).mapInArrow(reduce, REDUCED)).mapInArrow(decide, KNOWN)
    lead = ["slice", "piece", "again", "known_first", "known_second", "known_least"]
    none = F.lit(None).cast("binary")
    known = known.join(F.broadcast(hot), "slice").withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).withColumn("again", F.lit(0)).select(
        *lead, *[none.alias(c) for c in names[1:]])
    dealt = rows.select("slice", F.pmod(F.xxhash64("ids", names[-1]), F.col("pieces")).cast("int").alias("piece"),
                        F.lit(1).alias("again"), *[none.alias(c) for c in lead[3:]], *names[1:])
    return (known.unionByName(dealt).repartition("slice", "piece").sortWithinPartitions("slice", "piece", "again")
            .mapInArrow(meet, ANSWERS))


def _split(found: DataFrame, entries: Column, most: int, columns: str, plain, unpacked, answer, buckets: int) -> DataFrame:
    """Answers of all slices: ``plain`` for those that fit a task, in pieces for the others."""
    hot = _hot_slices(found, entries, most)
    cool = found if hot is None else found.join(F.broadcast(hot), "slice", "left_anti")
    answers = cool.repartition("slice").sortWithinPartitions("slice").mapInArrow(plain, ANSWERS)
    return answers if hot is None else answers.unionByName(_hot_answers(found, hot, columns, unpacked, answer, buckets))


def hits(found: DataFrame, bits: int, buckets: int, most: int = HOT) -> DataFrame:
    """(doc_id, hits): hashes of a document's windows that are some block and occur in two documents."""
    rest = _rest_bits(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _slice_rows(batches):
            hashes = np.concatenate([unpack(r[2], np.uint32) for r in rows])
            doc = np.concatenate([unpack(r[0], np.int64)[_from_planes(r[1], np.uint16)] for r in rows])
            block = np.concatenate([np.unpackbits(np.frombuffer(r[3], np.uint8))[:len(r[2]) // 4] for r in rows])
            order = np.argsort(hashes, kind="stable")
            hashes, doc, block = hashes[order], doc[order], block[order]
            heads = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
            shared = (np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads)) & (
                np.maximum.reduceat(block, heads) > 0)
            keep = np.repeat(shared, np.diff(np.r_[heads, len(hashes)]))
            whole = hashes[keep].astype(np.uint64) | np.uint64(part << rest)
            yield from _answers(doc[keep], np.zeros(len(whole), np.int64), whole, buckets)

    def entries(row: tuple) -> tuple[np.ndarray, ...]:
        part, ids, docs, hashes, blocks = row
        whole = unpack(hashes, np.uint32).astype(np.uint64) | np.uint64(part << rest)
        none = np.zeros(len(whole), np.int64)
        return (whole, none.view(np.uint64), unpack(ids, np.int64)[_from_planes(docs, np.uint16)],
                np.unpackbits(np.frombuffer(blocks, np.uint8))[:len(whole)], none, whole)

    answers = _split(found, F.octet_length("hashes") / 4, most, ANCHORS, run, entries,
                     lambda doc, least: np.ones(len(doc), bool), buckets)
    return _per_text(answers, np.uint64, "hits").drop("content")


def _candidate_windows(words: np.ndarray, marked: np.ndarray, bits: int) -> np.ndarray:
    """Starts of the windows that hold a rolling BLOCK-word window whose hash is among ``marked``."""
    n = len(words)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    hit = np.r_[0, np.cumsum(np.isin(_anchor_hashes(words, np.arange(n - BLOCK + 1), bits), marked))]
    start = np.arange(n - WINDOW + 1)
    return start[hit[start + WINDOW - BLOCK + 1] > hit[start]]


WINDOWS = "slice int, ids binary, texts binary, docs binary, first binary, second binary, starts binary"


def windows(candidates: DataFrame, bits: int) -> DataFrame:
    """Packed 128-bit hashes of the candidate windows, by slice. Rows: doc_id, content, text, hits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []

        def out() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            first, second, start = (np.concatenate([h[k] for h in held]) for k in (2, 3, 4))
            doc = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
            ids, texts = (np.array([h[k] for h in held], np.int64) for k in (0, 1))
            held.clear()
            order = np.argsort(first, kind="stable")
            first, second, start, doc = first[order], second[order], start[order], doc[order]
            part = (first >> np.uint64(64 - bits)).astype(np.int64)
            edges = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)]
            rows = []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                used, at = np.unique(doc[a:b], return_inverse=True)
                rows.append((int(part[a]), ids[used].tobytes(), texts[used].tobytes(), _planes(at.astype(np.uint16)),
                             first[a:b].tobytes(), second[a:b].tobytes(), _planes(start[a:b].astype(np.uint32))))
            for at in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows[at:at + 64]), [pa.int32(), *[pa.binary()] * 6])],
                    names=[c.split()[0] for c in WINDOWS.split(", ")])

        n = 0
        for batch in batches:
            for doc_id, content, text, found in zip(*(batch.column(k) for k in range(4))):
                data, bounds = flat_text(pa.array([text.as_py()], pa.string()))
                words, _ = word_hashes(data, bounds)
                marked = np.frombuffer(found.as_py(), np.uint64)
                start = _candidate_windows(words, marked, bits)
                if not len(start):
                    continue
                again, _ = word_hashes(data, bounds, 1)
                held.append((doc_id.as_py(), content.as_py(), sequence_hashes(words, start, WINDOW),
                             sequence_hashes(again, start, WINDOW, 1), start))
                n += len(start)
                if n >= FLUSH_WORDS // 4 or len(held) >= DOCS:
                    yield from out()
                    n = 0
        yield from out()

    return candidates.select("doc_id", "content", "text", "hits").mapInArrow(run, WINDOWS)


def repeats(found: DataFrame, buckets: int, most: int = HOT) -> DataFrame:
    """(doc_id, content, starts): windows of a text that also start in a smaller doc_id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _slice_rows(batches):
            at = [_from_planes(r[2], np.uint16) for r in rows]
            doc = np.concatenate([np.frombuffer(r[0], np.int64)[a] for r, a in zip(rows, at)])
            text = np.concatenate([np.frombuffer(r[1], np.int64)[a] for r, a in zip(rows, at)])
            first, second = (np.concatenate([np.frombuffer(r[k], np.uint64) for r in rows]) for k in (3, 4))
            start = np.concatenate([_from_planes(r[5], np.uint32) for r in rows])
            order = np.lexsort((doc, second, first))
            doc, text, first, second, start = doc[order], text[order], first[order], second[order], start[order]
            heads = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
            least = np.repeat(doc[heads], np.diff(np.r_[heads, len(doc)]))
            gone = least < doc
            yield from _answers(doc[gone], text[gone], start[gone], buckets)

    def entries(row: tuple) -> tuple[np.ndarray, ...]:
        _, ids, texts, docs, first, second, starts = row
        at = _from_planes(docs, np.uint16)
        doc, text = np.frombuffer(ids, np.int64)[at], np.frombuffer(texts, np.int64)[at]
        return (np.frombuffer(first, np.uint64), np.frombuffer(second, np.uint64), doc, np.ones(len(doc), np.uint8), text,
                _from_planes(starts, np.uint32))

    answers = _split(found, F.octet_length("first") / 8, most, WINDOWS, run, entries,
                     lambda doc, least: least < doc, buckets)
    return _per_text(answers, np.uint32, "starts")


def kept_words(text: str, starts: np.ndarray) -> tuple[int, int, str]:
    """Number of words, how many go, and the words that stay joined by one space."""
    data, bounds = flat_text(pa.array([text], pa.string()))
    joined, begin, end, _ = spaced(data, bounds)
    cover = np.zeros(len(begin) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, np.minimum(starts + WINDOW, len(begin)), -1)
    stay = np.cumsum(cover[:-1]) == 0
    text = b" ".join(joined[b:e] for b, e in zip(begin[stay].tolist(), end[stay].tolist()))
    return len(begin), int((~stay).sum()), text.decode()


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def summaries(docs: DataFrame) -> DataFrame:
    """doc_id, content (digest of the text), n_words, whole_sha256 (of all words joined by one space)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, 1):
            joined, begin, end, firsts = spaced(data, bounds)
            sums = [hashlib.sha256(joined[begin[a]:end[b - 1]] if b > a else b"").hexdigest()
                    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(2), pa.array(np.diff(firsts)), pa.array(sums, pa.string())],
                names=["doc_id", "content", "n_words", "whole_sha256"])

    return docs.withColumn("content", F.unhex(F.sha2("text", 256))).mapInArrow(
        run, "doc_id bigint, content binary, n_words bigint, whole_sha256 string")


def removed(docs: DataFrame, most: int = HOT) -> tuple[DataFrame, DataFrame]:
    """What texts lose, and the summaries of all rows.

    The first has doc_id, content (SHA-256 of the text), n_words, n_removed,
    kept_sha256 and kept_text of every text that loses words; ``kept_text`` is
    NULL where a copy lost all of them.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text"))
    facts = stash(summaries(texts), "substring-facts")
    total = facts.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("words"), F.count("*").alias("rows")).first()
    bits, buckets = _slice_bits(total["words"]), max(1, total["rows"] // BUCKET_DOCS)
    ordered = texts.filter("doc_id is not null")
    found = hits(anchors(ordered, bits), bits, buckets, most)
    # Of equal texts the least doc_id goes on; the others repeat it as a whole.
    firsts = stash(facts.filter(f"doc_id is not null and n_words >= {WINDOW}").groupBy("content").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("content", "first"),
        "substring-firsts")
    copies = stash(facts.join(firsts, "content").filter("doc_id > first").select(
        "doc_id", "content", "n_words"), "substring-copies")
    whole = F.unhex(F.sha2("text", 256))
    met = ordered.join(found, "doc_id").withColumn("digest", whole)
    gone = copies.select(F.col("doc_id").alias("copy_id"), F.col("content").alias("copy"))
    candidates = stash(met.join(gone, (F.col("doc_id") == F.col("copy_id")) & (F.col("digest") == F.col("copy")), "left_anti")
                       .dropDuplicates(["doc_id", "digest"]).withColumn("content", F.xxhash64("digest")), "substring-candidates")
    starts = repeats(windows(candidates, bits), buckets, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, digest, text, found in zip(*(batch.column(k).to_pylist() for k in range(4))):
                n, lost, kept = kept_words(text, np.frombuffer(found, np.uint32).astype(np.int64))
                rows.append((doc_id, digest, n, lost, _sha(kept), kept))
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             names=["doc_id", "content", "n_words", "n_removed", "kept_sha256", "kept_text"])

    cut = candidates.select("doc_id", "content", "digest", "text").join(starts, ["doc_id", "content"]).select(
        "doc_id", "digest", "text", "starts").mapInArrow(
        run, "doc_id bigint, content binary, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string")
    all_gone = copies.distinct().select("doc_id", "content", "n_words", F.col("n_words").alias("n_removed"),
                             F.lit(_sha("")).alias("kept_sha256"), F.lit(None).cast("string").alias("kept_text"))
    return cut.unionByName(all_gone), facts


def op5_substrings(docs: DataFrame, most: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    prepare(docs.sparkSession)
    lost, facts = removed(docs, most)
    lost = lost.select(F.col("doc_id").alias("lost_id"), F.col("content").alias("lost"), "n_removed", "kept_sha256")
    return facts.join(lost, (F.col("doc_id") == F.col("lost_id")) & (F.col("content") == F.col("lost")), "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d),
win AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY array_to_string(w[s:s + 49], ' ')) AS first FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM win WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS text, count(*) AS n
  FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""
