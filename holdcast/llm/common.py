"""Helpers shared by the training-data operators.

Texts reach Python in Arrow batches only where Spark has no expression for the
work (rolling hashes, tokenisation, bit-sliced comparison). A batch is cut to a
byte budget, so a task's memory does not depend on how long the texts are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdcast.plans.stage import materialize
from holdcast.session import configure

#: Rows and bytes of an Arrow batch handed to Python, whichever is reached first.
ARROW_ROWS = 2048
ARROW_BYTES = 8 << 20
#: Bytes of text worked on at a time inside a task.
SLICE_BYTES = 1 << 20

# Word separators of every contract here: space and 0x09-0x0D. All are single
# UTF-8 bytes, so words can be cut on bytes.
INK = np.ones(256, dtype=bool)
INK[[0x20, *range(0x09, 0x0E)]] = False


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    return materialize(df, name)


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text column; NULL counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def located(docs: DataFrame) -> DataFrame:
    """row, file, position: a row's columns as one struct, and its content locator.

    The locator is the file and the row's place in it. Columns inside the struct
    may have any names; ``select("row.*")`` gives them back in their order. A
    DataFrame that is not a plain file scan, or that has a column named like the
    scan's metadata, is first written to the shared folder.
    """
    rows = docs.select(F.struct("*").alias("row"))
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("position")]
    if "_metadata" not in map(str.lower, docs.columns):
        try:
            found = docs.select(F.struct("*").alias("row"), *place)
            found.schema
            return found
        except AnalysisException:
            pass
    return stash(rows, "located").select("row", *place)


def slices(batches: Iterator[pa.RecordBatch], column: int,
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches so that the texts of ``column`` hold about ``limit`` bytes.

    Yields (rows, text bytes, bounds): row i's text is ``data[bounds[i]:bounds[i + 1]]``.
    A single text longer than the limit is a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        start, n = 0, batch.num_rows
        ends = np.cumsum(np.asarray(_lengths(batch.column(column))))
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            part = batch.slice(start, stop - start)
            yield part, *flat_text(part.column(column))
            start = stop


def _lengths(texts: pa.Array) -> np.ndarray:
    bounds = _bounds(texts)
    return bounds[1:] - bounds[:-1]


def _bounds(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    raw = np.frombuffer(texts.buffers()[1], dtype=kind)
    return raw[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def flat_text(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One array with the bytes of all texts, and where each begins and ends."""
    bounds = _bounds(texts)
    data = texts.buffers()[2]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def split_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of every text: byte starts, byte ends, and the first word of each text."""
    ink = INK[data]
    n = len(data)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = ink[:-1], ink[1:]
    before[bounds[:-1][bounds[:-1] < n]] = False
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    starts = np.flatnonzero(ink & ~before)
    ends = np.flatnonzero(ink & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def spaced(data: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts with exactly one space between words: bytes, word starts, ends, firsts."""
    starts, ends, firsts = split_words(data, bounds)
    lengths = ends - starts
    new = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths + 1, out=new[1:])
    keep = INK[data]
    out = np.full(int(new[-1]), 0x20, np.uint8)
    at = np.repeat(new[:-1] - starts, lengths) + np.flatnonzero(keep)
    out[at] = data[keep]
    return out.tobytes(), new[:-1], new[:-1] + lengths, firsts


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift, multiply), on wrapping uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes of substrings modulo 2**64 with an odd base.

    ``prefix`` sums make every substring's hash one subtraction and one
    multiplication by an inverse power, for any window length.
    """

    def __init__(self, base: int):
        self.base = np.uint64(base | 1)
        self.inverse = np.uint64(pow(base | 1, -1, 1 << 64))
        self._powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._powers[0]) < n:
            made = []
            for x in (self.base, self.inverse):
                p = np.full(n, x, np.uint64)
                p[0] = 1
                made.append(np.multiply.accumulate(p))
            self._powers = (made[0], made[1])
        return self._powers[0][:n], self._powers[1][:n]

    def of(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self.powers(len(values) + 1)
        prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values.astype(np.uint64) * up[:-1], out=prefix[1:])
        return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count values) of every entry, one after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.repeat(starts - first, counts) + np.arange(total)
