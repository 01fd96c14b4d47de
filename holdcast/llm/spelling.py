"""Spelling variants: words a single edit apart, found by dense prefix-suffix tiling.

Words of a tile are a matrix of code points, padded to the longest; two tiles are
compared a column at a time, from the left for the common prefix and from the right
for the common suffix of every pair at once. Two words are one inserted, deleted or
replaced code point apart exactly if prefix plus suffix reach the longer length
minus one (and the words differ, with lengths at most one apart).

Which tiles meet: the prefix or the suffix of such a pair has at least half of the
longer length minus one. So a word of length L goes to four groups, one for its first
and one for its last half under a longer length of L and of L + 1, and only tiles
of one group are compared. A pair is counted in the group of its longer length, under
the prefix if that is long enough and else under the suffix, hence once. A group
with many words is cut into tiles of at most about TILE words (fewer where words are
long) by a hash, and its tiles meet in pairs; small groups are compared many at a time.
A tile returns one row a word (how many words are near, and the best one), not pairs.

Words are counted in the tasks (one entry a word and flush) and then by Spark, so a
word in every document is one row per flush. Long texts are read a piece at a time.

Defined cases: a NULL text has no words; a NULL doc_id is hashed as the empty text;
repeated rows count each time. Letters are A-Z, a-z and U+00C0 to U+00FF; only A-Z are
lower-cased. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdcast.llm.common import SLICE_BYTES, prepare, slices, stash, text_bytes

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5               # a form occurs at least so many times as often as its variant
SLIP = 199              # a run whose hash this divides has lost a code point
FLUSH = 1 << 18         # words a task counts before it hands them on
TILE = 1024             # words of a tile
TILE_BYTES = 4 << 20    # and bytes of its matrix
PACK = 256              # words of small groups compared at a time
TASK_WORK = 1 << 31     # compared code points a task, about

# A letter beyond ASCII is two bytes of UTF-8, the first always 0xC3.
RUN = re.compile(rb"(?:[A-Za-z]+|\xc3[\x80-\xbf])+")
BREAK = re.compile(rb"[^A-Za-z\x80-\xff]")


def _pieces(text: bytes) -> Iterator[bytes]:
    """``text`` in pieces of about SLICE_BYTES that cut no run."""
    start = 0
    while len(text) - start > SLICE_BYTES:
        cut = BREAK.search(text, start + SLICE_BYTES)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def _without(word: bytes, place: int) -> bytes:
    letters = word.decode()
    return (letters[:place] + letters[place + 1:]).encode()


def _length(word: bytes) -> int:
    return len(word) - word.count(0xC3)


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                slip: int = SLIP) -> DataFrame:
    """(word, n): the words of at least that length and number of occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            kept = [(w, n) for w, n in words.items() if _length(w) >= least_length]
            words.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.binary()), pa.array([n for _, n in kept], pa.int64())],
                                              names=["word", "n"])

        for part, data, bounds in slices(batches, 1):
            text = data.tobytes()
            for i, doc in enumerate(part.column(0).to_pylist()):
                start = zlib.crc32((doc or "").encode() + b":")
                for piece in _pieces(text[bounds[i]:bounds[i + 1]]):
                    for word, n in Counter(RUN.findall(piece.lower())).items():
                        if len(word) < least_length:
                            continue
                        h = zlib.crc32(word, start)
                        if not h % slip:
                            word = _without(word, h % _length(word))
                        words[word] = words.get(word, 0) + n
                    if len(words) >= FLUSH:
                        yield flush()
        yield flush()

    texts = docs.select(F.col("doc_id").cast("string").alias("doc"), text_bytes().alias("text"))
    counted = texts.mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least_count).select(F.decode("word", "UTF-8").alias("word"), "n")


def groups(words: DataFrame) -> DataFrame:
    """(bucket, longer, head, word, n): four rows a word, see the module's text."""
    size = F.length("word")
    half = lambda m: F.floor(m / 2).cast("int")
    sides = []
    for more in (0, 1):
        m = size + more
        sides += [F.struct(m.alias("longer"), F.lit(True).alias("head"), F.substring("word", F.lit(1), half(m)).alias("part")),
                  F.struct(m.alias("longer"), F.lit(False).alias("head"),
                           F.substring("word", size - half(m) + 1, half(m)).alias("part"))]
    rows = words.select("word", "n", F.explode(F.array(*sides)).alias("side"))
    # Two parts that share a hash only meet without need: every pair is checked in full.
    return rows.select(F.xxhash64("side").alias("bucket"), "side.longer", "side.head", "word", "n")


def _matrix(words: list[bytes], right: bool) -> np.ndarray:
    """A row per word of its code points (all below 256), padded with zeros on one side."""
    width = max(map(len, words))
    joined = b"".join(w.rjust(width, b"\0") if right else w.ljust(width, b"\0") for w in words)
    return np.frombuffer(joined, np.uint8).reshape(len(words), width)


def _common(a: np.ndarray, b: np.ndarray, columns: range, most: np.ndarray) -> np.ndarray:
    """Equal leading (or, by the columns' order, trailing) code points of every pair, ``most`` at most."""
    length = np.zeros((len(a), len(b)), np.int32)
    row = column = ()
    for step, c in enumerate(columns):
        if step == 0 or len(row) > length.size // 4:          # many pairs: the whole matrix
            alive = (a[:, c][:, None] == b[:, c][None, :]) & (most > step)
            if step:
                alive &= length == step
            length += alive
            row, column = np.nonzero(alive)
        else:
            same = (a[row, c] == b[column, c]) & (most[row, column] > step)
            row, column = row[same], column[same]
            length[row, column] += 1
        if not len(row):
            break
    return length


def near(a: list[bytes], b: list[bytes], longer: np.ndarray, head: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Which pairs (Latin-1 words of two tiles) are one edit apart and counted in their group.

    ``longer`` and ``head`` tell the group of each word of ``a``; ``allowed`` says which pairs share one.
    """
    size_a, size_b = np.array([len(w) for w in a])[:, None], np.array([len(w) for w in b])[None, :]
    most, m = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    allowed = allowed & (m == longer[:, None]) & (m - most <= 1)
    most = np.where(allowed, most, 0)
    left_a, left_b = _padded(_matrix(a, False), _matrix(b, False), False)
    prefix = _common(left_a, left_b, range(left_a.shape[1]), most)
    right_a, right_b = _padded(_matrix(a, True), _matrix(b, True), True)
    suffix = _common(right_a, right_b, range(right_a.shape[1] - 1, -1, -1), most)
    half = m // 2                                             # ceil((m - 1) / 2)
    here = np.where(head[:, None], prefix >= half, prefix < half)
    return allowed & here & (prefix + suffix >= m - 1) & ~((prefix == m) & (m == most))


def _padded(a: np.ndarray, b: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    pad = lambda x: np.pad(x, ((0, 0), (width - x.shape[1], 0) if right else (0, width - x.shape[1])))
    return pad(a), pad(b)


BEST = "word string, n_near bigint, best_n bigint, best string"


def _answers(hit: np.ndarray, words: list[str], others: list[str], counts: np.ndarray) -> list[tuple[str, int, int, str]]:
    """For each word with a near one in this tile: how many, and the best (largest n, then least text)."""
    out = []
    row, column = np.nonzero(hit)
    ends = np.flatnonzero(np.append(row[1:] != row[:-1], True)) + 1 if len(row) else []
    start = 0
    for end in ends:
        found = column[start:end]
        best = min(found.tolist(), key=lambda j: (-counts[j], others[j]))
        out.append((words[row[start]], int(end - start), int(counts[best]), others[best]))
        start = end
    return out


def _tile_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packed: list[tuple[int, bool, list[dict]]] = []
    waiting = 0

    def small() -> list[tuple[str, int, int, str]]:
        """All groups that wait, compared with one another as one tile."""
        words = [w["word"] for _, _, g in packed for w in g]
        counts = np.array([w["n"] for _, _, g in packed for w in g], np.int64)
        sizes = [len(g) for _, _, g in packed]
        group = np.repeat(np.arange(len(packed)), sizes)
        longer, head = np.repeat([x[0] for x in packed], sizes), np.repeat([x[1] for x in packed], sizes)
        latin = [w.encode("latin-1") for w in words]
        return _answers(near(latin, latin, longer, head, group[:, None] == group[None, :]), words, words, counts)

    def batch(rows: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=[c.split()[0] for c in BEST.split(", ")])

    for b in batches:
        out = []
        for longer, head, left, right in zip(*(b.column(c).to_pylist() for c in ("longer", "head", "left", "right"))):
            if right is None and len(left) < PACK and longer * PACK < TILE_BYTES:
                if waiting + len(left) > PACK:
                    out += small()
                    packed, waiting = [], 0
                packed.append((longer, head, left))
                waiting += len(left)
                continue
            words, others = [w["word"] for w in left], [w["word"] for w in (right or left)]
            counts, other_counts = (np.array([w["n"] for w in x], np.int64) for x in (left, right or left))
            latin, other_latin = [w.encode("latin-1") for w in words], [w.encode("latin-1") for w in others]
            hit = near(latin, other_latin, np.full(len(words), longer), np.full(len(words), head), np.ones((len(words), len(others)), bool))
            out += _answers(hit, words, others, other_counts)
            if right is not None:
                out += _answers(hit.T, others, words, counts)
        if out:
            yield batch(out)
    if packed and (out := small()):
        yield batch(out)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of every word of ``words`` (word, n) that has a near word."""
    keyed = stash(groups(words), "spelling-groups")
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.max("longer").alias("widest")).filter("members > 1")
    tile = F.greatest(F.lit(1.0), F.least(F.lit(float(TILE)), TILE_BYTES / F.col("widest")))
    sizes = stash(sizes.select("bucket", "members", "widest", F.ceil(F.col("members") / tile).cast("int").alias("tiles")), "spelling-sizes")
    work = sizes.agg(F.sum(F.col("members").cast("double") * F.greatest("members", F.lit(PACK)) * F.col("widest"))).first()[0]
    spread = max(keyed.sparkSession.sparkContext.defaultParallelism, int((work or 0) / TASK_WORK) + 1)
    split = keyed.join(sizes.select("bucket", "tiles"), "bucket").withColumn(
        "tile", F.pmod(F.xxhash64("word", F.lit(1)), F.col("tiles").cast("long")).cast("int"))
    # A tile has about TILE words: bounded.
    tiles = stash(split.groupBy("bucket", "longer", "head", "tile", "tiles").agg(
        F.collect_list(F.struct("word", "n")).alias("left")), "spelling-tiles")
    alone = tiles.select("bucket", "tile", F.col("tile").alias("other"), "longer", "head", "left", F.lit(None).cast(
        tiles.schema["left"].dataType).alias("right"))
    ahead = tiles.filter("tile + 1 < tiles").withColumn("other", F.explode(F.sequence(F.col("tile") + 1, F.col("tiles") - 1)))
    other = tiles.select("bucket", "longer", "head", F.col("tile").alias("other"), F.col("left").alias("right"))
    pairs = ahead.join(other, ["bucket", "longer", "head", "other"]).select(alone.columns)
    found = alone.unionByName(pairs).repartition(spread, "bucket", "tile", "other").select(
        "longer", "head", "left", "right").mapInArrow(_tile_task, BEST)
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top"))
    return best.select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): the last word that forms lead to.

    A form occurs RATIO times as often, so a way has no cycle and, for counts below
    2**63, at most 27 steps; each pass doubles the steps that a row has gone.
    """
    way = stash(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = stash(way.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                            F.col("further").isNotNull().alias("moved")), "spelling-roots")
        way = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            return way


def variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs``."""
    prepare(docs.sparkSession)
    words = stash(count_words(docs), "spelling-words")
    known = words.join(neighbours(words), "word", "left")
    is_form = F.col("best_n") >= F.col("n") * ratio
    known = stash(known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
                               F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")),
                  "spelling-forms")
    ends = roots(known.filter("form IS NOT NULL"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(documents: DataFrame) -> DataFrame:
    """The contract's rows: ``variants`` with the production parameters."""
    return variants(documents)


# CRC-32 from its polynomial, a byte at a time; code points below 256 are one or two bytes of UTF-8.
OP12_SQL = f"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), n)) AS steps),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
counted AS MATERIALIZED (
  SELECT doc, run, count(*) AS n FROM runs WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(list_reduce(flatten(list_transform(string_split(doc || ':' || run, ''), lambda x:
      CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END)),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM counted, crc),
slipped AS (
  SELECT CASE WHEN h % {SLIP} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= {LEAST_LENGTH}
  GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
shorter AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)),
pairs AS (
  SELECT s.word AS a, w.word AS b FROM shorter s JOIN words w ON w.word = s.rest
  UNION SELECT w.word, s.word FROM shorter s JOIN words w ON w.word = s.rest
  UNION SELECT s.word, t.word FROM shorter s JOIN shorter t ON t.rest = s.rest AND t.i = s.i AND t.word <> s.word),
ranked AS (
  SELECT p.a, p.b, w.n, count(*) OVER (PARTITION BY p.a) AS n_near FROM pairs p JOIN words w ON w.word = p.b
  QUALIFY row_number() OVER (PARTITION BY p.a ORDER BY w.n DESC, p.b) = 1),
forms AS MATERIALIZED (
  SELECT w.word, w.n, CAST(coalesce(r.n_near, 0) AS BIGINT) AS n_near, CASE WHEN r.n >= {RATIO} * w.n THEN r.b END AS form,
    CASE WHEN r.n >= {RATIO} * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.a = w.word),
walk AS (
  SELECT word, form AS place FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT k.word, f.form FROM walk k JOIN forms f ON f.word = k.place WHERE f.form IS NOT NULL),
ends AS (SELECT k.word, k.place AS root FROM walk k JOIN forms f ON f.word = k.place WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n
FROM forms f LEFT JOIN ends e ON e.word = f.word"""
