"""Quality classifier from positive and unlabelled texts.

Trusted positives are documents labelled 1; unlabelled web text is every
document of the table, whether a label names it or not. Negative labels are
never read. A linear model over byte-class and repetition features minimises the
non-negative unbiased risk (Kiryo et al., "Positive-Unlabeled Learning with
Non-Negative Risk Estimator"):

    prior * P[loss(+)] + max(0, U[loss(-)] - prior * P[loss(-)])

with the logistic loss. Features are computed once and stored, 16 bits each.
Loss and slope of the unlabelled side are sums over all stored rows, one pass for
several step lengths; the steps are Newton's, with a curvature from about
CURVATURE documents (it shapes the way to the minimum, not the minimum). A step that
would use up the bracket is bent along its border and shortened until the bracket stays above zero.
At the unbounded minimum the mean score of all documents is the prior; at the border it is not, so
the intercept is set last to make it so.

The prior is estimated without negatives (Garg et al., "Mixture Proportion
Estimation and PU Learning", best bin): a first model is fitted with prior 1/2 on
three in four of the positives, and the prior is the least ratio, over score thresholds, of the
share of all documents above to the share of the other positives above, with an allowance
for small samples. At most POSITIVES positives are used, chosen by a hash of doc_id, so
they do not depend on the input's layout; of rows that repeat a doc_id one teaches.

Defined cases: NULL text counts as empty; an empty text has no features, so its
score is the model's value for a text without content; rows without a doc_id
are scored and are unlabelled text, held_out is NULL for them; labels that are NULL or
for no document are not used; without any positive every score is 0.5.
Repeated rows each get a row. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdcast.llm.common import Rolling, flat_text, mix64, prepare, slices, spaced, stash, text_bytes

POSITIVES = 6_000
CURVATURE = 12_000     # documents, about, whose features give the curvature of a step
THRESHOLD = 0.3
FOLDS = 5
STEPS = 12
LENGTHS = np.array([1.0, 0.5, 0.2, 0.05])     # of a step, tried in one pass
SPEND = 0.8            # of the bracket that one step may use up
TOLERANCE = 1e-4       # of the slope, at which fitting ends
RIDGE = 30.0           # over the number of positives
BINS = 50              # of a logit unit, for the prior
REACH = 30             # logits counted on either side
UNIT = float(1 << 20)  # sums of tasks are added as whole multiples of 1 / UNIT, so their order does not matter

# Byte classes: lower case, upper case, digit, space, line end, every other ASCII mark, control, beyond ASCII.
_CLASS = np.zeros(256, np.int64)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (0 if "a" <= _c <= "z" else 1 if "A" <= _c <= "Z" else 2 if "0" <= _c <= "9" else 3 if _b == 32
                  else 4 if _b in (10, 13) else 5 if _b >= 128 else 6 if _b < 32 or _b == 127 else 0)
_marks = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS[_marks] = 7 + np.arange(len(_marks))
CLASSES = 7 + len(_marks)
PAIRS = 192            # class pairs hash to so many features
EXTRA = 8
CLIP = 8.0             # deviations beyond which a feature counts no further, in fitting and scoring alike
FEATURES = CLASSES + PAIRS + EXTRA
_PAIR = (mix64(np.arange(CLASSES * CLASSES, dtype=np.uint64)) % np.uint64(PAIRS)).astype(np.int64)
_WORD, _RUN = Rolling(0x9E3779B97F4A7C15), Rolling(0xC2B2AE3D27D4EB4F)


def _distinct(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct values of each owner."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])] if len(owner) else np.zeros(0, bool)
    return np.bincount(owner[new], minlength=n)


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of FEATURES numbers for every text of a slice."""
    n, size = len(bounds) - 1, np.diff(bounds)
    owner = np.repeat(np.arange(n), size)
    kind = _CLASS[data]
    out = np.zeros((n, FEATURES))
    per = 1000.0 / np.maximum(1, size)[:, None]
    out[:, :CLASSES] = np.log1p(np.bincount(owner * CLASSES + kind, minlength=n * CLASSES).reshape(n, -1) * per)
    inside = owner[1:] == owner[:-1]
    pair = _PAIR[kind[:-1] * CLASSES + kind[1:]][inside]
    out[:, CLASSES:CLASSES + PAIRS] = np.log1p(
        np.bincount(owner[1:][inside] * PAIRS + pair, minlength=n * PAIRS).reshape(n, -1) * per)
    text, starts, ends, firsts = spaced(data, bounds)
    words = np.diff(firsts)
    who = np.repeat(np.arange(n), words)
    hashes = _WORD.of(np.frombuffer(text, np.uint8), starts, ends)
    three = np.flatnonzero(np.arange(len(who)) + 3 <= np.repeat(firsts[1:], words))
    runs = _RUN.of(hashes, three, three + 3)
    many = np.maximum(1, words)
    again = np.zeros(len(who), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (who[1:] == who[:-1])
    length = np.bincount(who, weights=ends - starts, minlength=n) / many
    spread = np.bincount(who, weights=(ends - starts) ** 2.0, minlength=n) / many - length ** 2
    out[:, -EXTRA:] = np.stack([
        np.log1p(words), length, np.sqrt(np.maximum(0, spread)), _distinct(who, hashes, n) / many,
        _distinct(who[three], runs, n) / np.maximum(1, words - 2), size / many / 10, words == 0,
        np.bincount(who, weights=again, minlength=n) / many], axis=1)
    return np.clip(out, -65000, 65000).astype(np.float16).astype(float)      # as they are stored


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(standardised(x, self.centre, self.scale) @ self.weight + self.bias)


def standardised(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The features a model is fitted on and scores with."""
    return np.clip((x - centre) / scale, -CLIP, CLIP)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -REACH, REACH)))


def risk_sums(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Loss against label 0 summed over the rows of ``x``, then its slope, for every column of ``weights``."""
    z = x @ weights
    return np.r_[np.logaddexp(0, z).sum(axis=0)[None], x.T @ sigmoid(z)]


def minimise(positive: np.ndarray, sample: np.ndarray, prior: float, unlabelled: Callable[[np.ndarray], np.ndarray],
             steps: int = STEPS, ridge: float = RIDGE) -> np.ndarray:
    """Weights of the least non-negative unbiased risk.

    ``positive`` and ``sample`` are standardised rows with a constant column; ``unlabelled`` gives
    the means of ``risk_sums`` over all unlabelled rows.
    """
    penalty = np.r_[np.full(positive.shape[1] - 1, ridge / len(positive)), 0.0]
    pull = prior * positive.mean(axis=0)

    def risk(weights: np.ndarray, losses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = positive @ weights
        bracket = losses - prior * np.logaddexp(0, z).mean(axis=0)
        whole = prior * np.logaddexp(0, -z).mean(axis=0) + np.maximum(0, bracket)
        return whole + (penalty[:, None] * weights ** 2).sum(axis=0) / 2, bracket

    weight = np.r_[np.zeros(positive.shape[1] - 1), np.log(prior / (1 - prior))]
    means = unlabelled(weight[:, None])
    values, brackets = risk(weight[:, None], means[0])
    value, bracket, slope = values[0], brackets[0], means[1:, 0]
    for _ in range(steps):
        gradient = slope - pull + penalty * weight
        if np.abs(gradient).max() < TOLERANCE:
            break
        s = sigmoid(sample @ weight)
        curvature = sample.T @ (sample * (s * (1 - s))[:, None]) / len(sample) + np.diag(penalty + 1e-6)
        rise = slope - prior * (positive.T @ sigmoid(positive @ weight)) / len(positive)     # the bracket's own slope
        step, lift = np.linalg.solve(curvature, np.c_[-gradient, rise]).T
        # Near the border a step goes along it: it may use up no more than SPEND of the bracket.
        short = -SPEND * bracket - rise @ step
        if short > 0:
            step = step + lift * short / (rise @ lift)
        tried = weight[:, None] + step[:, None] * LENGTHS
        means = unlabelled(tried)
        values, brackets = risk(tried, means[0])
        values = np.where(brackets >= 0, values, np.inf)
        best = int(values.argmin())
        if not values[best] < value:
            break
        weight, value, bracket, slope = tried[:, best], values[best], brackets[best], means[1:, best]
    return weight


def with_constant(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.c_[standardised(x, centre, scale), np.ones(len(x))]


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> Model:
    """The model of arrays held in memory: what ``train`` fits when Spark holds the unlabelled side."""
    centre, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0)
    scale = np.where(scale < 1e-3, 1.0, scale)
    u = with_constant(unlabelled, centre, scale)
    weight = minimise(with_constant(positive, centre, scale), u, prior, lambda w: risk_sums(u, w) / len(u), steps)
    return Model(centre, scale, weight[:-1], float(weight[-1]) + shift(_bins(u @ weight), prior))


def best_bin(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The prior from counts of logits in bins, ascending: the least ratio of the shares above a threshold."""
    p, u = positive.sum(), unlabelled.sum()
    above_p, above_u = np.cumsum(positive[::-1]) / p, np.cumsum(unlabelled[::-1]) / u
    seen = above_p > 0
    slack = 1.01 * (np.sqrt(np.log(40) / 2 / p) + np.sqrt(np.log(40) / 2 / u))
    at = int(((above_u[seen] + slack) / above_p[seen]).argmin())
    return float(np.clip(above_u[seen][at] / above_p[seen][at], 0.01, 0.99))


def shift(unlabelled: np.ndarray, prior: float) -> float:
    """What to add to all logits, given as counts in bins, so that the mean score is the prior."""
    at = (np.arange(len(unlabelled)) + 0.5) / BINS - REACH
    low, high = -2.0 * REACH, 2.0 * REACH
    for _ in range(60):
        middle = (low + high) / 2
        if np.average(1 / (1 + np.exp(-at - middle)), weights=unlabelled) < prior:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def _bins(logits: np.ndarray) -> np.ndarray:
    kind = np.floor((np.clip(logits, -REACH, REACH) + REACH) * BINS).astype(np.int64)
    return np.bincount(kind, minlength=2 * REACH * BINS + 1)


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the doc_id as text, modulo FOLDS, is 0."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == 0


def _sample(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` doc_ids, by a hash: the fit's documented bound."""
    return ids.select("doc_id").distinct().orderBy(F.xxhash64(F.lit("fit"), "doc_id"), "doc_id").limit(most)


def content(docs: DataFrame) -> DataFrame:
    """doc_id, x: every text's features, 16 bits each, computed once and stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in slices(batches, 1):
            x = features(data, bounds).astype(np.float16)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["doc_id", "x"])

    return stash(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("text")).mapInArrow(
        run, "doc_id bigint, x binary"), "quality-features")


def _stored(x: pa.Array) -> np.ndarray:
    return flat_text(x)[0].view(np.float16).reshape(-1, FEATURES).astype(float)


def totals(vectors: DataFrame, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """Sum of ``part(x)`` over all stored rows, a fixed number of values; None without rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = np.ravel(part(_stored(batch.column(0))))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(np.rint(total * UNIT))],
                                             names=["i", "total"])

    rows = vectors.select("x").mapInArrow(run, "i bigint, total double").groupBy("i").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()      # as many as ``part`` has values
    return np.array([float(r["total"]) for r in sorted(rows)]) / UNIT if rows else None


def _matrix(rows: list) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(r["x"]) for r in rows), np.float16).reshape(-1, FEATURES).astype(float)


def train(vectors: DataFrame, labels: DataFrame, positives: int = POSITIVES) -> Model:
    """Fit on a bounded sample of trusted positives and on all stored rows as unlabelled text."""
    zero = np.zeros(FEATURES)
    trusted = labels.filter(F.col("doc_id").isNotNull() & (F.col("quality") == 1) & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("bigint").alias("doc_id"))
    # One row of a doc_id teaches; the sample bounds what reaches the driver.
    taught = vectors.join(F.broadcast(_sample(trusted, positives)), "doc_id").groupBy("doc_id").agg(
        F.min("x").alias("x"), F.min(F.pmod(F.xxhash64(F.lit("prior"), "doc_id"), F.lit(4))).alias("part")).collect()
    if not taught:
        return Model(zero, zero + 1, zero, 0.0)
    taught.sort(key=lambda r: r["doc_id"])
    positive, other = _matrix(taught), np.array([r["part"] == 0 for r in taught])

    sums = totals(vectors, lambda x: np.r_[x.sum(axis=0), (x * x).sum(axis=0), len(x)])
    n = sums[-1]
    centre = sums[:FEATURES] / n
    scale = np.sqrt(np.maximum(0, sums[FEATURES:-1] / n - centre ** 2))
    scale = np.where(scale < 1e-3, 1.0, scale)
    p = with_constant(positive, centre, scale)
    # Each text once, so that copies cannot make the sample large.
    sample = vectors.select("x").filter(F.pmod(F.xxhash64("x"), F.lit(max(1, int(n) // CURVATURE))) == 0).distinct().collect()
    sample = with_constant(_matrix(sorted(sample, key=lambda r: bytes(r["x"]))) if sample else positive, centre, scale)

    def unlabelled(weights: np.ndarray) -> np.ndarray:
        found = totals(vectors, lambda x: risk_sums(with_constant(x, centre, scale), weights))
        return found.reshape(-1, weights.shape[1]) / n

    def logits(weight: np.ndarray) -> np.ndarray:
        return totals(vectors, lambda x: _bins(with_constant(x, centre, scale) @ weight))

    few = not other.any() or other.all()
    first = minimise(p if few else p[~other], sample, 0.5, unlabelled)
    prior = best_bin(_bins((p if few else p[other]) @ first), logits(first))
    weight = minimise(p, sample, prior, unlabelled)
    return Model(centre, scale, weight[:-1], float(weight[-1]) + shift(logits(weight), prior))


def scores(vectors: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every stored row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_stored(batch.column(1))))],
                                                 names=["doc_id", "score"])

    return vectors.select("doc_id", "x").mapInArrow(run, "doc_id bigint, score double")


def op4_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    prepare(docs.sparkSession)
    vectors = content(docs)
    return scores(vectors, train(vectors, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores at least ``threshold``."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(content(docs), labels))

    @F.pandas_udf("double")
    def score(text):
        parts = [shared.value.score(features(data, bounds)) for _, data, bounds in slices(
            iter([pa.RecordBatch.from_arrays([pa.array(text, pa.string())], names=["text"])]), 0)]
        import pandas as pd
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.filter(score(text_bytes()) >= threshold)
