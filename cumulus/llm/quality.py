"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Ratings are ordered grades g0 < g1 < ... found in the labels. One weight
vector is shared by all grades and ordered thresholds cut the line:
``P(grade <= k) = 1 / (1 + exp(-(threshold_k - w x)))``. A text's features are
the square roots of its hashed byte n-gram frequencies (n = 1, 2, 3, letters
folded to lower case) and a few of its shape. A text is selected by its tail
probability.

The model is fitted on at most ``SAMPLE`` labelled rows, those of the smallest
id hashes; every text is scored whole.

Cases: null and empty texts have zero n-gram features and get a grade like any
other; null ratings and ids without a text are not used; with one grade only
(or none) every tail probability is 1; repeated rows give repeated rows; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import SpanHasher, joined, row_slices, space_words, text_bytes

SAMPLE = 4000  # labelled rows the model is fitted on
BITS = 11  # hash cells of n-grams: 2 ** BITS
KEEP = 0.5  # tail probability from which a text is selected
_SHAPE = 8


def features(texts: list[bytes]) -> np.ndarray:
    """One float32 row for each text."""
    size = 1 << BITS
    out = np.zeros((len(texts), size + _SHAPE), np.float32)
    buf, starts = joined(texts)
    lower = buf.astype(np.uint32)
    upper = (buf >= 65) & (buf <= 90)
    lower[upper] += 32
    pad = np.concatenate((lower, np.zeros(3, np.uint32)))
    grams = [lower, pad[:-3] + (pad[1:-2] << 8) + 1, pad[:-3] + (pad[1:-2] << 8) + (pad[2:-1] << 16) + 2]
    hashed = [((g[: len(buf)] * np.uint32(0x9E3779B1)) ^ np.uint32(k * 0x3C6EF372)) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS) for k, g in enumerate(grams)]
    hasher = SpanHasher(buf)
    w_start, w_end = space_words(buf)
    word = hasher(w_start, w_end)
    bounds = np.searchsorted(w_start, starts)
    letters = upper | ((buf >= 97) & (buf <= 122)) | (buf >= 128)
    letter_sum, upper_sum = np.concatenate(([0], np.cumsum(letters))), np.concatenate(([0], np.cumsum(upper)))
    for r in range(len(texts)):
        lo, hi = int(starts[r]), int(starts[r + 1]) - 1
        n = hi - lo
        if not n:
            continue
        counts = np.bincount(np.concatenate([h[lo:hi] for h in hashed]), minlength=size)
        out[r, :size] = np.sqrt(counts / n)
        own = word[bounds[r] : bounds[r + 1]]
        if len(own):
            _, times = np.unique(own, return_counts=True)
            out[r, size : size + 4] = (len(times) / len(own), times.max() / len(own), np.sqrt((times / len(own)) @ (times / len(own))), len(own) / n * 4)
        out[r, size + 4 :] = (np.log1p(n) / 12, (letter_sum[hi] - letter_sum[lo]) / n, (upper_sum[hi] - upper_sum[lo]) / n, len(own) < 5)
    return out


@dataclass
class OrdinalModel:
    grades: list[float]
    weights: np.ndarray
    thresholds: np.ndarray

    def below(self, x: np.ndarray) -> np.ndarray:
        """``P(grade <= k)`` for every grade but the last."""
        z = self.thresholds[None, :] - (x @ self.weights)[:, None]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))

    def expected(self, x: np.ndarray) -> np.ndarray:
        cum = np.concatenate((np.zeros((len(x), 1)), self.below(x), np.ones((len(x), 1))), axis=1)
        return np.diff(cum, axis=1) @ np.array(self.grades)

    def tail(self, x: np.ndarray) -> np.ndarray:
        """``P(grade > the lowest)``: what selection goes by."""
        return 1.0 - self.below(x)[:, 0] if len(self.grades) > 1 else np.ones(len(x))


def fit_ordinal(x: np.ndarray, y: np.ndarray, rounds: int = 400, ridge: float = 1e-4, rate: float = 0.05) -> OrdinalModel:
    """Maximum likelihood by Adam; thresholds stay ordered (a first one and positive steps)."""
    grades = sorted(set(y.tolist()))
    if len(grades) < 2:
        return OrdinalModel(grades or [0.0], np.zeros(x.shape[1]), np.zeros(0))
    k = np.searchsorted(grades, y)
    share = np.cumsum(np.bincount(k, minlength=len(grades)) / len(k))[:-1]
    first = np.log(share / (1 - share))
    free = np.concatenate(([first[0]], np.log(np.maximum(np.diff(first), 1e-3))))
    w = np.zeros(x.shape[1])
    m, v = np.zeros(len(w) + len(free)), np.zeros(len(w) + len(free))
    x64 = x.astype(np.float32)
    for step in range(1, rounds + 1):
        theta = np.concatenate((free[:1], free[0] + np.cumsum(np.exp(free[1:]))))
        s = x64 @ w.astype(np.float32)
        edge = np.concatenate(([-np.inf], theta, [np.inf]))
        hi = 1 / (1 + np.exp(-np.clip(edge[k + 1] - s, -40, 40)))
        lo = 1 / (1 + np.exp(-np.clip(edge[k] - s, -40, 40)))
        hi[k == len(grades) - 1], lo[k == 0] = 1.0, 0.0
        p = np.maximum(hi - lo, 1e-9)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
        g_s = (d_hi - d_lo) / len(k)  # of minus the log-likelihood, by the score
        g_theta = np.zeros(len(theta))
        np.add.at(g_theta, np.minimum(k, len(theta) - 1), np.where(k < len(theta), -d_hi, 0) / len(k))
        np.add.at(g_theta, np.maximum(k - 1, 0), np.where(k > 0, d_lo, 0) / len(k))
        g_free = np.concatenate(([g_theta.sum()], np.exp(free[1:]) * np.cumsum(g_theta[::-1])[::-1][1:]))
        grad = np.concatenate((x64.T @ g_s.astype(np.float32) + ridge * w, g_free))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, free = w - move[: len(w)], free - move[len(w) :]
    theta = np.concatenate((free[:1], free[0] + np.cumsum(np.exp(free[1:]))))
    return OrdinalModel(grades, w, theta)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, rating_col: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled rows ``id, text, y``: those of the smallest id hashes.

    An id that repeats in ``docs`` gives one row, with its text of the smallest hash.
    """
    rated = labels.select(F.col(id_col).alias("id"), F.col(rating_col).cast("double").alias("y")).filter("id is not null and y is not null")
    rated = rated.groupBy("id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(limit)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    some = texts.join(F.broadcast(rated), "id")  # at most ``limit`` ids
    first = some.groupBy("id").agg(F.min("y").alias("y"), F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
    return first.select("id", F.col("first.text").alias("text"), "y")


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rating_col: str = "quality", sample: int = SAMPLE
) -> OrdinalModel:
    def run(batches):
        for batch in batches:
            for part in row_slices(batch, 2):
                x = features(text_bytes(part.column(2)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "y", "x"]
                )

    rows = labelled_sample(docs, labels, id_col, text_col, rating_col, sample).select(F.col("id").cast("long").alias("id"), "y", "text")
    got = sorted(rows.mapInArrow(run, "id long, y double, x binary").collect())
    x = np.frombuffer(b"".join(r[2] for r in got), np.float32).reshape(len(got), (1 << BITS) + _SHAPE)
    return fit_ordinal(x, np.array([r[1] for r in got]))


def score_quality(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """``doc_id, expected_grade, tail_probability, selected`` of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in row_slices(batch, 1):
                x = features(text_bytes(part.column(1))).astype(np.float64)
                tail = model.tail(x)
                grade = model.expected(x) if len(model.grades) > 1 else np.full(len(x), model.grades[0])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(grade), pa.array(tail), pa.array(tail >= keep)],
                    ["doc_id", "expected_grade", "tail_probability", "selected"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double, selected boolean")


def select_quality(docs: DataFrame, model: OrdinalModel, text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """The rows of ``docs``, all their columns, whose tail probability is at least ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for part in row_slices(batch, at):
                tail = shared.value.tail(features(text_bytes(part.column(at))).astype(np.float64))
                yield part.filter(pa.array(tail >= keep))

    return docs.mapInArrow(run, docs.schema)
