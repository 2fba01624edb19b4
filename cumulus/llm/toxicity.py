"""Toxicity by weak supervision.

1. Voters: a lexicon of insults, patterns of address and emphasis, and stems
   mined from labelled training rows (hashed word beginnings that stand almost
   only in rows labelled toxic); a voter says toxic or nothing.
2. A generative label model over the votes: class balance and each voter's two
   firing rates by expectation maximisation, and the correlations that are left
   between voters given the class; correlated voters share one say.
3. A linear classifier on the hashed words and word beginnings that go with the
   posterior labels is trained on those labels, and scores every whole text.

Labels are read only from rows outside the held-out fold
(``crc32(id as text) mod 4 = 2``). The sample of labelled rows is bounded by
``SAMPLE`` (smallest id hashes); scores use the text alone.

Cases: null and empty texts get the score of a text without features; with no
labelled row, or none labelled toxic, only lexicon and patterns vote; repeated
rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import SpanHasher, joined, row_slices, runs, text_bytes
from cumulus.llm.quality import labelled_sample

SAMPLE = 12_000  # labelled training rows
BITS = 20
STEMS = (4, 5, 6, 7)  # bytes of a word's beginning
MINED = 200  # mined voters at most
SCREENED = 1000  # features of the linear classifier at most
THRESHOLD = 0.3
# Common English insults.
LEXICON = (
    "idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting",
    "dumb", "imbecile", "filth", "vermin", "bastard", "jerk", "fool", "ugly", "hate", "freak",
)
PATTERNS = (
    re.compile(rb"(?i)\byou(?:'re| are) (?:a |an |such )?(?:total |complete )?(?:" + "|".join(LEXICON).encode() + rb")"),
    re.compile(rb"(?i)\b(?:shut up|go away|get lost|drop dead)\b"),
    re.compile(rb"(?:[A-Z]{4,}[ ,]+){3,}[A-Z]{4,}!"),
    re.compile(rb"!{4,}"),
)


def is_held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2


def _letters() -> np.ndarray:
    table = np.zeros(256, bool)
    table[65:91] = table[97:123] = table[128:] = True
    return table


_IS_LETTER = _letters()


def text_features(texts: list[bytes]) -> list[np.ndarray]:
    """Distinct hashed words and word beginnings of each text."""
    buf, starts = joined(texts)
    hasher = SpanHasher(buf)
    w_start, w_end = runs(_IS_LETTER[buf])
    shift = np.uint64(64 - BITS)
    columns = [hasher(w_start, w_end) >> shift]
    for n in STEMS:
        end = np.minimum(w_start + n, w_end)
        with np.errstate(over="ignore"):
            stem = (hasher(w_start, end) * np.uint64(2 * n + 1)) >> shift
        columns.append(np.where(w_end - w_start >= n, stem, columns[0]))
    grid = np.stack(columns, axis=1).astype(np.int32)
    bounds = np.searchsorted(w_start, starts)
    return [np.unique(grid[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _word_ids(words: tuple[str, ...]) -> np.ndarray:
    buf, starts = joined([w.encode() for w in words])
    return (SpanHasher(buf)(starts[:-1], starts[1:] - 1) >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class LabelModel:
    prior: float
    fires: np.ndarray  # firing rate of each voter given clean, toxic
    share: np.ndarray  # say of each voter after correlation
    correlation: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        rate = np.clip(self.fires, 2e-5, 1 - 1e-4)
        on = np.log(rate[1] / rate[0])
        off = np.log((1 - rate[1]) / (1 - rate[0]))
        z = np.log(self.prior / (1 - self.prior)) + votes @ (on * self.share) + (1 - votes) @ (off * self.share)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_label_model(votes: np.ndarray, prior: float, rounds: int = 30, given: np.ndarray | None = None) -> LabelModel:
    """Accuracies by expectation maximisation, then correlations given the class.

    ``given`` labels, where there are any, weigh as much as the posterior in
    every round, so that rare voters are not taken for noise.
    """
    n, voters = votes.shape
    prior = float(np.clip(prior, 1e-3, 0.5))
    any_vote = votes.any(axis=1)
    q = np.where(any_vote, 0.9, prior / 4)
    model = LabelModel(prior, np.zeros((2, voters)), np.ones(voters), np.eye(voters))
    for _ in range(rounds):
        held = q if given is None else (q + given) / 2
        clean, toxic = (1 - held).sum(), held.sum()
        model.fires = np.stack((((1 - held) @ votes + 0.01) / (clean + 1), (held @ votes + 0.5) / (toxic + 1)))
        # a voter that does not fire more often on toxic rows has no say
        model.share = (model.fires[1] > 2 * model.fires[0]).astype(float)
        model.prior = float(np.clip(held.mean(), 1e-3, 0.5))
        q = model.posterior(votes)
    left = votes - np.outer(1 - q, model.fires[0]) - np.outer(q, model.fires[1])
    scale = np.sqrt(np.maximum((left * left).mean(axis=0), 1e-9))
    model.correlation = (left.T @ left) / max(n, 1) / np.outer(scale, scale)
    strong = np.abs(model.correlation) * (np.abs(model.correlation) > 0.1)
    # votes that repeat each other count as the square root of their number
    model.share = model.share / np.sqrt(np.maximum(strong.sum(axis=1), 1.0))
    return model


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def score(self, feats: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(f) for f in feats])
        flat = self.weights[np.concatenate(feats)] if len(feats) else np.zeros(0)
        z = np.bincount(np.repeat(np.arange(len(feats)), sizes), flat, len(feats)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _mine(feats: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Features that stand almost only in rows labelled toxic, the most frequent first."""
    if not (y == 1).any():
        return np.zeros(0, np.int32)
    size = 1 << BITS
    toxic = np.bincount(np.concatenate([f for f, t in zip(feats, y, strict=True) if t == 1]), minlength=size)
    clean = np.bincount(np.concatenate([f for f, t in zip(feats, y, strict=True) if t != 1] or [np.zeros(0, np.int32)]), minlength=size)
    good = np.flatnonzero((toxic >= 4) & (toxic >= 12 * clean))
    return good[np.argsort(-toxic[good], kind="stable")][:MINED]


def _fit_linear(feats: list[np.ndarray], q: np.ndarray, rounds: int = 300, rate: float = 0.1, ridge: float = 1e-4) -> ToxicityModel:
    """Ridge logistic regression on soft labels over the features that speak for a toxic label."""
    size, flat = 1 << BITS, np.concatenate(feats)
    row = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    seen = np.bincount(flat, minlength=size)
    toxic = np.bincount(flat, q[row], size)
    base = q.mean()
    with np.errstate(invalid="ignore", divide="ignore"):
        excess = np.where(seen >= 3, (toxic - seen * base) / np.sqrt(seen * base * (1 - base)), 0)
    good = np.flatnonzero((excess > 4) & (toxic > 0.5 * seen))
    good = good[np.argsort(-excess[good], kind="stable")][:SCREENED]
    column = np.full(size, -1)
    column[good] = np.arange(len(good))
    keep = column[flat] >= 0
    x = np.zeros((len(feats), len(good)), np.float32)
    x[row[keep], column[flat[keep]]] = 1
    w = np.zeros(len(good) + 1)
    w[-1] = np.log(base / (1 - base))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        z = x @ w[:-1].astype(np.float32) + w[-1]
        e = ((1 / (1 + np.exp(-np.clip(z, -40, 40))) - q) / len(q)).astype(np.float32)
        g = np.append(x.T @ e + ridge * w[:-1], e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(size, np.float32)
    weights[good] = w[:-1]
    return ToxicityModel(weights, float(w[-1]))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE
) -> tuple[ToxicityModel, LabelModel]:
    """Fit on at most ``sample`` labelled rows outside the held-out fold."""

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, 2):
                texts = text_bytes(part.column(2))
                feats = text_features(texts)
                marks = [[p.search(t) is not None for p in PATTERNS] for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([f.tobytes() for f in feats], pa.binary()), pa.array(marks, pa.list_(pa.bool_()))],
                    ["id", "y", "f", "p"],
                )

    train = labels.filter(~is_held_out(F.col(id_col)))
    rows = labelled_sample(docs, train, id_col, text_col, label_col, sample).select(F.col("id").cast("long").alias("id"), "y", "text")
    got = sorted(rows.mapInArrow(run, "id long, y double, f binary, p array<boolean>").collect(), key=lambda r: (r[0], r[2]))
    if not got:
        weights = np.zeros(1 << BITS, np.float32)
        weights[_word_ids(LEXICON)] = 4.0
        return ToxicityModel(weights, -3.0), LabelModel(0.05, np.zeros((2, 0)), np.zeros(0), np.eye(0))
    y = np.array([r[1] for r in got])
    feats = [np.frombuffer(r[2], np.int32) for r in got]
    voters = [np.array([i]) for i in _word_ids(LEXICON)] + [np.array([i]) for i in _mine(feats, y)]
    column = np.full(1 << BITS, -1)
    column[np.concatenate(voters)] = np.arange(len(voters))
    votes = np.zeros((len(got), len(voters) + len(PATTERNS)))
    for k, (f, r) in enumerate(zip(feats, got, strict=True)):
        hit = column[f]
        votes[k, hit[hit >= 0]] = 1
        votes[k, len(voters) :] = r[3]
    told = fit_label_model(votes, float((y == 1).mean()), given=(y == 1).astype(float))
    q = np.clip(told.posterior(votes), 0.001, 0.999)
    return _fit_linear([f if len(f) else np.zeros(1, np.int32) for f in feats], q), told


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in row_slices(batch, 2):
                score = model.score(text_features(text_bytes(part.column(2))))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    own = F.col(id_col)
    rows = docs.select(own.cast("long").alias("doc_id"), F.coalesce(is_held_out(own), F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
