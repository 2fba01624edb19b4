"""Target-distribution importance resampling: draw the documents that look most like a target set.

Features are runs of consecutive words (ASCII letters in lower case), repeats
counted, hashed to ``cells`` buckets by CRC-32. A bucket's gain is the rounded
log ratio of its smoothed share in the target to its share in the documents; a
document's weight is the floored mean gain of its features, its score the
weight with Gumbel noise from a hash of its id, so that the highest scores are
a draw without replacement in proportion to the exponent of the weight.

The gains are one array of ``cells`` integers, the only thing that tasks share.
Scores are persisted. The cutoff is found by numeric bisection: exact count
jobs over the persisted scores, then over the tied ids, then over what still
ties, halve the range until one value is left (``HALVINGS`` times in a job).
Drawn rows are range-partitioned in draw order; a row's rank is its place in
its partition after the rows of the partitions before it.

Cases: null texts are empty and have no features (weight 0, never drawn as they
are below ``least_words``); null ids are hashed as the empty text and come last
among ties; rows repeated under one id stand each for itself (their common
score ties, fewer features first, then any order of rows that are equal in
every column); other columns are ignored; empty tables give empty results, an
empty target gives gains by the smoothing alone.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import row_slices, scratch_table, text_bytes

CELLS = 10_000
LONGEST_RUN = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
HALVINGS = 4

_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _buckets(text: bytes, cells: int, longest: int) -> tuple[int, np.ndarray]:
    """The number of words of a text, and the bucket of each of its features."""
    words = text.translate(_WORD_BYTES).split()
    runs = list(words)
    for n in range(2, longest + 1):
        runs += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return len(words), (np.fromiter(map(zlib.crc32, runs), np.uint32, len(runs)) % cells).astype(np.int64)


def bucket_counts(docs: DataFrame, text_col: str = "text", cells: int = CELLS, longest: int = LONGEST_RUN) -> np.ndarray:
    """Features of all texts by bucket: one array a task, summed by bucket in Spark."""

    def run(batches):
        total = np.zeros(cells, np.int64)
        for batch in batches:
            for part in row_slices(batch, 0):
                for text in text_bytes(part.column(0)):
                    total += np.bincount(_buckets(text, cells, longest)[1], minlength=cells)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter("text is not null")
    out = np.zeros(cells, np.int64)
    for bucket, n in texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():  # at most ``cells`` rows
        out[bucket] = n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 * ln(share in the target / share in the documents))``, one added to every count."""
    cells, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * (s_all + cells) / ((s + 1.0) * (t_all + cells)))) for s, t in zip(raw.tolist(), target.tolist())],
        np.int64,
    )


def importance_scores(
    docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST_RUN, seed: int = SEED
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches):
        gains = shared.value
        for batch in batches:
            for part in row_slices(batch, 1):
                rows = []
                for text in text_bytes(part.column(1)):
                    n_words, at = _buckets(text, len(gains), longest)
                    rows.append((n_words, len(at), int(gains[at].sum()) // len(at) if len(at) else 0))
                columns = np.array(rows, np.int64).T
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, columns)], ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long").withColumn("score", F.col("weight") + noise)


def _smallest(rows: DataFrame, column: str, need: int) -> tuple[int, int, int]:
    """The least value with ``need`` rows up to it, and the rows below and at it, by counting alone."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    below = 0
    while low < high:
        cuts = sorted({low + (high - low) * k // (1 << HALVINGS) for k in range(1 << HALVINGS)})
        counts = rows.agg(*[F.count_if(F.col(column) <= cut) for cut in cuts]).first()
        for cut, n in zip(cuts, counts):
            if n >= need:
                high = cut
                break
            low, below = cut + 1, n
    return low, below, rows.filter(F.col(column) == low).count()


def draw_limits(rows: DataFrame, order: list[str], draw: int) -> list[int]:
    """Values of the first columns of ``order`` up to which exactly ``draw`` rows come; the last column is unique."""
    limits: list[int] = []
    for column in order:
        limit, below, tied = _smallest(rows, column, draw)
        limits.append(limit)
        draw -= below
        if tied == draw:
            break
        rows = rows.filter(F.col(column) == limit)
    return limits


def _up_to(order: list[str], limits: list[int]) -> Column:
    """Rows whose first columns come, one after the other, before the limits or equal them."""
    found = F.lit(True)
    for column, limit in reversed(list(zip(order, limits))):
        found = (F.col(column) < limit) | ((F.col(column) == limit) & found)
    return found


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their ``rank`` (from 1) by ``order``, a total order: no partition but a slice of the range is sorted."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = scratch_table(placed, "placed")
    part = F.shiftright("place", 33)
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())  # one row for each range partition
    before, start = {}, 0
    for number, size in sizes:
        before[number] = start
        start += size
    offsets = rows.sparkSession.createDataFrame(list(before.items()), "part long, before long")
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.join(F.broadcast(offsets), part == F.col("part"))
    return placed.withColumn("rank", F.col("before") + inside + 1).drop("part", "before", "place")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    cells: int = CELLS,
    longest: int = LONGEST_RUN,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; ``rank`` is null for those not drawn."""
    gains = bucket_gains(bucket_counts(docs, text_col, cells, longest), bucket_counts(target, text_col, cells, longest))
    scores = importance_scores(docs, gains, id_col, text_col, longest, seed).select(
        "*",
        (-F.col("score")).alias("o_score"),
        F.col("doc_id").isNull().cast("int").alias("o_null"),
        F.coalesce("doc_id", F.lit(0)).alias("o_id"),
        F.monotonically_increasing_id().alias("o_row"),
    )
    scores = scratch_table(scores, "scores")
    order = ["o_score", "o_null", "o_id", "n_features", "o_row"]
    fits = F.col("n_words") >= least_words
    draw = scores.filter(fits).count() * percent // 100
    result = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not draw:
        return scores.select(*result, none)
    drawn = fits & _up_to(order, draw_limits(scores.filter(fits), order, draw))
    return ranked(scores.filter(drawn), order).select(*result, "rank").union(scores.filter(~drawn).select(*result, none))


ORACLE = r"""
WITH step AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b::BIGINT)) AS tab),
words AS MATERIALIZED (
  SELECT 0 AS side, row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL
  SELECT 1, 0, NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
n AS (SELECT side, r, w, count(*) AS c FROM (SELECT side, r, unnest(ws) AS w FROM words) GROUP BY ALL),
vocab AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM n)),
bytes AS (SELECT w, list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT) AS bs FROM vocab),
cell AS (
  SELECT w, xor(list_reduce(bs, lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS cell
  FROM bytes, step),
gain AS (
  SELECT cell, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000))))::BIGINT AS g
  FROM (SELECT cell, coalesce(sum(c) FILTER (side = 0), 0) AS s, coalesce(sum(c) FILTER (side = 1), 0) AS t
        FROM range(10000) AS u(cell) LEFT JOIN (SELECT * FROM n JOIN cell USING (w)) USING (cell) GROUP BY cell)),
sums AS (SELECT r, sum(c * g) AS total FROM n JOIN cell USING (w) JOIN gain USING (cell) WHERE side = 0 GROUP BY r),
scored AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(floor(total::DOUBLE / len(ws)), 0)::BIGINT AS weight,
    ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM words LEFT JOIN sums USING (r) WHERE side = 0),
full_ AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS p,
    count(*) OVER (PARTITION BY n_features >= 20) AS fit FROM full_)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND p <= 10 * fit // 100 THEN p END AS rank FROM placed
"""
