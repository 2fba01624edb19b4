"""Periodic runs of words, by an enhanced suffix array and the branching-tandem test.

A run is a stretch of words with smallest period q that no neighbouring word
extends; stretches of at least ``LEAST_LENGTH`` words and ``LEAST_TURNS``
periods are reported. Texts of a slice share one suffix array (prefix doubling;
words are numbered for each text apart, so no prefix crosses texts), with its
inverse and the common prefix lengths of neighbours. Every interval of equal
prefix length l is split by its own boundaries into children; for suffixes i of
all children but the largest, the inverse array tells whether i + l or i - l
lies in the interval but in another child: exactly then a square of period l
starts at the smaller of the two and its period ends behind it. No tree nodes
are built. A square whose period is a multiple of that of a shorter run ending
at the same word is left out; the others are rotated to the left as far as the
period holds, which gives the run.

Texts go through tasks in Arrow slices of bounded size (or one text); the
suffix enumeration, n log n at worst, is cut in blocks. Nothing is shuffled.

Cases: null and empty texts have no words and no runs; a text of one word
repeated is one run of period 1; repeated rows are handled each for itself;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import row_slices, text_bytes

LEAST_LENGTH = 6
LEAST_TURNS = 4
BLOCK = 1 << 19  # suffixes that are tested at once
SPACES = " \t\n\x0b\x0c\r"


def suffix_array(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse, and ``lcp[k]`` of the suffixes of rank k - 1 and k (-1 at both ends).

    ``ends[i]`` is the end of the text that position i is in; texts share no code.
    """
    n = len(codes)
    sa = np.argsort(codes, kind="stable")
    in_order = codes[sa]
    fresh = np.concatenate(([True], in_order[1:] != in_order[:-1]))
    heads = np.flatnonzero(fresh)
    rank = np.empty(n + 1, np.int64)
    rank[sa] = heads[np.cumsum(fresh) - 1]
    rank[n] = -1  # behind the last word
    levels, step = [rank.copy()], 1
    several = np.diff(np.append(heads, n)) > 1
    slots = np.flatnonzero(several[np.cumsum(fresh) - 1])
    while len(slots):
        at = sa[slots]
        later = np.minimum(at + step, n)
        key = rank[at] * (n + 1) + np.where(later < ends[at], rank[later] + 1, 0)
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        sa[slots] = at
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        heads = np.flatnonzero(fresh)
        rank[at] = slots[heads[np.cumsum(fresh) - 1]]
        several = np.diff(np.append(heads, len(at))) > 1
        slots = slots[several[np.cumsum(fresh) - 1]]
        step *= 2
        if len(slots):
            levels.append(rank.copy())
    lcp = np.zeros(n + 1, np.int64)
    left, right = sa[:-1], sa[1:]
    pairs = np.flatnonzero(levels[0][left] == levels[0][right])
    left, right = left[pairs], right[pairs]
    common = np.zeros(len(pairs), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        common += (levels[k][np.minimum(left + common, n)] == levels[k][np.minimum(right + common, n)]).astype(np.int64) << k
    lcp[pairs + 1] = common
    lcp[[0, n]] = -1
    return sa, rank[:n], lcp


def _nearest_smaller(lcp: np.ndarray, at: np.ndarray, side: int) -> np.ndarray:
    """The nearest place on one side of each place of ``at`` with a smaller value, by jumping pointers."""
    jump = np.arange(len(lcp)) + side
    todo = at
    while len(todo):
        todo = todo[lcp[jump[todo]] >= lcp[todo]]
        jump[todo] = jump[jump[todo]]
    return jump[at]


def branching_squares(codes: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of starts and periods of the squares whose period does not go on behind them; may repeat."""
    sa, rank, lcp = suffix_array(codes, ends)
    edge = np.flatnonzero(lcp > 0)
    if not len(edge):
        return
    low, high = _nearest_smaller(lcp, edge, -1), _nearest_smaller(lcp, edge, 1)  # the interval is low .. high - 1
    order = np.lexsort((edge, lcp[edge], low))
    edge, low, high = edge[order], low[order], high[order]
    depth = lcp[edge]
    first = np.concatenate(([True], (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])))
    group = np.cumsum(first) - 1
    lead = np.flatnonzero(first)  # first boundary of each interval
    tail = np.append(lead[1:], len(edge)) - 1
    child_from = np.empty(len(edge) + len(lead), np.int64)
    child_to = np.empty_like(child_from)
    place = np.arange(len(edge)) + group
    child_from[place + 1], child_from[place[lead]] = edge, low[lead]
    child_to[place], child_to[place[tail] + 1] = edge, high[lead]
    size = child_to - child_from
    begin = place[lead]
    interval = np.zeros(len(size), np.int64)
    interval[begin[1:]] = 1
    interval = np.cumsum(interval)
    is_largest = size == np.maximum.reduceat(size, begin)[interval]
    seen = np.cumsum(is_largest)
    is_largest &= seen == (seen[begin] - is_largest[begin])[interval] + 1  # the first of the largest only
    small = np.flatnonzero(~is_largest)
    total = np.cumsum(size[small])
    cuts = np.unique(np.searchsorted(total, np.arange(0, total[-1] + BLOCK, BLOCK)))
    for a, b in zip(cuts, np.append(cuts[1:], len(small))):
        part = small[a:b]
        if not len(part):
            continue
        which = np.repeat(part, size[part])
        offset = np.arange(len(which)) - np.repeat(np.cumsum(size[part]) - size[part], size[part])
        here = lead[interval[which]]
        i, period = sa[child_from[which] + offset], depth[here]
        for start, other in ((i, i + period), (i - period, i - period)):
            inside = (other >= 0) & (other < len(codes))
            r = rank[np.where(inside, other, 0)]
            hit = inside & (r >= low[here]) & (r < high[here]) & ((r < child_from[which]) | (r >= child_to[which]))
            if hit.any():
                yield start[hit], period[hit]


def _rotate(codes: np.ndarray, start: int, period: int, least: int) -> int:
    """The first word of the run of this period that the square at ``start`` is in."""
    block = 8
    while start > least:
        m = min(block, start - least)
        differ = np.flatnonzero(codes[start - m : start] != codes[start - m + period : start + period])
        if len(differ):
            return start - m + int(differ[-1]) + 1
        start, block = start - m, block * 2
    return start


def find_runs(texts: list[list], least_length: int = LEAST_LENGTH, least_turns: int = LEAST_TURNS) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of every run of each list of words, by start, then period."""
    lengths = np.array([len(words) for words in texts], np.int64)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not bounds[-1]:
        return found
    numbers, base = [], 0
    for words in texts:
        own: dict = {}
        numbers += [base + own.setdefault(w, len(own)) for w in words]
        base += len(own)
    codes = np.array(numbers, np.int64)
    del numbers
    squares = list(branching_squares(codes, np.repeat(bounds[1:], lengths)))
    if not squares:
        return found
    start, period = np.concatenate([s for s, _ in squares]), np.concatenate([p for _, p in squares])
    rows = np.unique(np.stack((start + 2 * period, period), axis=1), axis=0)  # by end, then period
    text_of = np.searchsorted(bounds, rows[:, 0] - 1, "right") - 1
    last, shorter = -1, []
    for (end, p), text in zip(rows.tolist(), text_of.tolist()):
        if end != last:
            last, shorter = end, []
        if any(p % q == 0 and first <= end - 2 * p for first, q in shorter):
            continue  # a square of a run already found
        first = _rotate(codes, end - 2 * p, p, int(bounds[text]))
        shorter.append((first, p))
        if end - first >= max(least_length, least_turns * p):
            found[text].append((first - int(bounds[text]), end - first, p))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds behind its first period."""
    if not runs:
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()])


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_turns: int = LEAST_TURNS
) -> DataFrame:
    """``doc_id, runs, collapsed`` of every document: its runs by start, then period, and its text without the repeats."""
    fields = ["start", "length", "period"]

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, 1):
                texts = [text.split() for text in text_bytes(part.column(1))]
                found = find_runs(texts, least_length, least_turns)
                flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
                ends = np.cumsum([0, *map(len, found)])
                structs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
                short = pa.array([collapse(w, r) for w, r in zip(texts, found)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), lists, short], ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``; every tenth text, by the CRC-32 h of its id, becomes periodic from word a on, with period p."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.translate("text", SPACES, " " * len(SPACES)), " "), lambda w: w != "")
    rows = rows.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("old"))
    rows = rows.withColumn("n", F.size("old")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    a, p, old = F.col("a"), F.col("p"), F.col("old")
    new = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: old[F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")])
    return rows.select("doc_id", F.when(a.isNotNull(), F.array_join(new, " ")).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """``n_runs``, the run of most turns, and hashes of all runs and of the collapsed text."""

    def better(best: Column, r: Column) -> Column:  # of equal turns the first, as runs go by start, then period
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), better)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return rows.select(
        "doc_id",
        "n_runs",
        *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best")["length"] / F.col("best")["period"]).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
