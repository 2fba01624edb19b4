"""N-gram Jaccard join by prefix filters under several global token orders.

A document is its set of distinct shingles of ``words`` words (64-bit hashes).
Two linked sets differ in few shingles, so under any global order the first
``n - ceil(percent n / 100) + 1`` shingles of both must share one. All orders put
shingles of common classes last (the class comes from a fixed-size count sketch
over all documents) and differ in the hash that ranks a class.

1. Documents with equal sets fall into one group (linked by definition); its
   smallest id stands for it.
2. Prefix shingles of the first order that two or more representatives share
   make buckets, without those whose size is far from all others there. In a
   bucket only representatives can link whose sizes and
   positions of the shingle leave room for enough common ones, and whose parity
   sketches are near enough (a differing shingle changes one bit at most).
3. First each representative is paired with one leader of its bucket, verified,
   and joined to components; then, in buckets of many, with its nearest in
   another component as long as that finds links; then all remaining near pairs
   of a bucket whose components differ. So links within a large group of near
   copies cost pairs in proportion to its size, and no link between components is lost.
4. A pair of large sets must also be near by sketches that grow with the sets,
   and every pair must share prefix shingles under every further order; what
   passes all filters is verified on the whole sets.

Cases: null or empty texts have no shingles and link with nothing; under ``words``
words the whole sequence is one shingle; repeated rows count once; null ids are
left out; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumulus.llm.common import SpanHasher, drop_scratch, joined, mix, row_slices, scratch_table, space_words, text_bytes
from cumulus.llm.components import components
from cumulus.operators.joins import bounded_broadcast

WORDS = 3  # of a shingle, where the caller names no other number
ORDERS = 3
BITS = 1024  # of the parity sketch in a bucket, at most
SKETCH = 1 << 18  # cells of the count sketch
MAX_BROADCAST_IDS = 500_000
BLOCK = 1500  # representatives of one bucket compared at once
MANY = 32  # representatives of a bucket that first look for their nearest
FAR = 1 << 30
_SEEDS = [np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64)) for k in range(8)]


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    buf, starts = joined(texts)
    hasher = SpanHasher(buf)
    w_start, w_end = space_words(buf)
    word = hasher(w_start, w_end)
    bounds = np.searchsorted(w_start, starts)
    n = max(len(word) - words + 1, 0)
    run = np.full(n, 7, np.uint64)
    with np.errstate(over="ignore"):
        for k in reversed(range(words)):
            run = mix(word[k : k + n] + run)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= words:
            out.append(np.unique(run[lo : hi - words + 1]))
        elif hi > lo:
            short = np.full(1, 2 * (hi - lo) + 1, np.uint64)
            with np.errstate(over="ignore"):
                for k in reversed(range(lo, hi)):
                    short = mix(word[k : k + 1] + short)
            out.append(short)
        else:
            out.append(word[:0])
    return out


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(46)).astype(np.int64)


def count_sketch(docs: DataFrame, words: int = WORDS) -> np.ndarray:
    """How often the shingles of each hash cell occur over all documents: a fixed-size array.

    Every task sums its own, then groups of tasks are summed; the driver gets
    one array of ``SKETCH`` numbers whatever the input.
    """

    def count(batches):
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for part in row_slices(batch, 1):
                sets = shingle_sets(text_bytes(part.column(1)), words)
                total += np.bincount(_cells(np.concatenate(sets)) if sets else [], minlength=SKETCH).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.int32).tobytes()], pa.binary())], ["cells"])

    def add(batches):
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for cells in batch.column(0).to_pylist():
                total += np.frombuffer(cells, np.int32 if len(cells) == 4 * SKETCH else np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["cells"])

    parts = docs.mapInArrow(count, "cells binary").repartition(16).mapInArrow(add, "cells binary")
    whole = parts.repartition(1).mapInArrow(add, "cells binary").collect()
    return sum((np.frombuffer(r[0], np.int64) for r in whole), np.zeros(SKETCH, np.int64))


def rank_classes(counts: np.ndarray) -> np.ndarray:
    """Class of each sketch cell: 0 up to the usual count, one more for each quarter above it."""
    usual = max(float(np.median(counts)), 1.0)
    ratio = counts / usual - 4.0 / np.sqrt(usual)
    return np.clip(np.floor(4 * np.log2(np.maximum(ratio, 1.0))), 0, 255).astype(np.uint8)


def prefix_size(n: int, percent: int) -> int:
    """Shingles of a set of ``n`` of which a linked set must hold one."""
    return n - -(-percent * n // 100) + 1


def _least_shared(both, percent: int):
    """Shingles that linked sets of ``both`` shingles in all share at least: ``100 o >= percent (both - o)``."""
    return -(-percent * both // (100 + percent))


def _prefixes(shingles: np.ndarray, classes: np.ndarray, percent: int) -> list[np.ndarray]:
    p = prefix_size(len(shingles), percent)
    level = classes[_cells(shingles)].astype(np.uint64) << np.uint64(56)
    out = []
    for seed in _SEEDS[:ORDERS]:
        with np.errstate(over="ignore"):
            rank = level | (mix(shingles ^ seed) >> np.uint64(8))
        at = np.argpartition(rank, p - 1)[:p] if p < len(shingles) else np.arange(p)
        if not out:
            at = at[np.lexsort((shingles[at], rank[at]))]  # positions count under the first order
        out.append(shingles[at])
    return out


def _parity(shingles: np.ndarray, bits: int = BITS) -> bytes:
    """A bit for each of ``bits`` cells: whether it holds an odd number of the shingles."""
    return np.packbits(np.bincount((shingles >> np.uint64(20)).astype(np.int64) % bits, minlength=bits).astype(np.uint8) & 1).tobytes()


def sketch_bits(n: int, percent: int) -> int:
    """Bits, a power of two, that a sketch needs to tell sets of ``n`` unrelated shingles from linked ones."""
    most, bits = 2 * n - 2 * _least_shared(2 * n, percent), 64
    while bits / 2 - 3 * bits**0.5 <= most:  # unrelated sets differ in half of the bits, less some deviations
        bits *= 2
    return bits


def _profiles(docs: DataFrame, classes: np.ndarray, percent: int, words: int) -> DataFrame:
    """``id, n, low, high, sketch, wide, p0, p1, ...`` of every document: set size, set signature, parity sketches, prefixes (``p0`` in order)."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)  # SKETCH bytes
    fields = ["id", "n", "low", "high", "sketch", "wide", *[f"p{k}" for k in range(ORDERS)]]

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, 1):
                sets = shingle_sets(text_bytes(part.column(1)), words)
                low, high, sketch, wide, prefixes = [], [], [], [], [[] for _ in range(ORDERS)]
                for s in sets:
                    with np.errstate(over="ignore"):
                        low.append(int(np.add.reduce(mix(s)).astype(np.int64)))
                        high.append(int(np.add.reduce(mix(s ^ _SEEDS[5])).astype(np.int64)))
                    bits = sketch_bits(len(s), percent)
                    sketch.append(_parity(s, min(bits, BITS)))
                    wide.append(np.frombuffer(_parity(s, 2 * bits) if bits > BITS else b"", np.int64))
                    for k, p in enumerate(_prefixes(s, shared.value, percent) if len(s) else [s] * ORDERS):
                        # the further orders keep 32 bits of each hash: enough to see that none is shared
                        prefixes[k].append(p.astype(np.uint32).view(np.int32) if k else p.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(low, pa.int64()),
                        pa.array(high, pa.int64()),
                        pa.array(sketch, pa.binary()),
                        pa.array(wide, pa.list_(pa.int64())),
                        *[pa.array(p, pa.list_(pa.int32() if k else pa.int64())) for k, p in enumerate(prefixes)],
                    ],
                    fields,
                )

    kinds = "id long, n long, low long, high long, sketch binary, wide array<long>, " + ", ".join(f"p{k} array<{'int' if k else 'long'}>" for k in range(ORDERS))
    return docs.mapInArrow(run, kinds)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in row_slices(batch, 1):
                sets = shingle_sets(text_bytes(part.column(1)), words)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["id", "shingles"]
                )

    return docs.mapInArrow(run, "id long, shingles array<long>")


class _Bucketed:
    """Rows of whole buckets in order of bucket and id, as arrays; ``first`` is the bucket's first row of each row."""

    def __init__(self, rows: pa.Table, percent: int):
        self.percent = percent
        self.ids, self.n, self.part, self.comp = (rows[c].to_numpy() for c in ("id", "n", "part", "component"))
        self.across = rows["one"].to_numpy() != rows["two"].to_numpy()
        self.at = rows["pos"].to_numpy()
        sketches = rows["sketch"].to_pylist()
        self.sketch = np.frombuffer(b"".join(sketches), np.uint64)
        self.width = np.fromiter((len(x) // 8 for x in sketches), np.int64, len(sketches))
        self.start = np.cumsum(self.width) - self.width
        self.bucket = _bucket_numbers(rows)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distance of the sketches of rows ``a`` and ``b``; ``FAR`` where they cannot link by this bucket."""
        n, m = self.n[a], self.n[b]
        least = _least_shared(n + m, self.percent)
        # If the bucket's shingle is the first that both hold, no earlier one is shared.
        ok = (least <= n - self.at[a]) & (least <= m - self.at[b])
        most, out = n + m - 2 * least, np.full(len(a), FAR)
        for k in range(0, len(a), 1 << 15):
            at = np.flatnonzero(ok[k : k + (1 << 15)]) + k
            width = np.minimum(self.width[a[at]], self.width[b[at]])
            for w in np.unique(width):
                of = at[width == w]
                bits = np.bitwise_count(self._folded(a[of], w) ^ self._folded(b[of], w)).sum(axis=1, dtype=np.int64)
                out[of] = np.where(bits <= most[of], bits, FAR)
        return out

    def _folded(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Sketches of ``rows`` in ``width`` words: cells of a wider one that fall together add up."""
        words = np.arange(width)
        out = self.sketch[self.start[rows][:, None] + words]
        for skip in range(width, int(self.width[rows].max(initial=0)), width):
            more = np.flatnonzero(self.width[rows] > skip)
            out[more] ^= self.sketch[(self.start[rows[more]] + skip)[:, None] + words]
        return out

    def to_leaders(self):
        """Each row with the first earlier row of its bucket that leads and is near."""
        open_ = np.arange(len(self.ids))
        while len(open_) > 1:
            groups, at = np.unique(self.bucket[open_], return_index=True)
            lead = open_[at][np.searchsorted(groups, self.bucket[open_])]
            rest = open_ != lead
            open_, lead = open_[rest], lead[rest]
            near = self.apart(lead, open_) < FAR
            yield lead[near], open_[near]
            open_ = open_[~near]

    def all_pairs(self):
        """Every near pair of a bucket whose components differ."""
        for a, b, _ in self._across():
            yield a, b

    def to_nearest(self):
        """Each row with the nearest row of its bucket in another component."""
        best, other = np.full(len(self.ids), FAR), np.zeros(len(self.ids), np.int64)
        for a, b, far in self._across():
            for x, y in ((a, b), (b, a)):  # no row comes twice on one side
                less = far < best[x]
                best[x[less]], other[x[less]] = far[less], y[less]
        at = np.flatnonzero(best < FAR)
        yield np.minimum(at, other[at]), np.maximum(at, other[at])

    def _across(self):
        low, high = np.full(self.bucket[-1] + 1, self.comp.max()), np.full(self.bucket[-1] + 1, self.comp.min())
        np.minimum.at(low, self.bucket, self.comp)
        np.maximum.at(high, self.bucket, self.comp)
        mixed = np.flatnonzero((low < high)[self.bucket])
        bucket = self.bucket[mixed]
        for by in range(1, len(mixed)):
            at = np.flatnonzero(bucket[by:] == bucket[:-by])
            if not len(at):
                return
            a, b = mixed[at], mixed[at + by]
            keep = (self.comp[a] != self.comp[b]) & (~self.across[a] | (self.part[a] != self.part[b]))
            a, b = a[keep], b[keep]
            far = self.apart(a, b)
            near = far < FAR
            yield a[near], b[near], far[near]


def _bucket_numbers(rows: pa.Table) -> np.ndarray:
    keys = [rows[c].to_numpy() for c in ("token", "one", "two")]
    new = np.zeros(len(rows), np.int64)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def _bucket_pairs(buckets: DataFrame, percent: int, pairing: str) -> DataFrame:
    """Near pairs ``a < b`` within buckets ``(token, one, two, part, id, n, pos, sketch, component)``.

    A bucket over ``BLOCK`` rows comes in several parts; a group holds one or
    two of them, so a hot bucket is spread over many tasks and a task holds a
    bounded number of its rows. ``pairing`` names the method of ``_Bucketed``: a
    row meets the first near row that leads, or of the near rows of other
    components the nearest or all.
    """

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if not len(rows):
                continue
            bucket = _bucket_numbers(rows)
            cut = int(np.searchsorted(bucket, bucket[-1]))
            held = rows.slice(cut)
            if cut:
                yield from pairs(rows.slice(0, cut))
        if held is not None:
            yield from pairs(held)

    def pairs(rows):
        rows = _Bucketed(rows, percent)
        for a, b in getattr(rows, pairing)():
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(rows.ids[a], pa.int64()), pa.array(rows.ids[b], pa.int64())], ["a", "b"])

    keys = ["token", "one", "two"]
    rows = buckets.select(*keys, "part", "id", "n", "pos", "sketch", "component").repartition(*keys).sortWithinPartitions(*keys, "id")
    return rows.mapInArrow(run, "a long, b long")


def _parted(postings: DataFrame, both: bool) -> DataFrame:
    """Give rows of buckets their part; with ``both`` copy each row into every pair of parts it belongs to."""
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = postings.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    if not both:
        return rows.withColumn("one", F.col("part")).withColumn("two", F.col("part"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda k: F.struct(F.least(k, F.col("part")).alias("one"), F.greatest(k, F.col("part")).alias("two")),
    )
    return rows.select("*", F.explode_outer(meets).alias("meet")).select("*", "meet.one", "meet.two").drop("meet")


def _open_buckets(postings: DataFrame, known: DataFrame) -> DataFrame:
    """Postings with the component of their set; buckets of many rows in one component go."""
    known = bounded_broadcast(known.withColumnRenamed("node", "id"), MAX_BROADCAST_IDS)
    labelled = postings.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    many = labelled.filter(F.col("size") > MANY).groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    done = scratch_table(many.filter("lo = hi").select("token"), "done")
    return labelled.join(bounded_broadcast(done, MAX_BROADCAST_IDS), "token", "left_anti")


def _buckets(profiles: DataFrame, percent: int) -> DataFrame:
    """``token, id, n, pos, size`` of prefix shingles that several sets share.

    Linked sets differ little in size, so a row goes unless the one before or
    after it in its bucket by size is near enough. ``size`` counts the whole bucket.
    """
    bucket = Window.partitionBy("token").orderBy("n")
    whole = bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tokens = profiles.select("id", "n", F.posexplode_outer("p0").alias("pos", "token"))
    rows = tokens.select(
        "*", F.count("*").over(whole).alias("size"), F.lag("n").over(bucket).alias("less"), F.lead("n").over(bucket).alias("more")
    )
    near = (100 * F.col("less") >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.col("more"))
    return rows.filter(near).select("token", "id", "n", "pos", "size")


def _sketches_near(percent: int) -> Column:
    """Whether the second sketches of sets ``a`` and ``b`` leave a link possible; true where one has none."""

    def folded(own: str, other: str) -> Column:
        half = (F.size(own) / 2).cast("int")
        low, high = F.slice(own, F.lit(1), half), F.slice(own, half + 1, half)
        return F.when(F.size(own) > F.size(other), F.zip_with(low, high, lambda x, y: x.bitwiseXOR(y))).otherwise(F.col(own))

    one, two = folded("wide_a", "wide_b"), folded("wide_b", "wide_a")
    bits = F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(bits, F.lit(0), lambda total, x: total + x)
    both = F.col("n_a") + F.col("n_b")
    most = both - 2 * F.ceil(percent * both / (100 + percent))
    several = (F.size("wide_a") > 0) & (F.size("wide_b") > 0) & (F.size(one) == F.size(two))
    return ~several | (apart <= most)


def _with_profiles(pairs: DataFrame, profiles: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs with ``columns`` of both their sets, as ``<column>_a`` and ``<column>_b``."""
    named = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    some = profiles.join(bounded_broadcast(scratch_table(named, "named"), MAX_BROADCAST_IDS), "id", "left_semi")
    for side in ("a", "b"):
        pairs = pairs.join(some.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
    return pairs


def _verified(pairs: DataFrame, profiles: DataFrame, docs: DataFrame, percent: int, words: int) -> DataFrame:
    """Pairs whose second sketches are near, that share prefix tokens under every further order and whose sets then are similar enough."""
    pairs = _with_profiles(pairs, profiles, ["n", "wide"]).filter(_sketches_near(percent))
    pairs = scratch_table(pairs.select("a", "b", "n_a", "n_b"), "sketched")
    orders = [f"p{k}" for k in range(1, ORDERS)]
    pairs = _with_profiles(pairs, profiles, orders)
    for p in orders:
        pairs = pairs.filter(F.arrays_overlap(f"{p}_a", f"{p}_b"))
    pairs = scratch_table(pairs.select("a", "b", "n_a", "n_b").distinct(), "candidates")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = bounded_broadcast(wanted, MAX_BROADCAST_IDS)
    # Dealt by id here, so neither join below deals the whole sets once more.
    sets = _sets(docs.join(wanted, "id", "left_semi"), words).dropDuplicates(["id"])
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("s"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("t"))
    shared = pairs.join(one, "a").join(two, "b").withColumn("o", F.size(F.array_intersect("s", "t")))
    near = shared.filter(100 * F.col("o") >= percent * (F.col("n_a") + F.col("n_b") - F.col("o")))
    links = scratch_table(near.select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
    drop_scratch(pairs)
    return links


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 90, words: int = WORDS
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document id (links: ``100 * shared >= percent * union``)."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    classes = rank_classes(count_sketch(docs, words))
    # A row number, fixed once written, tells repeated rows of one id apart: a set has one profile row.
    rows = scratch_table(_profiles(docs, classes, percent, words).withColumn("row", F.monotonically_increasing_id()), "profiles")
    sets_of = rows.filter("n > 0").select("id", "n", "low", "high", "row")
    groups = sets_of.groupBy("n", "low", "high").agg(F.min(F.struct("id", "row")).alias("first"))
    groups = scratch_table(groups.select("n", "low", "high", F.col("first.id").alias("rep"), F.col("first.row").alias("rep_row")), "groups")
    copies = sets_of.join(groups.drop("rep"), ["n", "low", "high"]).filter("row <> rep_row").select("row")
    copies = bounded_broadcast(scratch_table(copies, "copies"), MAX_BROADCAST_IDS)
    profiles = rows.filter("n > 0").join(copies, "row", "left_anti").drop("row")

    postings = _buckets(profiles, percent).join(profiles.select("id", "n", "sketch"), ["id", "n"])
    postings = scratch_table(postings, "postings")

    first = _bucket_pairs(_parted(postings, both=False).withColumn("component", F.col("id")), percent, "to_leaders")
    tried = scratch_table(first.distinct(), "leaders")
    links = _verified(tried, profiles, docs, percent, words)
    known = scratch_table(components(links), "known")
    many = postings.filter(F.col("size") > MANY)
    while True:
        pairs = _bucket_pairs(_parted(_open_buckets(many, known), both=True), percent, "to_nearest")
        pairs = scratch_table(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "nearest")
        if pairs.isEmpty():
            break
        found = _verified(pairs, profiles, docs, percent, words)
        tried = tried.union(pairs)
        if found.isEmpty():
            break
        links = links.union(found)
        known = scratch_table(components(links), "known")
    # The one pair of a bucket of two has been looked at.
    rest = _open_buckets(postings.filter("size > 2"), known)
    pairs = _bucket_pairs(_parted(rest, both=True), percent, "all_pairs").distinct().join(tried, ["a", "b"], "left_anti")
    more = _verified(scratch_table(pairs, "pairs"), profiles, docs, percent, words)
    drop_scratch(postings)

    found = components(links.union(more)).select(F.col("node").alias("rep"), F.col("component"))
    named = groups.join(found, "rep", "left").select("n", "low", "high", F.coalesce("component", "rep").alias("component_id"))
    return (
        rows.select("id", "n", "low", "high")
        .distinct()
        .join(named, ["n", "low", "high"], "left")
        .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
    )
