"""Embedding near-duplicates by a subspace pigeonhole join.

Vectors are scaled to length one and rotated (random signs, then a
Walsh-Hadamard transform). Two vectors of cosine ``c`` are at squared distance
``2 - 2 c``; cut into blocks, some block must hold at most its share of that
budget. Each block is range-joined on a grid over its first two coordinates
(cells twice as wide as the block's radius, each row sent to those of half of
the neighbouring cells that its radius reaches) and, within a cell, on windows
of its third coordinate. A pair is taken up by the first block whose budget it
keeps, and its cosine is then computed from the given components in double
precision. Rows of a cell are dealt over several tasks when there are many.

Equal vectors of one label are one point with a count, so copies cost nothing;
links of a point are counted with the copies on the other side. A task returns
counts and a spanning set of links, never all pairs of a group.

Cases: null label, null vector, zero vector, null or non-finite components:
linked with nothing, kept. Vectors of unlike dimension link with nothing.
Repeated ids give one row each time they occur; null ids are left out; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import scratch_table
from cumulus.llm.components import components

BLOCKS = 8
PART = 2000  # rows of a cell that meet in one task, from either side
PAIRS = 1 << 15  # pairs whose whole vectors are compared at once
_NEXT = [(0, 1), (1, -1), (1, 0), (1, 1)]  # half of the neighbouring cells


def rotate(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors under random signs and a Walsh-Hadamard transform, padded to a power of two.

    Only element-wise steps in a fixed order, so a vector's coordinates are the
    same bits in whatever batch it comes.
    """
    size = 1 << max(3, (vectors.shape[1] - 1).bit_length())
    out = np.zeros((len(vectors), size))
    out[:, : vectors.shape[1]] = vectors
    norm = np.zeros(len(vectors))
    for k in range(vectors.shape[1]):
        norm += out[:, k] * out[:, k]
    out /= np.sqrt(norm)[:, None]
    out *= np.random.default_rng(7).choice([-1.0, 1.0], size) / np.sqrt(size)
    h = 1
    while h < size:
        pairs = out.reshape(len(out), size // (2 * h), 2, h)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(len(out), size)
        h *= 2
    return out


def _block_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    total = np.zeros(np.broadcast_shapes(x.shape, y.shape)[:-1])
    for k in range(x.shape[-1]):
        d = x[..., k] - y[..., k]
        total += d * d
    return total


def _matrix(col: pa.ChunkedArray, dim: int) -> np.ndarray:
    return col.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links join two parts not joined before."""
    parent: dict[int, int] = {}

    def top(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    keep = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = top(x), top(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            keep[k] = True
    return keep


def _radius(budget: float) -> float:
    """The most by which a coordinate of a block differs within its share of the budget, and a hair for rounding."""
    return np.sqrt(budget / BLOCKS) * (1 + 1e-6) + 1e-9


def _cells(points: DataFrame, budget: float) -> DataFrame:
    """``label, dim, block, cx, cy, home`` rows: each point in its own cell and in the later neighbours it reaches, for every block."""
    radius = _radius(budget)
    width = 2 * radius

    def run(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for dim in np.unique(rows["dim"].to_numpy()).tolist():
                mine = rows.filter(pa.compute.equal(rows["dim"], dim))
                for k in range(0, len(mine), 2048):
                    part = mine.slice(k, 2048)
                    turned = rotate(_matrix(part["v"], dim))
                    size = turned.shape[1] // BLOCKS
                    for block in range(BLOCKS):
                        x = turned[:, block * size]
                        y = turned[:, block * size + 1] if size > 1 else np.zeros_like(x)
                        cx, cy = np.floor(x / width), np.floor(y / width)
                        for dx, dy in [(0, 0), *_NEXT]:
                            reached = (np.floor((x + dx * radius) / width) == cx + dx) & (np.floor((y + dy * radius) / width) == cy + dy)
                            at = np.flatnonzero(reached)
                            made = part.take(pa.array(at)).append_column("block", pa.array(np.full(len(at), block), pa.int32()))
                            made = made.append_column("cx", pa.array((cx[at] + dx).astype(np.int64)))
                            made = made.append_column("cy", pa.array((cy[at] + dy).astype(np.int64)))
                            made = made.append_column("home", pa.array([(dx, dy) == (0, 0)] * len(at), pa.bool_()))
                            yield from made.to_batches()

    return points.mapInArrow(run, "id long, label long, copies long, dim int, v array<float>, block int, cx long, cy long, home boolean")


def _cell_links(cells: DataFrame, budget: float, cosine: float) -> DataFrame:
    """``u, v, n``: links of points as counts (``v`` null) and spanning links (``n`` null)."""

    def run(key, rows):
        label, dim, block = (k.as_py() for k in key[:3])
        rows = rows.sort_by([("home", "descending"), ("id", "ascending")])
        ids, copies, home = rows["id"].to_numpy(), rows["copies"].to_numpy(), rows["home"].to_numpy(zero_copy_only=False)
        v = _matrix(rows["v"], dim)
        turned = rotate(v)
        size = turned.shape[1] // BLOCKS
        share = budget / BLOCKS * (1 + 1e-9) + 1e-12
        own = turned[:, block * size : (block + 1) * size]
        piece = rows["one"].to_numpy()
        first, second = key[5].as_py(), key[6].as_py()
        count = np.zeros(len(ids), np.int64)
        left, right = [], []

        def linked(i, j):
            """Which pairs this block is the first to take up, and are similar enough."""
            ok = _block_distance(own[i], own[j]) <= share
            for earlier in range(block):
                span = slice(earlier * size, (earlier + 1) * size)
                at = np.flatnonzero(ok)
                ok[at] = _block_distance(turned[i[at], span], turned[j[at], span]) > share
            at = np.flatnonzero(ok)
            ok[at] = _cosines(v[i[at]], v[j[at]]) >= cosine
            return ok

        # Home rows of the first piece against home rows of the second and against visitors.
        third, squares = own[:, min(2, size - 1)], (own * own).sum(axis=1)
        ones, twos = np.flatnonzero(home & (piece == first)), np.flatnonzero(piece == second)
        ones, twos = ones[np.argsort(third[ones], kind="stable")], twos[np.argsort(third[twos], kind="stable")]
        radius = _radius(budget)
        for k in range(0, len(ones), 128):
            mine = ones[k : k + 128]
            lo = np.searchsorted(third[twos], third[mine[0]] - radius)
            hi = np.searchsorted(third[twos], third[mine[-1]] + radius, "right")
            theirs = twos[lo:hi]
            rough = squares[mine][:, None] + squares[theirs] - 2 * (own[mine] @ own[theirs].T)
            i, j = np.nonzero(rough <= share + 1e-9)  # a matrix product rounds otherwise; exact below
            i, j = mine[i], theirs[j]
            ok = (ids[i] != ids[j]) & (~home[j] | (i < j) | (first != second))
            i, j = i[ok], j[ok]
            near = [linked(i[at : at + PAIRS], j[at : at + PAIRS]) for at in range(0, len(i), PAIRS)]
            if near:
                near = np.concatenate(near)
                i, j = i[near], j[near]
            np.add.at(count, i, copies[j])
            np.add.at(count, j, copies[i])
            span = _forest(ids[i], ids[j])
            left.append(ids[i[span]])
            right.append(ids[j[span]])
        a = np.concatenate(left) if left else ids[:0]
        b = np.concatenate(right) if right else ids[:0]
        span = _forest(a, b)
        some = np.flatnonzero(count)
        u = np.concatenate((a[span], ids[some]))
        w = pa.array(np.concatenate((b[span], ids[some])), pa.int64(), mask=np.arange(len(u)) >= span.sum())
        n = pa.array(np.concatenate((np.zeros(span.sum(), np.int64), count[some])), pa.int64(), mask=np.arange(len(u)) < span.sum())
        return pa.table({"u": pa.array(u, pa.int64()), "v": w, "n": n})

    return cells.groupBy("label", "dim", "block", "cx", "cy", "first", "second").applyInArrow(run, "u long, v long, n long")


def _dealt(cells: DataFrame) -> DataFrame:
    """Cells over ``PART`` rows in pieces: each group meets home rows of one piece with all rows of another."""
    keys = ["label", "dim", "block", "cx", "cy"]
    sizes = cells.groupBy(*keys).agg(F.count("*").alias("size"), F.sum(F.col("home").cast("int")).alias("homes"))
    rows = cells.join(sizes.filter("homes > 0 and size > 1"), keys)
    pieces = F.ceil(F.col("size") / PART).cast("int")
    rows = rows.withColumn("pieces", pieces).withColumn("one", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
    every = F.sequence(F.lit(0), F.col("pieces") - 1)
    pair = lambda a, b: F.struct(a.alias("first"), b.alias("second"))
    # As home row of the first piece it meets every second piece of visitors, and of home rows the later ones.
    homes = F.transform(every, lambda k: pair(F.col("one"), k))
    others = F.transform(every, lambda k: pair(k, F.col("one")))
    visits = F.when(F.col("home"), F.array_distinct(F.concat(homes, F.filter(others, lambda p: p["first"] <= p["second"])))).otherwise(others)
    return rows.select("*", F.explode_outer(visits).alias("visit")).select("*", "visit.first", "visit.second").drop("visit")


def embedding_links(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.93
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector (links: equal label, cosine at least ``cosine``)."""
    budget = 2.0 - 2.0 * cosine + 1e-9
    rows = table.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<float>").alias("v")
    ).filter("id is not null")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = rows.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))
    points = usable.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    points = scratch_table(points.withColumn("dim", F.size("v").cast("int")), "points")

    cells = _cells(points.select("id", "label", "copies", "dim", "v"), budget)
    found = scratch_table(_cell_links(_dealt(cells), budget, cosine), "links")
    counts = found.filter("v is null").groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("n"))
    groups = components(found.filter("v is not null").select("u", "v"))
    named = (
        points.join(counts, "id", "left")
        .join(groups.withColumnRenamed("node", "id"), "id", "left")
        .select(
            F.col("label").alias("p_label"),
            F.col("v").alias("p_v"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    joined = rows.join(named, (F.col("label") == F.col("p_label")) & (F.col("v") == F.col("p_v")), "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )


# Cosines in SQL are compared after the same double-precision sums.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS id, vec_id AS to_id FROM embeddings
  UNION
  SELECT reach.id, l.b FROM reach JOIN l ON l.a = reach.to_id)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, r.m::BIGINT AS component_id, e.vec_id = r.m AS kept
FROM embeddings e JOIN (SELECT id, min(to_id) AS m FROM reach GROUP BY id) r ON r.id = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) c ON c.a = e.vec_id
"""
