"""Connected components of a link table by alternating star steps (DataFrame joins only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import drop_scratch, scratch_table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.filter("v > u").join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``links(u, v)``; the component is its smallest node.

    Large-star and small-star steps in turn until nothing changes: every step
    is a grouped minimum (combined on the map side, so a node with very many
    links is no hot spot) and an equi-join, and each round is written to the
    shared scratch folder. Null ends and self links are left out; an empty
    table gives an empty result.
    """
    edges = scratch_table(
        links.filter("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        stars = scratch_table(_small_star(_large_star(edges)), "edges")
        state = stars.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("u", "v") % 1000003)).first()
        drop_scratch(edges)
        edges = stars
        if state[0] == 0 or state == seen:
            break
        seen = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
