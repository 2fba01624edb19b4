"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

Logs hold the same conversation again and again as it grows. Every turn gets a
rolling hash of the turns up to it (a running sum over position-dependent turn
hashes, kept in four parts of 32 bits, so 128 bits in all). A conversation
whose last hash is an inner prefix hash of some longer one is a snapshot and
goes (anti join on distinct prefixes); of equal conversations the smallest id
stays. What is left is rendered.

Cases: null conversation ids are left out; repeated rows count once; turns of
equal number are ordered by role and text; null roles read ``unknown``, null
texts are empty; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cumulus.llm.common import scratch_table

START, END = "<|im_start|>", "<|im_end|>"
_KEY = ["at", "h0", "h1", "h2", "h3"]


def collapse_and_render(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, n_turns, rendered`` of every maximal conversation."""
    rows = (
        turns.select(
            F.col(id_col).alias("conv"),
            F.col(turn_col).cast("long").alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        )
        .filter("conv is not null")
        .distinct()
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("at", F.row_number().over(order))
    low = F.lit(0xFFFFFFFF).cast("long")
    one, two = F.xxhash64("at", "role", "text"), F.xxhash64("text", "at", "role", F.lit("second"))
    parts = {"h0": one.bitwiseAND(low), "h1": F.shiftrightunsigned(one, 32), "h2": two.bitwiseAND(low), "h3": F.shiftrightunsigned(two, 32)}
    upto = Window.partitionBy("conv").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hashed = rows.select("conv", "at", *[p.alias(c) for c, p in parts.items()])
    hashed = hashed.select("conv", "at", *[F.sum(c).over(upto).alias(c) for c in parts])
    hashed = hashed.withColumn("n", F.count("*").over(Window.partitionBy("conv")))
    hashed = scratch_table(hashed, "prefixes")

    inner = hashed.filter("at < n").select(*_KEY).distinct()
    whole = hashed.filter("at = n").groupBy(*_KEY).agg(F.min("conv").alias("conv"))
    maximal = scratch_table(whole.join(inner, _KEY, "left_anti").select("conv"), "maximal")

    line = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END + "\n"))
    kept = rows.join(maximal, "conv", "left_semi").select("conv", F.struct("at", line.alias("line")).alias("t"))
    return kept.groupBy(F.col("conv").alias("conv_id")).agg(
        F.count("*").alias("n_turns"),
        F.array_join(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["line"]), "").alias("rendered"),
    )


ORACLE = """
WITH r AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (
  SELECT conv_id, row_number() OVER w AS pos, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS line FROM r
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn ASC NULLS FIRST, role, text)),
p AS (
  SELECT conv_id, pos, count(*) OVER (PARTITION BY conv_id) AS n,
         string_agg(line, '') OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS upto FROM t),
whole AS (SELECT min(conv_id) AS conv_id, n, upto FROM p WHERE pos = n GROUP BY n, upto),
inner_ AS (SELECT DISTINCT pos, upto FROM p WHERE pos < n)
SELECT conv_id, n AS n_turns, upto AS rendered FROM whole ANTI JOIN inner_ ON inner_.pos = whole.n AND inner_.upto = whole.upto
"""
