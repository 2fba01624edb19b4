"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is ten consecutive words (a whole item if it has fewer). Of the seven
four-word hashes of a window the smallest is its fingerprint, so documents and
items that share a window share that fingerprint, wherever they were cut. The
distinct fingerprints of documents meet those of the benchmark in one join;
only documents with a hit are read again, and there every window whose
fingerprint hit is extended to its ten words and compared as text. Items under
ten words are windows of their own length with their own hash.

Cases: null or empty texts have no words; a document's row is keyed by its id
and its text, so a repeated row gives one result row and two texts under one
id give two; items without words are left out; null ids are kept as a key; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cumulus.llm.common import scratch_table
from cumulus.operators.joins import bounded_broadcast

WINDOW = 10
GRAM = 4
BROADCAST_ROWS = 500_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SEPARATORS = "".join(chr(c) for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122 or 65 <= c <= 90))


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text after lower-casing A-Z."""
    flat = F.translate(F.coalesce(text, F.lit("")), _UPPER + _SEPARATORS, _UPPER.lower() + " " * len(_SEPARATORS))
    return F.array_remove(F.split(flat, " "), "")


def _beside(col: str, by: int, f) -> Column:
    """Combine each element with the one ``by`` places on; past the end there is null."""
    return F.zip_with(col, F.slice(col, F.lit(by + 1), F.size(col)), f)


def _marks(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep, marks``: from column ``words``, the fingerprint of the window from each word on.

    Marks past the last whole window mix fewer hashes; they can only add
    candidates. Each step is a projection of its own, so no array is computed twice.
    """
    hashed = rows.select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("g"))
    for by in (1, 2):  # hashes of two, then of four words
        hashed = hashed.select(*keep, _beside("g", by, lambda a, b: F.xxhash64(a, b)).alias("g"))
    for by in (1, 2, WINDOW - GRAM - 3):  # least of two, four, then seven
        hashed = hashed.select(*keep, _beside("g", by, lambda a, b: F.least(a, b)).alias("g"))
    return hashed.withColumnRenamed("g", "marks")


def _short_marks(length: int) -> Column:
    """Hashes of all runs of ``length`` words of column ``words``."""
    n = F.size("words") - (length - 1)
    starts = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice("words", i, length), " ")))


def _folded(text: Column) -> Column:
    """A text with every letter in lower case, whatever stands around it: equal words stay equal."""
    return F.lower(F.replace(text, F.lit("\u03a3"), F.lit("\u03c3")))


def _windows(rows: DataFrame, keys: list[str], length: int) -> DataFrame:
    """``keys, start, length, window`` of every window of ``length`` words."""
    n = F.size("words") - (length - 1)
    starts = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    parts = F.transform(
        starts, lambda i: F.struct(i.alias("start"), F.array_join(F.slice("words", i, length), " ").alias("window"))
    )
    return (
        rows.select(*keys, F.explode_outer(parts).alias("w"))
        .filter("w is not null")
        .select(*keys, "w.start", F.lit(length).alias("length"), "w.window")
    )


def text_key(text: Column) -> Column:
    """What tells texts under one id apart."""
    return F.xxhash64(text.cast("string"))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    max_broadcast_rows: int = BROADCAST_ROWS,
    with_hash: bool = False,
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document.

    ``with_hash`` adds ``text_hash``, the other half of a document's key (``text_key`` of its text).
    """
    keys = ["doc_id", "text_hash"]
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.select("doc_id", text_key(F.col("text")).alias("text_hash"), "text")
    items = benchmark.select(F.col(item_col).alias("item"), words(F.col(item_text_col).cast("string")).alias("words"))
    items = items.filter(F.size("words") > 0)
    # Lengths of items under ten words: nine values at most.
    short = sorted(r[0] for r in items.select(F.size("words").alias("n")).filter(F.col("n") < WINDOW).distinct().collect())
    lengths = [WINDOW, *short]
    tested = _windows(items, ["item"], WINDOW)
    for n in short:
        tested = tested.union(_windows(items.filter(F.size("words") == n), ["item"], n))
    tested = scratch_table(tested.select("item", "length", "window").distinct(), "windows")

    # Candidates: documents of which some fingerprint is a fingerprint of the benchmark.
    # Both sides are marked over words folded alike.
    whole = tested.filter(F.col("length") == WINDOW).select(F.split(_folded(F.col("window")), " ").alias("words"))
    known = _marks(whole, []).select(F.element_at("marks", 1).alias("known"))
    for n in short:
        known = known.union(tested.filter(F.col("length") == n).select(F.xxhash64(_folded(F.col("window"))).alias("known")))
    known = bounded_broadcast(known.distinct(), max_broadcast_rows)
    loose = F.array_remove(F.split(_folded(F.coalesce(F.col("text"), F.lit(""))), _SPLIT), "")
    folded = docs.select(*keys, loose.alias("words")).select(*keys, "words", F.size("words").alias("n"))
    own = [F.col("marks"), *[_short_marks(n) for n in short]]
    marked = _marks(folded, [*keys, "n", *(["words"] if short else [])])
    marked = marked.select(*keys, "n", F.array_distinct(F.concat(*own) if short else own[0]).alias("marks"))
    found = (
        marked.select(*keys, "n", F.explode_outer("marks").alias("mark"))
        .join(known, F.col("mark") == F.col("known"), "left")
        .groupBy(*keys)
        .agg(F.max("n").alias("n"), F.count("known").alias("marks"))
    )
    found = scratch_table(found, "marked")

    # Extend: in candidates, windows count where they are windows of the benchmark, word for word.
    hit = found.filter("marks > 0").select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
    suspects = docs.join(
        bounded_broadcast(hit, max_broadcast_rows),
        F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")),
        "left_semi",
    ).select(*keys, words(F.col("text")).alias("words"))
    distinct = bounded_broadcast(tested.select("length", "window").distinct(), max_broadcast_rows)
    spans = None
    for n in lengths:
        these = _windows(suspects, keys, n).join(distinct, ["length", "window"], "left_semi").select(*keys, "start", "length", "window")
        spans = these if spans is None else spans.union(these)
    spans = scratch_table(spans.distinct(), "spans")

    # Words under a hit: the union of the spans [start, start + length).
    before = Window.partitionBy(*keys).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    covered = (
        spans.select(*keys, "start", "length", end.alias("end"))
        .withColumn("reached", F.coalesce(F.max("end").over(before), F.lit(0)))
        .groupBy(*keys)
        .agg(F.sum(F.greatest(F.col("end") - F.greatest("start", "reached"), F.lit(0))).alias("n_hit"))
    )
    named = (
        spans.select(*keys, "length", "window")
        .distinct()
        .join(tested, ["length", "window"])
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    )
    hits = covered.join(named, (covered.doc_id.eqNullSafe(named.doc_id)) & (covered.text_hash == named.text_hash)).select(
        covered.doc_id.alias("hit_id"), covered.text_hash.alias("hit_hash"), "n_hit", "items"
    )
    items_col = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return found.join(
        hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left"
    ).select(
        "doc_id",
        *(["text_hash"] if with_hash else []),
        F.col("n").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_col).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_col, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM iw),
starts AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d JOIN lengths ON len(w) >= n),
hit AS (
  SELECT doc_id, s, starts.n AS n, iw.item_id
  FROM starts JOIN iw ON iw.n = starts.n AND iw.win = array_to_string(w[s : s + starts.n - 1], ' ')),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hit)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""
