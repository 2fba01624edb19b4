"""Host-level quality rules, in DataFrame functions only.

Every document is measured whole (words, symbols, repeated lines, words in
repeated three-word windows) and held against ``RULES``. Failures are summed by
host and rule. A host's rate is shrunk: the rates of all hosts give a beta
prior for each rule (moments, less what sampling alone would spread), so a
host with few documents stays near the common rate. A host whose shrunk rate
of any rule is above ``HOST_LIMIT`` is rejected; its verdict is joined back to
its documents. The measures are written once, in a narrow table, and read by
both the sums and the join.

Repeated windows are found by sorting 64-bit window hashes within the row, so
nothing of a text is shuffled and a hot host costs one partial sum a task.

Cases: null texts have no words and fail the word rule; empty lines are no
lines; documents with a null host are judged by themselves; with one host, or
hosts of one rate, the prior is as strong as ``PRIOR_LIMIT`` documents and
every host has the common rate; repeated rows count and return each for
itself; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import scratch_table
from cumulus.operators.joins import bounded_broadcast

LEAST_WORDS = 50
REPEAT_PERCENT = 50
HOST_LIMIT = 0.5  # shrunk rate of failures above which a host is rejected
PRIOR_LIMIT = 1_000_000.0  # documents that the prior weighs at most
MAX_BROADCAST_HOSTS = 500_000

# Fixed values of the measures: white space and symbol characters.
SPACE, NO_SPACE = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
SYMBOL = "[#*$%&|<>]"

# Rules are SQL conditions over the measures; a document for which one holds fails it.
BASE_RULES = {"few_words": f"n_words < {LEAST_WORDS}", "repeated_windows": f"100 * n_repeat_words > {REPEAT_PERCENT} * n_words"}
RULES = BASE_RULES | {
    "symbols": "10 * n_symbols > n_words",  # more than one to ten words
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 10 * n_words",
}


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` of every document."""
    # Each step is one projection: an array that the next step's lambdas index must be a column, not an expression.
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"),
    )
    rows = rows.select(
        "doc_id",
        "host",
        F.regexp_count("body", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.filter(F.split("body", "\n"), lambda line: line.rlike(NO_SPACE)).alias("body_lines"),
        F.array_remove(F.split("body", SPACE), "").alias("body_words"),
    )
    word = F.col("body_words")
    window = F.transform(F.sequence(F.lit(0), F.size(word) - 3), lambda i: F.xxhash64(word[i], word[i + 1], word[i + 2]))
    rows = rows.select(
        "doc_id",
        "host",
        F.size(word).cast("long").alias("n_words"),
        F.length(F.array_join(word, "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("body_lines").cast("long").alias("n_lines"),
        (F.size("body_lines") - F.size(F.array_distinct("body_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(word) >= 3, window).otherwise(F.array().cast("array<long>")).alias("windows"),
    )
    # Only texts with a repeated window are sorted.
    placed = F.sort_array(F.transform("windows", lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
    rows = rows.withColumn("windows", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed))
    pairs = F.arrays_zip(F.col("windows").alias("one"), F.slice("windows", 2, F.size("windows")).alias("two"))
    twice = F.filter(pairs, lambda x: x["one"]["h"] == x["two"]["h"])
    twice = F.flatten(F.transform(twice, lambda x: F.array(x["one"]["at"], x["two"]["at"])))
    rows = rows.withColumn("windows", F.when(F.size("windows") > 0, F.sort_array(F.array_distinct(twice))))
    # A window covers three words, or those up to the next repeated window.
    covered = F.transform("windows", lambda at, k: F.least(F.lit(3), F.coalesce(F.get("windows", k + 1) - at, F.lit(3))))
    total = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0))
    return rows.withColumn("n_repeat_words", total.cast("long")).drop("windows")


def host_verdicts(measured: DataFrame, rules: dict[str, str] | None = None, limit: float = HOST_LIMIT) -> DataFrame:
    """``host, n, rate_<rule>..., host_kept`` of every host: shrunk rates of rule failures and the verdict."""
    rules = rules or RULES
    hosts = measured.filter("host is not null").groupBy("host").agg(
        F.count("*").alias("n"), *[F.count_if(F.expr(rule)).alias(f"fail_{name}") for name, rule in rules.items()]
    )
    hosts = scratch_table(hosts, "hosts")
    rate = {name: F.col(f"fail_{name}") / F.col("n") for name in rules}
    moments = hosts.agg(
        F.avg(1 / F.col("n")).alias("inverse"),
        *[f(r).alias(f"{word}_{name}") for name, r in rate.items() for word, f in (("mean", F.avg), ("var", F.var_pop))],
    ).first()
    shrunk = {}
    for name in rules:
        mean, spread = moments[f"mean_{name}"] or 0.0, moments[f"var_{name}"] or 0.0
        alone = mean * (1 - mean)
        between = spread - alone * (moments["inverse"] or 0.0)
        weight = PRIOR_LIMIT if between <= 0 else min(max(alone / between - 1, 0.0), PRIOR_LIMIT)
        shrunk[name] = (mean * weight + F.col(f"fail_{name}")) / (weight + F.col("n"))
    rates = hosts.select("host", "n", *[r.alias(f"rate_{name}") for name, r in shrunk.items()])
    return rates.withColumn("host_kept", F.greatest(*[F.col(f"rate_{name}") for name in rules], F.lit(0.0)) <= limit)


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` of every document."""
    measured = scratch_table(measures(docs, id_col, text_col, host_col), "measures")
    rejected = host_verdicts(measured).filter("not host_kept").select(F.col("host").alias("rejected_host"))
    joined = measured.join(bounded_broadcast(rejected, MAX_BROADCAST_HOSTS), F.col("host") == F.col("rejected_host"), "left")
    failed = F.expr(" or ".join(f"({rule})" for rule in BASE_RULES.values()))
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("rejected_host").isNull()).alias("kept"),
    )


ORACLE = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
win AS MATERIALIZED (
  SELECT r, s, ws[s] || ' ' || ws[s + 1] || ' ' || ws[s + 2] AS w FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS s FROM d)),
twice AS (SELECT r, w FROM win GROUP BY r, w HAVING count(*) > 1),
rep AS (
  SELECT r, count(DISTINCT p) AS n_rep FROM (SELECT r, unnest(range(s, s + 3)) AS p FROM win JOIN twice USING (r, w)) GROUP BY r),
m AS MATERIALIZED (
  SELECT r, doc_id, source, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(ls) AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_rep, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (r)),
f AS (
  SELECT *, unnest([{'rule': 1, 'bad': n_words < 50}, {'rule': 2, 'bad': 100 * n_repeat_words > 50 * n_words}, {'rule': 3, 'bad': 10 * n_symbols > n_words},
    {'rule': 4, 'bad': 10 * n_dup_lines > 3 * n_lines}, {'rule': 5, 'bad': word_chars < 3 * n_words}, {'rule': 6, 'bad': word_chars > 10 * n_words}]) AS x
  FROM m WHERE source IS NOT NULL),
h AS (SELECT source, x.rule AS rule, count(*) AS n, count(*) FILTER (x.bad) AS bad FROM f GROUP BY ALL),
mo AS (SELECT rule, avg(bad / n) AS mean, var_pop(bad / n) - avg(bad / n) * (1 - avg(bad / n)) * avg(1 / n) AS between_ FROM h GROUP BY rule),
k AS (SELECT rule, mean, CASE WHEN between_ <= 0 THEN 1e6 ELSE least(greatest(mean * (1 - mean) / between_ - 1, 0), 1e6) END AS weight FROM mo),
gone AS (SELECT DISTINCT source FROM h JOIN k USING (rule) WHERE (mean * weight + bad) / (weight + n) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND gone.source IS NULL AS kept
FROM m LEFT JOIN gone USING (source)
"""
