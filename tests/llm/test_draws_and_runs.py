"""Resampling, host rules and periodic runs against brute force and SQL, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from cumulus.llm import host_rules, periodic, queries, resample

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Extra columns carry names that the operators use inside.
DOC = "doc_id long, text string, source string, host string, weight long, windows string, runs string, n_words long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, "w", "r", 2) for i, t, s in rows], DOC)


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["Élan", "ÉLAN", "naïve", "10", "x_y"]
    out = [(0, None, "a"), (1, "", "a"), (2, " \t\n", None), (None, "null id " * 12, "b"), (None, "null id " * 12, "b"), (3, "one", "b")]
    for i in range(4, 160):
        n = rnd.choice([3, 19, 20, 21, 60, 200])
        words = [rnd.choice(vocab) for _ in range(n)]
        if i % 3 == 0:
            words = words[: n // 2] + ["loop", "again"] * (n // 4)
        out.append((i, rnd.choice([" ", "\n", " \x0b", "\n\n"]).join(words), f"host{i % 7}"))
    out += [(500, "same row again " * 9, "hot")] * 40 + [(500, "same id, other text " * 8, "hot")] * 3
    out.append((600, " ".join(rnd.choice(vocab) for _ in range(30000)), "long"))
    return out


# 11 -- resampling


def brute_resample(rows, target, percent=10, cells=10000, least=20, seed=2024):
    def features(t):
        return LOWER_WORD.findall(ascii_lower(t or ""))

    def bucket(w):
        return zlib.crc32(w.encode()) % cells

    raw, aim = Counter(), Counter()
    for _, t, _ in rows:
        raw.update(map(bucket, features(t)))
    for t in target:
        aim.update(map(bucket, features(t)))
    s_all, t_all = sum(raw.values()), sum(aim.values())
    out = []
    for i, t, _ in rows:
        w = features(t)
        gains = [math.floor(1000 * math.log((aim[b] + 1) * (s_all + cells) / ((raw[b] + 1) * (t_all + cells)))) for b in map(bucket, w)]
        weight = sum(gains) // len(w) if w else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(w), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = [(*r, k + 1) for k, r in enumerate(fit[: len(fit) * percent // 100])]
    rest = Counter(out) - Counter(r[:4] for r in drawn)
    return Counter(drawn) + Counter({(*r, None): n for r, n in rest.items()})


@pytest.mark.parametrize("percent", [0, 1, 10, 20, 37, 100])
def test_resampling_is_the_whole_sort(spark, rows, percent):
    target = ["w1 w2 w3 w1 Élan", None, "w59 " * 30, "never seen"]
    aim = spark.createDataFrame([(str(k), t, "x") for k, t in enumerate(target)], "item_id string, text string, score string")
    got = Counter(tuple(r) for r in resample.resample(docs(spark, rows), aim, percent=percent).collect())
    assert got == brute_resample(rows, target, percent)


def test_resampling_edges(spark, rows):
    none = docs(spark, [])
    some = docs(spark, rows)
    assert resample.resample(none, some).count() == 0
    got = Counter(tuple(r) for r in resample.resample(some, none).collect())
    assert got == brute_resample(rows, [])
    # repeated rows at the cutoff: as many as are due, each with its own rank
    same = docs(spark, [(7, "word " * 25, "s")] * 100)
    ranks = sorted(r["rank"] for r in resample.resample(same, none, percent=25).collect() if r["rank"])
    assert ranks == list(range(1, 26))
    # longer runs are features too
    found = resample.importance_scores(docs(spark, [(1, "A b C", "s")]), resample.bucket_gains(*[resample.np.zeros(50, int)] * 2), longest=3)
    assert found.first().n_features == 6


# 12 -- host rules


def brute_measures(t):
    words = SPACE_WORD.findall(t or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in (t or "").split("\n") if SPACE_WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in t or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def test_host_rules_measure_whole_texts(spark, rows):
    more = rows + [(700, "a b c a b c a b", "s"), (701, "#x *y $z %p &q |r <s> é😀", "s"), (702, "l\nl\n\n \nm\nl", None), (703, "z " * 60, "s")]
    got = Counter(tuple(r[:6]) for r in host_rules.judge_documents(docs(spark, more)).collect())
    assert got == Counter((i, *brute_measures(t)) for i, t, _ in more)


def test_host_verdict_reaches_every_document(spark):
    rnd = random.Random(2)

    def good():
        return " ".join(f"word{rnd.randrange(10**6)}" for _ in range(80))

    rows = [(i, good(), f"good{i % 8}") for i in range(160)]
    rows += [(1000 + i, good() if i % 10 == 0 else "too short", "bad") for i in range(200)]  # nine in ten fail
    rows += [(2000, "too short", "tiny"), (2001, good(), "tiny"), (2002, good(), "tiny"), (2003, "short", None), (2004, good(), None)]
    kept = {r.doc_id: (r.base_failed, r.kept) for r in host_rules.judge_documents(docs(spark, rows)).collect()}
    assert all(kept[i] == (False, True) for i in range(160))
    assert all(not kept[1000 + i][1] and kept[1000 + i][0] == (i % 10 != 0) for i in range(200))
    assert kept[2000] == (True, False) and kept[2001] == (False, True)  # shrunk: one failure does not sink a tiny host
    assert kept[2003] == (True, False) and kept[2004] == (False, True)
    measured = host_rules.measures(docs(spark, rows))
    rates = {r.host: r for r in host_rules.host_verdicts(measured).collect()}
    assert set(rates) == {f"good{k}" for k in range(8)} | {"bad", "tiny"}
    assert 0 < rates["tiny"].rate_few_words < 1 / 3 + 0.2 and rates["bad"].rate_few_words > 0.8
    # the shrunk rate lies between the host's own and the mean of all hosts
    own = {h: (sum(len(t.split()) < 50 for _, t, s in rows if s == h) / sum(s == h for *_, s in rows)) for h in rates}
    mean = sum(own.values()) / len(own)
    assert all(min(own[h], mean) - 1e-9 <= rates[h].rate_few_words <= max(own[h], mean) + 1e-9 for h in rates)


def test_host_rules_edges(spark):
    assert host_rules.judge_documents(docs(spark, [])).count() == 0
    assert host_rules.host_verdicts(host_rules.measures(docs(spark, [(1, None, None)]))).count() == 0
    one = host_rules.judge_documents(docs(spark, [(1, None, "s"), (None, "x " * 60, None)])).collect()
    assert sorted(r.kept for r in one) == [False, False]


# 13 -- periodic runs


def brute_runs(w):
    """Every maximal stretch of every period, smallest period only."""
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted((s, length, q) for (s, length), q in out.items())


def test_runs_equal_brute_force():
    rnd = random.Random(1)
    texts = []
    for _ in range(1500):
        letters, t = rnd.choice([1, 2, 2, 3, 4]), []
        while len(t) < rnd.randint(0, 60):
            block = [rnd.randrange(letters) for _ in range(rnd.randint(1, 6))]
            t += block * rnd.randint(1, 7) if rnd.random() < 0.4 else block[:1]
        texts.append(t)
    assert periodic.find_runs(texts) == [brute_runs(t) for t in texts]


def test_runs_of_all_turns_with_small_blocks(monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK", 3)
    rnd = random.Random(4)
    texts = [[rnd.randrange(2) for _ in range(rnd.randint(0, 40))] for _ in range(200)]

    def squares(w):
        return {(i, q) for q in range(1, len(w) // 2 + 1) for i in range(len(w) - 2 * q + 1) if w[i : i + q] == w[i + q : i + 2 * q]}

    for t, runs in zip(texts, periodic.find_runs(texts, 2, 2)):
        told = {(i, k * q) for s, length, q in runs for k in range(1, length // q) for i in range(s, s + length - 2 * k * q + 1)}
        assert told == squares(t)


def test_long_periodic_texts_stay_fast():
    assert periodic.find_runs([[1] * 300_000]) == [[(0, 300_000, 1)]]
    word, other = "a", "ab"
    while len(other) < 60_000:
        word, other = other, other + word
    assert periodic.find_runs([list(other)]) == [[]]  # no stretch of four periods in this word
    half = list(range(5000))
    assert periodic.find_runs([half * 4 + [-1], half * 3]) == [[(0, 20_000, 5000)], []]


def brute_digest(i, t):
    w = SPACE_WORD.findall(t or "")
    n = len(w)
    h = zlib.crc32(str(i).encode())
    g = h // 10
    if i is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (k - a) % p] for k in range(a, n)]
    runs = brute_runs(w)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None,) * 3
    drop = {k for s, length, q in runs for k in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    text = " ".join(x for k, x in enumerate(w) if k not in drop)
    return (
        i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(),
    )


def test_periodic_query_equals_brute_force(spark, small_dir, rows):
    given = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in queries.op13_periodic_runs(spark, small_dir).collect())
    assert got == Counter(brute_digest(i, t) for i, t, _ in given)
    short = [r for r in rows if r[0] != 600]
    got = periodic.run_digest(periodic.periodic_runs(periodic.with_planted_runs(docs(spark, short)))).collect()
    assert Counter(map(tuple, got)) == Counter(brute_digest(i, t) for i, t, _ in short)
    assert periodic.run_digest(periodic.periodic_runs(periodic.with_planted_runs(docs(spark, [])))).count() == 0


def test_periodic_output_is_whole(spark):
    found = periodic.periodic_runs(docs(spark, [(1, "x " + "a b " * 5 + "y", "s"), (2, None, "s")])).orderBy("doc_id").collect()
    assert [tuple(r) for r in found[0].runs] == [(1, 10, 2)] and found[0].collapsed == "x a b y"
    assert found[1].runs == [] and found[1].collapsed == ""


# SQL


@pytest.mark.parametrize("name", ["op11_resampling", "op12_quality_rules"])
def test_sql_agrees(spark, small_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{small_dir}/{t}.parquet')")
    res = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in res.description]
    assert Counter(res.fetchall()) == Counter(tuple(r[c] for c in names) for r in queries.QUERIES[name](spark, small_dir).collect())


def test_native_plan(spark, rows):
    plan = host_rules.judge_documents(docs(spark, rows))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow", "CartesianProduct"))
