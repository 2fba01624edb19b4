"""Secret scans: patterns, and a linear-chain conditional random field over tokens.

Tokens are runs of word bytes and runs of other printable bytes. Each gets the
tag secret begin, secret inside or outside; features are its own shape, the
shapes of its neighbours, a key word shortly before it, and two of the text.
Weights and transitions are fitted by likelihood (forward-backward) on windows
around pattern hits and on other windows of a bounded sample of texts, up to
half of them drawn from all texts with a hit. Texts are decoded by Viterbi. A text in which no token's tag score beats outside by
more than entering and leaving a secret costs keeps every token outside on its
best path, so only the others walk the full search.

Pattern spans stay; the parts of tag spans outside them are added with kind ``crf``.

Cases: null and empty texts have no spans; offsets count code points; repeated
rows give repeated rows; other columns are ignored; an empty table gives an
empty result; with no pattern hit in any text there is no field and no span.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import SpanHasher, drop_scratch, joined, row_slices, scratch_table, text_bytes

SAMPLE = 3000  # distinct texts (smallest hashes) the field is fitted on
SHORTEST = 8  # bytes of a tagged span, as of the shortest pattern value it is trained on
HIT_WINDOWS = 16  # training windows around hits of one text
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(rb"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
KEY_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey", b"key", b"pwd", b"auth", b"bearer")
_HINTS = (b"passw", b"secret", b"token", b"api_key", b"apikey")
BEGIN, INSIDE, OUTSIDE = 0, 1, 2


def _hinted(text: bytes) -> bool:
    """Whether a text holds one of the words that an assignment starts with."""
    lower = text.lower()
    return any(h in lower for h in _HINTS)


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """Pattern spans ``(start, end, kind)`` in bytes, leftmost and not overlapping within a kind."""
    found = []
    if _hinted(text):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if b"AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def _classes() -> np.ndarray:
    table = np.full(256, 2, np.uint8)  # 0 space, 1 word, 2 other
    table[[32, *range(9, 14)]] = 0
    for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
        table[lo:hi] = 1
    table[[43, 45, 47, 95]] = 1  # + - / _
    return table


_CLASS = _classes()
_N_SHAPES = 6 * 5 * 4 * 3 * 3  # length, digits, changes, upper, lower
_N_FEATURES = 3 * _N_SHAPES + 2 + 2 + 4
WINDOW = 25  # tokens of a training window


def tokens(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and classes of the tokens of a text."""
    cls = _CLASS[text]
    edge = np.flatnonzero(np.diff(cls)) + 1
    start = np.concatenate(([0], edge)) if len(text) else edge
    end = np.concatenate((edge, [len(text)])) if len(text) else edge
    kind = cls[start] if len(start) else cls
    keep = kind > 0
    return start[keep], end[keep], kind[keep]


def _share(count: np.ndarray, n: np.ndarray, cuts: int) -> np.ndarray:
    return np.minimum(np.ceil(cuts * count / np.maximum(n, 1)), cuts).astype(np.int64)


class Tokens:
    """Tokens of some texts in one buffer, with their feature numbers (one row each)."""

    def __init__(self, texts: list[bytes]):
        self.buf, self.starts = joined(texts)
        buf = self.buf
        self.start, self.end, _ = tokens(buf)
        self.bounds = np.searchsorted(self.start, self.starts)
        own = np.repeat(np.arange(len(texts)), np.diff(self.bounds))
        n = self.end - self.start
        is_digit = (buf >= 48) & (buf <= 57)
        digit, change = _total(is_digit), _total(np.concatenate(([False], is_digit[1:] != is_digit[:-1])) if len(buf) else is_digit)
        upper, lower = _total((buf >= 65) & (buf <= 90)), _total((buf >= 97) & (buf <= 122))
        turns = np.maximum(change[self.end] - change[np.minimum(self.start + 1, self.end)], 0)
        shape = np.searchsorted([4, 8, 16, 24, 32], n, "right")
        for part, size in (
            (_share(digit[self.end] - digit[self.start], n, 4), 5),
            (np.searchsorted([1, 3, 7], turns, "right"), 4),
            (_share(upper[self.end] - upper[self.start], n, 2), 3),
            (_share(lower[self.end] - lower[self.start], n, 2), 3),
        ):
            shape = shape * size + part
        before, after = np.zeros_like(shape), np.zeros_like(shape)
        same = own[1:] == own[:-1]
        before[1:] = np.where(same, shape[:-1], 0)
        after[:-1] = np.where(same, shape[1:], 0)
        is_key = np.isin(SpanHasher(buf)(self.start, self.end), _key_hashes())
        key = np.zeros_like(shape)
        for by in range(1, 5):  # a key word up to four tokens before
            key[by:] |= is_key[:-by] & (own[by:] == own[:-by])
        quoted = np.isin(buf[np.maximum(self.start - 1, 0)], (34, 39, 58, 61)) if len(buf) else np.zeros(0, bool)
        hint = np.array([_hinted(t) for t in texts], np.int64)
        size = np.maximum(np.diff(self.starts), 1)
        rich = (digit[self.starts[1:]] - digit[self.starts[:-1]]) > 0.03 * size
        whole = (hint + 2 * rich)[own]
        at = 3 * _N_SHAPES
        self.features = np.stack(
            (shape, _N_SHAPES + before, 2 * _N_SHAPES + after, at + key, at + 2 + quoted.astype(np.int64), at + 4 + whole), axis=1
        ).astype(np.int32)


def _total(mask: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))


@lru_cache(maxsize=1)
def _key_hashes() -> np.ndarray:
    buf, starts = joined(list(KEY_WORDS))
    return SpanHasher(buf)(starts[:-1], starts[1:] - 1)


@dataclass
class Field:
    weights: np.ndarray  # features x tags
    moves: np.ndarray  # tag x next tag

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = self.weights[features[:, 0]]
        for k in range(1, features.shape[1]):
            out = out + self.weights[features[:, k]]
        return out

    def silent(self, scores: np.ndarray) -> np.ndarray:
        """Tokens that cannot lift a path above the one that stays outside."""
        # Against staying outside, a stretch of tags gains at most the sum of its tokens' gains plus
        # what entering and leaving cost less (at a text's edge one of them, or both, fall away).
        m, stay = self.moves, self.moves[OUTSIDE, OUTSIDE]
        enter, leave = m[OUTSIDE, :2].max() - stay, m[:2, OUTSIDE].max() - stay
        inner = max(m[:2, :2].max() - stay, 0.0)
        gain = np.maximum(scores[:, BEGIN], scores[:, INSIDE]) - scores[:, OUTSIDE]
        return gain + inner + max(enter + leave, enter, leave, 0.0) < 0

    def decode(self, scores: np.ndarray) -> list[int]:
        """Viterbi: the best tags of one text."""
        m = self.moves.tolist()
        best, back = scores[0].tolist(), []
        for row in scores[1:].tolist():
            came, now = [], []
            for tag in range(3):
                options = (best[0] + m[0][tag], best[1] + m[1][tag], best[2] + m[2][tag])
                top = max(options)
                came.append(options.index(top))
                now.append(top + row[tag])
            back.append(came)
            best = now
        tag = best.index(max(best))
        path = [tag]
        for came in reversed(back):
            tag = came[tag]
            path.append(tag)
        return path[::-1]


def fit_field(features: np.ndarray, tags: np.ndarray, rounds: int = 60, rate: float = 0.2, ridge: float = 1e-4) -> Field:
    """Likelihood fit on windows: ``features`` is windows x tokens x features, ``tags`` windows x tokens (-1 pads)."""
    n, length, _ = features.shape
    real = tags >= 0
    gold = np.where(real, tags, OUTSIDE)
    w, moves = np.zeros((_N_FEATURES, 3)), np.zeros((3, 3))
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, moves)]
    flat = features.reshape(-1)
    per = features.shape[2]
    both = real[:, 1:] & real[:, :-1]
    for step in range(1, rounds + 1):
        score = w[features].sum(axis=2)
        alpha, beta = np.zeros((n, length, 3)), np.zeros((n, length, 3))
        alpha[:, 0] = score[:, 0]
        for t in range(1, length):
            nxt = _log_sum(alpha[:, t - 1, :, None] + moves[None], 1) + score[:, t]
            alpha[:, t] = np.where(real[:, t, None], nxt, alpha[:, t - 1])
        for t in range(length - 2, -1, -1):
            nxt = _log_sum(moves[None] + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(real[:, t + 1, None], nxt, 0)
        total = _log_sum(alpha[:, -1], 1)
        node = np.exp(alpha + beta - total[:, None, None]) * real[:, :, None]
        node[np.arange(n)[:, None], np.arange(length)[None], gold] -= real
        node /= n
        g_w = np.stack([np.bincount(flat, np.repeat(node[:, :, tag].reshape(-1), per), _N_FEATURES) for tag in range(3)], axis=1)
        pair = alpha[:, :-1, :, None] + moves[None, None] + (score + beta)[:, 1:, None, :] - total[:, None, None, None]
        g_m = (np.exp(np.minimum(pair, 0)) * both[:, :, None, None]).sum(axis=(0, 1))
        np.subtract.at(g_m, (gold[:, :-1][both], gold[:, 1:][both]), 1)
        g_m /= n
        for x, g, (m, v) in zip((w, moves), (g_w + ridge * w, g_m + ridge * moves), state, strict=True):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(w, moves)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _training_windows(texts: list[bytes]) -> list[tuple[bytes, bytes]]:
    """Feature and tag bytes of windows: around every pattern hit, and one other a text."""
    rows = Tokens(texts)
    out = []
    for r, text in enumerate(texts):
        lo, hi = int(rows.bounds[r]), int(rows.bounds[r + 1])
        if lo == hi:
            continue
        start = rows.start[lo:hi] - rows.starts[r]
        tags = np.full(hi - lo, OUTSIDE)
        values = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
        values += [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 16] + [m.span() for m in HEX.finditer(text)]
        at = []
        for a, b in sorted(values):
            i, j = np.searchsorted(start, (a, b))
            if j > i:
                tags[i + 1 : j], tags[i] = INSIDE, BEGIN
                at.append(int(i) - WINDOW // 2)
        at = at[:: -(-len(at) // HIT_WINDOWS) or 1]
        at.append(len(text) * 7919 % max(hi - lo - WINDOW, 1))
        for k in at:
            k = max(k, 0)
            part = np.zeros((WINDOW, rows.features.shape[1]), np.int32)
            told = np.full(WINDOW, -1, np.int8)
            got = rows.features[lo + k : min(lo + k + WINDOW, hi)]
            part[: len(got)], told[: len(got)] = got, tags[k : k + len(got)]
            out.append((part.tobytes(), told.tobytes()))
    return out


def fit_secrets(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Field | None:
    """The field, fitted on at most ``sample`` texts, up to half of them with a pattern hit; None when no text has one."""

    def mark(batches):
        for batch in batches:
            for part in row_slices(batch, 1):
                hit = [bool(base_spans(t)) for t in text_bytes(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(hit, pa.bool_())], ["key", "hit"])

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, 1):
                made = _training_windows(text_bytes(part.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.binary())], ["x", "y"])

    texts = docs.select(F.col(text_col).cast("string").alias("text")).select(F.xxhash64("text").alias("key"), "text")
    marked = scratch_table(texts.mapInArrow(mark, "key long, hit boolean").distinct(), "hits")
    hits = [r.key for r in marked.filter("hit").orderBy("key").limit(-(-sample // 2)).select("key").collect()]
    if not hits:
        drop_scratch(marked)
        return None
    others = [r.key for r in marked.filter("not hit").orderBy("key").limit(sample - len(hits)).select("key").collect()]
    drop_scratch(marked)
    keys = docs.sparkSession.createDataFrame([(k,) for k in hits + others], "key long")  # at most ``sample``
    rows = texts.join(F.broadcast(keys), "key").dropDuplicates(["key"])
    got = sorted(rows.mapInArrow(run, "x binary, y binary").collect())
    tags = np.frombuffer(b"".join(r[1] for r in got), np.int8).reshape(len(got), WINDOW)
    if not (tags == BEGIN).any():
        return None
    return fit_field(np.frombuffer(b"".join(r[0] for r in got), np.int32).reshape(len(got), WINDOW, -1), tags)


def _field_spans(texts: list[bytes], field: Field) -> list[list[tuple[int, int]]]:
    rows = Tokens(texts)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    if not len(rows.start):
        return out
    scores = field.scores(rows.features)
    loud = np.flatnonzero(~field.silent(scores))
    for r in np.unique(np.searchsorted(rows.bounds, loud, "right") - 1).tolist():
        lo, hi = int(rows.bounds[r]), int(rows.bounds[r + 1])
        path = field.decode(scores[lo:hi])
        base, k = int(rows.starts[r]), 0
        while k < len(path):
            if path[k] == OUTSIDE:
                k += 1
                continue
            stop = k + 1
            while stop < len(path) and path[stop] == INSIDE:
                stop += 1
            a, b = int(rows.start[lo + k]), int(rows.end[lo + stop - 1])
            if b - a >= SHORTEST:
                out[r].append((a - base, b - base))
            k = stop
    return out


def _outside(text: bytes, a: int, b: int, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The parts of a tag span that no pattern span covers and that hold a word byte."""
    parts = []
    for s, e, _ in sorted(base):
        if s < b and a < e:
            parts.append((a, s))
            a = e
    parts.append((a, b))
    return [(s, e, 3) for s, e in parts if s < e and (_CLASS[np.frombuffer(text[s:e], np.uint8)] == 1).any()]


def find_secrets(texts: list[bytes], field: Field | None) -> list[list[tuple[int, int, int]]]:
    """Spans ``(start, end, kind)`` in code points, by start, then kind."""
    tagged = _field_spans(texts, field) if field else [[] for _ in texts]
    out = []
    for text, extra in zip(texts, tagged, strict=True):
        base = base_spans(text)
        spans = base + [p for a, b in extra for p in _outside(text, a, b, base)]
        if spans and len(text) != len(text.decode("utf-8", "replace")):
            point = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
            spans = [(int(point[a]), int(point[b]), k) for a, b, k in spans]
        out.append(sorted(spans, key=lambda s: (s[0], s[2], s[1])))
    return out


def scan_secrets(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: arrays of ``kind, start, end`` of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for batch in batches:
            for part in row_slices(batch, 1):
                found = find_secrets(text_bytes(part.column(1)), shared.value)
                spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, b, k in f] for f in found]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, field: Field | None, text_col: str = "text", mark: str = "<SECRET>") -> DataFrame:
    """The same rows with every span (overlapping ones as one) replaced by ``mark``; null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for part in row_slices(batch, at):
                texts = part.column(at).to_pylist()
                out = []
                for text, spans in zip(texts, find_secrets([(t or "").encode() for t in texts], shared.value), strict=True):
                    done, pieces = 0, []
                    for a, b, _ in spans:
                        if b <= done:
                            continue
                        if a >= done:
                            pieces += [text[done:a], mark]
                        done = b
                    out.append(text if not spans else "".join([*pieces, text[done:]]))
                yield part.set_column(at, text_col, pa.array(out, pa.string()))

    return docs.mapInArrow(run, docs.schema)


def secret_digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` from ``scan_secrets``."""
    told = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select(
        "doc_id", *[number(k) for k in KINDS[:3]], F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans")
    )
