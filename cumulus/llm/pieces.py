"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search walks a text once and keeps, for every boundary of a window no
longer than the longest piece, the piece that ends there on the best path.
Whenever the back paths of all boundaries in that window meet in one boundary,
everything before it is committed and forgotten, so memory does not grow with
the text.

* unigram models: a path's weight is the sum of its piece scores (ties: the
  longer last piece);
* BPE models: the path of a boundary is the merge result of the text before
  it. It is unique, and a piece may follow another exactly when the merges
  leave the two of them apart, so the same window search gives the ids that
  merging gives.

Cases: null and empty texts have no ids; characters outside the vocabulary
become byte pieces (else the unknown id); spaces are kept (one is added in
front, as the model asks); a literal U+2581 is read as a space, so such a text
does not come back unchanged (``round_trip`` is false). Repeated rows give
repeated rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumulus.llm.common import mix, powers, row_slices

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
CACHE_SEGMENTS = 150_000  # short segments whose ids a worker remembers, in each of two generations (some 30 MB)
CACHE_PAIRS = 150_000  # pairs of pieces it remembers to stay apart or not (some 30 MB)
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceModel:
    """Vocabulary of a SentencePiece model: normal pieces, scores, byte pieces."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: dict[int, int], unk: int, kind: str):
        self.ids = {p: i for p, (i, _) in pieces.items()}
        self.scores = {p: s for p, (_, s) in pieces.items()}
        self.byte_ids, self.unk, self.kind = byte_ids, unk, kind
        self.longest = max(map(len, pieces), default=1)
        # A space never stands behind another character inside a piece, so a
        # path boundary stands before every run of spaces.
        self.cut_at_space = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        lengths: dict[str, set[int]] = {}
        for p in pieces:
            if len(p) > 1:
                lengths.setdefault(p[-2:], set()).add(len(p))
        # Lengths of the pieces that end in given two characters, longest first.
        self.lengths = {tail: tuple(sorted(n, reverse=True)) for tail, n in lengths.items()}
        self.unk_score = min(self.scores.values(), default=0.0) - 10.0
        size = max([i for i, _ in pieces.values()] + list(byte_ids.values()) + [unk]) + 1
        self.bytes_of = [b""] * size
        for p, (i, _) in pieces.items():
            self.bytes_of[i] = p.replace(SPACE, " ").encode()
        for value, i in byte_ids.items():
            self.bytes_of[i] = bytes([value])
        self.bytes_of[unk] = " ⁇ ".encode()

    @classmethod
    def load(cls, path: str, kind: str = "bpe") -> PieceModel:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids = {}, {}
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(p[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[p] = (i, sp.get_score(i))
        return cls(pieces, byte_ids, sp.unk_id(), kind)


class StreamingEncoder:
    """The window search over one model; ``encode_all`` remembers segments up to a bound."""

    def __init__(self, model: PieceModel):
        self.model = model
        self._apart: dict[tuple[str, str], bool] = {}
        self._segments: dict[str, bytes] = {}  # without their first space
        self._older: dict[str, bytes] = {}
        self.lock_step = LockStep(self) if model.kind == "bpe" and model.ids else None

    def _merge(self, text: str) -> list[str]:
        """Merge adjacent symbols, best score first, leftmost first (texts of two pieces at most)."""
        get, symbols = self.model.scores.get, list(text)
        none = float("-inf")
        gains = [get(symbols[k] + symbols[k + 1], none) for k in range(len(symbols) - 1)]
        while gains and (best := max(gains)) > none:
            k = gains.index(best)
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
            del gains[k]
            if k < len(gains):
                gains[k] = get(symbols[k] + symbols[k + 1], none)
            if k:
                gains[k - 1] = get(symbols[k - 1] + symbols[k], none)
        return symbols

    def _stay_apart(self, before: str, piece: str) -> bool:
        known = self._merge(before + piece) == ([before, piece] if before else [piece])
        if len(self._apart) >= CACHE_PAIRS:
            self._apart.clear()
        self._apart[before, piece] = known
        return known

    def _known_apart(self, before: str, piece: str) -> bool:
        known = self._apart.get((before, piece))
        return self._stay_apart(before, piece) if known is None else known

    def pieces(self, chunks: Iterable[str]) -> Iterator[str]:
        """Pieces of the text that the chunks make up, committed as soon as they are certain."""
        scores, lengths, longest = self.model.scores, self.model.lengths, self.model.longest
        merges, apart, unk = self.model.kind == "bpe", self._apart, self.model.unk_score
        text, last, weight = "", [""], [0.0]  # the window; last piece and weight at each boundary
        at = checked = 0
        for chunk in chunks:
            text += chunk
            while at < len(text):
                at += 1
                found, found_weight = None, 0.0
                for n in lengths.get(text[at - 2 : at], ()) if at > 1 else ():
                    if n > at:
                        continue
                    piece = text[at - n : at]
                    s = scores.get(piece)
                    if s is None:
                        continue
                    if merges:
                        before = last[at - n]
                        free = apart.get((before, piece))
                        if free or free is None and self._stay_apart(before, piece):
                            found = piece
                            break
                    elif found is None or weight[at - n] + s > found_weight:
                        found, found_weight = piece, weight[at - n] + s
                if merges:
                    found = found or text[at - 1]
                else:
                    one = weight[at - 1] + scores.get(text[at - 1], unk)
                    if found is None or one > found_weight:
                        found, found_weight = text[at - 1], one
                    weight.append(found_weight)
                last.append(found)
                if at - checked >= 4 * longest:
                    cut = self._meeting(last, at)
                    yield from self._back(last, cut)
                    text = text[cut:]
                    del last[:cut], weight[:cut]
                    at -= cut
                    checked = at
        yield from self._back(last, at)

    def _meeting(self, last: list[str], at: int) -> int:
        """The boundary in which the back paths of all boundaries meet that a later piece can start at."""
        alive = set(range(max(0, at + 1 - self.model.longest), at + 1))
        while len(alive) > 1:
            b = max(alive)
            alive.remove(b)
            alive.add(b - len(last[b]) if b else 0)
        return alive.pop()

    @staticmethod
    def _back(last: list[str], at: int) -> list[str]:
        path = []
        while at:
            path.append(last[at])
            at -= len(last[at])
        return path[::-1]

    def _ids(self, segment: str) -> bytes:
        return self._numbers(self.pieces(segment[k : k + 256] for k in range(0, len(segment), 256)))

    def _numbers(self, pieces: Iterable[str]) -> bytes:
        model, out = self.model, []
        for piece in pieces:
            i = model.ids.get(piece)
            if i is not None:
                out.append(i)
            elif model.byte_ids:
                out.extend(model.byte_ids[b] for b in piece.encode())
            else:
                out.append(model.unk)
        return np.array(out, np.int32).tobytes()

    def _keys(self, text: str) -> list[str]:
        """Segments of a text, each from a run of spaces to the next, without the first space."""
        if not text:
            return []
        if "  " in text or text[0] == " " or text[-1] == " " or SPACE in text:
            return [s[1:] for s in _SEGMENT.findall(SPACE + text.replace(" ", SPACE))]
        return text.split(" ")

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, each as little-endian int32 bytes."""
        if not self.model.cut_at_space:
            return [self._ids(SPACE + t.replace(" ", SPACE)) if t else b"" for t in texts]
        keys = [self._keys(t) for t in texts]
        if len(self._segments) >= CACHE_SEGMENTS:  # what is used again comes back from the older generation
            self._older, self._segments = self._segments, {}
        known, older = self._segments, self._older
        new = set().union(*keys).difference(known)
        seen = new & older.keys()
        known.update({k: older[k] for k in seen})
        new -= seen
        long = {k: self._ids(SPACE + k) for k in new if len(k) >= LockStep.LONGEST or self.lock_step is None}
        short = [k for k in new if k not in long]
        if short:
            known.update(zip(short, self.lock_step.ids([SPACE + k for k in short]), strict=True))
        known.update(long)
        out = [b"".join(map(known.__getitem__, k)) for k in keys]
        for k in long:
            del known[k]
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text or ""])[0]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the space that encoding puts in front is taken off."""
        text = b"".join(map(self.model.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class LockStep:
    """The same search for many short segments at once, one boundary of all of them a step.

    Spans are looked up by hash in numpy tables; whether two pieces stay apart
    is remembered in a direct-mapped table and asked of the encoder when new.
    """

    LONGEST = 64  # characters; longer segments go through the streaming window
    AT_ONCE = 8192
    PAIR_BITS = 20  # slots of the table of pairs

    def __init__(self, encoder: StreamingEncoder):
        self.encoder, ids = encoder, encoder.model.ids
        self.names = list(ids)
        self.number = np.array([ids[p] for p in self.names], np.int32)
        self.start, self.odd = len(self.names), len(self.names) + 1  # before the text; a character of no piece
        sums, down = self._sums(*self._matrix(self.names))
        sizes = np.array([len(p) for p in self.names])
        self.keys = sums[sizes, np.arange(len(sizes))]
        self.tables, left = [], np.arange(len(self.names))
        while len(left):  # a slot keeps one key; the others go to a next table
            table, slots = np.full(1 << 18, -1, np.int32), self._slot(self.keys[left], len(self.tables))
            table[slots] = left
            self.tables.append(table)
            left = left[table[slots] != left]
        self.pairs = np.full(1 << self.PAIR_BITS, -1, np.int64)
        self.apart = np.zeros(1 << self.PAIR_BITS, bool)

    @staticmethod
    def _slot(keys: np.ndarray, level: int) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15 + 2 * level) >> np.uint64(46)).astype(np.int64)

    @staticmethod
    def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points by position (rows) and word (columns), and the words' lengths."""
        sizes = np.array([len(w) for w in words])
        grid = np.zeros((len(words), int(sizes.max())), np.uint32)
        grid[np.arange(grid.shape[1]) < sizes[:, None]] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        return np.ascontiguousarray(grid.T), sizes

    @staticmethod
    def _sums(grid: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        up, down = powers(1 << 8)
        sums = np.zeros((grid.shape[0] + 1, grid.shape[1]), np.uint64)
        np.cumsum(mix(grid.astype(np.uint64) + np.uint64(1)) * up[: grid.shape[0], None], axis=0, out=sums[1:])
        return sums, down

    def _find(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(keys), -1, np.int32)
        for level, table in enumerate(self.tables):
            at = table[self._slot(keys, level)]
            found = np.where((at >= 0) & (self.keys[at] == keys), at, found)
        return found

    def _stay_apart(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        pair = before.astype(np.int64) * (self.odd + 1) + piece
        slot = (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.PAIR_BITS)).astype(np.int64)
        new = self.pairs[slot] != pair
        if not new.any():
            return self.apart[slot]
        result = self.apart[slot]
        asked, back = np.unique(pair[new], return_inverse=True)
        name = lambda i: self.names[i] if i < self.start else ""
        told = np.array([self.encoder._known_apart(name(p // (self.odd + 1)), name(p % (self.odd + 1))) for p in asked.tolist()])
        result[new] = told[back]
        self.pairs[slot[new]] = pair[new]
        # of two pairs in one slot the last written stays, with its own answer
        keep = self.pairs[slot[new]] == pair[new]
        self.apart[slot[new][keep]] = result[new][keep]
        return result

    def ids(self, words: list[str]) -> list[bytes]:
        """Ids of words of 1 to ``LONGEST`` characters."""
        order = sorted(range(len(words)), key=lambda k: len(words[k]))
        out: list[bytes] = [b""] * len(words)
        for k in range(0, len(order), self.AT_ONCE):
            part = order[k : k + self.AT_ONCE]
            for j, found in zip(part, self._solve([words[j] for j in part]), strict=True):
                out[j] = found
        return out

    def _solve(self, words: list[str]) -> list[bytes]:
        grid, sizes = self._matrix(words)
        sums, down = self._sums(grid, sizes)
        longest, steps, n_words = self.encoder.model.longest, grid.shape[0], len(words)
        last = np.full((steps + 1, n_words), self.odd, np.int32)
        length = np.ones((steps + 1, n_words), np.int8)
        last[0] = self.start
        for at in range(1, steps + 1):
            open_ = np.arange(int(np.searchsorted(sizes, at)), n_words)  # words are in order of length
            for n in range(min(longest, at), 0, -1):
                if not len(open_):
                    break
                piece = self._find((sums[at, open_] - sums[at - n, open_]) * down[at - n])
                hit = np.flatnonzero(piece >= 0)
                if len(hit):
                    ok = self._stay_apart(last[at - n, open_[hit]], piece[hit])
                    hit = hit[ok]
                    last[at, open_[hit]] = piece[hit]
                    length[at, open_[hit]] = n
                    left = np.ones(len(open_), bool)
                    left[hit] = False
                    open_ = open_[left]
        path, where, column = [], sizes.copy(), np.arange(n_words)
        while where.any():
            path.append(np.where(where > 0, last[where, column], -1))
            where = where - np.where(where > 0, length[where, column], 0)
        flat = np.array(path[::-1]).T
        odd = (flat == self.odd).any(axis=1)
        counts = (flat >= 0).sum(axis=1)
        ends = np.cumsum(counts) * 4
        number = np.append(self.number, [0, 0])
        data = number[flat[flat >= 0]].astype(np.int32).tobytes()
        out = [data[e - 4 * c : e] for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
        for k in np.flatnonzero(odd).tolist():
            out[k] = self._spell(words[k], [p for p in flat[k].tolist() if p >= 0])
        return out

    def _spell(self, word: str, path: list[int]) -> bytes:
        """Ids of a path with characters of no piece."""
        names, at = [], 0
        for p in path:
            names.append(word[at] if p == self.odd else self.names[p])
            at += len(names[-1])
        return self.encoder._numbers(names)


@lru_cache(maxsize=2)
def encoder_for(path: str, kind: str) -> StreamingEncoder:
    """One encoder for each worker process, kept between tasks."""
    return StreamingEncoder(PieceModel.load(path, kind))


def _list_column(parts: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(p) // 4 for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encode_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL_PATH, kind: str = "bpe"
) -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip`` of every text; the model file lies at ``model_path`` on every node."""

    def run(batches):
        encoder = encoder_for(model_path, kind)
        for batch in batches:
            for part in row_slices(batch, 1):
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = encoder.encode_all(texts)
                same = [encoder.decode(np.frombuffer(i, np.int32).tolist()) == t for i, t in zip(ids, texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), _list_column(ids), pa.array(same)],
                    ["doc_id", "n_tokens", "ids", "round_trip"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean"
    )


def decode_pieces(
    encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model_path: str = MODEL_PATH, kind: str = "bpe"
) -> DataFrame:
    """``doc_id, text`` from id arrays; null ids give an empty text, ids outside the vocabulary fail."""

    def run(batches):
        encoder = encoder_for(model_path, kind)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [encoder.decode(i or []) for i in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, "doc_id long, text string"
    )
