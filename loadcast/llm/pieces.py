"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with log scores.

A text gets a leading space, spaces become the whitespace marker, and the path of pieces with the greatest sum of scores
is taken; of equal sums the one with the longest last piece. A character that no piece holds becomes its UTF-8 bytes
(byte fallback); so does the marker character itself where a text contains it, which keeps decoding exact. No piece has
the marker after another character, so each run of spaces with what follows up to the next space is solved on its own and
remembered; all new ones of a batch are solved at once with array operations.

Cases: null and empty texts have no tokens and decode to the empty text; any other text decodes to itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm.common import ready_workers

MARK = "▁"
#: The default vocabulary; any file of the same format may be named instead.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: What an unknown character costs below the lowest score.
UNKNOWN_PENALTY = 10.0
#: Remembered segments per worker, and code points solved at once.
REMEMBERED, AT_ONCE = 400_000, 2_000_000


@dataclass
class Vocabulary:
    """pieces and scores by id; byte_ids[b] is the piece of byte b (-1: none); plain marks pieces that match text."""

    pieces: list[str]
    scores: np.ndarray
    plain: np.ndarray
    byte_ids: np.ndarray
    unknown: int
    code: np.ndarray = field(init=False)
    base: np.ndarray = field(init=False)
    check: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        usable = [(p, i) for i, p in enumerate(self.pieces) if self.plain[i] and p]
        letters = sorted({c for p, _ in usable for c in p})
        self.code = np.zeros(0x110000, dtype=np.int32)
        for k, c in enumerate(letters):
            self.code[ord(c)] = k + 1
        self.code[ord(" ")], self.code[ord(MARK)] = self.code[ord(MARK)], 0
        number = {c: k + 1 for k, c in enumerate(letters)}
        self.base, self.check, self.value = double_array([([number[c] for c in p], i) for p, i in usable], len(letters) + 1)


def double_array(keys: list[tuple[list[int], int]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check and value of a double-array trie over sequences of codes 1 .. width - 1.

    State s goes to t = base[s] + c on code c if check[t] == s; value[t] is the id of the key that ends in t, else -1.
    """
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for codes, i in keys:
        node = 0
        for c in codes:
            if c not in children[node]:
                children[node][c] = len(children)
                children.append({})
                ends.append(-1)
            node = children[node][c]
        ends[node] = i
    size = 2 * len(children) + 2 * width + 64
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    taken = bytearray(size)
    taken[0] = 1
    free, queue = 1, [(0, 0)]
    for node, state in queue:
        value[state] = ends[node]
        codes = sorted(children[node])
        if not codes:
            continue
        while taken[free]:
            free += 1
        at = max(free, codes[0])
        while any(taken[at - codes[0] + c] for c in codes):
            at += 1
        base[state] = at - codes[0]
        for c in codes:
            t = int(base[state]) + c
            taken[t] = 1
            check[t] = state
            queue.append((children[node][c], t))
    return base, check, value


def read_vocabulary(path: str = MODEL) -> Vocabulary:
    """Pieces of a model file, read on the driver. Where scores are ranks, log scores follow from them by Zipf's law."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    n = p.get_piece_size()
    names = [p.id_to_piece(i) for i in range(n)]
    byte_ids = np.full(256, -1, dtype=np.int32)
    for i in range(n):
        if p.is_byte(i):
            byte_ids[int(names[i][1:-1], 16)] = i
    plain = np.array([not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i)) for i in range(n)])
    scores = np.array([p.get_score(i) for i in range(n)], dtype=np.float64)
    if (scores == np.round(scores)).all():
        scores = -np.log1p(-scores)  # a vocabulary of merges: minus its rank stands for the score; log by Zipf's law
    return Vocabulary(names, scores, plain, byte_ids, p.unk_id())


class Encoder:
    """Encodes and decodes with one vocabulary; remembers segments between calls."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.lines = not v.code[ord("\n")]  # a line break that no piece holds parts the text too
        self.floor = float(v.scores[v.plain].min(initial=0.0)) - UNKNOWN_PENALTY
        self.surface = [p.replace(MARK, " ").encode() if v.plain[i] else b"" for i, p in enumerate(v.pieces)]
        for b, i in enumerate(v.byte_ids.tolist()):
            if i >= 0:
                self.surface[i] = bytes([b])
        if v.unknown >= 0:
            self.surface[v.unknown] = " ⁇ ".encode()
        self.is_byte = np.zeros(len(v.pieces), dtype=bool)
        self.is_byte[v.byte_ids[v.byte_ids >= 0]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.start, self.length, self.store = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def solve(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all segments in a row and their number in each."""
        v = self.v
        points = np.frombuffer("\n".join(segments).encode("utf-32-le"), dtype=np.uint32)
        size = np.array([len(s) for s in segments])
        first = np.cumsum(np.append(0, size[:-1] + 1))
        code = np.append(v.code[points], np.zeros(1, np.int32))
        n = len(points)
        inside = np.ones(n, dtype=bool)
        inside[first[1:] - 1] = False  # the joints between segments
        code[:n][~inside] = 0
        # All pieces from all positions at once, one character further in each step.
        at = np.flatnonzero(inside)
        known_one = np.zeros(n, dtype=bool)
        state = np.zeros(len(at), dtype=np.int32)
        begin, span, piece = [], [], []
        depth, live = 0, at
        while len(live):
            c = code[np.minimum(live + depth, n)]
            nxt = v.base[state] + c
            go = (c > 0) & (v.check[nxt] == state)
            live, state = live[go], nxt[go]
            depth += 1
            ends = v.value[state] >= 0
            begin.append(live[ends])
            span.append(np.full(int(ends.sum()), depth, dtype=np.int32))
            piece.append(v.value[state[ends]])
            if depth == 1:
                known_one[begin[0]] = True
        lone = at[~known_one[at]]
        begin.append(lone)
        span.append(np.ones(len(lone), dtype=np.int32))
        piece.append(np.full(len(lone), -1, dtype=np.int32))
        a, w, k = np.concatenate(begin), np.concatenate(span), np.concatenate(piece)
        # Every path passes the places that no piece spans; between two of them paths are independent.
        cover = np.bincount(a + 1, minlength=n + 2) - np.bincount(a + w, minlength=n + 2)
        cut = np.cumsum(cover)[: n + 1] == 0
        origin = np.maximum.accumulate(np.where(cut[:n], np.arange(n), 0))
        step = (a - origin[a]) * (depth + 1) + w
        if step.max(initial=0) < 65_536:
            step = step.astype(np.uint16)  # sorted by digits, not by comparison
        order = np.argsort(step, kind="stable")
        a, w, k, step = a[order], w[order], k[order], step[order]
        gain = np.where(k >= 0, v.scores[k], self.floor)
        best = np.full(n + 1, -np.inf)
        back, through = np.zeros(n + 1, dtype=np.int32), np.zeros(n + 1, dtype=np.int32)
        bounds = [0, *(1 + np.flatnonzero(step[1:] != step[:-1])).tolist(), len(step)]
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            s, e = a[lo:hi], a[lo:hi] + w[lo:hi]
            total = np.where(cut[s], 0.0, best[s]) + gain[lo:hi]
            better = total > best[e]
            e = e[better]
            best[e] = total[better]
            back[e] = w[lo:hi][better]
            through[e] = k[lo:hi][better]
        on = np.zeros(n + 1, dtype=bool)
        stop = np.append(cut[:n] & inside, True)
        stop[first] = False
        stop[first[1:] - 1] = True
        here = np.flatnonzero(stop)
        while len(here):
            on[here] = True
            here = here - back[here]
            here = here[~cut[here]]
        end = np.flatnonzero(on)
        tokens, owner = through[end], np.searchsorted(first, end - 1, side="right") - 1
        return self._bytes(tokens, points[end - 1], owner, len(segments))

    def _bytes(self, tokens: np.ndarray, points: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Put the UTF-8 bytes in place of unknown characters."""
        lost = tokens < 0
        if not lost.any():
            return tokens, np.bincount(owner, minlength=n)
        p = points.astype(np.int64)
        wide = np.where(lost, 1 + (p > 0x7F) + (p > 0x7FF) + (p > 0xFFFF), 1)
        out, src = np.repeat(tokens, wide), np.repeat(np.arange(len(tokens)), wide)
        nth = np.arange(len(out)) - np.repeat(np.cumsum(wide) - wide, wide)
        again = lost[src]
        p, w, nth = p[src[again]], wide[src[again]], nth[again]
        bits = p >> (6 * (w - 1 - nth))
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[w]
        byte = np.where(nth == 0, np.where(w == 1, p, lead | bits), 0x80 | (bits & 0x3F))
        ids = self.v.byte_ids[byte]
        out[again] = np.where(ids >= 0, ids, self.v.unknown)
        if (ids < 0).any():  # no byte fallback: one unknown token for the character
            keep = np.ones(len(out), dtype=bool)
            keep[np.flatnonzero(again)[(ids < 0) & (nth > 0)]] = False
            out, src = out[keep], src[keep]
        return out, np.bincount(owner[src], minlength=n)

    def segments(self, data: bytes, first: np.ndarray) -> pa.Array:
        """Runs of spaces with what follows them, and lines; `first` are the places where texts begin."""
        b = np.frombuffer(data, dtype=np.uint8)
        space = b == 0x20
        start = space.copy()
        start[1:] &= ~space[:-1]
        if self.lines:
            start |= b == 0x0A
        start[first] = True
        self.begins = np.flatnonzero(start)
        offsets = np.append(self.begins, len(data)).astype(np.int32)
        return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts in a row and their number in each."""
        rows = [b" " + t.encode() if t else b"" for t in texts]
        size = np.cumsum([0, *map(len, rows)])
        data = b"".join(rows)
        segments = self.segments(data, size[:-1][np.diff(size) > 0]).dictionary_encode()
        distinct = segments.dictionary.to_pylist()
        number = list(map(self.known.get, distinct))
        if None in number:
            new = [s for s, k in zip(distinct, number, strict=True) if k is None]
            if len(self.known) + len(new) > REMEMBERED:
                self.forget()
                new = distinct
            tokens, count = self.solve(new)
            place = len(self.store) + np.cumsum(count) - count
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.start, self.length = np.append(self.start, place), np.append(self.length, count)
            self.store = np.append(self.store, tokens)
            number = list(map(self.known.__getitem__, distinct))
        which = np.array(number, dtype=np.int64)[segments.indices.to_numpy()]
        length = self.length[which]
        ends = np.cumsum(length)
        take = np.repeat(self.start[which] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
        upto = np.append(0, ends)[np.searchsorted(self.begins, size)]
        return self.store[take], np.diff(upto)

    def decode(self, tokens: Iterable[int]) -> str:
        out = b"".join(map(self.surface.__getitem__, tokens))
        return (out[1:] if out[:1] == b" " else out).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str, shared) -> Encoder:
    """One encoder for each worker and vocabulary; workers build the trie from the pieces."""
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(Vocabulary(*shared.value))
    return _ENCODERS[name]


def _share(spark: SparkSession, path: str):
    """A name for the vocabulary and its pieces and scores, some hundred kilobytes, for all workers."""
    v = read_vocabulary(path)
    return uuid.uuid4().hex, spark.sparkContext.broadcast((v.pieces, v.scores, v.plain, v.byte_ids, v.unknown))


def _portions(texts: list[str]) -> Iterable[list[str]]:
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t)
        if size >= AT_ONCE:
            yield some
            some, size = [], 0
    if some:
        yield some


def _ragged(flat: np.ndarray, count: np.ndarray) -> pa.Array:
    ends = np.append(0, np.cumsum(count)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def encode(spark: SparkSession, text: Column, path: str = MODEL) -> Column:
    """struct(tokens, n_bytes, exact) of a text: its piece ids, how many of them are bytes, whether they decode to it."""
    name, shared = _share(spark, path)

    def work(column: pa.Array) -> pa.Array:
        e = _encoder(name, shared)
        tokens, counts, exact = [], [], []
        for some in _portions([t or "" for t in column.to_pylist()]):
            flat, count = e.encode(some)
            tokens.append(flat)
            counts.append(count)
            ids, ends = flat.tolist(), np.append(0, np.cumsum(count)).tolist()
            exact += [e.decode(ids[a:b]) == t for a, b, t in zip(ends[:-1], ends[1:], some, strict=True)]
        flat, count = np.concatenate([np.zeros(0, np.int32), *tokens]), np.concatenate([np.zeros(0, np.int64), *counts])
        upto = np.append(0, np.cumsum(e.is_byte[flat]))
        ends = np.append(0, np.cumsum(count))
        return pa.StructArray.from_arrays(
            [_ragged(flat, count), pa.array(np.diff(upto[ends]).astype(np.int32)), pa.array(exact, pa.bool_())],
            ["tokens", "n_bytes", "exact"],
        )

    return F.arrow_udf(work, "tokens array<int>, n_bytes int, exact boolean")(text)


def decode(spark: SparkSession, tokens: Column, path: str = MODEL) -> Column:
    """The text of an array of piece ids; null for null."""
    name, shared = _share(spark, path)

    def work(column: pa.Array) -> pa.Array:
        e = _encoder(name, shared)
        return pa.array([None if t is None else e.decode(t) for t in column.to_pylist()], pa.string())

    return F.arrow_udf(work, "string")(tokens)


def encoded_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, tokens, n_tokens, n_bytes and exact of every row."""
    ready_workers(docs.sparkSession)
    e = docs.select("doc_id", encode(docs.sparkSession, F.col("text"), path).alias("e"))
    return e.select("doc_id", "e.tokens", F.size("e.tokens").cast("long").alias("n_tokens"), "e.n_bytes", "e.exact")
