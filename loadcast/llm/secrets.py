"""Secret scan: base patterns, and a character convolutional network over candidates in their context.

Base patterns find assignments, access keys and long hexadecimal strings. Candidates are all other runs of token
characters, 12 characters or longer, their parts of letters and digits between separators, and of both, where they are
longer than 40 characters, all stretches of 40 at steps of 20. The network reads a candidate with 24 characters before and 8
after it: learned character vectors, a convolution over five places, the maximum over the candidate and over its context,
and a linear layer. It is trained on all texts: base findings are secrets, candidates that touch none are not. Half of the
secrets are shown without their context, so that shape counts too. Secrets and runs are dealt to three parts, whole with
all their windows: the network learns from the first, the second calibrates the scores and sets the highest threshold that
keeps the wanted recall there, the third is only counted (`Detector.unseen`). Every distinct window belongs to a part. They
lie in shares of bounded size; in each round every share takes the network through its windows of the first part, and the
mean of what the shares made of it goes into the next round. One share is plain training. Findings
that overlap are one. Base findings always stay. What is left of a run beside a base finding is a candidate as well, read
without the finding, and never learned from.

All of a text is read. Vectorised tests over the bytes decide which texts can hold a finding or candidate at all, only
those are searched with patterns.

Cases: null and empty texts have no findings (the digest of the empty text); repeated and null ids are scanned like any
row; without findings, or without other candidates, nothing is added to the base findings.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadcast.llm.common import ready_workers
from loadcast.session import materialize

#: Base kinds in the order in which they are listed.
KINDS = ("assign", "access", "hex")
LEARNED = "learned"
_ASSIGN = re.compile(
    r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
_PART = re.compile(r"[A-Za-z0-9]{12,}")

#: Places of a window before, in and after the candidate.
BEFORE, INSIDE, AFTER = 24, 40, 8
#: Characters of the shortest candidate.
LEAST = 12
WINDOW = BEFORE + INSIDE + AFTER


@dataclass(frozen=True)
class SecretOptions:
    """A share holds about `share` windows of the most frequent sort: findings, candidates with a digit, those without.

    A sort weighs no more than `share` windows, however many it has. A rarer sort is shown in several shares, up to a
    tenth of `share` in each, and weighs as much less there.
    """

    share: int = 3000
    recall: float = 0.98
    dims: int = 8
    filters: int = 24
    epochs: int = 10
    rate: float = 0.01
    seed: int = 8


_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[[ord(c) for c in "0123456789abcdef"]] |= 1
_CLASS[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] |= 2


def _runs(mask: np.ndarray, least: int) -> np.ndarray:
    """Where runs of True of at least some length begin."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return start[stop - start >= least]


def suspects(texts: list[str]) -> np.ndarray:
    """Which texts can hold a base finding or a candidate; no text that does is left out."""
    rows = [t.encode() + b"\n" for t in texts]
    data = np.frombuffer(b"".join(rows), dtype=np.uint8)
    ends = np.cumsum([0, *map(len, rows)])
    kinds = _CLASS[data]
    out = np.zeros(len(texts), dtype=bool)
    token = (kinds & 2) > 0
    for place in (_runs(token, LEAST), _runs((kinds & 1) > 0, 24), np.flatnonzero((data == 0x3D) | (data == 0x3A))):
        out[np.searchsorted(ends, place, side="right") - 1] = True
    return out | np.array(["AKIA" in t for t in texts], dtype=bool)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Base findings (start, end, kind), leftmost and without overlap within a kind."""
    out = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def stretches(a: int, b: int) -> list[tuple[int, int]]:
    """text[a:b] in overlapping pieces that the network sees whole."""
    if b - a <= INSIDE:
        return [(a, b)]
    return [(s, s + INSIDE) for s in (*range(a, b - INSIDE, INSIDE // 2), b - INSIDE)]


class Candidate(NamedTuple):
    start: int
    end: int
    #: The run without base findings that the candidate is a piece of.
    run: tuple[int, int]
    #: Whether a base finding takes the rest of the run.
    beside: bool


def open_runs(text: str, base: list[tuple[int, int, str]]) -> list[Candidate]:
    """Token runs outside of base findings; of one that meets a finding, what is left on both sides."""
    taken = merged((a, b) for a, b, _ in base)
    out, first = [], 0
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        while first < len(taken) and taken[first][1] <= a:
            first += 1
        at, k = a, first
        while k < len(taken) and taken[k][0] < b:
            if taken[k][0] - at >= LEAST:
                out.append(Candidate(at, taken[k][0], (at, taken[k][0]), True))
            at, k = taken[k][1], k + 1
        if b - at >= LEAST:
            out.append(Candidate(at, b, (at, b), at > a))
    return out


def pieces_of(text: str, run: Candidate) -> list[Candidate]:
    """A run whole, its parts between separators, and the stretches of both."""
    parts = [(run.start, run.end), *(p.span() for p in _PART.finditer(text, run.start, run.end))]
    spans = dict.fromkeys(v for p in parts for v in (p, *stretches(*p)))
    return [run._replace(start=a, end=b) for a, b in spans]


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Token runs outside of base findings, whole and in pieces."""
    return [(c.start, c.end) for run in open_runs(text, base) for c in pieces_of(text, run)]


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans with those that overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def window(text: str, a: int, b: int, low: int = 0, high: int | None = None) -> bytes:
    """Codes of the characters around and in text[a:b]; 0 is nothing, 1 any character beyond ASCII.

    The context ends at `low` and `high`.
    """
    inner = text[a:b] if b - a <= INSIDE else text[a : a + INSIDE // 2] + text[b - INSIDE // 2 : b]
    before = text[max(low, a - BEFORE) : a].rjust(BEFORE, "\0")
    after = text[b : b + AFTER if high is None else min(high, b + AFTER)].ljust(AFTER, "\0")
    parts = before + inner.ljust(INSIDE, "\0") + after
    return bytes(ord(c) if ord(c) < 128 else 1 for c in parts)


def value_span(text: str, a: int, b: int, kind: str) -> tuple[int, int]:
    """The secret itself in a base finding."""
    if kind != "assign":
        return a, b
    m = _ASSIGN.match(text, a, b)
    return m.span(2)


def _key(secret: str) -> int:
    """What windows of one secret or run have in common."""
    return zlib.crc32(secret.encode())


class Scan(NamedTuple):
    """Findings and candidates of a text with their windows; `*_of` names the secret or run of a window.

    Windows of what lies beside a base finding have no name, which keeps them out of the training.
    """

    base: list[tuple[int, int, str]]
    other: list[tuple[int, int, str]]
    found: list[bytes]
    found_of: list[int]
    open: list[bytes]
    open_of: list[int | None]


def scan_text(text: str) -> Scan:
    base = base_spans(text)
    out = Scan(base, [], [], [], [], [])
    for span in base:
        a, b = value_span(text, *span)
        for v in dict.fromkeys(((a, b), *stretches(a, b))):
            out.found.append(window(text, *v))
            out.found_of.append(_key(text[a:b]))
    for run in open_runs(text, base):
        key = None if run.beside else _key(text[run.start : run.end])
        # The context of a rest ends where its run does, so that its own shape decides.
        edges = run.run if run.beside else (0, None)
        for c in pieces_of(text, run):
            out.other.append((c.start, c.end, LEARNED))
            out.open.append(window(text, c.start, c.end, *edges))
            out.open_of.append(key)
    return out


def scan(text: Column) -> Column:
    """The fields of `Scan` as a struct, for every text."""
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
    windows, names = pa.list_(pa.binary()), pa.list_(pa.int64())
    kind = pa.struct(
        [("base", pa.list_(span)), ("other", pa.list_(span)), ("found", windows), ("found_of", names), ("open", windows), ("open_of", names)]
    )
    nothing = Scan([], [], [], [], [], [])

    def spans(rows: list[tuple[int, int, str]]) -> list[dict]:
        return [{"start": a, "end": b, "kind": k} for a, b, k in rows]

    def work(column: pa.Array) -> pa.Array:
        texts = [t or "" for t in column.to_pylist()]
        found = [scan_text(t) if may else nothing for t, may in zip(texts, suspects(texts), strict=True)]
        return pa.array([{**s._asdict(), "base": spans(s.base), "other": spans(s.other)} for s in found], kind)

    listed = "array<struct<start: int, end: int, kind: string>>"
    more = "found array<binary>, found_of array<bigint>, open array<binary>, open_of array<bigint>"
    return F.arrow_udf(work, f"base {listed}, other {listed}, {more}")(text)


class Unseen(NamedTuple):
    """What a detector finds among windows that it neither learned from nor was calibrated on."""

    secrets: int = 0
    windows: int = 0
    found: int = 0
    others: int = 0
    others_found: int = 0


class Detector:
    """The network; `p` holds its arrays, `scale` and `shift` its calibration."""

    WIDTH = 5

    def __init__(self, p: dict[str, np.ndarray]):
        self.p, self.scale, self.shift, self.threshold = p, 1.0, 0.0, 2.0
        self.recall = self.precision = 0.0  # where the threshold was set
        self.unseen = Unseen()

    def forward(self, codes: np.ndarray) -> dict:
        p = self.p
        e = p["e"][codes]
        n, places = len(codes), WINDOW - self.WIDTH + 1
        # The numbers of neighbouring places lie side by side, so a window of places is copied as one piece.
        flat = np.lib.stride_tricks.sliding_window_view(e.reshape(n, -1), self.WIDTH * e.shape[2], axis=1)[:, :: e.shape[2]]
        cols = np.ascontiguousarray(flat).reshape(n * places, -1)
        kernel = p["k"].reshape(e.shape[2], self.WIDTH, -1).swapaxes(0, 1).reshape(cols.shape[1], -1)
        act = cols @ kernel
        act += p["b"]
        act = np.maximum(act, 0, out=act).reshape(n, places, -1)
        middle = slice(BEFORE - 2, BEFORE + INSIDE - 2)
        inner = act[:, middle]
        outer = np.concatenate([act[:, : BEFORE - 2], act[:, BEFORE + INSIDE - 2 :]], axis=1)
        ai, ao = inner.argmax(axis=1), outer.argmax(axis=1)
        ao_full = np.where(ao < BEFORE - 2, ao, ao + INSIDE)
        top = np.concatenate(
            [np.take_along_axis(inner, ai[:, None], 1)[:, 0], np.take_along_axis(outer, ao[:, None], 1)[:, 0]], axis=1
        )
        return {"top": top, "at": np.concatenate([ai + BEFORE - 2, ao_full], axis=1), "y": top @ p["w"] + p["d"]}

    def raw(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(self.forward(codes[i : i + 64])["y"] for i in range(0, len(codes), 64))])

    def score(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * self.raw(codes) + self.shift)))

    def gradient(self, codes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(codes)
        n, filters = len(codes), p["k"].shape[1]
        dy = (1 / (1 + np.exp(-f["y"])) - y) * weight / n
        dtop = dy[:, None] * p["w"][None, :] * (f["top"] > 0)
        rows = np.repeat(np.arange(n), 2 * filters)
        at, which = f["at"].ravel(), np.tile(np.arange(2 * filters) % filters, n)
        g, size = dtop.ravel(), len(p["e"])
        dk, de = np.zeros_like(p["k"]), np.zeros_like(p["e"])
        for s in range(self.WIDTH):
            # What each character at this place of the windows that won adds to each filter.
            cells = np.bincount(codes[rows, at + s] * filters + which, weights=g, minlength=size * filters).reshape(size, filters)
            own = slice(s, None, self.WIDTH)
            dk[own] = p["e"].T @ cells
            de += cells @ p["k"][own].T
        return {"e": de, "k": dk, "b": np.bincount(which, weights=g, minlength=filters), "w": f["top"].T @ dy, "d": np.array([dy.sum()])}


def _codes(windows: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(w) for w in windows), dtype=np.uint8).reshape(-1, WINDOW).astype(np.int64)


def _names(windows: list[bytes], names: list[int] | None) -> np.ndarray:
    return np.array(names if names is not None else [zlib.crc32(w[BEFORE : BEFORE + INSIDE]) for w in windows], dtype=np.int64)


def _dealt(names: np.ndarray) -> np.ndarray:
    """0, 1 or 2 for the fit, calibration and counting part of each window: three, one and one fifth of the names."""
    _, place = np.unique(names, return_inverse=True)
    return np.array([0, 1, 2, 0, 0])[place % 5]


#: The arrays of a network and their two moments.
State = list[dict[str, np.ndarray]]


@dataclass
class Share:
    """Windows that are learned from in one place: codes, 1 for secrets, part, weight, and whether it counts the window."""

    number: int
    x: np.ndarray
    y: np.ndarray
    names: np.ndarray
    part: np.ndarray
    weight: np.ndarray
    once: np.ndarray

    def shown(self, seed: int) -> tuple[Share, np.random.Generator]:
        """The windows in random order, half of the secrets with the context of others, and the generator after that."""
        rng = np.random.default_rng([seed, self.number] if self.number else seed)
        order = rng.permutation(len(self.y))
        out = Share(self.number, *(v[order] for v in (self.x, self.y, self.names, self.part, self.weight, self.once)))
        x, y, part = out.x, out.y, out.part
        bare = (y == 1) & (rng.random(len(y)) < 0.5)
        for k in range(3):
            some, others = np.flatnonzero(bare & (part == k)), x[(y == 0) & (part == k)]
            if len(others):
                lend = others[rng.integers(0, len(others), len(some))]
                x[some, :BEFORE], x[some, BEFORE + INSIDE :] = lend[:, :BEFORE], lend[:, BEFORE + INSIDE :]
        return out, rng


def _start(options: SecretOptions, rng: np.random.Generator) -> State:
    f = options.filters
    p = {
        "e": rng.normal(0, 0.5, (128, options.dims)),
        "k": rng.normal(0, 1 / np.sqrt(5 * options.dims), (5 * options.dims, f)),
        "b": np.zeros(f),
        "w": rng.normal(0, 1 / np.sqrt(2 * f), 2 * f),
        "d": np.zeros(1),
    }
    return [p, *({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))]


def _round(share: Share, number: int, state: State | None, options: SecretOptions) -> State:
    """The network after one pass over the first part of a share; without a state the share makes its own."""
    shown, rng = share.shown(options.seed)
    start = _start(options, rng)
    p, m, v = ({k: a.copy() for k, a in d.items()} for d in state or start)
    net, fit = Detector(p), shown.part == 0
    fx, fy, fw = shown.x[fit], shown.y[fit], shown.weight[fit]
    for _ in range(number):
        rng.permutation(len(fy))
    step, order = number * -(-len(fy) // 64), rng.permutation(len(fy))
    for lo in range(0, len(fy), 64):
        some = order[lo : lo + 64]
        step += 1
        for k, g in net.gradient(fx[some], fy[some], fw[some]).items():
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.001 * (g * g - v[k])
            p[k] -= options.rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return [p, m, v]


def _calibrate(net: Detector, raw: np.ndarray, weight: np.ndarray, secret: np.ndarray, spread: float) -> None:
    """Logistic calibration by gradient steps on two numbers; `secret` is how much of each value's weight is of secrets."""
    x, total = raw / spread, weight.sum()
    a, b = 1.0, 0.0
    for _ in range(500):
        miss = weight / (1 + np.exp(-(a * x + b))) - secret
        a -= 0.5 * float((miss * x).sum() / total + 1e-3 * a)
        b -= 0.5 * float(miss.sum() / total)
    net.scale, net.shift = a / spread, b


def train(
    found: list[bytes],
    left: list[bytes],
    options: SecretOptions,
    found_of: list[int] | None = None,
    left_of: list[int] | None = None,
) -> Detector | None:
    """A calibrated detector from windows that fit one share; None if there are too few of either kind.

    `found_of` and `left_of` name the secret or run of each window; windows of one name stay in one part. Without them
    a window is named by what is inside.
    """
    if min(len(found), len(left)) < 10:
        return None
    y = np.concatenate([np.ones(len(found)), np.zeros(len(left))])
    names = np.concatenate([_names(found, found_of), _names(left, left_of)])
    part = np.concatenate([_dealt(names[y == 1]), _dealt(names[y == 0])])
    if len(np.unique(2 * part + y)) < 6:
        return None
    share = Share(0, np.concatenate([_codes(found), _codes(left)]), y, names, part, np.ones(len(y)), np.ones(len(y), dtype=bool))
    state = None
    for number in range(options.epochs):
        state = _round(share, number, state, options)
    net = Detector((state or _start(options, share.shown(options.seed)[1]))[0])
    shown, _ = share.shown(options.seed)
    x, y, names, part = shown.x, shown.y, shown.names, shown.part
    raw, cy = net.raw(x[part == 1]), y[part == 1]
    _calibrate(net, raw, np.ones(len(cy)), cy, max(float(raw.std()), 1e-6))
    score = net.score(x[part == 1])
    secret = np.sort(score[cy == 1])
    net.threshold = float(secret[int((1 - options.recall) * len(secret))])
    hit = score >= net.threshold
    net.recall, net.precision = float(hit[cy == 1].mean()), float(cy[hit].mean())
    hit, ry = net.score(x[part == 2]) >= net.threshold, y[part == 2] == 1
    net.unseen = Unseen(
        len(np.unique(names[part == 2][ry])), int(ry.sum()), int((hit & ry).sum()), int((~ry).sum()), int((hit & ~ry).sum())
    )
    return net


def _distinct_windows(scanned: DataFrame) -> DataFrame:
    """Every window with a name once in its sort: sort (0 findings, 1 candidates with a digit, 2 without), w, of."""

    def named(column: str, k: int) -> Column:
        pairs = F.arrays_zip(F.col(f"scan.{column}").alias("w"), F.col(f"scan.{column}_of").alias("of"))
        return F.transform(pairs, lambda p: F.struct(p["w"].alias("w"), p["of"].alias("of"), F.lit(k).alias("k")))

    rows = scanned.select(F.explode(F.concat(named("found", 0), named("open", 1))).alias("p")).select("p.*").where("of is not null")
    digit = F.substring("w", BEFORE + 1, INSIDE).cast("string").rlike("[0-9]")
    sort = F.when(F.col("k") == 0, 0).when(digit, 1).otherwise(2).cast("int")
    return rows.groupBy(sort.alias("sort"), "w").agg(F.min("of").alias("of"))


def _parts(windows: DataFrame) -> DataFrame:
    """The part (0, 1 or 2) of every name: three, one and one fifth of the secrets and of the other runs, as `_dealt`.

    Names are hashes, so 256 ranges of them are even; a name's place is that in its range and after all ranges before.
    """
    names = windows.select((F.col("sort") == 0).alias("secret"), "of").distinct().withColumn("_b", F.shiftright("of", 24))
    sizes = names.groupBy("secret", "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = W.partitionBy("secret").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    first = sizes.select("secret", "_b", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_first"))
    inside = F.row_number().over(W.partitionBy("secret", "_b").orderBy("of"))
    place = F.pmod(F.col("_first") + inside - 1, F.lit(5)).cast("int")
    # At most 256 rows for each side.
    ranked = names.join(F.broadcast(first), ["secret", "_b"])
    return ranked.select("secret", "of", F.get(F.array(*map(F.lit, (0, 1, 2, 0, 0))), place).alias("part"))


def _shares(batches: Iterable[pa.RecordBatch], weights: list[float]) -> Iterable[Share]:
    for batch in batches:
        for row in range(batch.num_rows):
            share, w = batch.column(0)[row].as_py(), batch.column(1)[row].values.to_pylist()
            sort, of, part, once = (batch.column(k)[row].values.to_numpy(zero_copy_only=False).astype(np.int64) for k in range(2, 6))
            yield Share(share, _codes(w), (sort == 0).astype(float), of, part, np.array(weights)[sort], once == 1)


def train_on(scanned: DataFrame, options: SecretOptions) -> Detector | None:
    """Train on all distinct findings and candidates of a table with a `scan` column."""
    windows = materialize(_distinct_windows(scanned), "windows")
    sizes = {r.sort: r.n for r in windows.groupBy("sort").agg(F.count(F.lit(1)).alias("n")).collect()}
    if min(sizes.get(0, 0), sizes.get(1, 0) + sizes.get(2, 0)) < 10:
        return None
    n = [max(1, sizes.get(k, 0)) for k in range(3)]
    count = -(-max(n) // options.share)
    copies = [min(count, max(1, count * options.share // (10 * k))) for k in n]
    # Of a sort, what its windows weigh in the shares' mean is that of `share` windows at most.
    weights = [count * min(k, options.share) / (k * c) for k, c in zip(n, copies, strict=True)]

    by_sort = F.get(F.array(*map(F.lit, copies)), F.col("sort"))
    dealt = windows.withColumn("secret", F.col("sort") == 0).join(_parts(windows), ["secret", "of"])
    again = dealt.select("*", F.explode(F.sequence(F.lit(0), by_sort - 1)).alias("copy"))
    place = F.pmod(F.xxhash64("w") + F.col("copy"), F.lit(count)).cast("int")
    row = F.struct("sort", "w", "of", "part", (F.col("copy") == 0).alias("once"))
    rows = again.groupBy(place.alias("share")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    shares = materialize(rows.select("share", "rows.w", "rows.sort", "rows.of", "rows.part", "rows.once"), "shares")
    held = dealt.groupBy("part", "secret").agg(F.count(F.lit(1)).alias("n")).collect()
    if len(held) < 6:
        return None

    state = None if count == 1 else _start(options, np.random.default_rng(options.seed))
    for number in range(options.epochs):
        state = _mean_round(shares, number, state, options, weights)
    net = Detector((state or _start(options, np.random.default_rng(options.seed)))[0])
    return _with_threshold(net, shares, options, weights)


def _mean_round(shares: DataFrame, number: int, state: State | None, options: SecretOptions, weights: list[float]) -> State:
    """The mean network of all shares after a round; a task adds up its shares, so the driver gets one network a task."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total, count, first = None, 0, None
        for share in _shares(batches, weights):
            made = _round(share, number, state, options)
            flat = np.concatenate([a.ravel() for d in made for a in d.values()])
            total, count = flat if total is None else total + flat, count + 1
            first = share.number if first is None else first
        if count:
            yield pa.RecordBatch.from_pydict({"first": [first], "count": [count], "total": [total.tolist()]})

    rows = sorted(shares.mapInArrow(work, "first long, count long, total array<double>").collect(), key=lambda r: r.first)
    mean = np.sum([r.total for r in rows], axis=0) / sum(r["count"] for r in rows)
    shapes = _start(options, np.random.default_rng(0))
    ends = np.cumsum([a.size for d in shapes for a in d.values()])
    pieces = iter(np.split(mean, ends[:-1]))
    return [{k: next(pieces).reshape(a.shape) for k, a in d.items()} for d in shapes]


def _with_threshold(net: Detector, shares: DataFrame, options: SecretOptions, weights: list[float]) -> Detector:
    """The network calibrated and its threshold set on all windows of the second part, counted on all of the third."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for share in _shares(batches, weights):
            shown, _ = share.shown(options.seed)
            kept = shown.once & (shown.part > 0)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": shown.part[kept], "secret": shown.y[kept] == 1, "of": shown.names[kept], "weight": shown.weight[kept],
                    "raw": net.raw(shown.x[kept]),
                }
            )

    scored = materialize(shares.mapInArrow(work, "part long, secret boolean, of long, weight double, raw double"), "scored")
    held = scored.where("part = 1")
    spread, n = held.agg(F.stddev_pop("raw"), F.count_if("secret")).first()
    spread = max(float(spread), 1e-6)
    # Values are as near as a 4,096th of their spread in a cell, so the driver gets some ten thousand cells at any size.
    cell = F.floor(F.col("raw") / F.lit(spread) * 4096)
    cells = held.groupBy(cell.alias("cell")).agg(
        F.avg("raw").alias("raw"), F.sum("weight").alias("weight"), F.sum(F.when(F.col("secret"), F.col("weight")).otherwise(0.0)).alias("secret")
    )
    cells = cells.orderBy("cell").collect()
    _calibrate(net, *(np.array([r[c] for r in cells]) for c in ("raw", "weight", "secret")), spread)
    up = F.col("raw") * F.lit(1.0 if net.scale >= 0 else -1.0)
    place = int((1 - options.recall) * n)
    bound = held.where("secret").select(up.alias("up"), "raw").orderBy("up").offset(place).limit(1).first()
    net.threshold = float(1 / (1 + np.exp(-(net.scale * bound.raw + net.shift))))
    hit = up >= F.lit(bound.up)
    counts = scored.groupBy("part", "secret").agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("hit"))
    counts = {(r.part, r.secret): r for r in counts.collect()}
    true, false = counts[1, True], counts[1, False]
    net.recall, net.precision = true.hit / true.n, true.hit / max(1, true.hit + false.hit)
    names = scored.where("part = 2 and secret").select("of").distinct().count()
    true, false = counts[2, True], counts[2, False]
    net.unseen = Unseen(names, true.n, true.hit, false.n, false.hit)
    return net


def _added(net: Detector | None, other: pa.Array, windows: pa.Array) -> list[list[tuple[int, int, str]]]:
    """The spans that the network adds to each row."""
    wins = windows.to_pylist()
    flat = [w for row in wins for w in row]
    good = iter((net.score(_codes(flat)) >= net.threshold).tolist() if flat and net else [False] * len(flat))
    rows = ([(s["start"], s["end"]) for s in row if next(good)] for row in other.to_pylist())
    return [[(a, b, LEARNED) for a, b in merged(row)] for row in rows]


def accepted(net: Detector | None, scanned: Column) -> Column:
    """The spans that the network adds, from a `scan` column."""

    def work(spans: pa.Array, windows: pa.Array) -> pa.Array:
        rows = _added(net, spans, windows)
        return pa.array([[{"start": a, "end": b, "kind": k} for a, b, k in row] for row in rows], spans.type)

    kind = "array<struct<start: int, end: int, kind: string>>"
    return F.arrow_udf(work, kind)(scanned["other"], scanned["open"])


def spans_text(spans: Column) -> Column:
    """kind:start:end by start, then kind in the listed order, joined by commas."""
    order = F.array(*(F.lit(k) for k in (*KINDS, LEARNED)))
    rows = F.transform(
        spans, lambda s: F.struct(s["start"].alias("a"), F.array_position(order, s["kind"]).alias("k"), s["end"].alias("b"), s["kind"].alias("kind"))
    )
    return F.array_join(
        F.transform(F.array_sort(rows), lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["b"].cast("string"))), ","
    )


def scanned_documents(docs: DataFrame, options: SecretOptions = SecretOptions()) -> DataFrame:
    """doc_id with counts of base findings, their digest and all spans."""
    ready_workers(docs.sparkSession)
    found = materialize(docs.select("doc_id", scan(F.col("text")).alias("scan")), "scan")
    added = accepted(train_on(found, options), F.col("scan"))

    def count(kind: str) -> Column:
        return F.size(F.filter("scan.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.withColumn("added", added).select(
        "doc_id",
        *(count(k) for k in KINDS),
        F.sha2(spans_text(F.col("scan.base")), 256).alias("base_sha256"),
        spans_text(F.concat("scan.base", "added")).alias("spans"),
    )


def replaced(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every finding (of an assignment its value) replaced by its kind in brackets."""
    values = [(*value_span(text, *s), s[2]) for s in spans]
    parts, at = [], 0
    for a, b, kind in sorted(values, key=lambda s: (s[0], -s[1])):
        if b <= at:
            continue
        if a >= at:
            parts += [text[at:a], f"[{kind}]"]
        at = b
    return "".join([*parts, text[at:]])


def hidden(text: Column, net: Detector | None, scanned: Column) -> Column:
    """The text without its base findings and those of the network, from a `scan` column; null stays null.

    One function scores and replaces, so that a task needs one Python worker.
    """

    def work(texts: pa.Array, base: pa.Array, other: pa.Array, windows: pa.Array) -> pa.Array:
        out = []
        for t, row, more in zip(texts.to_pylist(), base.to_pylist(), _added(net, other, windows), strict=True):
            spans = [(s["start"], s["end"], s["kind"]) for s in row] + more
            out.append(replaced(t, spans) if spans else t)
        return pa.array(out, pa.string())

    return F.arrow_udf(work, "string")(text, scanned["base"], scanned["other"], scanned["open"])


def redact(text: Column, net: Detector | None) -> Column:
    """The text with base findings and those of the network replaced."""
    return hidden(text, net, scan(text))


def redacted_documents(docs: DataFrame, options: SecretOptions = SecretOptions()) -> DataFrame:
    """`docs` with secrets replaced in `text` and `n_chars` following it; every row stays.

    The rows are written with what the scan found, so that no text is scanned twice.
    """
    ready_workers(docs.sparkSession)
    found = materialize(docs.select(F.struct("*").alias("row"), scan(F.col("text")).alias("scan")), "scan")
    net = train_on(found, options)
    text = hidden(F.col("row.text"), net, F.col("scan"))
    out = found.select(F.col("row").withField("text", text).alias("row")).select("row.*")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def digest(spans: list[tuple[int, int, str]]) -> str:
    """The digest of base spans in plain Python."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()
