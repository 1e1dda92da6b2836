"""Quality classifier by attention over passages (multiple-instance learning).

A text is cut into passages of 64 words. Every passage is encoded: shares of byte classes and of pairs of them, word
statistics (length, capitals, repeats, variety) and hashed words. A hidden layer makes a vector of each passage, gated
attention learns from document labels which passages matter, and the weighted sum gives the document's score. Nothing but
the text enters a score.

The network is fitted on a bounded sample of labelled documents (`fit_documents`, of each at most `fit_passages` passages
at even distances); every document is scored on all its passages.

Cases: null and empty texts and texts of white space are one passage of zeros and get a score too; null or other labels
than 0 and 1 are ignored, of several labels for an id the mean decides, of several texts the one with the smallest hash is learned from; repeated and null ids are scored like any row; with
no labelled document of both classes the score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.common import ready_workers


@dataclass(frozen=True)
class QualityOptions:
    fit_documents: int = 4000
    fit_passages: int = 32
    hidden: int = 24
    gates: int = 12
    epochs: int = 16
    batch: int = 128
    rate: float = 0.004
    decay: float = 1e-3
    threshold: float = 0.3
    seed: int = 5


#: Words of a passage, buckets of hashed words, bytes worked on at once.
PASSAGE, HASHED, AT_ONCE = 64, 128, 1_000_000

_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _fine_classes() -> np.ndarray:
    """Class of a byte: each punctuation mark its own, then letters, digits, spaces, parts of longer characters."""
    out = np.zeros(256, dtype=np.int64)
    out[ord("a") : ord("z") + 1], out[ord("A") : ord("Z") + 1], out[ord("0") : ord("9") + 1] = 1, 2, 3
    out[0x20], out[0x0A], out[0x09], out[0x0B:0x0E] = 4, 5, 6, 6
    out[0x80:0xC0], out[0xC0:0xE0], out[0xE0:0xF0], out[0xF0:] = 7, 8, 9, 10
    for k, c in enumerate(_PUNCTUATION):
        out[ord(c)] = 11 + k
    return out


FINE = _fine_classes()
N_FINE = 11 + len(_PUNCTUATION)
#: Coarser classes for pairs: control, lower, upper, digit, white space, long character, sentence mark, other mark.
COARSE = np.array([0, 1, 2, 3, 4, 4, 4, 5, 5, 5, 5] + [6 if c in ".,;:!?'\"" else 7 for c in _PUNCTUATION])[FINE]
N_FEATURES = N_FINE + 64 + 9 + HASHED
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_PRIME = 0x9E3779B97F4A7C15


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some texts, and the number of passages of each text."""
    rows = [(t or "").encode() + b"\n" for t in texts]
    data = np.frombuffer(b"".join(rows), dtype=np.uint8)
    ends = np.cumsum([len(r) for r in rows])
    n = len(data)
    space = _SPACE[data]
    before = np.append(True, space[:-1])
    start = np.flatnonzero(~space & before)
    stop = np.flatnonzero(space & ~before)  # every text ends in white space
    doc_of_word = np.searchsorted(ends, start, side="right")
    words = np.bincount(doc_of_word, minlength=len(texts))
    first_word = np.cumsum(words) - words
    count = np.maximum(1, -(-words // PASSAGE))
    first = np.cumsum(count) - count
    of_word = first[doc_of_word] + (np.arange(len(start)) - first_word[doc_of_word]) // PASSAGE
    total = int(count.sum())
    out = np.zeros((total, N_FEATURES), dtype=np.float32)
    if not len(start):
        return out, count
    # A passage's bytes: from its first word to the next passage of the text, or to the text's end.
    lead = np.flatnonzero(np.append(True, of_word[1:] != of_word[:-1]))
    p = of_word[lead]
    lo = start[lead]
    hi = np.minimum(np.append(lo[1:], n), ends[np.searchsorted(ends, lo, side="right")])
    width = hi - lo
    at = np.repeat(np.arange(len(p)), width)
    take = np.arange(int(width.sum())) + np.repeat(lo - (np.cumsum(width) - width), width)
    b = data[take]
    fine = np.bincount(at * N_FINE + FINE[b], minlength=len(p) * N_FINE).reshape(len(p), N_FINE)
    coarse = COARSE[b]
    same = at[1:] == at[:-1]
    pair = np.bincount(
        (at[1:] * 64 + coarse[:-1] * 8 + coarse[1:])[same], minlength=len(p) * 64
    ).reshape(len(p), 64)
    w = np.bincount(of_word, minlength=total)[p]
    length = (stop - start).astype(np.float64)
    powers, inverse = _powers(n, _PRIME), _powers(n, pow(_PRIME, -1, 1 << 64))
    sums = np.append(np.zeros(1, np.uint64), np.cumsum(powers * (data.astype(np.uint64) + np.uint64(1)), dtype=np.uint64))
    h = (sums[stop] - sums[start]) * inverse[start]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    place = np.searchsorted(p, of_word)

    def mean(x: np.ndarray) -> np.ndarray:
        return np.bincount(place, weights=x, minlength=len(p)) / w

    repeat = np.append(False, (h[1:] == h[:-1]) & (place[1:] == place[:-1]))
    order = np.lexsort((h, place))
    new = np.append(True, (h[order][1:] != h[order][:-1]) | (place[order][1:] != place[order][:-1]))
    variety = np.bincount(place[order][new], minlength=len(p)) / w
    lead_byte, last_byte = FINE[data[start]], FINE[data[stop - 1]]
    m = mean(length)
    stats = np.stack(
        [
            m / 10,
            np.sqrt(np.maximum(mean(length**2) - m * m, 0)) / 10,
            mean(repeat),
            variety,
            mean(lead_byte == 2),
            mean((lead_byte == 2) & (last_byte != 1) & (length > 1)),
            mean(last_byte > 10),
            mean(lead_byte > 10),
            np.log1p(w) / 4,
        ],
        axis=1,
    )
    hashed = np.bincount(place * HASHED + (h % np.uint64(HASHED)).astype(np.int64), minlength=len(p) * HASHED)
    hashed = hashed.reshape(len(p), HASHED)
    out[p] = np.hstack([np.sqrt(fine / width[:, None]), np.sqrt(pair / width[:, None]), stats, hashed / w[:, None]])
    return out, count


class Network:
    """Gated attention over passage vectors; `p` holds its arrays."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    def forward(self, x: np.ndarray, count: np.ndarray) -> dict:
        p, starts = self.p, np.cumsum(count) - count
        doc = np.repeat(np.arange(len(count)), count)
        hid = np.tanh((x - p["mean"]) / p["std"] @ p["w"] + p["b"])
        t, s = np.tanh(hid @ p["v"]), 1 / (1 + np.exp(-(hid @ p["u"])))
        e = (t * s) @ p["a"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[doc])
        att = e / np.add.reduceat(e, starts)[doc]
        z = np.add.reduceat(att[:, None] * hid, starts)
        return {"hid": hid, "t": t, "s": s, "att": att, "z": z, "doc": doc, "starts": starts, "y": z @ p["c"] + p["d"]}

    def score(self, x: np.ndarray, count: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.forward(x, count)["y"]))

    def gradient(self, x: np.ndarray, count: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, count)
        hid, t, s, att, doc, starts = (f[k] for k in ("hid", "t", "s", "att", "doc", "starts"))
        dy = (1 / (1 + np.exp(-f["y"])) - y) / len(y)
        dz = dy[:, None] * p["c"][None, :]
        datt = (dz[doc] * hid).sum(axis=1)
        de = att * (datt - np.add.reduceat(att * datt, starts)[doc])
        dg = de[:, None] * p["a"][None, :]
        dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
        dpre = (att[:, None] * dz[doc] + dt @ p["v"].T + ds @ p["u"].T) * (1 - hid * hid)
        xs = (x - p["mean"]) / p["std"]
        return {
            "w": xs.T @ dpre, "b": dpre.sum(axis=0), "v": hid.T @ dt, "u": hid.T @ ds,
            "a": (t * s).T @ de, "c": f["z"].T @ dy, "d": np.array([dy.sum()]),
        }


def fit(x: np.ndarray, count: np.ndarray, y: np.ndarray, options: QualityOptions) -> Network:
    """A network from passages `x`, their number per document and the documents' labels."""
    rng = np.random.default_rng(options.seed)
    h, g = options.hidden, options.gates
    # Rare features keep a floor under their spread, so that a value never seen in the sample cannot overwhelm a score.
    p = {
        "mean": x.mean(axis=0, dtype=np.float64) if len(x) else np.zeros(N_FEATURES),
        "std": np.maximum(x.std(axis=0, dtype=np.float64), 0.02) if len(x) else np.ones(N_FEATURES),
        "w": rng.normal(0, 1 / np.sqrt(N_FEATURES), (N_FEATURES, h)), "b": np.zeros(h),
        "v": rng.normal(0, 1 / np.sqrt(h), (h, g)), "u": rng.normal(0, 1 / np.sqrt(h), (h, g)),
        "a": rng.normal(0, 1 / np.sqrt(g), g), "c": rng.normal(0, 1 / np.sqrt(h), h), "d": np.zeros(1),
    }
    net = Network(p)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        p["c"][:], p["d"][:] = 0, np.log(share / (1 - share))
        return net
    first = np.cumsum(count) - count
    moment = {k: (np.zeros_like(p[k]), np.zeros_like(p[k])) for k in "w b v u a c d".split()}
    step = 0
    for _ in range(options.epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), options.batch):
            docs = order[lo : lo + options.batch]
            rows = np.concatenate([np.arange(first[d], first[d] + count[d]) for d in docs])
            step += 1
            for k, grad in net.gradient(x[rows].astype(np.float64), count[docs], y[docs]).items():
                m, v = moment[k]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                p[k] -= options.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
                if k in "wvu":
                    p[k] *= 1 - options.rate * options.decay
    return net


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves no remainder modulo 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, options: QualityOptions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages, passages per document and labels of the labelled documents with the smallest hashes of their ids."""
    known = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("q"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(options.fit_documents)
    )
    most = options.fit_passages

    def work(column: pa.Array) -> pa.Array:
        found = []
        for t in column.to_pylist():
            x, count = passages([t])
            some = np.unique(np.linspace(0, count[0] - 1, min(most, int(count[0]))).astype(int))
            found.append(x[some].tobytes())
        return pa.array(found, pa.binary())

    # At most `fit_documents` rows, so the broadcast has a fixed bound. Of an id that repeats, the text with the smallest hash
    # stands for all, chosen before passages are made.
    one = (
        docs.join(F.broadcast(known), "doc_id")
        .groupBy("doc_id", "q")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    )
    rows = one.select("doc_id", (F.col("q") >= 0.5).cast("double").alias("y"), F.arrow_udf(work, "binary")("text").alias("x"))
    rows = sorted(rows.collect(), key=lambda r: r.doc_id)
    parts = [np.frombuffer(r.x, dtype=np.float32).reshape(-1, N_FEATURES) for r in rows]
    x = np.vstack([np.zeros((0, N_FEATURES), np.float32), *parts])
    return x, np.array([len(q) for q in parts], dtype=np.int64), np.array([r.y for r in rows])


def scorer(net: Network):
    """A column function that scores texts with `net`."""

    def work(column: pa.Array) -> pa.Array:
        out, some, size = [np.zeros(0)], [], 0
        texts = column.to_pylist()
        for k, t in enumerate(texts):
            some.append(t)
            size += len(t or "")
            if size >= AT_ONCE or k == len(texts) - 1:
                out.append(net.score(*passages(some)))
                some, size = [], 0
        return pa.array(np.concatenate(out), pa.float64())

    return F.arrow_udf(work, "double")


def scored_documents(docs: DataFrame, labels: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """`docs` with `held_out`, `score` and `predicted`; columns of these names are replaced."""
    ready_workers(docs.sparkSession)
    net = fit(*training_sample(docs.select("doc_id", "text"), labels, options), options)
    scored = docs.withColumn("held_out", held_out(F.col("doc_id"))).withColumn("score", scorer(net)(F.col("text")))
    return scored.withColumn("predicted", (F.col("score") >= options.threshold).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """The rows of `docs` that are not rejected, with all their columns as they were."""
    rows = docs.select("doc_id", "text", F.struct("*").alias("row"))
    return scored_documents(rows, labels, options).where("predicted = 1").select("row.*")
