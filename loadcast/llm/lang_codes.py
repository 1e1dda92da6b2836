"""Language identification by error-correcting output codes.

Every language gets a codeword of bits, one binary classifier over hashed character n-grams predicts each bit, and the
codeword with the least weighted loss names the language. For up to seven languages the code is exhaustive (every split of
the languages into two groups is a bit), beyond that random dense with the largest least distance of many draws. A bit's loss
counts for a language by the accuracy that the bit has on documents of that language that were kept out of its fit, so
that splits that a classifier cannot tell apart weigh little. A document is ambiguous if the two nearest codewords are close.

Features are runs of one to three characters of the lower-cased text, everything but letters being one space, hashed to
`buckets`, as square roots of counts and of length one. Whole texts are read, in pieces of bounded size.

The classifiers are fitted on a bounded sample (`fit_documents`, shared evenly among the languages: the smallest hashes of
each); every document is scored. More than `max_languages` distinct values are an error, not a cut.

Cases: a null text and one without a letter are `und` with score 0; null languages and null ids are never learned from;
of several texts for an id and language the one with the smallest hash is learned from; with one language every text with a
letter gets it with score 1, with none `und`; ties go to the language that sorts first; columns of the result's names are
replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadcast.llm.common import ready_workers

UNKNOWN = "und"


@dataclass(frozen=True)
class CodeOptions:
    buckets: int = 4096
    fit_documents: int = 3000
    max_languages: int = 1000
    epochs: int = 12
    batch: int = 64
    rate: float = 0.05
    decay: float = 1e-4
    #: A document is ambiguous if the second language's score comes this near to the first's.
    least_gap: float = 0.2
    seed: int = 12


#: Characters worked on at once, and documents of one matrix.
AT_ONCE, DOCS = 1_000_000, 64
OTHER = re.compile(r"[\W\d_]+")
#: Odd numbers that spread the characters of a run.
_SPREAD = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def ngram_counts(texts: list[str], buckets: int) -> np.ndarray:
    """Hashed n-grams of one to three characters per text, as square roots of counts and of length one."""
    out = np.zeros((len(texts), buckets), dtype=np.float32)
    shift = np.uint32(32 - (buckets - 1).bit_length())
    for k, text in enumerate(texts):
        total = np.zeros(buckets, dtype=np.int64)
        for lo in range(0, len(text), AT_ONCE):
            plain = f" {OTHER.sub(' ', text[lo : lo + AT_ONCE].lower()).strip()} "
            c = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            h = np.zeros(len(c), dtype=np.uint32)
            for n, spread in enumerate(_SPREAD):
                if len(c) <= n:
                    break
                h = h[: len(c) - n] * np.uint32(0x01000193) + (c[n:] + np.uint32(n)) * np.uint32(spread)
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)
                total += np.bincount((mixed >> shift) % np.uint32(buckets), minlength=buckets)
        out[k] = np.sqrt(total)
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-12)


def codewords(k: int, seed: int) -> np.ndarray:
    """A row of +1 and -1 for each of `k` languages; columns are distinct splits with both groups in use."""
    if k <= 7:
        bits = 2 ** max(k - 1, 0) - 1
        return np.array([[1 if j == 0 or not (b >> (j - 1)) & 1 else -1 for b in range(1, bits + 1)] for j in range(k)]).reshape(k, bits)
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(k)))
    best, least = None, -1
    for _ in range(20):
        code = rng.choice([-1, 1], size=(k, bits))
        code = np.unique(code * code[:1], axis=1)  # a split and its mirror image are the same
        code = code[:, np.abs(code.sum(axis=0)) < k]
        near = ((code.shape[1] - code @ code.T) // 2 + np.eye(k, dtype=int) * code.shape[1]).min()
        if near > least:
            best, least = code, near
    return best


class Codes:
    """Languages in order, their codewords, the bits' classifiers and the weight of every bit for every language."""

    def __init__(self, names: list[str], code: np.ndarray, w: np.ndarray, b: np.ndarray, trust: np.ndarray):
        self.names, self.code, self.w, self.b, self.trust = names, code, w, b, trust

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w + self.b

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Share of each language: the smaller the weighted loss of its codeword, the larger."""
        if not self.code.shape[1]:
            return np.ones((len(x), len(self.names)))
        m = self.margins(x)
        loss = np.logaddexp(0, -m[:, None, :] * self.code[None, :, :])
        loss = (loss * self.trust[None, :, :]).sum(axis=2) * self.code.shape[1]
        e = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return e / e.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, y: list[str], options: CodeOptions) -> Codes:
    """Logistic classifiers of all bits at once; every fifth document of a language measures them."""
    names = sorted(set(y))
    label = np.array([names.index(v) for v in y], dtype=np.int64)
    code = codewords(len(names), options.seed)
    bits = code.shape[1]
    w, b = np.zeros((x.shape[1], bits)), np.zeros(bits)
    rng = np.random.default_rng(options.seed)
    place = np.zeros(len(label), dtype=np.int64)
    for k in range(len(names)):
        own = np.flatnonzero(label == k)
        place[own] = np.arange(len(own))
    aside = place % 5 == 4
    # Languages count alike in the fit, however many documents the sample has of them.
    share = 1 / np.maximum(np.bincount(label[~aside], minlength=len(names)), 1)
    own = np.flatnonzero(~aside)
    weight = share[label] * len(own) / max(len(names), 1)
    moment = [np.zeros_like(w), np.zeros_like(b)]
    for _ in range(options.epochs if bits else 0):
        rng.shuffle(own)
        for lo in range(0, len(own), options.batch):
            some = own[lo : lo + options.batch]
            xs, target = x[some].astype(np.float64), code[label[some]]
            slope = -target / (1 + np.exp(np.clip(target * (xs @ w + b), -60, 60))) * weight[some][:, None] / len(some)
            for value, grad, m in ((w, xs.T @ slope + options.decay * w, moment[0]), (b, slope.sum(axis=0), moment[1])):
                m += grad * grad
                value -= options.rate * len(some) ** 0.5 * grad / np.sqrt(m + 1e-8)
    trust = np.ones_like(code, dtype=np.float64)
    for k in range(len(names) if bits else 0):
        rows = np.flatnonzero((label == k) & aside)
        if len(rows):
            # Accuracy above chance, never quite nothing.
            right = ((x[rows] @ w + b) * code[k] > 0).mean(axis=0)
            trust[k] = np.maximum(2 * right - 1, 0.05)
    trust = trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-12)
    return Codes(names, code, w, b, trust)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves no remainder modulo 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, options: CodeOptions) -> tuple[np.ndarray, list[str]]:
    """Features and languages of the sample."""
    rows = docs.where("lang is not null and text is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    found = rows.select("lang").distinct().limit(options.max_languages + 1).count()
    if found > options.max_languages:
        raise ValueError(f"more than {options.max_languages} languages")
    if not found:
        return np.zeros((0, options.buckets), np.float32), []
    each = max(2, options.fit_documents // found)
    # First the smallest hashes in each of 256 shares of a language, then those of the language: no task gets one whole.
    ids = rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).distinct().withColumn("share", F.pmod("h", F.lit(256)))
    for keys in (["lang", "share"], ["lang"]):
        first = Window.partitionBy(*keys).orderBy("h", "doc_id")
        ids = ids.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= each)
    ids = ids.select("lang", "doc_id", "nth")
    buckets = options.buckets

    def work(column: pa.Array) -> pa.Array:
        return pa.array([ngram_counts([t], buckets).tobytes() for t in column.to_pylist()], pa.binary())

    # At most `fit_documents` ids (or two a language), so the broadcast has a fixed bound.
    one = rows.join(F.broadcast(ids), ["lang", "doc_id"]).groupBy("lang", "doc_id", "nth")
    one = one.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    got = one.select("lang", "doc_id", "nth", F.arrow_udf(work, "binary")("text").alias("x")).collect()
    got.sort(key=lambda r: (r.nth, r.lang, r.doc_id))
    x = [np.frombuffer(r.x, dtype=np.float32) for r in got]
    return np.vstack([np.zeros((0, buckets), np.float32), *x]), [r.lang for r in got]


def predictor(codes: Codes, options: CodeOptions):
    """A column function: language, score and whether the second language is near."""
    names, buckets = codes.names, options.buckets

    def work(column: pa.Array) -> pa.Array:
        texts = column.to_pylist()
        lang, score, near = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        some = [k for k, t in enumerate(texts) if names and t and any(map(str.isalpha, t))]
        for lo in range(0, len(some), DOCS):
            at = some[lo : lo + DOCS]
            p = codes.scores(ngram_counts([texts[k] for k in at], buckets))
            best = p.argmax(axis=1)
            top = p[np.arange(len(at)), best]
            p[np.arange(len(at)), best] = -np.inf
            for k, j, s, second in zip(at, best, top, p.max(axis=1), strict=True):
                lang[k], score[k], near[k] = names[j], s, s - second < options.least_gap
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(near, pa.bool_())], ["lang_pred", "score", "ambiguous"]
        )

    return F.arrow_udf(work, "lang_pred string, score double, ambiguous boolean")


def identified(docs: DataFrame, options: CodeOptions = CodeOptions()) -> DataFrame:
    """`docs` with `held_out`, `lang_pred`, `score` and `ambiguous`."""
    ready_workers(docs.sparkSession)
    codes = fit(*training_sample(docs.select("doc_id", "text", "lang"), options), options)
    found = docs.withColumn("held_out", held_out(F.col("doc_id"))).withColumn("_found", predictor(codes, options)(F.col("text")))
    return found.withColumns({c: F.col(f"_found.{c}") for c in ("lang_pred", "score", "ambiguous")}).drop("_found")
