"""Importance resampling, language codes and the filter audit against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadcast.llm import filter_audit, importance, lang_codes
from loadcast.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- filter audit ---------------------------------------------------------------------------------------------------


def plain_audit(rows, labels):
    """(part, order, step) -> counts, straight from the definition."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    fails = []
    for i, text, _, source in rows:
        t = text or ""
        w = WORD.findall(t)
        f = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and i > least[t],
        }
        fails.append((source or "", {k for k, v in f.items() if v}, i in good, i in toxic))
    out = {}
    for part in {p for p, *_ in fails}:
        own = [x for x in fails if x[0] == part]
        removed_by = Counter()
        for order in itertools.permutations("ABCDE"):
            gone = set()
            for k, c in enumerate(order):
                hit = [n for n, x in enumerate(own) if c in x[1] and n not in gone]
                redundant = sum(c in x[1] and n in gone for n, x in enumerate(own))
                gone |= set(hit)
                removed_by[c] += len(hit)
                out[part, "".join(order), k + 1] = [
                    len(own) - len(gone), len(hit), redundant, sum(x[1] == {c} for x in own),
                    sum(own[n][2] for n in hit), sum(own[n][3] for n in hit),
                ]
        for key in [k for k in out if k[0] == part]:
            out[key].append(removed_by[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, path, labels, **options):
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.filter_interactions(spark, path, labels, filter_audit.AuditOptions(**options))
    assert got.columns == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    rows = got.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(out) == len(rows)
    return out


def audit_rows():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [None, "", "x", "AB CD", " ".join(["same"] * 300), "# " + " ".join(rng.choices(vocabulary, k=250))]
    texts += [" ".join(rng.choices(vocabulary, k=rng.choice([50, 220, 300]))) + rng.choice(["", " $", " ABCDEFGHIJ" * 9]) for _ in range(12)]
    rows = [(i, rng.choice(texts), "en", rng.choice(["a", "b", None, ""])) for i in rng.sample(range(1 << 60, (1 << 60) + 500), 160)]
    rows += [(None, texts[7], "en", "a"), (None, texts[7], "en", "b"), rows[0], rows[0][:3] + ("other",)]
    return rows, texts


def test_audit_retracts_earlier_masks(spark, folder):
    rows, _ = audit_rows()
    labels = [(r[0], k % 2, k % 3 == 0) for k, r in enumerate(rows[::2]) if r[0]]
    labels = [(i, q, int(t)) for i, q, t in labels] + [(rows[0][0], 1, 1), (rows[0][0], 0, 0), (7, 1, 1), (None, 1, 1), (rows[1][0], None, None)]
    # Larger ids come in earlier files, so that almost every later batch takes something back.
    for k, lo in enumerate(range(0, len(rows), 20)):
        some = sorted(rows, key=lambda r: -(r[0] or 0))[lo : lo + 20]
        spark.createDataFrame(some, DOCS).withColumn("mask", F.lit("x")).coalesce(1).write.mode("append").parquet(f"{folder}/docs")
    got = audited(spark, f"{folder}/docs", labels, least_batch=1, batches=100, texts_at_once=3)
    assert got == plain_audit(rows, labels)


def test_audit_of_one_file_and_of_nothing(spark, folder):
    rows, _ = audit_rows()
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(f"{folder}/one")
    assert audited(spark, f"{folder}/one", []) == plain_audit(rows, [])
    spark.createDataFrame([], DOCS).write.parquet(f"{folder}/none")
    assert audited(spark, f"{folder}/none/", [(1, 1, 1)]) == {}


def test_audit_of_the_given_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source")
    labels = [tuple(r) for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in QUERIES["op13_filter_audit"](spark, SMALL).collect()}
    assert got == plain_audit([tuple(r) for r in docs.collect()], labels)


# --- importance resampling ------------------------------------------------------------------------------------------


def plain_features(text, most):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return [" ".join(w[i : i + n]) for n in range(1, most + 1) for i in range(len(w) - n + 1)], len(w)


def plain_resample(rows, target, o):
    def buckets(text):
        return [zlib.crc32(f.encode()) % o.buckets for f in plain_features(text, o.most)[0]]

    s, t = (Counter(b for x in texts for b in buckets(x)) for texts in ([x for _, x in rows], target))
    n, m = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(float(t[b] + 1) * (n + o.buckets) / (float(s[b] + 1) * (m + o.buckets)))) for b in range(o.buckets)]
    out = []
    for i, text in rows:
        own = buckets(text)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{o.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(own), weight, score, None, plain_features(text, o.most)[1] >= o.least_words])
    order = sorted((x for x in out if x[5]), key=lambda x: (-x[3], -math.inf if x[0] is None else x[0], x[1], x[2]))
    for k, x in enumerate(order[: o.percent * len(order) // 100]):
        x[4] = k + 1
    return sorted((tuple(x[:5]) for x in out), key=repr)


@pytest.mark.parametrize("most", [1, 3])
def test_resampling_equals_plain_version(spark, most):
    rng = random.Random(most)
    vocabulary = [*"abcdefgh", "Ärger", "naïve", "X1", "déjà", "日本", "it's", "a_b"]
    rows = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(60)))) for k in range(150)]
    rows += [(None, "a b " * 15), (3, None), (4, ""), (5, " \n!? "), (6, "z" * 5000), (900, "a b c " * 3000)]
    rows += [(7, "a b c d " * 10)] * 40
    target = ["a b a b c", None, "", "日本 naïve a b", "new words only"]
    o = importance.ResampleOptions(most=most, buckets=97, percent=37)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("weight", F.lit("x"))
    got = importance.resampled(docs, spark.createDataFrame([(x,) for x in target], "text string"), o)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_resample(rows, target, o)


def test_pieces_of_words_do_not_lose_runs(monkeypatch):
    texts = ["a b c d e", None, "f", "", "g h A b", "one two three four five six seven"]
    want = [Counter((zlib.crc32(f.encode()), k) for k, t in enumerate(texts) for f in plain_features(t, most)[0]) for most in (1, 2, 4)]
    for size in (1, 2, 3, 100):
        monkeypatch.setattr(importance, "AT_ONCE", size)
        for most, expected in zip((1, 2, 4), want, strict=True):
            found = Counter()
            for hashes, doc in importance.word_pieces(texts, most):
                found.update(zip(hashes.tolist(), doc.tolist(), strict=True))
            assert found == expected


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resampled(none, none).count() == 0
    one = importance.resampled(spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string"), none).collect()
    assert len(one) == 1 and one[0]["rank"] is None


# --- language codes -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("k", [1, 2, 3, 4, 7, 8, 30])
def test_codewords_are_far_apart(k):
    code = lang_codes.codewords(k, 1)
    assert code.shape[0] == k and set(np.unique(code)) <= {-1, 1}
    assert all(0 < (c == 1).sum() < k for c in code.T)
    assert len({tuple(c) for c in code.T * code[0][:, None]}) == code.shape[1]
    for a, b in itertools.combinations(code, 2):
        assert (a != b).sum() >= (2 ** (k - 2) if k <= 7 else 0.3 * code.shape[1])


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = QUERIES["op12_language_codes"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in got)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_many_languages_and_ambiguous_texts(spark):
    rng = random.Random(5)
    alphabets = ["".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 9)) for _ in range(12)]

    def text(k, n):
        return " ".join("".join(rng.choices(alphabets[k], k=rng.randrange(2, 8))) for _ in range(n))

    rows = [(i, text(i % 12, 40), f"l{i % 12:02d}", "s") for i in range(900)]
    rows += [(1000, None, "l00", "s"), (1001, "", None, "s"), (1002, "123 ?! ٣", "l01", "s"), (None, text(3, 40), "l05", "s")]
    rows += [(2000 + k, " ".join(text(j, 30) for j in (k, (k + 1) % 12)), None, "s") for k in range(12)]
    rows += [(3000, text(4, 60_000), None, "s")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("x")).withColumn("h", F.lit("x"))
    got = {r.doc_id: r for r in lang_codes.identified(docs).collect()}
    held = [i for i, *_ in rows[:900] if got[i].held_out]
    assert sum(got[i].lang_pred == f"l{i % 12:02d}" for i in held) >= 0.97 * len(held)
    for i in (1000, 1001, 1002):
        assert (got[i].lang_pred, got[i].score) == ("und", 0)
    assert got[None].lang_pred == "l03" and got[None].held_out is False
    assert got[3000].lang_pred == "l04"
    clear = sum(got[i].ambiguous for i in range(900)) / 900
    assert sum(got[2000 + k].ambiguous for k in range(12)) / 12 > clear
    assert all(got[2000 + k].lang_pred in (f"l{k:02d}", f"l{(k + 1) % 12:02d}") for k in range(12))
    with pytest.raises(ValueError):
        lang_codes.identified(docs, lang_codes.CodeOptions(max_languages=11))


def test_one_language_and_none(spark):
    learn = [(i, "abc def ghi", "xx", "s") for i in range(20)]
    one = lang_codes.identified(spark.createDataFrame([*learn, (99, "zzz", None, "s"), (98, "9", None, "s")], DOCS)).collect()
    assert {(r.lang_pred, r.score) for r in one if r.doc_id != 98} == {("xx", 1.0)}
    assert [r.lang_pred for r in one if r.doc_id == 98] == ["und"]
    none = lang_codes.identified(spark.createDataFrame([(1, "abc", None, "s")], DOCS)).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert lang_codes.identified(spark.createDataFrame([], DOCS)).count() == 0


def test_features_of_long_texts_are_those_of_their_pieces(monkeypatch):
    texts = ["Déjà vu, encore 3 fois; " * 50, "", "x"]
    whole = lang_codes.ngram_counts(texts, 256)
    assert np.allclose((whole**2).sum(axis=1)[[0, 2]], 1, atol=1e-5)
    monkeypatch.setattr(lang_codes, "AT_ONCE", 24 * 10)
    assert np.abs(lang_codes.ngram_counts(texts, 256) - whole).max() < 0.02
