"""Importance resampling against a plain version, and its edge cases."""

import hashlib
import math
import random
import re
import zlib

import pytest

from penmark.llm import importance_resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(t, max_n):
    w = WORD.findall((t or "").translate(UPPER))
    return w, [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def plain(rows, target, max_n=1, buckets=10_000, seed=2024, percent=10, least=20):
    """{(id, n_words, n_features, weight, score, rank)} with distinct ids."""
    def bucket(g):
        return zlib.crc32(g.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for g in grams(x, max_n)[1]:
                counts[bucket(g)] += 1
    big_s, big_t = sum(s) + buckets, sum(t) + buckets
    out = []
    for k, x in rows:
        w, f = grams(x, max_n)
        gain = [math.floor(1000 * math.log((t[b] + 1.0) * big_s / ((s[b] + 1.0) * big_t))) for b in map(bucket, f)]
        weight = sum(gain) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{k}".encode()).hexdigest()[:8], 16)
        out.append((k, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0]))
    rank = {x[0]: i + 1 for i, x in enumerate(able[:percent * len(able) // 100])}
    return {(*x, rank.get(x[0])) for x in out}


def texts(n, seed=3):
    rnd = random.Random(seed)
    vocab = ["straße", "ÉTÉ", "a1", "Über-all", "x_y", "the", "The", "naïve,co", "漢字", "7"] + [f"w{i}" for i in range(60)]
    return [rnd.choice([" ", "\n", ". "]).join(rnd.choices(vocab, k=rnd.choice([0, 3, 19, 20, 21, 60, 300]))) for _ in range(n)]


@pytest.mark.parametrize("max_n,slice_,batch", [(1, 1 << 20, 4 << 20), (3, 50, 400), (2, 7, 1), (1, 13, 100)])
def test_against_plain(spark, monkeypatch, max_n, slice_, batch):
    if slice_ < 1 << 20:   # the slices of whole texts, cut here as on very long ones
        found = list(R.features([x.lower().encode() for x in texts(30)], max_n, 97))
        monkeypatch.setattr(R, "SLICE", slice_)
        cut = list(R.features([x.lower().encode() for x in texts(30)], max_n, 97))
        for j in range(3):
            assert sorted(x for f in found for x in f[j].tolist()) == sorted(x for f in cut for x in f[j].tolist())
    rows = [(i, t) for i, t in enumerate(texts(120))] + [(500, None), (501, ""), (502, " .. "), (503, "Word " * 40_000)]
    target = texts(20, seed=8) + [None, ""]
    docs = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, score int")
    got = R.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), max_n=max_n, percent=30)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert {tuple(r) for r in got.collect()} == plain(rows, target, max_n, percent=30)


def test_repeated_rows_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, long)] * 50 + [(1, "w1 " * 25)] * 10 + [(None, long)] * 3 + [(2, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = R.resample(docs, docs.select("text"), percent=100).collect()
    assert len(got) == len(rows)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 64))
    assert [r["rank"] for r in got if r["n_words"] < 20] == [None]
    by_rank = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["score"] for r in by_rank] == sorted((r["score"] for r in by_rank), reverse=True)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert R.resample(none, some.select("text")).collect() == []
    r = R.resample(some, none.select("text"), percent=100).first()
    assert (r["n_features"], r["rank"]) == (40, 1)
    assert {tuple(x) for x in R.resample(some, none.select("text")).collect()} == plain([(1, "a b " * 20)], [])


def test_drawn_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts(60))], "doc_id long, text string, rank string")
    target = spark.createDataFrame([("w1 w2 w3 the",)], "text string")
    drawn = R.resampled_documents(docs, target, percent=50)
    want = {x[0] for x in plain([(r["doc_id"], r["text"]) for r in docs.collect()], ["w1 w2 w3 the"], percent=50) if x[-1]}
    assert drawn.columns == docs.columns and {r["doc_id"] for r in drawn.collect()} == want
