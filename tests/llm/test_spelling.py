"""Spelling variants against a plain version, and their edge cases."""

import collections
import random
import re
import zlib

import pytest

from penmark.llm import spelling_variants as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows, least_length=6, least_count=5, thinned=199):
    n = collections.Counter()
    for k, t in rows:
        for w in RUN.findall(t or ""):
            w = w.translate(UPPER)
            h = zlib.crc32(f"{'' if k is None else k}:{w}".encode())
            if h % thinned == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += len(w) >= least_length
    return {w: c for w, c in n.items() if c >= least_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain(n, ratio=5):
    rows, form = {}, {}
    for w in n:
        nb = [v for v in n if near(w, v)]
        best = min(nb, key=lambda v: (-n[v], v), default=None)
        form[w] = best if nb and n[best] >= ratio * n[w] else None
        rows[w] = (n[w], len(nb), n[best] if form[w] else None)
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, *rows[w]))
    return out


def words_of(rnd, n, alphabet):
    return {"".join(rnd.choices(alphabet, k=rnd.choice([1, 2, 3, 4, 5]))): rnd.choice([1, 1, 2, 5, 9, 30, 200]) for _ in range(n)}


@pytest.mark.parametrize("alphabet", ["ab", "aé", "abcÿ"])
def test_neighbours_against_plain(spark, alphabet):
    n = words_of(random.Random(5), 120, alphabet)
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = [(r["word"], r["near"]) for r in S.neighbours(words).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in n for b in n if near(a, b)}
    assert {tuple(r) for r in S.group_variants(words).collect()} == plain(n)


def test_long_chains_and_small_batches(spark):
    n = {"a" * i: 3 ** i for i in range(1, 25)}   # forms lead all the way up
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")   # runs go over batches
    try:
        got = {tuple(r) for r in S.group_variants(words, ratio=2).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == plain(n, ratio=2) and {r[2] for r in got} == {"a" * 24}


def test_texts_against_plain(spark):
    rnd = random.Random(9)
    vocab = ["Colour", "colour", "COLOUR", "color", "colours", "straße", "Straße", "strasse", "ÉTUDES", "études", "short", "x÷yzabc", "neighbour", "neighbor"]
    rows = [(i, rnd.choice([" ", "-", "1", "Ā"]).join(rnd.choices(vocab, k=rnd.choice([0, 5, 40])))) for i in range(300)]
    rows += [(7, rows[7][1]), (None, "colour neighbour " * 5), (900, None), (901, ""), (902, "neighbour " * 30_000)]
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, n string")
    n = plain_counts(rows, thinned=3)
    got = S.spelling_variants(docs, thinned=3)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == plain(n)
    assert any(r[1] for r in plain(n))


def test_slices_and_flushes(monkeypatch):
    text = ("Colour étude-neighbour 12 " * 50).encode()
    want = collections.Counter(RUN.findall(text.decode().translate(UPPER)))
    for size in (1, 5, 64):
        monkeypatch.setattr(S, "SLICE", size)
        assert sum(S.letter_runs(text, 1), collections.Counter()) == want


def test_empty_table(spark):
    assert S.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert S.spelling_variants(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect() == []
