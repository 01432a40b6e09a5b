"""Substring dedup, SimHash, language identification and BPE: rules, edge cases, brute force."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from penmark.llm import substring_dedup as SD
from penmark.llm.bpe_speculative import Vocabulary, decode_documents, encode_documents
from penmark.llm.components import Forest, components
from penmark.llm.language_id import features, held_out, identify, train
from penmark.llm.simhash_pivots import one_per_group, pivots, simhash, simhash_groups, spanning_links

DOCS = "doc_id long, text string"
BPE = public_tokenizers.path("byte_bpe_50k.json")


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), DOCS)


def prose(seed, n, vocabulary=400):
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


# ------------------------------------------------------------------ substring dedup

def dedup_texts():
    a, b, c = prose(1, 300), prose(2, 200), prose(3, 60)
    return [None, "", " \n ", " ".join(prose(4, 34)), " ".join(prose(4, 35)), " ".join(prose(4, 35)),
            " ".join(a), " ".join(a[:150] + prose(5, 7) + a[150:]), "\n".join(prose(6, 20) + a[40:110] + prose(7, 40)),
            " ".join(b + c + b), " \t".join(c + prose(8, 30)), " ".join(["same"] * 90), " ".join(["same"] * 36),
            " ".join(a[:34]), " ".join(prose(9, 100)), " ".join(prose(9, 100)[:60] + ["x"] + prose(9, 100)[61:]),
            " ".join(["é", "ü"] * 40), " ".join(["é", "ü"] * 17)]


def test_substring_dedup_matches_brute_force(spark):
    texts = dedup_texts()
    rows = SD.substring_dedup(docs(spark, texts)).collect()
    got = sorted((r.row.doc_id, r.n_words, r.n_removed, r.kept) for r in rows)
    assert got == brute.repeated_windows(list(enumerate(texts)))
    for r in rows:
        assert r.n_removed == sum(b - a for a, b in r.spans) and all(b - a >= 35 for a, b in r.spans)


def test_substring_dedup_of_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(SD, "PIECE", 50)
    monkeypatch.setattr(SD, "BYTES", 64)
    words = [w.encode() for w in prose(1, 500)]
    whole = SD.text_words([b" ".join(words), b"", b" ".join(words[100:])])
    assert [len(w) for w in whole] == [500, 0, 400] and (whole[0][100:] == whole[2]).all()
    d, lo, hi, a, c = SD.blocks(whole)
    starts = sorted((k, s) for k, x, y in zip(d, lo, hi) for s in range(x, y + 1))
    assert starts == [(k, s) for k, n in ((0, 500), (2, 400)) for s in range(n - 34)]


def test_equal_windows_have_equal_anchors():
    rnd = random.Random(5)
    core = [f"c{rnd.randrange(9)}".encode() for _ in range(60)]
    one, two = SD.text_words([b" ".join([b"p"] * 3 + core), b" ".join([b"q"] * 50 + core + [b"r"])])
    _, lo, hi, a, c = SD.blocks([one])
    _, lo2, hi2, a2, c2 = SD.blocks([two])
    first = {s - 3: x for l, h, x in zip(lo, hi, a) for s in range(l, h + 1)}
    second = {s - 50: x for l, h, x in zip(lo2, hi2, a2) for s in range(l, h + 1)}
    assert all(first[s] == second[s] for s in range(26))


def test_substring_dedup_edges(spark):
    empty = SD.substring_dedup(docs(spark, []))
    assert empty.count() == 0
    some = spark.createDataFrame([(None, "x y", 1, 2)], "doc_id long, text string, n_words int, kept int")
    r = SD.substring_dedup(some).first()
    assert (r.row.doc_id, r.row.n_words, r.row.kept, r.n_words, r.n_removed, r.kept) == (None, 1, 2, 2, 0, "x y")


def test_substring_dedup_line_ends_that_are_words(spark):
    texts = ["word \u2028", "word \u0085", " word\t\u2029 ", "a \n b \u2028\n"]
    got = {r.row.doc_id: r.kept for r in SD.substring_dedup(docs(spark, texts)).collect()}
    assert [got[i] for i in range(4)] == ["word \u2028", "word \u0085", "word \u2029", "a b \u2028"]


# ------------------------------------------------------------------ SimHash

def test_simhash_matches_brute_force(spark):
    base = prose(1, 120)
    texts = [None, "", " ", "One", "one", "one two", " ".join(base), " ".join(base).upper().replace("W", "w"), " ".join(base + ["end"]),
             " ".join(base[:-1]), "É é Ä b c", " ".join(prose(2, 400)), " ".join(prose(2, 400)[:395]), "a " * 50]
    got = {r.doc_id: (f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in simhash_groups(docs(spark, texts)).collect()}
    assert got == brute.simhash_groups(list(enumerate(texts)))


@pytest.mark.parametrize("seed", range(4))
def test_spanning_links_connect_what_all_pairs_connect(seed):
    rng = np.random.default_rng(seed)
    centre = rng.integers(0, 2 ** 63, 30, dtype=np.uint64).repeat(12)
    fp = np.unique(centre ^ (np.uint64(1) << rng.integers(0, 64, 360, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 360, dtype=np.uint64)))
    table = np.stack([np.bitwise_count(fp ^ np.uint64(p)) for p in pivots()], axis=1).astype(np.uint8)
    bucket = rng.integers(0, 4, len(fp))
    i, j = spanning_links(bucket, fp, table, 3)
    pairs = [(x, y) for x in range(len(fp)) for y in range(x) if bucket[x] == bucket[y] and bin(int(fp[x] ^ fp[y])).count("1") <= 3]
    assert brute.component_ids(len(fp), pairs) == brute.component_ids(len(fp), list(zip(i.tolist(), j.tolist())))
    assert len(i) <= len(fp) * 8


def test_simhash_slices_long_texts(monkeypatch):
    from penmark.llm import simhash_pivots
    t = " ".join(prose(3, 1000))
    want = brute.simhash(t)
    monkeypatch.setattr(simhash_pivots, "SLICE", 64)
    assert simhash(t.encode()) & (1 << 64) - 1 == want


def test_one_per_group(spark):
    a, b, c = " ".join(prose(1, 50)), " ".join(prose(2, 50)), " ".join(prose(3, 50))
    rows = [(5, a, "x"), (2, a, "y"), (9, b, "x"), (9, b, "x"), (None, b, "z"), (None, c, "u"), (None, c, "u")]
    some = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    out = one_per_group(some)
    assert out.columns == some.columns
    assert sorted((str(r.doc_id), r.fp) for r in out.collect()) == [("2", "y"), ("9", "x"), ("None", "u")]
    assert one_per_group(some.limit(0)).count() == 0


def test_one_per_group_of_repeated_ids(spark):
    a, b, c, d = (" ".join(prose(i, 50)) for i in (1, 2, 3, 4))
    # id 1: two unrelated texts, one of them twice; d is a copy of a group whose smallest id has another text, too
    rows = [(1, a), (1, b), (1, b), (2, b), (3, d), (1, c), (4, c), (5, d)]
    out = one_per_group(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, out.collect())) == sorted([(1, a), (1, b), (1, c), (3, d)])


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7), (200, 150)] + [(300, i) for i in range(301, 330)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs + [(None, 3)], "u long, v long")).collect()}
    want = brute.component_ids(400, pairs)
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {x: want[x] for x in linked}


def test_forest_keeps_a_spanning_set():
    f = Forest(6)
    f.add(np.array([0, 1, 0]), np.array([1, 2, 2]))
    f.add(np.array([3]), np.array([2]))
    assert not f.apart(np.array([0]), np.array([3]))[0] and f.apart(np.array([0]), np.array([5]))[0]
    links = np.concatenate(f.links)
    assert brute.component_ids(6, links.tolist()) == [0, 0, 0, 0, 4, 5]


# ------------------------------------------------------------------ language

SAMPLE = {"en": "the quick brown fox and the lazy dog were there with them this evening",
          "de": "der schnelle braune fuchs und der faule hund waren heute abend nicht dort",
          "fr": "le renard brun et le chien paresseux étaient là avec eux pendant la soirée",
          "es": "el zorro marrón y el perro perezoso estaban allí con ellos durante la tarde"}


def labelled(spark):
    rnd = random.Random(0)
    rows = []
    for lang, text in SAMPLE.items():
        for _ in range(60):
            w = text.split()
            rnd.shuffle(w)
            rows.append((len(rows), " ".join(w), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_held_out_accuracy_and_edges(spark):
    rows = labelled(spark)
    model = train(rows.filter(~held_out(F.col("doc_id"))), per_language=40)
    assert set(model.families) == {"germanic", "romance"} and len(model.pair_w) == 2
    test = rows.filter(held_out(F.col("doc_id")))
    hits = identify(test, model).join(test, "doc_id").filter("lang = lang_pred").count()
    assert hits == test.count() > 30
    odd = docs(spark, [None, "", "123 !?", "\n", "der Hund und der Fuchs", "漢字"]).withColumn("lang_pred", F.lit(1))
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(odd, model).collect()}
    assert all(got[i] == ("und", 0.0) for i in range(4)) and got[4][0] == "de" and got[5][0] in SAMPLE
    assert all(0 <= s <= 1 for _, s in got.values())
    assert identify(odd.limit(0), model).count() == 0


def test_language_without_labels(spark):
    rows = labelled(spark).withColumn("lang", F.lit(None).cast("string"))
    got = identify(rows, train(rows)).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in got] == [("und", 0.0)]


def test_language_features_of_slices(monkeypatch):
    from penmark.llm import language_id
    t = "Der Hund, und -- die Katze 12 " * 40
    want = features(t)
    monkeypatch.setattr(language_id, "SLICE", 37)
    assert np.allclose(features(t), want)


def test_held_out_by_crc(spark):
    import zlib
    df = spark.createDataFrame([(i,) for i in (0, 1, 2, 17, -5, 10 ** 12)] + [(None,)], "doc_id long").select("doc_id", held_out(F.col("doc_id")).alias("h"))
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in df.collect())


# ------------------------------------------------------------------ BPE

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def vocabulary():
    with open(BPE, "rb") as f:
        return Vocabulary(f.read())


def fuzz(n):
    rnd = random.Random(n)
    alphabet = "abc ABC  \n\t'sll’é ñü漢字🙂👩‍👩‍👧\x1c\x1f\x85\xa0 ​٣Ⅷ½0123!?.,<|>endoftext"
    syllables = ["th", "er", "in", "tion", "on", "a", "s", "ing", "ed", "pre", "un", "xq", "zz", "lly", " ", "\n", " "]
    return (["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
            + ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 80))) for _ in range(n)])


ODD = ["", " ", "  ", "\n", "\n\n", "a\n b", "a \nb", " a", "a ", "\na", "a\n", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>",
       "<|endoftext|", "a" * 3000, "ab" * 1500, "the " * 300, "x\r\ny", "don't we'll 'tis 's", "﻿bom", "é"]


def test_encoding_equals_the_library(vocabulary, library):
    texts = ODD + fuzz(400)
    for text, got in zip(texts, vocabulary.encode_batch(texts)):
        ids = np.frombuffer(got, np.int32).tolist()
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text
        assert vocabulary.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_compatible_pairs_are_those_that_encode_to_themselves(vocabulary):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 50256, (2, 3000))
    a[:1500], b[:1500] = rng.integers(0, 1200, (2, 1500))
    want = [[x, y] == vocabulary.merge([vocabulary.token_bytes[x] + vocabulary.token_bytes[y]])[0].tolist() for x, y in zip(a, b)]
    assert vocabulary.compatible(a, b).tolist() == want and 0 < sum(want) < 3000


def test_long_texts_and_a_full_table(vocabulary, library, monkeypatch):
    from penmark.llm import bpe_speculative
    text = " ".join(fuzz(60))
    want = library.encode(text, add_special_tokens=False).ids
    for name, value in (("LONG_TEXT", 100), ("SLICE", 7), ("CACHE_PIECES", 50), ("LONG_PIECE", 3)):
        monkeypatch.setattr(bpe_speculative, name, value)
        vocabulary.cache = {}
        assert np.frombuffer(vocabulary.encode_batch([text, "a b"])[0], np.int32).tolist() == want


def test_words_are_encoded_in_bounded_blocks_and_forgotten(vocabulary, library, monkeypatch):
    from penmark.llm import bpe_speculative
    sizes, encode = [], vocabulary.encode_words
    monkeypatch.setattr(bpe_speculative, "WORD_BLOCK", 5)
    monkeypatch.setattr(bpe_speculative, "_LOADED", {"k": vocabulary})
    monkeypatch.setattr(vocabulary, "encode_words", lambda words: sizes.append(len(words)) or encode(words))
    vocabulary.cache = {}
    text = " ".join(fuzz(60))
    want = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(vocabulary.encode_batch([text])[0], np.int32).tolist() == want
    assert len(sizes) > 1 and max(sizes) <= 5 and vocabulary.cache
    bpe_speculative._forget()
    assert not vocabulary.cache


def test_encode_and_decode_documents(spark, library):
    texts = [None, "", "Hello world\n", "Hello world\n", "naïve 🙂<|endoftext|>"]
    some = docs(spark, texts).withColumn("ids", F.lit("mine")).withColumn("a.b", F.lit(1))
    out = decode_documents(encode_documents(some, BPE), BPE)
    assert set(out.columns) == {"doc_id", "text", "a.b", "ids", "decoded"}
    for r in out.collect():
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "")
    assert encode_documents(some.limit(0), BPE).count() == 0
    nothing = decode_documents(spark.createDataFrame([(None,)], "ids array<int>"), BPE).first()
    assert nothing.decoded == ""
