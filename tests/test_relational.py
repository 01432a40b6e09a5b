"""Relational reports: balance, histogram, pivot, mesh, terms, skew helpers."""

import math

import pytest
from pyspark.sql import functions as F

from penmark.operators import features as FE
from penmark.operators import ingest as I
from penmark.operators import metrics as M
from penmark.operators import skew
from penmark.operators import terms as TM


def test_balanced_sample_equal_classes(spark):
    rows = [(i, "a") for i in range(5)] + [(10 + i, "b") for i in range(3)] + [(20 + i, "c") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, author string")
    out = M.balanced_sample(df, "doc_id")
    counts = {r["author"]: r["count"] for r in out.groupBy("author").count().collect()}
    assert counts == {"a": 3, "b": 3, "c": 3}
    # exact: the three smallest keys of each author
    keyed = df.withColumn("k", M.shuffle_key("doc_id")).collect()
    for a in "abc":
        want = sorted((r["k"], r["doc_id"]) for r in keyed if r["author"] == a)[:3]
        got = sorted((r["shuffle_key"], r["doc_id"]) for r in out.collect() if r["author"] == a)
        assert got == want


def test_smallest_k_handles_hot_group(spark):
    rows = [(i, "hot") for i in range(3000)] + [(10_000 + i, "cold") for i in range(7)]
    df = spark.createDataFrame(rows, "id long, g string").withColumn("key", F.md5(F.col("id").cast("string")))
    out = skew.smallest_k_per_group(df, "g", "key", 500, prefix=2).collect()
    hot = sorted(r["key"] for r in out if r["g"] == "hot")
    assert len(hot) == 500
    assert hot == sorted(r["key"] for r in df.filter("g = 'hot'").collect())[:500]
    assert len([r for r in out if r["g"] == "cold"]) == 7


def test_histogram_equal_values(spark):
    df = spark.createDataFrame([("x", [4, 4, 4]), ("y", [1, 2, 11])],
                               "author string, number_of_words_each_sentence array<int>")
    h = {(r["author"], r["bin"]): r["n"] for r in M.sentence_length_histogram(df).collect()}
    assert h[("x", 25)] == 3
    assert h[("y", 0)] == 1 and h[("y", 5)] == 1 and h[("y", 49)] == 1
    assert sum(v for (a, _), v in h.items() if a == "y") == 3


def test_grid_pivot_and_mesh(spark):
    long = spark.createDataFrame([(x, y, float(x * 10 + y)) for x in (1, 2) for y in (2, 3, 4)],
                                 "x int, y int, z double")
    wide = {r["y"]: (r["1"], r["2"]) for r in M.grid_pivot(long, "x", "y", "z").collect()}
    assert wide == {2: (12.0, 22.0), 3: (13.0, 23.0), 4: (14.0, 24.0)}
    assert M.grid_mesh(long, "x", "y").count() == 6


def test_grid_mesh_in_blocks(spark):
    """Axes of several blocks, null among their values, and an empty table."""
    long = spark.createDataFrame([(i % 23, f"y{i % 41}") for i in range(1000)] + [(None, "y0"), (5, None)], "x int, y string")
    want = {(x, y) for x in [*range(23), None] for y in [*(f"y{i}" for i in range(41)), None]}
    for sizes in ({}, {"x_block": 4, "y_block": 7}):
        got = M.grid_mesh(long, "x", "y", **sizes).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert M.grid_mesh(long.limit(0), "x", "y").count() == 0
    dup = long.unionByName(long.limit(1))
    with pytest.raises(Exception):
        M.grid_pivot(dup, "x", "y", "z").collect()


def test_tfidf_toy(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, ["b"])], "doc_id long, t array<string>")
    tf = FE.term_counts(docs, tokens=F.col("t"))
    n = docs.select(F.count(F.lit(1))).scalar()
    unsm = {r["term"]: r["idf"] for r in FE.document_frequency(tf, n, smooth=False).collect()}
    sm = {r["term"]: r["idf"] for r in FE.document_frequency(tf, n, smooth=True).collect()}
    assert unsm["b"] == pytest.approx(1.0) and sm["b"] == pytest.approx(1.0)
    assert sm["a"] == pytest.approx(1 + math.log(2))
    w = FE.tfidf(tf, FE.document_frequency(tf, n, smooth=True))
    norms = w.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n2")).collect()
    assert all(r["n2"] == pytest.approx(1.0) for r in norms)


def test_chi2_matches_direct_formula(spark):
    w = spark.createDataFrame([(1, "a", 1.0), (2, "a", 0.5), (2, "b", 1.0), (3, "b", 2.0)],
                              "doc_id long, term string, weight double")
    labels = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "doc_id long, lang string")
    got = {r["term"]: r["chi2"] for r in FE.chi2_scores(w, labels).collect()}
    # term a: O = (1.5, 0), total 1.5, shares (2/3, 1/3)
    ea = (1.0, 0.5)
    chi_a = (1.5 - ea[0]) ** 2 / ea[0] + (0 - ea[1]) ** 2 / ea[1]
    assert got["a"] == pytest.approx(chi_a)


def test_top_terms_ties_by_first_appearance(spark):
    df = spark.createDataFrame([(1, [["b", "a", "c"], ["a", "b", "d"]])], "doc_id long, sentences_words array<array<string>>")
    top = [(r["term"], r["n"]) for r in TM.top_terms(df, 3).orderBy("rank").collect()]
    assert top == [("b", 2), ("a", 2), ("c", 1)]
    bi = [(r["w1"], r["w2"], r["n"]) for r in TM.top_bigrams(df, 2, stopwords=[]).orderBy("rank").collect()]
    assert bi[0] == ("b", "a", 1)


def test_ingest_set_operations(spark):
    authors = spark.createDataFrame([("http://m/a\n",), ("http://m/b",), ("http://m//c",)], "author_url string")
    index = spark.createDataFrame([("http://m/a", "u1"), ("http://m/a", "u2")], "author_url string, article_url string")
    pend = sorted(r["author_url"] for r in I.pending_authors(authors, index).collect())
    assert pend == ["http://m//c", "http://m/b"]
    old = spark.createDataFrame([("x", "u1", 0, 0)], "author_url string, article_url string, page_id long, link_pos int")
    new = spark.createDataFrame([("y", "u1", 1, 0), ("y", "u3", 1, 1), ("z", "u3", 2, 0)],
                                "author_url string, article_url string, page_id long, link_pos int")
    merged = {r["article_url"]: r["author_url"] for r in I.upsert_url_index(old, new).collect()}
    assert merged == {"u1": "x", "u3": "y"}


def test_top_k_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, [["a", "b"], ["a"]])], "doc_id long, sentences_words array<array<string>>")
    plan = TM.top_terms(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_metrics_tokenise_once_per_article(spark):
    """The word arrays sit behind a Generate node, so the drop filter does not
    re-run the tokenisation inside its predicate."""
    df = spark.createDataFrame([(1, "A b. C.", "x")], "doc_id long, body string, author string")
    plan = M.article_metrics(df)._jdf.queryExecution().optimizedPlan().toString()
    filters = [ln for ln in plan.splitlines() if "Filter" in ln]
    assert filters and not any("regexp_extract_all" in ln for ln in filters)


def test_spread_only_when_under_parallel(spark):
    from penmark.session import spread
    few = spark.range(100).coalesce(1)
    assert spread(few, 4).rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(16)
    assert spread(many, 4) is many
