"""Cases that earlier versions got wrong."""

import pytest
from pyspark.sql import functions as F

from penmark.functions import text as T
from penmark.operators import features as FE
from penmark.operators import mlmodels as ML
from penmark.operators import textmodel as TX
from penmark.operators import sparse_linear as SL
from penmark.session import shared_path
from penmark.sources import files as IO


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first().y


def test_declared_count_of_any_length(spark):
    assert one(spark, "page 20261202123456 of 3", T.declared_count) == 20261202123456
    assert one(spark, "9" * 40, T.declared_count) is None
    assert one(spark, "none", T.declared_count) is None


def test_first_heading_present_wins_even_empty(spark):
    assert one(spark, "<h1></h1><h2>second</h2>", T.first_heading) == ""
    assert one(spark, "<h3>third</h3>", T.first_heading) == "third"
    assert one(spark, "<header>x</header>", T.first_heading) == ""


def test_links_of_anchors_only(spark):
    html = """<article href="/no"><a class=x href='/a?b=1&amp;c=2'>1</a><a data-href="/no" href = "/d">2</a><A HREF="/e">3</A><a>4</a>"""
    assert one(spark, html, T.links) == ["/a?b=1&c=2", "/d", "/e"]


def articles(spark, *rows):
    return spark.createDataFrame([(u, a, "h", "b") for u, a in rows], IO.ARTICLE)


def test_author_store_keeps_what_it_has(spark):
    path = shared_path(spark, "test", "authors")
    IO.write_articles_by_author(articles(spark, ("u1", "Ann"), ("u2", "Bob"), (None, "Ann")), path)
    IO.write_articles_by_author(articles(spark, ("u2", "Bob"), ("u3", "Ann"), (None, "Ann")), path)
    got = sorted(str(r.url) for r in spark.read.schema(IO.ARTICLE).json(path).collect())
    assert got == ["None", "u1", "u2", "u3"]


def test_url_index_is_swapped_in_while_it_is_read(spark):
    path = shared_path(spark, "test", "index")
    IO.write_url_index(spark.createDataFrame([("a", "1")], IO.URL_INDEX), path)
    IO.write_url_index(IO.read_url_index(spark, path).unionByName(spark.createDataFrame([("b", "2")], IO.URL_INDEX)), path)
    assert sorted(map(tuple, IO.read_url_index(spark, path).collect())) == [("a", "1"), ("b", "2")]


def test_unreadable_model_is_not_replaced(spark):
    path = shared_path(spark, "test", "model")
    spark.range(1).write.parquet(path)
    with pytest.raises(Exception):
        TX.load_or_train(spark, path, lambda: pytest.fail("must not train"))
    assert spark.read.parquet(path).count() == 1


def test_own_tokenizer_is_not_lost_silently(spark):
    t = ML.TokenTransformer()
    t.tokenizer = lambda c: F.split(c, " ")
    with pytest.raises(ValueError):
        t.write()
    ML.TokenTransformer().write()


def labelled(spark):
    rows = [(i, " ".join([f"{c}{j}" for j in range(i % 4, i % 4 + 5)] * 2), c) for i, c in enumerate("abc" * 8)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_vectors_hold_the_whole_vocabulary(spark):
    docs = labelled(spark)
    train, test = docs.filter("doc_id < 18"), docs.filter("doc_id >= 18").unionByName(
        spark.createDataFrame([(99, "zz zz", "unknown")], docs.schema))
    w, idf = FE.fit_tfidf(train, sublinear=True)
    v = ML.vectorise(train, test, w, FE.transform_tfidf(test, idf, sublinear=True), idf)
    assert v.size == idf.count() and {r.features.size for r in v.train.collect()} == {v.size}
    assert v.labels == ["a", "b", "c"] and v.test.filter("doc_id = 99").count() == 0
    cells = {(r.doc_id, round(x, 9)) for r in v.train.collect() for x in r.features.values.tolist()}
    assert cells == {(r.doc_id, round(r.weight, 9)) for r in w.collect()}
    index = sorted(r.idx for r in ML.term_index(idf).collect())
    assert index == list(range(v.size))
    assert {(r.doc_id, r.label == r.prediction) for r in v.named(ML.knn_sparse(v.train, v.test, 3)).collect()} == {
        (i, True) for i in range(18, 24)}


def test_mixing_does_not_depend_on_partitioning(spark):
    docs = labelled(spark)
    w, idf = FE.fit_tfidf(docs)
    v = ML.vectorise(docs, docs, w, w, idf)
    for rule in ("perceptron", "pa"):
        a = SL.fit(v.train.repartition(2), 3, rule, epochs=3, parts=4)
        b = SL.fit(v.train.repartition(7), 3, rule, epochs=3, parts=4)
        assert abs(a.array(v.size) - b.array(v.size)).max() == 0
        pred = v.named(SL.predict(v.train, a))
        assert pred.filter("label = prediction").count() == 24

def test_mixing_has_no_cell_limit_and_splits_into_parts(spark, monkeypatch):
    from pyspark.ml.linalg import SparseVector, VectorUDT
    from pyspark.sql import types as TY

    monkeypatch.setattr(SL, "PART_CELLS", 40)
    size = 2 ** 30   # two classes x 2^30 terms: no array of that size is made
    rows = [(i, f"n{i}", float(i % 2), SparseVector(size, [i % 2, size - 1 - i % 2], [1.0, 0.5])) for i in range(40)]
    rows.append((None, None, 0.0, SparseVector(size, [0], [1.0])))
    schema = TY.StructType([TY.StructField("doc_id", TY.LongType()), TY.StructField("name", TY.StringType()),
                            TY.StructField("label_idx", TY.DoubleType()), TY.StructField("features", VectorUDT())])
    df = spark.createDataFrame(rows, schema)
    for rule in ("perceptron", "pa"):
        w = SL.fit(df, 2, rule, epochs=3)
        assert {r.term for r in w.cells.collect()} <= {-1, 0, 1, size - 1, size - 2}
        out = SL.predict(df, w)
        assert out.columns == ["doc_id", "name", "label_idx", "prediction"] and out.count() == 41
        assert out.filter("prediction != label_idx").count() == 0
