"""Text models as tables: scoring, round trips, pluggable rules, odd rows."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from penmark.operators import textmodel as TX
from penmark.session import shared_path

TRAIN = [(1, "shared alpha", "A"), (2, "alpha alpha", "A"), (3, "shared alpha alpha", "A"),
         (4, "shared beta", "B"), (5, "beta beta", "B"), (6, "shared beta beta", "B")]
SCHEMA = "doc_id long, text string, lang string"


def predicted(model, df):
    return {r["doc_id"]: r["predicted"] for r in model.predict(df).collect()}


@pytest.mark.parametrize("classifier", [TX.MultinomialNB, TX.BernoulliNB(0.1), TX.NearestCentroid, TX.Linear, TX.Linear("svc", epochs=200),
                                        LogisticRegression])
def test_round_trip(spark, classifier):
    docs = spark.createDataFrame(TRAIN, SCHEMA)
    model = TX.fit_text_model(docs, classifier)
    path = shared_path(spark, "test", "model")
    TX.save_model(model, path)
    again = TX.load_model(spark, path)
    new = spark.createDataFrame([(10, "alpha shared", ""), (11, "beta", ""), (12, "Beta BETA unheard", "")], SCHEMA)
    for df in (docs, new):
        assert predicted(model, df) == predicted(again, df)
    assert predicted(again, docs) == {i: c for i, _, c in TRAIN}
    assert predicted(again, new) == {10: "A", 11: "B", 12: "B"}


def test_odd_rows_keep_their_own_result(spark):
    docs = spark.createDataFrame([*TRAIN, (7, "alpha", None), (8, None, "A"), (9, "", "A")], SCHEMA)
    model = TX.fit_text_model(docs)
    new = spark.createDataFrame([(1, "beta", "x"), (1, "beta", "x"), (1, "alpha", "y"), (2, None, "x"), (3, "", "x"), (4, "beta " * 50_000, "x")], SCHEMA)
    got = sorted((r["doc_id"], r["predicted"], r["lang"]) for r in model.predict(new).collect())
    assert got == [(1, "A", "y"), (1, "B", "x"), (1, "B", "x"), (2, "A", "x"), (3, "A", "x"), (4, "B", "x")]
    assert model.predict(new.limit(0)).count() == 0


def test_model_of_no_rows(spark):
    model = TX.fit_text_model(spark.createDataFrame([], SCHEMA))
    assert predicted(model, spark.createDataFrame([(1, "alpha", "A")], SCHEMA)) == {1: None}


def test_the_latest_save_counts(spark):
    path = shared_path(spark, "test", "model")
    docs = spark.createDataFrame(TRAIN, SCHEMA)
    TX.save_model(TX.fit_text_model(docs), path)
    TX.save_model(TX.fit_text_model(docs.withColumn("lang", F.lit("C"))), path)
    assert set(predicted(TX.load_model(spark, path), docs).values()) == {"C"}


def test_saved_model_is_loaded_not_trained(spark):
    path = shared_path(spark, "test", "model")
    docs = spark.createDataFrame(TRAIN, SCHEMA)
    TX.load_or_train(spark, path, lambda: TX.fit_text_model(docs))
    again = TX.load_or_train(spark, path, lambda: pytest.fail("must not train"))
    assert predicted(again, docs)[4] == "B"


class Majority:
    """A rule of the caller's own."""

    name = "majority"

    def params(self):
        return {}

    def fit(self, weights, labels):
        return {"top": labels.groupBy("class").count().orderBy(F.col("count").desc(), "class").limit(1).select("class")}

    def predict(self, tables, docs, weights):
        return docs.withColumn("prediction", tables["top"].scalar())


def test_own_rule(spark):
    path = shared_path(spark, "test", "model")
    docs = spark.createDataFrame([*TRAIN, (7, "beta", "B")], SCHEMA)
    TX.save_model(TX.fit_text_model(docs, Majority), path)
    with pytest.raises(KeyError):
        TX.load_model(spark, path)
    assert set(predicted(TX.load_model(spark, path, {"majority": Majority}), docs).values()) == {"B"}


def test_build_and_evaluate_saves_the_full_fit(spark):
    path = shared_path(spark, "test", "model")
    rows = [(i, f"{w} word{i % 7} {w}", c) for i in range(40) for w, c in (("alpha", "A"), ("beta", "B"))]
    docs = spark.createDataFrame([*rows, (99, None, "A"), (98, "alpha", None)], SCHEMA)
    model, report, times = TX.build_and_evaluate(docs, outpath=path)
    got = {r["class"]: r for r in report.collect()}
    assert got["A"]["precision"] > 0.9 and got["B"]["recall"] == 1.0 and set(times) == {"eval_fit", "report", "full_fit"}
    assert predicted(model, docs) == predicted(TX.load_model(spark, path), docs)
