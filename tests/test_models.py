"""Aggregate classifiers, evaluation tables and the parameter-mixing rules on toy sets."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from penmark.operators import evaluate as EV
from penmark.operators import linear as L
from penmark.operators import mlmodels as ML
from penmark.operators import sparse_linear as SL

# Two authors, one shared word and one own word each.
TRAIN = [(1, "shared alpha", "A"), (2, "alpha alpha", "A"), (3, "shared alpha alpha", "A"),
         (4, "shared beta", "B"), (5, "beta beta", "B"), (6, "shared beta beta", "B")]


def weights(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    w = (docs.select("doc_id", F.explode(F.split("text", " ")).alias("term"))
         .groupBy("doc_id", "term").agg(F.count(F.lit(1)).cast("double").alias("weight")))
    return docs, w


@pytest.mark.parametrize("kind", ["multinomial", "bernoulli", "centroid"])
def test_separable_toy(spark, kind):
    docs, w = weights(spark, TRAIN)
    test_docs, tw = weights(spark, [(10, "alpha shared", "A"), (11, "beta", "B"), (12, "shared", "A")])
    labels = docs.select("doc_id", "lang")
    if kind == "multinomial":
        pred = L.multinomial_nb_predict(L.multinomial_nb_fit(w, labels), test_docs, tw)
    elif kind == "bernoulli":
        pred = L.bernoulli_nb_predict(L.bernoulli_nb_fit(w, labels), test_docs, tw)
    else:
        pred = L.nearest_centroid_predict(L.nearest_centroid_fit(w, labels), test_docs, tw)
    got = {r["doc_id"]: r["prediction"] for r in pred.collect()}
    assert got[10] == "A" and got[11] == "B"
    # a document with only the shared word is a tie: the first class wins
    assert got[12] == "A"


def test_nb_log_odds_sign(spark):
    docs, w = weights(spark, TRAIN)
    _, cells = L.multinomial_nb_fit(w, docs.select("doc_id", "lang"))
    coef = {r["term"]: r["weight"] for r in L.binary_log_odds(cells, w, "B", "A").collect()}
    assert coef["beta"] > 0 > coef["alpha"]
    assert abs(coef["shared"]) < min(abs(coef["beta"]), abs(coef["alpha"]))


def test_knn_exact(spark):
    train = spark.createDataFrame([(i, [float(i), 0.0], 0 if i < 5 else 1) for i in range(10)],
                                  "vec_id long, embedding array<float>, label int")
    test = spark.createDataFrame([(100, [0.4, 0.0], 0), (101, [8.6, 0.0], 0)],
                                 "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r["prediction"] for r in L.knn_predict(train, test, k=3, train_blocks=3, test_blocks=2).collect()}
    assert got == {100: 0, 101: 1}


def test_report_with_unpredicted_class(spark):
    pred = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "label string, prediction string")
    rep = {r["class"]: r for r in EV.classification_report(pred).collect()}
    assert rep["c"]["precision"] == 0.0 and rep["c"]["recall"] == 0.0 and rep["c"]["f1"] == 0.0
    assert rep["b"]["precision"] == pytest.approx(1 / 3) and rep["b"]["recall"] == 1.0
    assert rep["avg / total"]["support"] == 4
    cm = {(r["label"], r["prediction"]): r["n"] for r in EV.confusion_matrix(pred).collect()}
    assert cm == {("a", "a"): 1, ("a", "b"): 1, ("b", "b"): 1, ("c", "b"): 1}


def test_informative_features_pairs(spark):
    coefs = spark.createDataFrame([(t, float(i)) for i, t in enumerate("abcdef")], "term string, weight double")
    out = EV.informative_features(coefs, 2).orderBy("rank").collect()
    assert [(r["pos_term"], r["neg_term"]) for r in out] == [("f", "a"), ("e", "b")]


@pytest.mark.parametrize("rule", ["perceptron", "pa"])
def test_parameter_mixing_separates(spark, rule):
    rows = [(Vectors.sparse(3, [0], [1.0]), 0.0), (Vectors.sparse(3, [1], [1.0]), 1.0)] * 10
    df = spark.createDataFrame(rows, ["features", "label_idx"]).repartition(3)
    pred = SL.predict(df, SL.fit(df, 2, rule, epochs=5)).collect()
    assert all(r["prediction"] == r["label_idx"] for r in pred)


@pytest.mark.parametrize("blocks", [(1, 5), (3, 2), (None, None)])
def test_knn_every_query_answered_for_any_blocking(spark, blocks):
    """Uneven block counts once lost whole query blocks (key types differed
    between the cogroup sides); every test row must get a prediction."""
    train = spark.createDataFrame([(i, [float(i % 17), float(i % 5)], i % 3) for i in range(60)],
                                  "vec_id long, embedding array<float>, label int")
    test = spark.createDataFrame([(1000 + i, [float(i % 13), float(i % 4)], 0) for i in range(40)],
                                 "vec_id long, embedding array<float>, label int")
    tb, qb = blocks
    out = L.knn_predict(train, test, k=5, train_blocks=tb, test_blocks=qb)
    assert out.count() == 40


def plain_gaussian(train, rows, terms, floor=1e-9):
    """{id: class} of dense Gaussian naive Bayes; train and rows: {id: (class, {term: weight})}."""
    import numpy as np
    dense = lambda x: np.array([x.get(t, 0.0) for t in terms])
    x = np.array([dense(w) for _, w in train.values()])
    y = np.array([c for c, _ in train.values()])
    e = floor * x.var(axis=0).max()
    out = {}
    for k, (_, w) in rows.items():
        score = {}
        for c in sorted(set(y)):
            mu, var = x[y == c].mean(axis=0), x[y == c].var(axis=0) + e
            score[c] = np.log((y == c).mean()) - 0.5 * (np.log(2 * np.pi * var) + (dense(w) - mu) ** 2 / var).sum()
        out[k] = max(sorted(score), key=score.get)
    return out


def test_gaussian_nb_against_dense(spark):
    import random
    rnd = random.Random(2)
    terms = [f"t{i}" for i in range(12)]
    rows = {i: (rnd.choice("abc"), {t: round(rnd.random(), 3) for t in rnd.sample(terms, rnd.choice([0, 2, 4]))}) for i in range(80)}
    rows[80] = ("d", {})      # a class and a document without any weight
    rows[81] = ("a", {"t0": 0.5, "new": 0.7})
    train = {k: v for k, v in rows.items() if k < 60 or k == 80}
    w = spark.createDataFrame([(k, t, x) for k, (_, c) in rows.items() for t, x in c.items()], "doc_id long, term string, weight double")
    lab = spark.createDataFrame([(k, c) for k, (c, _) in rows.items()], "doc_id long, lang string")
    model = L.gaussian_nb_fit(w, lab.filter(F.col("doc_id").isin(list(train))))
    got = {r["doc_id"]: r["prediction"] for r in L.gaussian_nb_predict(model, lab, w).collect()}
    assert got == plain_gaussian(train, rows, [*terms, "new"])


@pytest.mark.parametrize("rule", ["perceptron", "pa"])
def test_one_part_is_the_online_rule(spark, rule):
    import random

    import numpy as np
    rnd = random.Random(6)
    rows = [(i, sorted(rnd.sample(range(9), rnd.choice([0, 2, 4]))), rnd.randrange(3)) for i in range(40)]
    data = spark.createDataFrame([(i, Vectors.sparse(9, j, [0.5 + k for k in range(len(j))]), float(y)) for i, j, y in rows],
                                 ["doc_id", "features", "label_idx"])
    w = np.zeros((3, 10))
    for _ in range(7):
        for _, j, y in rows:
            x = np.zeros(10)
            x[j], x[9] = [0.5 + k for k in range(len(j))], 1.0
            t = np.where(np.arange(3) == y, 1.0, -1.0)
            m = t * (w @ x)
            step = (m <= 0) * t if rule == "perceptron" else np.minimum(1.0, np.maximum(0, 1 - m) / (x @ x)) * t
            w += np.outer(step, x)
    assert np.allclose(SL.fit(data, 3, rule, epochs=7).array(9), w)


def test_mixing_ends_when_nothing_changes(spark):
    data = spark.createDataFrame([(i, Vectors.sparse(4, [i % 2], [1.0]), float(i % 2)) for i in range(12)], ["doc_id", "features", "label_idx"])
    few, many = (SL.fit(data, 2, "perceptron", epochs=e, parts=3).array(4) for e in (4, 50))
    assert (few == many).all() and (few != 0).any()


def test_logistic_regression_gathers_its_rows(spark, monkeypatch):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit

    seen, fit = [], LogisticRegression._fit
    monkeypatch.setattr(LogisticRegression, "_fit", lambda self, d: seen.append(d.rdd.getNumPartitions()) or fit(self, d))
    cores = spark.sparkContext.defaultParallelism
    df = spark.createDataFrame([(Vectors.sparse(4, [i % 3, 3], [1.0, 0.1 * (i % 7)]), float(i % 2)) for i in range(120)], ["features", "label"])
    df = df.repartition(3 * cores)
    scores = []
    for kind in (ML.GatheredLogisticRegression, LogisticRegression):
        lr = kind(maxIter=5)
        grid = ParamGridBuilder().addGrid(lr.regParam, [1e-3, 1e-1]).build()
        scores.append(TrainValidationSplit(estimator=lr, estimatorParamMaps=grid, evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
                                           seed=23).fit(df).validationMetrics)
    assert max(seen[:3]) <= cores < min(seen[3:])
    assert np.allclose(scores[0], scores[1])
