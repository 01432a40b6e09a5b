"""Text classifiers kept as Parquet tables: fit, score, save, load, evaluate.

A model is a manifest (one row: rule, its parameters, token options) and tables: the vocabulary with its idf, the classes,
and the non-zero (term, class) cells. It is fitted and applied by joins and aggregates on the term, so no vocabulary
and no coefficient passes through the driver. The manifest is written last: a folder without one is not a model.

A rule is any class with ``name``, ``params()``, ``fit(weights, labels) -> {name: table}`` and
``predict(tables, docs, weights) -> (id, prediction)``, where weights are (id, term, weight) and labels (id, class).
Rules here: naive Bayes, nearest centroid, the linear solvers, and any ``pyspark.ml`` estimator.

Rows without a label are left out of a fit. Null and empty texts are scored like texts without a known term. Every row
keeps its own result, rows with equal ids or texts too; other columns are passed on.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from penmark.functions import lexicon
from penmark.functions import text as T
from penmark.operators import features as FE
from penmark.operators import linear as LIN
from penmark.operators import sparse_linear as SL
from penmark.operators.blocks import class_gains, kept
from penmark.operators.evaluate import classification_report
from penmark.operators.mlmodels import sparse_vectors, term_index
from penmark.session import shared_path, written
from penmark.sources.files import path_exists

ID = "_row_id"
MANIFEST = "saved long, rule string, params string, options string, tables array<string>"


class MultinomialNB:
    name = "multinomial_nb"

    def __init__(self, alpha: float = 0.01):
        self.alpha = alpha

    def params(self) -> dict:
        return {"alpha": self.alpha}

    def fit(self, weights: DataFrame, labels: DataFrame) -> dict[str, DataFrame]:
        classes, cells = LIN.multinomial_nb_fit(weights, labels, self.alpha, ID, "class")
        return {"classes": classes, "cells": cells}

    def predict(self, tables: dict[str, DataFrame], docs: DataFrame, weights: DataFrame) -> DataFrame:
        return LIN.multinomial_nb_predict((tables["classes"], tables["cells"]), docs, weights, self.alpha, ID)


class BernoulliNB:
    name = "bernoulli_nb"

    def __init__(self, alpha: float = 0.01):
        self.alpha = alpha

    def params(self) -> dict:
        return {"alpha": self.alpha}

    def fit(self, weights: DataFrame, labels: DataFrame) -> dict[str, DataFrame]:
        classes, cells, vocabulary = LIN.bernoulli_nb_fit(weights, labels, self.alpha, ID, "class")
        return {"classes": classes, "cells": cells, "vocabulary": vocabulary}

    def predict(self, tables: dict[str, DataFrame], docs: DataFrame, weights: DataFrame) -> DataFrame:
        return LIN.bernoulli_nb_predict((tables["classes"], tables["cells"], tables["vocabulary"]), docs, weights, ID)


class NearestCentroid:
    name = "nearest_centroid"

    def params(self) -> dict:
        return {}

    def fit(self, weights: DataFrame, labels: DataFrame) -> dict[str, DataFrame]:
        classes, cells = LIN.nearest_centroid_fit(weights, labels, ID, "class")
        return {"classes": classes, "cells": cells}

    def predict(self, tables: dict[str, DataFrame], docs: DataFrame, weights: DataFrame) -> DataFrame:
        return LIN.nearest_centroid_predict((tables["classes"], tables["cells"]), docs, weights, ID)


def _numbered(labels: DataFrame) -> DataFrame:
    """(class, label_idx) in sorted order; a window over one row per label."""
    return labels.select("class").distinct().withColumn("label_idx", F.row_number().over(Window.orderBy("class")) - 1)


class Linear:
    """One class against the rest by a rule of ``sparse_linear.RULES``; the default is hinge loss by stochastic gradient descent."""

    name = "linear"

    def __init__(self, rule: str = "sgd_l2", **options):
        self.rule, self.options = rule, options

    def params(self) -> dict:
        return {"rule": self.rule, **self.options}

    def fit(self, weights: DataFrame, labels: DataFrame) -> dict[str, DataFrame]:
        index = written(term_index(weights.select("term").distinct()), "model-index")
        names = written(_numbered(labels), "model-classes")
        rows = sparse_vectors(labels.join(names, "class").select(ID, "label_idx"), weights, index, index.count(), ID)
        w = SL.fit(rows, names.count(), self.rule, id_col=ID, **self.options).cells.filter("weight != 0")
        own = w.select(F.col("term").alias("idx"), F.col("class").alias("label_idx"), "weight").join(names, "label_idx")
        bias = own.filter(F.col("idx") == SL.BIAS).select("class", F.col("weight").alias("bias"))
        classes = names.join(bias, "class", "left").select("class", F.coalesce("bias", F.lit(0.0)).alias("bias"))
        return {"classes": classes, "cells": own.join(index, "idx").select("term", "class", "weight")}

    def predict(self, tables: dict[str, DataFrame], docs: DataFrame, weights: DataFrame) -> DataFrame:
        ranked = LIN.ranked_classes(tables["classes"], -F.col("bias"))
        dots = class_gains(weights, tables["cells"], {"weight": 1}, ID).withColumnRenamed("gain", "dot")
        touched = written(dots.join(ranked, "class"), "linear-dots")   # read twice
        untouched = LIN.first_untouched(docs, touched, ranked, ID).select(ID, F.col("bias").alias("score"), "class")
        return LIN._best(touched.select(ID, (F.col("bias") + F.col("dot")).alias("score"), "class").unionByName(untouched), ID)


class Estimated:
    """Any ``pyspark.ml`` estimator over sparse vectors of the whole vocabulary, saved in its own format beside the tables."""

    name = "estimator"

    def __init__(self, estimator: Estimator | None = None):
        self.estimator, self.fitted = estimator, None

    def params(self) -> dict:
        return {}

    def fit(self, weights: DataFrame, labels: DataFrame) -> dict[str, DataFrame]:
        index = written(term_index(weights.select("term").distinct()), "model-index")
        names = written(_numbered(labels), "model-classes")
        rows = sparse_vectors(labels.join(names, "class").select(ID, F.col("label_idx").cast("double").alias("label")), weights, index, index.count(), ID)
        rows = rows.select("features", "label")
        model = self.estimator.copy().setParams(featuresCol="features", labelCol="label").fit(rows)
        self.fitted = PipelineModel(stages=[model])
        return {"index": index, "classes": names}

    def predict(self, tables: dict[str, DataFrame], docs: DataFrame, weights: DataFrame) -> DataFrame:
        size = tables["index"].count()
        scored = self.fitted.transform(sparse_vectors(docs.select(ID), weights, tables["index"], size, ID))
        return scored.select(ID, F.col("prediction").cast("int").alias("label_idx")).join(tables["classes"], "label_idx").select(
            ID, F.col("class").alias("prediction"))

    def save(self, path: str) -> None:
        self.fitted.write().save(path)

    def load(self, path: str) -> None:
        self.fitted = PipelineModel.load(path)


RULES = {r.name: r for r in (MultinomialNB, BernoulliNB, NearestCentroid, Linear, Estimated)}


def as_rule(classifier):
    """A rule from a rule, a ``pyspark.ml`` estimator, or the class of one."""
    classifier = classifier() if isinstance(classifier, type) else classifier
    return Estimated(classifier) if isinstance(classifier, Estimator) else classifier


class TextModel:
    """tokens -> counts -> smooth idf -> L2 rows -> rule. ``tables`` holds ``idf`` (term, idf) and the rule's own."""

    def __init__(self, rule, tables: dict[str, DataFrame], options: dict):
        self.rule, self.tables, self.options = rule, tables, options

    def predict(self, df: DataFrame, text_col: str = "text", out_col: str = "predicted") -> DataFrame:
        """``df`` with the predicted class, one row for each of its rows; null from a model of no rows."""
        rows = _keyed(df)
        weights = FE.transform_tfidf(rows, self.tables["idf"], ID, text_col, tokens=_tokens(F.col(text_col), self.options), with_block=True)
        pred = self.rule.predict(self.tables, rows.select(ID), kept(weights, "model-weights"))
        return rows.join(pred.withColumnRenamed("prediction", out_col), ID, "left").drop(ID)


def _keyed(df: DataFrame) -> DataFrame:
    """``df`` written with a number for each row: numbers made on the fly could differ when a lost task runs again."""
    return written(df.withColumn(ID, F.monotonically_increasing_id()), "model-input")


def _tokens(text: Column, options: dict) -> Column:
    tokens = T.normalize_tokens(T.wordpunct_tokens(text), options["lower"], options["strip"])
    return T.filter_tokens(tokens, options["stopwords"])


def fit_text_model(df: DataFrame, classifier=MultinomialNB, text_col: str = "text", label_col: str = "lang", lower: bool = True,
                   strip: bool = True, stopwords: list[str] | None = None) -> TextModel:
    """Vocabulary, idf and the classifier's tables, each written once under the shared folder."""
    rule = as_rule(classifier)
    options = {"lower": lower, "strip": strip, "stopwords": list(lexicon.ENGLISH_STOP_WORDS if stopwords is None else stopwords)}
    rows = _keyed(df.filter(F.col(label_col).isNotNull()).select(text_col, F.col(label_col).cast("string").alias("class")))
    weights, idf = FE.fit_tfidf(rows, ID, text_col, tokens=_tokens(F.col(text_col), options), with_block=True)
    idf = written(idf.select("term", "idf"), "model-idf")
    weights = kept(weights, "model-weights")
    tables = rule.fit(weights, rows.select(ID, "class"))
    return TextModel(rule, {"idf": idf} | {k: written(t, f"model-{k}") for k, t in tables.items()}, options)


def save_model(model: TextModel, path: str) -> None:
    """The model as a folder of Parquet tables. The manifest gets a row that names them when they are all written.

    The latest row counts; earlier tables stay, so a job that dies half way leaves the model before it whole.
    """
    spark = next(iter(model.tables.values())).sparkSession
    own = shared_path(spark, "x").rsplit("/", 1)[-1]
    for name, t in model.tables.items():
        t.write.parquet(f"{path}/{own}/{name}")
    if hasattr(model.rule, "save"):
        model.rule.save(f"{path}/{own}/rule")
    row = (time.time_ns(), model.rule.name, json.dumps(model.rule.params()), json.dumps(model.options), [f"{own}/{x}" for x in model.tables])
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def load_model(spark: SparkSession, path: str, rules: dict | None = None) -> TextModel:
    """The model saved at ``path``; ``rules`` names rules of one's own."""
    m = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy(F.col("saved").desc()).first()
    rule = (RULES | (rules or {}))[m["rule"]](**json.loads(m["params"]))
    if hasattr(rule, "load"):
        rule.load(f"{path}/{m['tables'][0].split('/')[0]}/rule")
    return TextModel(rule, {x.split("/")[1]: spark.read.parquet(f"{path}/{x}") for x in m["tables"]}, json.loads(m["options"]))


def load_or_train(spark: SparkSession, path: str, train: Callable[[], TextModel], rules: dict | None = None) -> TextModel:
    """The model saved at ``path``; trained and saved there where there is nothing.

    What is there but can't be read raises and is never overwritten, unless it is a save that never got its manifest.
    """
    if path_exists(spark, f"{path}/manifest") or (path_exists(spark, path) and not path_exists(spark, f"{path}/*/idf")):
        return load_model(spark, path, rules)
    model = train()
    save_model(model, path)
    return model


def build_and_evaluate(df: DataFrame, classifier=Linear, text_col: str = "text", label_col: str = "lang", outpath: str | None = None,
                       test_size: float = 0.2, seed: str = "0", **options):
    """Fit and report on a hash holdout of the texts (copies stay on one side), then a fit on all rows, saved where asked.

    Returns (model, report, seconds of the steps). Rows without a label are left out; a null text counts as an empty one.
    """
    rows = written(df.filter(F.col(label_col).isNotNull()).select(F.coalesce(text_col, F.lit("")).alias(text_col), label_col), "model-labelled")
    held = FE.split_flag(text_col, seed, test_size)
    t0 = time.time()
    model = fit_text_model(rows.filter(~held), classifier, text_col, label_col, **options)
    t1 = time.time()
    pred = model.predict(rows.filter(held), text_col)
    report = written(classification_report(pred, label_col=label_col, pred_col="predicted"), "model-report")
    t2 = time.time()
    full = fit_text_model(rows, classifier, text_col, label_col, **options)
    if outpath:
        save_model(full, outpath)
    return full, report, {"eval_fit": t1 - t0, "report": t2 - t1, "full_fit": time.time() - t2}
