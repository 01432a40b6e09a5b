"""Token stage, sparse text vectors, the forest and kNN on them.

Linear classifiers on text vectors are in ``penmark.operators.sparse_linear``, whole text models in
``penmark.operators.textmodel``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from penmark.functions import lexicon
from penmark.functions import text as T
from penmark.operators import features as FE
from penmark.operators.skew import top_k_per_group
from penmark.operators.sparse_linear import cell_arrays
from penmark.session import shared_path, written


class TokenTransformer(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Text -> normalised tokens: word/punctuation split, lower, strip, then stop
    words and punctuation-only tokens removed. Pure column expressions.

    ``tokenizer`` (not persisted) may replace the word/punctuation split with any
    ``Column -> array<string>`` function.
    """

    lower = Param(Params._dummy(), "lower", "lower-case tokens", TypeConverters.toBoolean)
    strip = Param(Params._dummy(), "strip", "strip spaces, _ and *", TypeConverters.toBoolean)
    stopwords = Param(Params._dummy(), "stopwords", "words to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCol="text", outputCol="tokens", lower=True, strip=True, stopwords=None):
        super().__init__()
        self._setDefault(lower=True, strip=True, stopwords=list(lexicon.ENGLISH_STOP_WORDS))
        kwargs = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._set(**kwargs)
        self.tokenizer: Callable[[Column], Column] | None = None

    def fit(self, dataset=None, y=None):
        return self

    def write(self):
        if self.tokenizer is not None:
            raise ValueError("a pipeline with its own tokenizer function cannot be saved: it would load without it")
        return super().write()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        split = self.tokenizer or T.wordpunct_tokens
        toks = T.normalize_tokens(split(F.col(self.getInputCol())), self.getOrDefault(self.lower),
                                  self.getOrDefault(self.strip))
        return dataset.withColumn(self.getOutputCol(), T.filter_tokens(toks, self.getOrDefault(self.stopwords)))


def label_stages(label_col: str) -> StringIndexer:
    return StringIndexer(inputCol=label_col, outputCol="label_idx", stringOrderType="alphabetAsc",
                         handleInvalid="error")


CLASSIFIERS: dict[str, Callable[[], Estimator]] = {
    # 30 is MLlib's greatest depth
    "random_forest": lambda: RandomForestClassifier(numTrees=100, maxDepth=30, seed=42),
    "multinomial_nb": lambda: NaiveBayes(modelType="multinomial", smoothing=0.01),
}


class GatheredLogisticRegression(LogisticRegression):
    """Logistic regression whose rows are gathered in a partition for each core.

    Every iteration each partition gives back a gradient of the size of the whole model (classes x vocabulary), so what is
    exchanged grows with the partitions. The rows and their order stay as they are.
    """

    def _fit(self, dataset: DataFrame):
        return super()._fit(dataset.coalesce(dataset.sparkSession.sparkContext.defaultParallelism))


class TextVectors:
    """Train and test rows (id, label, label_idx, features) over the whole fitted vocabulary."""

    def __init__(self, train: DataFrame, test: DataFrame, size: int, labels: list[str]):
        self.train, self.test, self.size, self.labels = train, test, size, labels

    def named(self, pred: DataFrame, id_col: str = "doc_id", label_col: str = "lang") -> DataFrame:
        names = F.array(*[F.lit(x) for x in self.labels])
        return pred.select(id_col, F.col(label_col).alias("label"),
                           F.element_at(names, F.col("prediction").cast("int") + 1).alias("prediction"))


def term_index(idf: DataFrame, buckets: int = 1024, keep: Sequence[str] = ()) -> DataFrame:
    """(term, idx, ``keep``): terms numbered from 0 without gaps, by hash bucket and term; no global sort."""
    terms = idf.select("term", *keep, F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("b"))
    sizes = terms.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    first = F.coalesce(F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("b").orderBy("term")) - 1
    return terms.withColumn("k", within).join(sizes.select("b", first.alias("first")), "b").select(
        "term", (F.col("first") + F.col("k")).cast("int").alias("idx"), *keep)


def as_vectors(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written once under the shared folder, its last column ``features`` read back as vectors."""
    path = shared_path(df.sparkSession, kind)
    df.write.parquet(path)
    schema = StructType([*[f for f in df.schema.fields if f.name != "features"], StructField("features", VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path)


def sparse_vectors(rows: DataFrame, weights: DataFrame, index: DataFrame, size: int, id_col: str = "doc_id") -> DataFrame:
    """``rows`` with ``features``, the sparse vector of their (id, term, weight) rows; none gives the zero vector. Written once."""
    none = F.expr(f"cast(struct(0, {size}, array(), array()) as {FE.VECTOR})")
    out = rows.join(FE.weight_vectors(weights, index, size, id_col), id_col, "left")
    return as_vectors(out.select(*rows.columns, F.coalesce("features", none).alias("features")), "vectors")


def vectorise(train: DataFrame, test: DataFrame, w_train: DataFrame, w_test: DataFrame, idf: DataFrame,
              id_col: str = "doc_id", label_col: str = "lang") -> TextVectors:
    """Sparse vectors of the fitted long-form weights, every term of the vocabulary in them.

    They are written to the shared folder: iterative trainers rescan them, and neither caches nor tokenisation are left behind.
    Test rows of unknown labels are left out.
    """
    index = written(term_index(idf), "vector-index")
    size = index.count()
    indexer = label_stages(label_col).fit(train)
    tr = sparse_vectors(indexer.transform(train.select(id_col, label_col)), w_train, index, size, id_col)
    te = sparse_vectors(indexer.setHandleInvalid("skip").transform(test.select(id_col, label_col)), w_test, index, size, id_col)
    return TextVectors(tr, te, size, list(indexer.labels))


def vectorise_texts(train: DataFrame, test: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
                    smooth: bool = True, sublinear: bool = False, max_df: float | None = None) -> TextVectors:
    """``vectorise`` of the tf-idf of both sides, fitted on ``train``, without weights in long form: a block's vectors are formed where
    its texts are tokenised."""
    indexer = label_stages(label_col).fit(train)
    keep = [id_col, label_col, "label_idx"]

    def side(docs):
        own = docs.select(F.col(id_col).alias("_id"), id_col, label_col, "label_idx", text_col)
        return FE.block_tokens(own, "_id", text_col, FE.lexicon.ENGLISH_STOP_WORDS, None, keep)

    own, blocks, n = side(indexer.transform(train))
    asked = written(FE.block_terms(own), "vector-terms")
    idf = FE.with_idf(asked.groupBy("term").agg(F.sum("n").alias("df")), F.lit(n), smooth, max_df)
    index = written(term_index(idf, keep=["idf"]), "vector-index")
    size = index.count()
    tr = as_vectors(FE.block_vectors(own, asked.select(FE.BLOCK, "term").join(index, "term"), blocks, size, sublinear, keep), "vectors")
    # rows of unknown labels go only after their id's cells are counted
    own, blocks, _ = side(indexer.setHandleInvalid("keep").transform(test))
    asked = FE.block_terms(own).select(FE.BLOCK, "term").join(index, "term")
    te = FE.block_vectors(own, asked, blocks, size, sublinear, keep).filter(F.col("label_idx") < len(indexer.labels))
    return TextVectors(tr, as_vectors(te, "vectors"), size, list(indexer.labels))


def time_and_score(name: str, fit: Callable[[], Callable[[], DataFrame]]) -> tuple:
    """(name, accuracy, train_time, test_time): ``fit`` trains and returns what predicts (label, prediction).

    A rule that is lazy to the end (ridge, kNN and the aggregates) spends its training in the second time.
    """
    t0 = time.time()
    predict = fit()
    t1 = time.time()
    pred = predict()
    acc = pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("a")).first().a
    return name, float(acc or 0.0), t1 - t0, time.time() - t1


def knn_sparse(train: DataFrame, test: DataFrame, k: int = 10, id_col: str = "doc_id", rows_per_block: int = 2000) -> DataFrame:
    """Exact k nearest neighbours (Euclidean, ties by id) of sparse rows and their majority's label_idx.

    Block nested loop: a (train block, test block) pair meets in one task, which gives back k
    candidates per test row. A test block is dense over the terms it has itself only.
    """
    tb, qb = (max(1, -(-x.count() // rows_per_block)) for x in (train, test))
    par = train.sparkSession.sparkContext.defaultParallelism
    qb = max(qb, -(-par // tb))

    def side(df, own, n_own, other, n_other):
        df = df.select(F.col(id_col).alias("id"), F.col("label_idx").alias("y"), *[
            c.alias(x) for c, x in zip(cell_arrays(df, "features"), "ix")])
        return df.select("id", "y", "i", "x", F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int").alias(own),
                         F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"q": [], "t": [], "d": [], "y": []})
        terms = np.unique(np.concatenate([np.asarray(x, np.int64) for x in right["i"]]))
        q = np.zeros((len(right), len(terms)))
        for r, (i, x) in enumerate(zip(right["i"], right["x"])):
            q[r, np.searchsorted(terms, i)] = x
        q2 = (q * q).sum(1)
        dist = np.empty((len(right), len(left)))
        for c, (i, x) in enumerate(zip(left["i"], left["x"])):
            i, x = np.asarray(i, np.int64), np.asarray(x)
            at = np.searchsorted(terms, i)
            both = np.flatnonzero((at < len(terms)) & (terms[np.minimum(at, len(terms) - 1)] == i)) if len(terms) else []
            dist[:, c] = q2 + x @ x - 2 * (q[:, at[both]] @ x[both])
        ids = left["id"].to_numpy()
        near = np.lexsort((np.broadcast_to(ids, dist.shape), np.round(dist, 12)), axis=1)[:, :k]
        row = np.repeat(np.arange(len(right)), near.shape[1])
        flat = near.ravel()
        return pd.DataFrame({"q": right["id"].to_numpy()[row], "t": ids[flat], "d": dist[row, flat],
                             "y": left["y"].to_numpy()[flat]})

    cand = side(train, "tb", tb, "qb", qb).groupBy("tb", "qb").cogroup(
        side(test, "qb", qb, "tb", tb).groupBy("tb", "qb")).applyInPandas(block, "q long, t long, d double, y double")
    nearest = top_k_per_group(cand, ["q"], [F.round("d", 12), F.col("t")], k)
    votes = nearest.groupBy("q", "y").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("q").agg(F.max(F.struct("n", (-F.col("y")).alias("y"))).alias("b"))
    return test.join(best.select(F.col("q").alias(id_col), (-F.col("b.y")).alias("prediction")), id_col)


def as_arrays(df: DataFrame, col: str = "features") -> DataFrame:
    return df.withColumn(col, vector_to_array(col))
