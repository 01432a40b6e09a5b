"""Vectors formed in the blocks of the texts: the rows that the weights in long form give, without a shuffle of cells."""

import numpy as np
from pyspark.sql import functions as F

from penmark.operators import features as FE
from penmark.operators import mlmodels as ML

ROWS = [(1, "red apple green apple", "a"), (2, "green pear old pear tree", "b"), (3, "red tree", "a"), (3, "blue tree tree", "a"),
        (4, "", "b"), (5, "red red blue river", "b"), (None, "green river", "a")]
TEST = [(7, "apple river unseen", "a"), (8, "tree blue", "zz"), (9, None, "b"), (9, "red pear", "b"), (10, "red", None)]


def sides(spark):
    return (spark.createDataFrame(r, "doc_id long, text string, lang string") for r in (ROWS, TEST))


def cells(v, df):
    got = [(r["doc_id"], r["label_idx"], tuple(r["features"].indices.tolist()), tuple(np.round(r["features"].values, 12).tolist()), r["features"].size)
           for r in df.collect()]
    return sorted(got, key=str)


def test_texts_give_the_vectors_of_the_weights(spark):
    train, test = sides(spark)
    v = ML.vectorise_texts(train, test, sublinear=True, max_df=0.5)
    w, idf = FE.fit_tfidf(train, sublinear=True, max_df=0.5)
    u = ML.vectorise(train, test, w, FE.transform_tfidf(test, idf, sublinear=True), idf)
    assert v.size == u.size and v.labels == u.labels == ["a", "b"]
    assert cells(v, v.train) == cells(u, u.train) and len(cells(v, v.train)) == len(ROWS)
    assert cells(v, v.test) == cells(u, u.test) and len(cells(v, v.test)) == 3
    assert {r[2] for r in cells(v, v.train) if r[0] is None} == {()}


def test_no_cell_is_shuffled(spark):
    """What the blocks ask for meets them; the plan explodes no cells and groups none by document."""
    train, _ = sides(spark)
    own, blocks, _ = FE.block_tokens(train.withColumn("_id", F.col("doc_id")), "_id", "text", [], None, ["doc_id"])
    index = own.select(FE.BLOCK, F.explode("tokens").alias("term")).distinct().withColumns({"idf": F.lit(1.0), "idx": F.lit(0)})
    plan = FE.block_vectors(own, index, blocks, 9, False, ["doc_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Python" not in plan and plan.count("FlatMapCoGroupsInArrow") == 1
    rows = train.select("doc_id").distinct()
    w = spark.createDataFrame([(1, "red", 0.6), (1, "tree", 0.8)], "doc_id long, term string, weight double")
    index = spark.createDataFrame([("red", 1), ("tree", 0)], "term string, idx int")
    got = {r["doc_id"]: r["features"] for r in ML.sparse_vectors(rows, w, index, 2).collect()}
    assert got[1].indices.tolist() == [0, 1] and got[1].values.tolist() == [0.8, 0.6] and got[2].numNonzeros() == 0
