"""What a query shuffles, grows or reads beyond need."""

import random

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from penmark.operators import sparse_linear as SL
from penmark.operators import terms as TM
from penmark.operators import trees as TR


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_top_terms_deal_words_out_by_document_once(spark):
    m = spark.createDataFrame([(1, [["a", "b"], ["a"]]), (2, [["c"]]), (2, [["c", "d"]]), (None, [["x"]])],
                              "doc_id long, sentences_words array<array<string>>")
    for got in (TM.top_terms(m, 1), TM.top_bigrams(m, 1, stopwords=None)):
        assert exchanges(got) == 1
    assert {tuple(r) for r in TM.top_terms(m, 1).collect()} == {(1, 1, "a", 2), (2, 1, "c", 2), (None, 1, "x", 1)}


def test_trees_no_deeper_than_the_grid_score_alike(spark):
    rnd = random.Random(3)
    data = [(i, rnd.choice("ab"), rnd.random(), rnd.random()) for i in range(120)]
    df = spark.createDataFrame(data, "doc_id long, label string, f double, g double")
    rows = TR.splits(df.select(F.col("doc_id").alias("id"), "label"), 2, 1, 0.25)
    cells = TR.dense_cells(df, ["f", "g"], "doc_id")
    scores = lambda nodes: {tuple(r) for r in TR.grid_scores(nodes, range(1, 4), range(2, 6)).collect()}
    whole = scores(TR.grow(cells, rows).nodes)
    for local in (TR.LOCAL_CELLS, 100):   # in one task, and level by level
        nodes = TR.grow(cells, rows, local, max_depth=3).nodes
        assert nodes.agg(F.max(F.length("node"))).first()[0] == 3
        assert scores(nodes) == whole


def test_rows_of_forty_eight_million_class_cells_stay_in_one_part(spark):
    df = spark.createDataFrame([(i, Vectors.sparse(9, [i % 9], [1.0]), float(i % 2)) for i in range(20)], ["doc_id", "features", "label_idx"])
    rows = SL._data(df, "features", "label_idx", "doc_id")
    parts = lambda classes: SL._dealt(rows, classes, "features", F.col("key"), 1)[3]
    assert (parts(1_200_000), parts(1_200_001)) == (1, 2)   # 40 cells, the bias's included
