"""The best setting's tree is grown beside the grid's: one split of the metrics, one growth."""

import random

from pyspark.sql import functions as F

from penmark.operators import metrics as M
from penmark.operators import trees as TR
from penmark.plans import catalog_ml as ML


def sides(spark, n=120, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = rnd.randrange(3)
        rows.append((i, f"a{y}", *[float(rnd.randrange(6) + (y if j < 2 else 0)) for j in range(len(M.FEATURES))], i % 4 == 0))
    df = spark.createDataFrame(rows, ["doc_id", "author", *M.FEATURES, "is_test"])
    return df.filter("NOT is_test").drop("is_test"), df.filter("is_test").drop("is_test")


def test_one_growth_gives_what_two_gave(spark, monkeypatch):
    train, test = sides(spark)
    calls, grow = [], TR.grow
    monkeypatch.setattr(ML, "metrics_split", lambda spark, d: calls.append("split") or (train, test))
    monkeypatch.setattr(TR, "grow", lambda *a, **k: calls.append("grow") or grow(*a, **k))
    got = ML.q_best_model(spark, "").collect()
    assert calls == ["split", "grow"]

    means = TR.mean_scores(ML._grid(spark, ""))
    best = TR.best_setting(means).first()
    nodes = ML.metrics_trees(spark, "", max_depth=best["max_depth"]).nodes
    want = TR.cut_accuracy(nodes, best["max_depth"], best["min_samples_split"]).first()["score"]
    assert [tuple(r) for r in got] == [(best["max_depth"], best["min_samples_split"], best["mean_test_score"], want)]


def test_an_id_on_both_sides_is_two_rows(spark):
    train, test = sides(spark)
    both = test.unionByName(train.limit(5).withColumns({c: F.lit(0.0) for c in M.FEATURES}))
    nodes = ML.grid_and_whole(train, both).nodes.filter(F.col("tree") == ML.GRID_SPLITS)
    assert nodes.filter("node = ''").first()["held"] == both.count() and nodes.filter("node = ''").first()["n"] == train.count()
