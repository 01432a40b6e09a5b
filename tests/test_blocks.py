"""tf-idf by blocks of documents: equal to the long-form joins, and no exchange of cells."""

from pyspark.sql import functions as F

from penmark.operators import blocks as BL
from penmark.operators import features as FE
from penmark.operators import linear as L

ROWS = [(1, "alpha beta beta gamma"), (2, "alpha delta"), (2, "beta delta delta"), (None, "alpha beta"), (4, None), (5, "the of"), (6, "alpha gamma gamma")]


def found(df):
    return {(r[0], r[1], round(r[2], 12)) for r in df.select("doc_id", "term", "weight").collect()}


def test_blocks_weigh_like_joins(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    tf = FE.term_counts(docs)
    for smooth, sublinear, most in ((True, True, 0.5), (False, False, None), (True, False, None)):
        idf = FE.document_frequency(tf, F.lit(len(ROWS)), smooth, most)
        w, own = FE.fit_tfidf(docs, smooth=smooth, sublinear=sublinear, max_df=most)
        assert found(w) == found(FE.tfidf(tf, idf, sublinear))
        plain = {tuple(r) for r in idf.select("term", "df", F.round("idf", 12)).collect()}
        assert {tuple(r) for r in own.select("term", "df", F.round("idf", 12)).collect()} == plain
        assert found(FE.transform_tfidf(docs, own, sublinear=sublinear)) == found(w)


def test_nothing_to_weigh(spark):
    docs = spark.createDataFrame(ROWS[4:6], "doc_id long, text string")
    w, idf = FE.fit_tfidf(docs)
    assert w.count() == 0 and idf.count() == 0


def test_cells_are_not_shuffled(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = FE.fit_tfidf(docs)[0]._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert lines and not [x for x in lines if "doc_id" in x or "id#" in x]


CELLS = [(1, "a", 0.5), (1, "b", 0.25), (2, "a", 1.0), (3, "b", 0.75), (3, "c", 0.125), (None, "a", 3.0), (5, "c", 2.0)]
LABELS = [(1, "x"), (1, "y"), (2, "x"), (3, None), (3, "y"), (None, "x"), (4, "x")]


def test_class_sums_and_gains_are_those_of_joins(spark):
    w = spark.createDataFrame(CELLS, "doc_id long, term string, weight double")
    labels = spark.createDataFrame(LABELS, "doc_id int, lang string")
    cells = spark.createDataFrame([("a", "x", 2.0, 1.0), ("b", "x", 4.0, 0.0), ("b", "y", 8.0, 3.0), ("c", "z", 1.0, 1.0), ("d", "z", 1.0, 1.0)],
                                  "term string, class string, half double, lin double")
    plain = w.join(labels, "doc_id").groupBy("term", "lang").agg(F.sum("weight"), F.count(F.lit(1)).cast("double"), F.sum(F.col("weight") ** 2))
    want = w.join(cells, "term").groupBy("doc_id", "class").agg(F.sum(F.col("half") * F.col("weight") ** 2 + F.col("lin") * F.col("weight")))
    want = {tuple(r) for r in want.collect()}
    marked = BL.marked(BL.in_blocks(w, "doc_id", 3), 3)
    for given in (w, marked, BL.kept(marked, "test-weights")):
        got = BL.class_sums(given, labels, {"s": 1, "n": 0, "q": 2}, "doc_id", "lang")
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in plain.collect()}
        for few, rows in ((100, 100), (1, 100), (1, 1)):   # (1, 1): classes meet the blocks in parts
            assert {tuple(r) for r in BL.class_gains(given, cells, {"half": 2, "lin": 1}, "doc_id", few, rows).collect()} == want
    twice = w.join(w.select("doc_id", "term", F.lit(1)), ["doc_id", "term"])   # not null ids, given a second time as a table of their own
    both = {tuple(r) for r in BL.class_gains([w, twice.select(w.columns)], cells, {"lin": 1}, "doc_id").collect()}
    lin = w.unionByName(twice.select(w.columns)).join(cells, "term").groupBy("doc_id", "class").agg(F.sum(F.col("lin") * F.col("weight")))
    assert both == {tuple(r) for r in lin.collect()}


def test_no_cells_no_classes(spark):
    w = spark.createDataFrame(CELLS, "doc_id long, term string, weight double")
    labels = spark.createDataFrame(LABELS, "doc_id long, lang string")
    cells = spark.createDataFrame([], "term string, class string, lin double")
    assert BL.class_sums(w.filter("false"), labels, {"s": 1}, "doc_id", "lang").count() == 0
    assert BL.class_sums(w, labels.filter("false"), {"s": 1}, "doc_id", "lang").count() == 0
    assert BL.class_gains(w, cells, {"lin": 1}, "doc_id").count() == 0


def test_kept_weights_are_not_shuffled_by_classifiers(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    labels = docs.select("doc_id", F.lit("x").alias("lang"))
    w = BL.kept(FE.fit_tfidf(docs, with_block=True)[0], "test-weights")
    classes, cells = L.nearest_centroid_fit(w, labels)
    for plan in (BL.class_sums(w, labels, {"s": 1}, "doc_id", "lang"), BL.class_gains(w, cells, {"mu": 1}, "doc_id")):
        lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
        scans = [i for i, x in enumerate(lines) if "test_weights_" in x and "FileScan" in x]
        assert scans

        def depth(x):
            return len(x) - len(x.lstrip(" :+-"))
        for i in scans:
            # what lies between a scan and the block's task: no exchange carries the weight
            up, level = [], depth(lines[i])
            for x in reversed(lines[:i]):
                if depth(x) < level:
                    up, level = [*up, x], depth(x)
                if "FlatMapCoGroups" in x:
                    break
            assert not [x for x in up if "Exchange" in x and "weight" in lines[i].split("[")[1].split("]")[0]]
