"""Registered queries: Spark ML models, tuning, persistence, extension surface.

Model fits have no SQL form, so most of these are rows-only checks. Where a
stage is pure column expressions (the token stage) the SQL oracle still applies.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from penmark.functions import text as T
from penmark.operators import evaluate as EV
from penmark.operators import features as FE
from penmark.operators import linear as LIN
from penmark.operators import metrics as M
from penmark.operators import mlmodels as ML
from penmark.operators import sparse_linear as SL
from penmark.operators import textmodel as TX
from penmark.operators import trees as TR
from penmark.operators.blocks import kept
from penmark.plans import sqlfrag as S
from penmark.plans.catalog import _TF_CLEAN, documents, metric_scalars, metrics, query, sweep_split, sweep_tfidf
from penmark.plans.catalog_pages import _FILT
from penmark.session import shared_path, written
from penmark.tables import table


def sweep_vectors(spark, d) -> ML.TextVectors:
    """The classifier sweep's sublinear, max_df=0.5 tf-idf as sparse vectors of the whole vocabulary."""
    return ML.vectorise_texts(*sweep_split(spark, d), sublinear=True, max_df=0.5)


def metrics_split(spark, d):
    """Balanced per-author metrics, 25 % hash holdout (seed 23), as in the structural path."""
    # split by text, so that exact copies are on one side
    texts = documents(spark, d).select("doc_id", FE.split_flag("text", "23", 0.25).alias("is_test"))
    # read by several branches of the plan: tokenised and written once
    m = written(metric_scalars(metrics(spark, d)), "kept-metrics")
    bal = M.balanced_sample(m, "doc_id", seed="0").drop("shuffle_key").join(texts, "doc_id")
    bal = written(bal, "balanced")
    return bal.filter("NOT is_test").drop("is_test"), bal.filter("is_test").drop("is_test")


def metrics_trees(spark, d, n_splits: int | None = None, max_depth: int | None = None) -> TR.Trees:
    """Trees on the six statistics: one of the training side scored on the test side, or one for each split of the training side."""
    train, test = metrics_split(spark, d)
    if n_splits is None:
        flagged = train.withColumn("held", F.lit(False)).unionByName(test.withColumn("held", F.lit(True)))
        rows = flagged.select(F.lit(0).alias("tree"), F.col("doc_id").alias("id"), F.col("author").alias("label"), "held")
        return TR.grow(TR.dense_cells(flagged, M.FEATURES, "doc_id"), rows, max_depth=max_depth)
    rows = TR.splits(train.select(F.col("doc_id").alias("id"), F.col("author").alias("label")), n_splits, 23, 0.25)
    return TR.grow(TR.dense_cells(train, M.FEATURES, "doc_id"), rows, max_depth=max_depth)


def author_texts(spark, d):
    """The text path: (doc_id, author, is_test) by text (seed 23, 25 %), and the unsmoothed tf-idf of all documents."""
    docs = documents(spark, d)
    labels = docs.select("doc_id", F.col("source").alias("author"), FE.split_flag("text", "23", 0.25).alias("is_test"))
    weights, _ = FE.fit_tfidf(docs.withColumn("text", T.clean_text("text")), smooth=False, with_block=True)
    return written(labels, "author-labels"), kept(weights, "author-weights")


@query("decision_tree")
def q_decision_tree(spark, d):
    """Exact trees on both paths: the six statistics, and the tf-idf weights."""
    labels, weights = author_texts(spark, d)
    cells = weights.select(F.col("doc_id").alias("id"), F.col("term").alias("feature"), F.col("weight").alias("value"))
    rows = labels.select(F.lit(0).alias("tree"), F.col("doc_id").alias("id"), F.col("author").alias("label"), F.col("is_test").alias("held"))
    both = [metrics_trees(spark, d).leaves.withColumn("path", F.lit("statistics")),
            TR.grow(cells, rows).leaves.withColumn("path", F.lit("tfidf"))]
    return both[0].unionByName(both[1]).select("path", F.col("id").alias("doc_id"), "label", "prediction")


_AUTHOR = f"""{_TF_CLEAN},
n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w0 AS (SELECT doc_id, term, tf * (ln(n.n / df.df) + 1) AS w FROM tf JOIN df USING (term), n),
w AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w0),
lab AS (SELECT doc_id, source AS class, {S.split_flag('text', '23', 0.25)} AS is_test FROM documents)"""


@query("gaussian_nb", f"""WITH {_AUTHOR},
cls AS (SELECT class, count(*) AS n_c FROM lab WHERE NOT is_test GROUP BY class),
tot AS (SELECT sum(n_c) AS t, (SELECT count(DISTINCT term) FROM w) AS v FROM cls),
sums AS (SELECT term, class, sum(weight) AS s, sum(weight * weight) AS q FROM w JOIN lab USING (doc_id) WHERE NOT is_test GROUP BY term, class),
eps AS (SELECT 1e-9 * max(q / t - (s / t) * (s / t)) AS e FROM (SELECT sum(s) AS s, sum(q) AS q FROM sums GROUP BY term), tot),
cell AS (SELECT term, class, s / n_c AS mu, greatest(q / n_c - (s / n_c) * (s / n_c), 0) + e AS var FROM sums JOIN cls USING (class), eps),
base AS (SELECT class, ln(n_c / t) - 0.5 * (coalesce(seen, 0) + (v - coalesce(nnz, 0)) * ln(2 * pi() * e)) AS base
         FROM cls LEFT JOIN (SELECT class, sum(ln(2 * pi() * var) + mu * mu / var) AS seen, count(*) AS nnz FROM cell GROUP BY class) USING (class), tot, eps),
gain AS (SELECT doc_id, class, sum(0.5 * weight * weight * (1 / e - 1 / var) + weight * mu / var) AS gain FROM w JOIN cell USING (term), eps GROUP BY 1, 2),
sc AS (SELECT lab.doc_id, base.class, base + coalesce(gain, 0) AS score FROM lab CROSS JOIN base LEFT JOIN gain ON gain.doc_id = lab.doc_id AND gain.class = base.class),
rk AS (SELECT doc_id, class, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, class) AS rn FROM sc)
SELECT doc_id, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, lab.class AS label, rk.class AS prediction FROM lab JOIN rk USING (doc_id) WHERE rn = 1""")
def q_gaussian_nb(spark, d):
    labels, weights = author_texts(spark, d)
    model = LIN.gaussian_nb_fit(weights, labels.filter("NOT is_test"), label_col="author")
    pred = LIN.gaussian_nb_predict(model, labels, weights)
    split = F.when(F.col("is_test"), "test").otherwise("train").alias("split")
    return labels.join(pred, "doc_id").select("doc_id", split, F.col("author").alias("label"), "prediction")


@query("random_forest")
def q_random_forest(spark, d):
    v = sweep_vectors(spark, d)
    est = ML.CLASSIFIERS["random_forest"]().setParams(featuresCol="features", labelCol="label_idx")
    return v.named(est.fit(v.train).transform(v.test))


def _linear(v, rule, **params):
    return v.named(SL.predict(v.test, SL.fit(v.train, len(v.labels), rule, **params)))


def _l1_svc(v):
    return v.named(SL.predict(v.test, SL.fit_l1(v.train, len(v.labels))))


def _each(kind, parts):
    """The predictions of several settings, one under the other."""
    out = None
    for name, pred in parts.items():
        pred = pred.select(F.lit(name).alias(kind), "*")
        out = pred if out is None else out.unionByName(pred)
    return out


def _together(fits):
    """Independent fits at the same time: rows of one part keep one core busy."""
    with ThreadPoolExecutor(len(fits)) as pool:
        return dict(zip(fits, pool.map(lambda f: f(), fits.values())))


@query("linear_svc")
def q_linear_svc(spark, d):
    v = sweep_vectors(spark, d)
    return _each("penalty", _together({"l2": lambda: _linear(v, "svc", epochs=1000), "l1": lambda: _l1_svc(v)}))


@query("sgd_linear")
def q_sgd_linear(spark, d):
    v = sweep_vectors(spark, d)
    return _each("penalty", _together({p: partial(_linear, v, f"sgd_{p}") for p in ("l2", "l1", "elasticnet")}))


@query("ridge_classifier")
def q_ridge_classifier(spark, d):
    return _linear(sweep_vectors(spark, d), "ridge", epochs=1000)


@query("perceptron")
def q_perceptron(spark, d):
    return _linear(sweep_vectors(spark, d), "perceptron")


@query("passive_aggressive")
def q_passive_aggressive(spark, d):
    return _linear(sweep_vectors(spark, d), "pa")


@query("l1_select_then_svc")
def q_l1_select_then_svc(spark, d):
    v = sweep_vectors(spark, d)
    return v.named(SL.l1_select_then_svc(v.train, v.test, len(v.labels))[0])


GRID_DEPTHS, GRID_MIN_SPLITS, GRID_SPLITS = range(1, 30), range(2, 50), 10


def _grid(spark, d):
    """The score of each of 29 x 48 settings on each of 10 splits, from one tree a split."""
    # no setting looks below the greatest depth
    trees = metrics_trees(spark, d, GRID_SPLITS, max(GRID_DEPTHS))
    return TR.grid_scores(trees.nodes, GRID_DEPTHS, GRID_MIN_SPLITS)


@query("grid_search")
def q_grid_search(spark, d):
    return _grid(spark, d).withColumnRenamed("tree", "split")


@query("cv_results")
def q_cv_results(spark, d):
    return TR.mean_scores(_grid(spark, d))


def grid_and_whole(train, test) -> TR.Trees:
    """Trees 0 to 9 of the grid's splits of the training side, and tree 10 of all of it with the test side held out, grown together."""
    whole = train.withColumn("held", F.lit(False)).unionByName(test.withColumn("held", F.lit(True)))
    # an id may be on both sides
    key = lambda held: F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", held)).alias("id")
    label = F.col("author").alias("label")
    rows = TR.splits(train.select(F.col("doc_id").alias("id"), label), GRID_SPLITS, 23, 0.25).withColumnRenamed("id", "doc_id").select(
        "tree", key(F.lit(False)), "label", "held")
    rows = rows.unionByName(whole.select(F.lit(GRID_SPLITS).alias("tree"), key(F.col("held")), label, "held"))
    cells = TR.dense_cells(whole.withColumn("id", key(F.col("held"))), M.FEATURES, "id")
    return TR.grow(cells, rows, max_depth=max(GRID_DEPTHS))


@query("best_model")
def q_best_model(spark, d):
    # the setting that is chosen only stops growth earlier, so its tree is grown beside the grid's
    nodes = grid_and_whole(*metrics_split(spark, d)).nodes
    grid, whole = nodes.filter(F.col("tree") < GRID_SPLITS), nodes.filter(F.col("tree") == GRID_SPLITS)
    best = TR.best_setting(TR.mean_scores(TR.grid_scores(grid, GRID_DEPTHS, GRID_MIN_SPLITS))).first()
    if best is None:
        return spark.createDataFrame([], "max_depth int, min_samples_split int, mean_test_score double, test_accuracy double")
    scored = TR.cut_accuracy(whole, best["max_depth"], best["min_samples_split"])
    return scored.select(F.lit(best["max_depth"]).alias("max_depth"), F.lit(best["min_samples_split"]).alias("min_samples_split"),
                         F.lit(best["mean_test_score"]).alias("mean_test_score"), F.col("score").alias("test_accuracy"))


@query("build_and_evaluate")
def q_build_and_evaluate(spark, d):
    _, report, _ = TX.build_and_evaluate(documents(spark, d))
    return report


def _text_nb(train: str, new: str, prior: str = "ln(n_c / n.n)") -> str:
    """The text model with multinomial naive Bayes in SQL; ``train`` gives (k, class, text), ``new`` (k, text); ``pred`` (k, prediction)."""
    counts = "SELECT k, term, count(*) AS tf FROM (SELECT k, unnest({0}) AS term FROM {1}) GROUP BY k, term"
    unit = "SELECT k, term, w / sqrt(sum(w * w) OVER (PARTITION BY k)) AS weight FROM (SELECT k, term, tf * idf AS w FROM {0} JOIN idf USING (term))"
    return f"""tr AS ({train}), nw AS ({new}), n AS (SELECT count(*) AS n FROM tr),
tf AS ({counts.format(_FILT, 'tr')}), nf AS ({counts.format(_FILT, 'nw')}),
idf AS (SELECT term, ln((1 + n.n) / (1 + df)) + 1 AS idf FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), n),
w AS ({unit.format('tf')}), x AS ({unit.format('nf')}),
fc AS (SELECT term, class, sum(weight) AS fc FROM w JOIN tr USING (k) GROUP BY term, class),
tot AS (SELECT class, sum(fc) AS tot, count(*) AS cells FROM fc GROUP BY class),
k AS (SELECT count(DISTINCT class) AS k, (SELECT count(*) FROM idf) AS v FROM tr),
cp AS (SELECT class, n_c, {prior} AS log_prior, ln(coalesce(tot, 0) + 0.01 * k.v) AS log_denom, coalesce(cells, 0) AS cells
       FROM (SELECT class, count(*) AS n_c FROM tr GROUP BY class) LEFT JOIN tot USING (class), n, k),
gain AS (SELECT x.k, class, sum(weight * (ln(fc + 0.01) - ln(0.01))) AS g FROM x JOIN fc USING (term) GROUP BY x.k, class),
xs AS (SELECT k, sum(weight) AS x FROM x GROUP BY k),
sc AS (SELECT nw.k, cp.class, log_prior + coalesce(xs.x, 0) * (ln(0.01) - log_denom) + coalesce(g, 0) AS score
       FROM nw CROSS JOIN cp LEFT JOIN xs ON xs.k = nw.k LEFT JOIN gain ON gain.k = nw.k AND gain.class = cp.class),
pred AS (SELECT k, class AS prediction FROM (SELECT k, class, row_number() OVER (PARTITION BY k ORDER BY score DESC, class) AS rn FROM sc) WHERE rn = 1)"""


_HELD = S.split_flag("text", "0", 0.2)
_ALL = "SELECT doc_id AS k, lang AS class, text FROM documents"


def _holdout_report(kind: str, prior: str) -> str:
    """classification_report of the holdout, as one parenthesised SELECT."""
    return f"""(WITH {_text_nb(f"{_ALL} WHERE NOT {_HELD}", f"SELECT doc_id AS k, text FROM documents WHERE {_HELD}", prior)},
p AS (SELECT lang AS label, prediction FROM pred JOIN documents ON doc_id = pred.k),
t AS (SELECT class, (SELECT count(*) FROM p WHERE label = class) AS support, (SELECT count(*) FROM p WHERE prediction = class) AS np,
             (SELECT count(*) FROM p WHERE label = class AND prediction = class) AS tp
      FROM (SELECT label AS class FROM p UNION SELECT prediction FROM p)),
m AS (SELECT class, CASE WHEN np > 0 THEN tp / np ELSE 0.0 END AS p, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r, support FROM t),
f AS (SELECT class, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f, support FROM m)
SELECT '{kind}' AS classifier, class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support::BIGINT AS support FROM f
UNION ALL SELECT '{kind}', 'avg / total', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
       round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM f)"""


@query("pluggable_classifier", f"""SELECT * FROM {_holdout_report('rule', 'ln(n_c / n.n)')}
UNION ALL SELECT * FROM {_holdout_report('estimator', 'ln(n_c + 0.01) - ln(n.n + 0.01 * k.k)')}""")
def q_pluggable_classifier(spark, d):
    """The class of a rule, and an instance of a ``pyspark.ml`` estimator (which smooths its priors, too)."""
    given = {"rule": TX.MultinomialNB, "estimator": NaiveBayes(modelType="multinomial", smoothing=0.01)}
    out = _each("classifier", {k: TX.build_and_evaluate(documents(spark, d), c)[1] for k, c in given.items()})
    return out.select("classifier", "class", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1")], "support")


def _text_model(spark, d) -> TX.TextModel:
    return TX.fit_text_model(documents(spark, d), TX.MultinomialNB(alpha=0.01))


_NEW = f"WITH {_text_nb(_ALL, 'SELECT item_id AS k, text FROM benchmark')} SELECT k AS item_id,"


@query("predict_new", f"{_NEW} prediction FROM pred")
def q_predict_new(spark, d):
    return _text_model(spark, d).predict(table(spark, d, "benchmark"), out_col="prediction").select("item_id", "prediction")


@query("save_model", f"""WITH {_text_nb(_ALL, 'SELECT item_id AS k, text FROM benchmark')}
SELECT 'multinomial_nb' AS rule, class, n_c::BIGINT AS n_documents, cells::BIGINT AS n_cells, round(log_prior, 6) AS log_prior,
       round(log_denom, 6) AS log_denom FROM cp""")
def q_save_model(spark, d):
    """What the saved folder holds for each class."""
    path = shared_path(spark, "models", "text")
    TX.save_model(_text_model(spark, d), path)
    stored = TX.load_model(spark, path)
    cells = stored.tables["cells"].groupBy("class").agg(F.count(F.lit(1)).alias("n_cells"))
    return stored.tables["classes"].join(cells, "class", "left").select(
        F.lit(stored.rule.name).alias("rule"), "class", F.col("n_c").alias("n_documents"), F.coalesce("n_cells", F.lit(0)).cast("long").alias("n_cells"),
        F.round("log_prior", 6).alias("log_prior"), F.round("log_denom", 6).alias("log_denom"))


@query("load_model", f"{_NEW} prediction AS first, prediction AS reloaded, true AS same FROM pred")
def q_load_model(spark, d):
    path = shared_path(spark, "models", "text")
    model = TX.load_or_train(spark, path, lambda: _text_model(spark, d))

    def absent():
        raise AssertionError("the saved model must be found")
    again = TX.load_or_train(spark, path, absent)
    bench = table(spark, d, "benchmark").select("item_id", "text")
    both = again.predict(model.predict(bench, out_col="first"), out_col="reloaded")
    return both.select("item_id", "first", "reloaded", (F.col("first") == F.col("reloaded")).alias("same"))


@query("assemble_features", f"""WITH {S.metrics_cte()},
f AS (SELECT doc_id, {S.metric_columns()} FROM m WHERE len(lens) > 0)
{" UNION ALL ".join(f"SELECT doc_id, {i} AS position, {c}::DOUBLE AS value FROM f" for i, c in enumerate(M.FEATURES))}""")
def q_assemble_features(spark, d):
    """The assembled vectors, a row for each component."""
    m = metric_scalars(metrics(spark, d))
    v = ML.as_arrays(FE.assemble_features(m, M.FEATURES))
    return v.select("doc_id", F.posexplode("features").alias("position", "value"))


@query("coef_density")
def q_coef_density(spark, d):
    v = sweep_vectors(spark, d)
    names = spark.createDataFrame(list(enumerate(v.labels)), "class int, label string")
    cells = SL.fit_l1(v.train, len(v.labels)).cells.filter(F.col("term") != SL.BIAS)
    density = EV.coef_density(cells, v.size, names)
    return density.join(names, "class").select(F.col("label").alias("class"), "dimensionality", "density")


@query("classifier_leaderboard")
def q_classifier_leaderboard(spark, d):
    """The sweep's 14 fits on one set of features."""
    train, test, w_train, w_test, idf = sweep_tfidf(spark, d)
    w_test = kept(w_test, "sweep-test-weights")
    v = ML.vectorise(train, test, w_train, w_test, idf)
    labels = train.select("doc_id", "lang")
    k = len(v.labels)

    def forest():
        est = ML.CLASSIFIERS["random_forest"]().setParams(featuresCol="features", labelCol="label_idx")
        model = est.fit(v.train)
        return lambda: v.named(model.transform(v.test))

    def linear(rule, **params):
        def go():
            w = SL.fit_l1(v.train, k) if rule == "svc_l1" else SL.fit(v.train, k, rule, **params)
            return lambda: v.named(SL.predict(v.test, w))
        return go

    def long_form(fit, predict):
        def go():
            model = fit(w_train, labels)
            return lambda: test.select("doc_id", F.col("lang").alias("label")).join(predict(model, test, w_test), "doc_id")
        return go

    def selected():
        pred, _ = SL.l1_select_then_svc(v.train, v.test, k)
        return lambda: v.named(pred)

    def knn():
        return lambda: v.named(ML.knn_sparse(v.train, v.test, 10))

    fits = [("ridge", linear("ridge", epochs=1000)), ("perceptron", linear("perceptron")), ("passive_aggressive", linear("pa")),
            ("knn", knn), ("random_forest", forest), ("linear_svc_l2", linear("svc", epochs=1000)), ("sgd_l2", linear("sgd_l2")),
            ("linear_svc_l1", linear("svc_l1")), ("sgd_l1", linear("sgd_l1")), ("sgd_elasticnet", linear("sgd_elasticnet")),
            ("nearest_centroid", long_form(LIN.nearest_centroid_fit, LIN.nearest_centroid_predict)),
            ("multinomial_nb", long_form(LIN.multinomial_nb_fit, LIN.multinomial_nb_predict)),
            ("bernoulli_nb", long_form(LIN.bernoulli_nb_fit, LIN.bernoulli_nb_predict)),
            ("l1_select_then_svc", selected)]
    rows = [ML.time_and_score(name, fit) for name, fit in fits]
    res = spark.createDataFrame(rows, "classifier string, accuracy double, train_time double, test_time double")
    return EV.normalise_times(res)


@query("token_transformer", f"SELECT doc_id, array_to_string({_FILT}, ' ') AS tokens FROM documents")
def q_token_transformer(spark, d):
    out = ML.TokenTransformer(inputCol="text", outputCol="tok").transform(documents(spark, d))
    return out.select("doc_id", F.array_join("tok", " ").alias("tokens"))


_WS_TOK = ("list_filter(list_transform(string_split_regex(text, '\\s+'), lambda t: trim(trim(trim(lower(t)), '_'), '*')), "
           f"lambda t: NOT list_contains({S.STOP}, t) AND NOT regexp_matches(t, {S.lit(T.PUNCT_ONLY)}))")


@query("custom_tokenizer", f"SELECT doc_id, array_to_string({_WS_TOK}, ' ') AS tokens FROM documents")
def q_custom_tokenizer(spark, d):
    tok = ML.TokenTransformer(inputCol="text", outputCol="tok")
    tok.tokenizer = lambda c: F.split(c, r"\s+", -1)
    out = tok.transform(documents(spark, d))
    return out.select("doc_id", F.array_join("tok", " ").alias("tokens"))


@query("custom_scorer")
def q_custom_scorer(spark, d):
    tr = sweep_vectors(spark, d).train
    lr = ML.GatheredLogisticRegression(featuresCol="features", labelCol="label_idx", maxIter=50)
    grid = ParamGridBuilder().addGrid(lr.regParam, [1e-3, 1e-1]).build()
    scorer = MulticlassClassificationEvaluator(labelCol="label_idx", metricName="accuracy")
    m = TrainValidationSplit(estimator=lr, estimatorParamMaps=grid, evaluator=scorer, trainRatio=0.75,
                             seed=23).fit(tr)
    rows = [(float(pm[lr.regParam]), float(s)) for pm, s in zip(grid, m.validationMetrics)]
    return spark.createDataFrame(rows, "reg_param double, accuracy double")
