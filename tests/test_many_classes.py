"""Naive Bayes and nearest centroid with many classes: documents never meet all of them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from penmark.operators import linear as L


def lines(spark, rows):
    return spark.createDataFrame(rows, "class string, icept double, slope double")


def ask(spark, envelope, xs, **kw):
    docs = spark.createDataFrame(list(enumerate(xs)), "doc_id long, _x double")
    best = L._best(L.envelope_classes(docs, envelope, "doc_id", **kw), "doc_id")
    return {r["doc_id"]: r["prediction"] for r in best.collect()}


@pytest.mark.parametrize("per_part", [10_000, 37])
def test_envelope_equals_the_best_line(spark, per_part):
    rng = random.Random(7)
    rows = [(f"c{i:03d}", rng.randint(-40, 40) / 4, -rng.random() * 5) for i in range(300)]
    rows += [("a", *rows[0][1:]), ("z", *rows[0][1:])]       # equal lines: the first class
    xs = [0.0, *[rng.random() * 12 for _ in range(200)]]
    got = ask(spark, L.upper_envelope(lines(spark, rows), per_part), xs, rows_per_part=50)
    for i, x in enumerate(xs):
        assert got[i] == min((-(b + a * x), c) for c, b, a in rows)[1], x


def test_equal_intercepts_at_zero_go_to_the_first_class(spark):
    rows = [("b", 1.0, 3.0), ("a", 1.0, -1.0), ("c", 1.0, 5.0)]
    assert ask(spark, L.upper_envelope(lines(spark, rows)), [0.0, 1.0]) == {0: "a", 1: "c"}


def test_envelope_of_nothing(spark):
    assert ask(spark, L.upper_envelope(lines(spark, [])), [1.0]) == {}


def test_first_untouched(spark):
    ranked = spark.createDataFrame([(r, f"c{r}") for r in (1, 2, 3)], "rank int, class string")
    docs = spark.createDataFrame([(i,) for i in range(4)], "doc_id long")
    touched = spark.createDataFrame([(0, 1), (0, 2), (0, 1), (1, 2), (1, 3), (2, 3), (2, 1), (2, 2)], "doc_id long, rank int")
    got = {r["doc_id"]: r["class"] for r in L.first_untouched(docs, touched, ranked, "doc_id").collect()}
    assert got == {0: "c3", 1: "c1", 3: "c1"}


def plain(kind, train, x, alpha=0.01):
    """{class: score} of one document x over all classes; train: [(class, {term: weight})]."""
    terms = sorted({t for _, w in train for t in w})
    out = {}
    for c in sorted({c for c, _ in train}):
        own = [w for k, w in train if k == c]
        if kind == "centroid":
            mean = {t: sum(w.get(t, 0.0) for w in own) / len(own) for t in terms}
            out[c] = -sum((x.get(t, 0.0) - mean[t]) ** 2 for t in terms)
            continue
        out[c] = math.log(len(own) / len(train))
        if kind == "multinomial":
            total = sum(sum(w.values()) for w in own) + alpha * len(terms)
            out[c] += sum(v * math.log((sum(w.get(t, 0.0) for w in own) + alpha) / total) for t, v in x.items())
        else:
            for t in terms:
                p = (sum(t in w for w in own) + alpha) / (len(own) + 2 * alpha)
                out[c] += math.log(p if t in x else 1 - p)
    return out


@pytest.mark.parametrize("kind", ["multinomial", "bernoulli", "centroid"])
def test_equal_to_scoring_every_class(spark, kind):
    rng = random.Random(3)
    sign = (lambda: rng.choice([-1, 1])) if kind == "centroid" else (lambda: 1)
    some = lambda n: {f"t{rng.randrange(25)}": sign() * (rng.random() + 0.1) for _ in range(n)}
    train = [(f"k{rng.randrange(30):02d}", some(rng.randint(1, 6))) for _ in range(120)]
    ask_for = [some(rng.randint(0, 5)) for _ in range(60)]
    terms = {t for _, w in train for t in w}
    ask_for = [{t: v for t, v in x.items() if t in terms} for x in ask_for]
    table = lambda xs: spark.createDataFrame([(i, t, v) for i, x in xs for t, v in x.items()], "doc_id long, term string, weight double")
    w = table(list(enumerate(x for _, x in train)))
    labels = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(train)], "doc_id long, lang string")
    docs = spark.createDataFrame([(i,) for i in range(len(ask_for))], "doc_id long")
    fit, predict = {"multinomial": (L.multinomial_nb_fit, L.multinomial_nb_predict), "bernoulli": (L.bernoulli_nb_fit, L.bernoulli_nb_predict),
                    "centroid": (L.nearest_centroid_fit, L.nearest_centroid_predict)}[kind]
    got = {r["doc_id"]: r["prediction"] for r in predict(fit(w, labels), docs, table(list(enumerate(ask_for)))).collect()}
    assert len(got) == len(ask_for)
    for i, x in enumerate(ask_for):
        score = plain(kind, train, x)
        assert score[got[i]] >= max(score.values()) - 1e-9


def test_no_documents_by_classes_in_the_plan(spark):
    labels = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, lang string")
    w = spark.createDataFrame([(1, "x", 1.0), (2, "y", 1.0)], "doc_id long, term string, weight double")
    docs = labels.select("doc_id")
    plan = L.nearest_centroid_predict(L.nearest_centroid_fit(w, labels), docs, w)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "Cross" not in plan
