"""Classifiers that are aggregates over the long (doc_id, term, weight) table.

Naive Bayes and nearest centroid score a document against every class as

    score(d, c) = base(d, c) + sum over the document's terms of delta(t, c) * x(d, t)

where ``base`` covers all vocabulary terms in closed form and ``delta`` exists
only for (class, term) cells seen in training. Documents never meet all classes: a
document is scored against the classes it shares a term with in its block
(``penmark.operators.blocks``), and against the best of the others, which is a lookup. For naive Bayes the base is a line
in a sum over the document's terms, so that lookup is the upper envelope of the classes'
lines; seen cells only add to a score, so the envelope's class may be one of the touched
ones without harm. For centroids it is the first class, in the order of the base, that the
document doesn't touch.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penmark.operators.blocks import class_gains, class_sums, per_document
from penmark.operators.skew import top_k_per_group
from penmark.session import written

ENVELOPE_LINES = 100_000     # lines whose envelope one task forms
LOOKUP_ROWS = 500_000        # documents one task looks up in an envelope
KNN_TASKS = 10_000           # tasks that pairs of blocks are dealt to at most


def _best(scores: DataFrame, id_col: str) -> DataFrame:
    """(id, prediction) of rows (id, score, class): the greatest score, ties to the first class."""
    return scores.groupBy(id_col).agg(F.min(F.struct((-F.col("score")).alias("m"), "class")).alias("b")).select(
        id_col, F.col("b.class").alias("prediction"))


def _envelope(lines: pd.DataFrame) -> pd.DataFrame:
    """The lines that are greatest somewhere on x >= 0, each with the x from which on it is; before them, once more,
    the line that is greatest at 0 itself, which is the first class of those with the greatest intercept."""
    at_zero = lines.sort_values(["icept", "class"], ascending=[False, True]).iloc[:1]
    lines = lines.sort_values(["slope", "icept", "class"], ascending=[True, False, True]).drop_duplicates("slope")
    a, b = lines["slope"].to_numpy(), lines["icept"].to_numpy()
    kept: list[int] = []
    since: list[float] = []
    for i in range(len(a)):
        x = 0.0
        while kept:
            x = (b[kept[-1]] - b[i]) / (a[i] - a[kept[-1]])   # from here on line i is above the last one
            if x > since[-1]:
                break
            kept.pop()
            since.pop()
            x = 0.0
        kept.append(i)
        since.append(x)
    return pd.concat([at_zero.assign(since=0.0), lines.iloc[kept].assign(since=since)])


def upper_envelope(lines: DataFrame, lines_per_part: int = ENVELOPE_LINES) -> tuple[DataFrame, int]:
    """The upper envelope on x >= 0 of lines (class, icept, slope) as rows (part, since, class, icept, slope), and the parts.

    Lines are dealt to parts of about ``lines_per_part`` and every part keeps its own envelope; what is left is dealt out
    again until it fits into one part or a round drops less than half. With several parts the greatest of the
    parts' values is the envelope's.
    """
    schema = "part int, since double, class string, icept double, slope double"

    def part(x: pd.DataFrame) -> pd.DataFrame:
        return _envelope(x)[["part", "since", "class", "icept", "slope"]]

    left, n = lines.select("class", F.col("icept").cast("double"), F.col("slope").cast("double")), lines.count()
    while True:
        parts = max(1, -(-n // lines_per_part))
        dealt = left.withColumn("part", F.pmod(F.xxhash64("class"), F.lit(parts)).cast("int"))
        out = written(dealt.groupBy("part").applyInPandas(part, schema), "envelope")
        m = out.count()
        if parts == 1 or 2 * m > n:
            return out, parts
        left, n = out.select("class", "icept", "slope").distinct(), m


def envelope_classes(docs: DataFrame, envelope: tuple[DataFrame, int], id_col: str, rows_per_part: int = LOOKUP_ROWS) -> DataFrame:
    """(id, score, class): the greatest of the lines at every document's ``_x`` >= 0, a row for each part of the envelope."""
    lines, parts = envelope
    blocks = max(1, -(-docs.select(id_col).count() // rows_per_part))
    dealt = docs.select(F.col(id_col).alias("id"), F.col("_x").alias("x"), F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int").alias("block"),
                        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    sides = lines.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    schema = docs.select(F.col(id_col).alias("id"), F.lit(0.0).alias("score"), F.lit("").alias("class")).schema

    def look(rows: pd.DataFrame, env: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or env.empty:
            return pd.DataFrame({"id": rows["id"].iloc[:0], "score": np.zeros(0), "class": np.zeros(0, object)})
        env = env.sort_values(["since", "slope"], kind="stable").reset_index(drop=True)
        x, a, b = rows["x"].to_numpy(np.float64), env["slope"].to_numpy(), env["icept"].to_numpy()
        order = env["class"].rank(method="dense").to_numpy()
        at = np.searchsorted(env["since"].to_numpy(), x, side="right") - 1
        # the neighbours too: at a corner of the envelope rounding may put x on the wrong side
        near = np.clip(at[:, None] + np.array([-2, -1, 0, 1]), 0, len(env) - 1)
        value = b[near] + x[:, None] * a[near]
        best = np.lexsort((order[near], -value), axis=1)[:, 0]
        pick = near[np.arange(len(x)), best]
        return pd.DataFrame({"id": rows["id"].to_numpy(), "score": value[np.arange(len(x)), best], "class": env["class"].to_numpy()[pick]})

    found = dealt.groupBy("block", "part").cogroup(sides.groupBy("block", "part")).applyInPandas(look, schema)
    return found.withColumnRenamed("id", id_col)


def first_untouched(docs: DataFrame, touched: DataFrame, ranked: DataFrame, id_col: str) -> DataFrame:
    """Every document with the row of ``ranked`` (rank from 1, ...) of the least rank that isn't among its ``touched`` (id, rank);
    none if it touches all. A document's ranks are at most the cells of its own terms."""
    ranks = F.array_sort(F.collect_set("rank"))
    gap = F.array_position(F.transform(ranks, lambda r, i: r != i + 1), True)
    least = touched.groupBy(id_col).agg(F.when(gap > 0, gap).otherwise(F.size(F.collect_set("rank")) + 1).cast("long").alias("rank"))
    every = docs.select(id_col).join(least, id_col, "left").withColumn("rank", F.coalesce("rank", F.lit(1).cast("long")))
    return every.join(ranked.withColumn("rank", F.col("rank").cast("long")), "rank")


def ranked_classes(classes: DataFrame, best_first: Column) -> DataFrame:
    """``classes`` with rank from 1 in the order of ``best_first``, ties by class; a window over one row per label."""
    return classes.withColumn("rank", F.row_number().over(Window.orderBy(best_first, "class")))


def _line_predict(classes: DataFrame, icept: Column, slope: Column, gain: DataFrame, docs: DataFrame, id_col: str) -> DataFrame:
    """Best class of docs (id, _x) by icept + slope * _x, plus the gains >= 0 (id, class, gain) where there are any."""
    lines = written(classes.select("class", icept.alias("icept"), slope.alias("slope")), "lines")
    touched = gain.join(lines, "class").join(docs, id_col).select(
        id_col, (F.col("icept") + F.col("_x") * F.col("slope") + F.col("gain")).alias("score"), "class")
    return _best(touched.unionByName(envelope_classes(docs, upper_envelope(lines), id_col)), id_col)


def _classes(labels: DataFrame, label_col: str) -> DataFrame:
    return labels.groupBy(F.col(label_col).cast("string").alias("class")).agg(F.count(F.lit(1)).alias("n_c"))


def _terms(weights: DataFrame) -> Column:
    """The number of distinct terms, counted once."""
    return written(weights.select("term").distinct().agg(F.count(F.lit(1)).alias("v")), "terms").scalar()


def multinomial_nb_fit(weights: DataFrame, labels: DataFrame, alpha: float = 0.01,
                       id_col: str = "doc_id", label_col: str = "lang"):
    """Fitted tables: classes (class, n_c, log_prior, log_denom) and
    cells (term, class, log_theta, delta). Weights are not negative."""
    n = labels.select(F.count(F.lit(1))).scalar()
    classes = _classes(labels, label_col).withColumn("log_prior", F.log(F.col("n_c") / n))
    v = _terms(weights)
    fc = written(class_sums(weights, labels, {"fc": 1}, id_col, label_col), "class-sums")
    tot = fc.groupBy("class").agg(F.sum("fc").alias("tot"))
    classes = (classes.join(tot, "class", "left").fillna(0.0, ["tot"])
               .withColumn("log_denom", F.log(F.col("tot") + F.lit(alpha) * v)))
    cells = (fc.join(classes.select("class", "log_denom"), "class")
             .withColumn("log_theta", F.log(F.col("fc") + alpha) - F.col("log_denom"))
             .withColumn("delta", F.log(F.col("fc") + alpha) - F.lit(math.log(alpha))))
    return classes, cells


def multinomial_nb_predict(model, docs: DataFrame, weights: DataFrame | Sequence[DataFrame], alpha: float = 0.01,
                           id_col: str = "doc_id") -> DataFrame:
    classes, cells = model
    xsum = per_document(weights, id_col, F.col("weight"), "_x")
    d = written(docs.select(id_col).join(xsum, id_col, "left").fillna(0.0, ["_x"]), "document-sums")
    gain = class_gains(weights, cells, {"delta": 1}, id_col)
    return _line_predict(classes, F.col("log_prior"), F.lit(math.log(alpha)) - F.col("log_denom"), gain, d, id_col)


def bernoulli_nb_fit(weights: DataFrame, labels: DataFrame, alpha: float = 0.01,
                     id_col: str = "doc_id", label_col: str = "lang"):
    """Binary features (weight > 0). Tables: classes (log_prior, s_neg, k0) and
    cells (term, class, delta)."""
    n = labels.select(F.count(F.lit(1))).scalar()
    classes = _classes(labels, label_col).withColumn("log_prior", F.log(F.col("n_c") / n))
    vocab = weights.filter(F.col("weight") > 0).select("term").distinct()
    vocab = written(vocab, "vocabulary")
    v = vocab.select(F.count(F.lit(1))).scalar()
    dfc = class_sums(weights.filter(F.col("weight") > 0), labels, {"df_c": 0}, id_col, label_col)
    dfc = written(dfc.withColumn("df_c", F.col("df_c").cast("long")), "class-counts")
    cells = dfc.join(classes.select("class", "n_c"), "class")
    lp = F.log(F.col("df_c") + alpha) - F.log(F.col("n_c") + 2 * alpha)
    neg = F.log(F.col("n_c") + alpha - F.col("df_c")) - F.log(F.col("n_c") + 2 * alpha)
    cells = cells.withColumn("lp", lp).withColumn("neg", neg)
    k0 = F.lit(math.log(alpha)) - F.log(F.col("n_c") + alpha)
    neg0 = F.log(F.col("n_c") + alpha) - F.log(F.col("n_c") + 2 * alpha)
    per_class = cells.groupBy("class").agg(F.sum("neg").alias("s_neg_seen"), F.count(F.lit(1)).alias("nnz"))
    classes = (classes.join(per_class, "class", "left").fillna({"s_neg_seen": 0.0, "nnz": 0})
               .withColumn("s_neg", F.col("s_neg_seen") + (F.lit(v) - F.col("nnz")) * neg0)
               .withColumn("k0", k0))
    cells = (cells.join(classes.select("class", "k0"), "class")
             .withColumn("delta", F.col("lp") - F.col("neg") - F.col("k0")))
    return classes, cells, vocab


def bernoulli_nb_predict(model, docs: DataFrame, weights: DataFrame | Sequence[DataFrame], id_col: str = "doc_id") -> DataFrame:
    classes, cells, vocab = model
    present = [w.filter(F.col("weight") > 0) for w in ([weights] if isinstance(weights, DataFrame) else weights)]
    # how many known terms a document has: the vocabulary as a class of its own
    known = vocab.select("term", F.lit("").alias("class"), F.lit(1.0).alias("one"))
    cnt = class_gains(present, known, {"one": 0}, id_col).select(id_col, F.col("gain").alias("_x"))
    d = written(docs.select(id_col).join(cnt, id_col, "left").fillna(0.0, ["_x"]), "document-sums")
    gain = class_gains(present, cells, {"delta": 0}, id_col)
    return _line_predict(classes, F.col("log_prior") + F.col("s_neg"), F.col("k0"), gain, d, id_col)


def gaussian_nb_fit(weights: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "lang",
                    floor: float = 1e-9) -> tuple[DataFrame, DataFrame]:
    """Gaussian naive Bayes over sparse non-negative weights; no dense vector anywhere.

    Every variance is raised by ``floor`` times the largest variance of a term over all training rows. A (class, term)
    pair without a weight has mean 0 and that least variance e. Up to what all classes share, a document's
    log-likelihood is its class's ``base`` (all terms at zero, in closed form) plus, for each of its terms x seen in the
    class, x^2/2 (1/e - 1/var) + x mu/var. Returned: classes (class, base) and cells (term, class, half, lin), the
    factors of x^2 and x. ``weights`` may hold more documents than ``labels``; all their terms are the vocabulary.
    """
    labels = labels.select(id_col, F.col(label_col).cast("string").alias("class"))
    counts = labels.groupBy("class").agg(F.count(F.lit(1)).alias("n_c"))
    t = labels.select(F.count(F.lit(1))).scalar()
    sums = written(class_sums(weights, labels, {"s": 1, "q": 2}, id_col, "class"), "gaussian-sums")
    spread = sums.groupBy("term").agg(F.sum("s").alias("s"), F.sum("q").alias("q"))
    e = written(spread.agg((floor * F.max(F.col("q") / t - (F.col("s") / t) * (F.col("s") / t))).alias("e")), "gaussian-floor").scalar()
    v = written(weights.agg(F.count_distinct("term").alias("v")), "gaussian-terms").scalar()
    mean = F.col("s") / F.col("n_c")
    var = F.greatest(F.col("q") / F.col("n_c") - mean * mean, F.lit(0.0)) + e
    cells = sums.join(counts, "class").select("term", "class", mean.alias("mu"), var.alias("var"))
    tau = 2 * math.pi
    seen = cells.groupBy("class").agg(F.sum(F.log(F.lit(tau) * F.col("var")) + F.col("mu") * F.col("mu") / F.col("var")).alias("seen"),
                                      F.count(F.lit(1)).alias("nnz"))
    empty = (F.coalesce(v, F.lit(0)) - F.coalesce("nnz", F.lit(0))) * F.log(F.lit(tau) * e)
    base = F.log(F.col("n_c") / t) - 0.5 * (F.coalesce("seen", F.lit(0.0)) + F.coalesce(empty, F.lit(0.0)))
    classes = counts.join(seen, "class", "left").select("class", base.alias("base"))
    return classes, cells.select("term", "class", (0.5 * (1 / e - 1 / F.col("var"))).alias("half"), (F.col("mu") / F.col("var")).alias("lin"))


def gaussian_nb_predict(model: tuple[DataFrame, DataFrame], docs: DataFrame, weights: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, prediction); ties go to the first class.

    Seen terms only add to a class's base. So the best class is among those a document shares a term
    with, or it is the one with the greatest base: documents never meet all classes.
    """
    classes, cells = model
    classes = written(classes, "gaussian-classes")
    gain = class_gains(weights, cells, {"half": 2, "lin": 1}, id_col)
    touched = gain.join(classes, "class").select(id_col, (-(F.col("base") + F.col("gain"))).alias("m"), "class")
    top = classes.agg(F.min(F.struct((-F.col("base")).alias("m"), "class")).alias("b")).select("b").scalar()
    rest = docs.select(id_col, top.alias("b")).select(id_col, "b.m", "b.class")
    return touched.unionByName(rest).groupBy(id_col).agg(F.min(F.struct("m", "class")).alias("b")).select(
        id_col, F.col("b.class").alias("prediction"))


def nearest_centroid_fit(weights: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                         label_col: str = "lang"):
    """Class mean vectors (zeros included): classes (class, n_c, norm2), cells (term, class, mu)."""
    classes = _classes(labels, label_col)
    sums = written(class_sums(weights, labels, {"s": 1}, id_col, label_col), "class-sums")
    cells = (sums.join(classes.select("class", "n_c"), "class")
             .withColumn("mu", F.col("s") / F.col("n_c")))
    norms = cells.groupBy("class").agg(F.sum(F.col("mu") * F.col("mu")).alias("norm2"))
    classes = classes.join(norms, "class", "left").fillna(0.0, ["norm2"])
    return classes, cells


def nearest_centroid_predict(model, docs: DataFrame, weights: DataFrame | Sequence[DataFrame], id_col: str = "doc_id") -> DataFrame:
    """(id, prediction): least |x - mean|^2, ties to the first class. |x|^2 is the same for all classes and left out."""
    classes, cells = model
    ranked = written(ranked_classes(classes, F.col("norm2")).select("class", "norm2", "rank"), "centroids")
    dots = class_gains(weights, cells, {"mu": 1}, id_col).withColumnRenamed("gain", "dot")
    touched = written(dots.join(ranked, "class"), "centroid-dots")   # read twice
    untouched = first_untouched(docs, touched, ranked, id_col).select(id_col, (-F.col("norm2")).alias("score"), "class")
    return _best(touched.select(id_col, (2.0 * F.col("dot") - F.col("norm2")).alias("score"), "class").unionByName(untouched), id_col)


def binary_log_odds(cells: DataFrame, weights: DataFrame, positive: str, negative: str,
                    alpha: float = 0.01) -> DataFrame:
    """(term, weight): log P(term | positive) - log P(term | negative) over the vocabulary.

    The linear coefficient of a two-class naive Bayes; unseen cells take the
    smoothed value ln(alpha) - log_denom of their class.
    """
    denom = cells.select("class", "log_denom").distinct()
    dp = denom.filter(F.col("class") == positive).select(F.first("log_denom")).scalar()
    dn = denom.filter(F.col("class") == negative).select(F.first("log_denom")).scalar()
    lt = cells.groupBy("term").agg(
        F.max(F.when(F.col("class") == positive, F.col("log_theta"))).alias("p"),
        F.max(F.when(F.col("class") == negative, F.col("log_theta"))).alias("n"))
    vocab = weights.select("term").distinct()
    la = F.lit(math.log(alpha))
    return vocab.join(lt, "term", "left").select(
        "term", (F.coalesce("p", la - dp) - F.coalesce("n", la - dn)).alias("weight"))


def nb_top_terms(cells: DataFrame, k: int = 10) -> DataFrame:
    """The k highest log-probability terms per class (ties by term)."""
    top = top_k_per_group(cells, ["class"], [F.col("log_theta").desc(), F.col("term")], k)
    return top.select("class", "rank", "term", F.col("log_theta").alias("weight"))


# ------------------------------------------------------------------ exact kNN

def _nearest(a: np.ndarray, b: np.ndarray, t_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The places in ``a`` and the squared distances of the k rows nearest to every row of ``b``, ties by id.

    Distances are direct squared differences (exact ties stay ties). They are formed for those rows only that a matrix product
    doesn't rule out: those within its error bound of the k-th least.
    """
    near, dist = np.empty((len(b), k), np.int64), np.empty((len(b), k))
    a2, b2 = np.einsum("td,td->t", a, a), np.einsum("qd,qd->q", b, b)
    error = 4 * (a.shape[1] + 8) * np.finfo(float).eps * (np.sqrt(a2.max()) + np.sqrt(b2)) ** 2
    step = max(1, 4_000_000 // len(a))
    for lo in range(0, len(b), step):
        part = a2 - 2.0 * (b[lo:lo + step] @ a.T)   # |b|^2 is the same for all
        bound = np.partition(part, k - 1, axis=1)[:, k - 1] + 4 * error[lo:lo + step]
        for q, (row, most) in enumerate(zip(part, bound), lo):
            own = np.flatnonzero(row <= most) if np.isfinite(most) else np.arange(len(a))
            diff = b[None, q, None] - a[None, own]
            d2 = np.einsum("qtd,qtd->qt", diff, diff)[0]
            order = np.lexsort((t_ids[own], d2))[:k]
            near[q], dist[q] = own[order], d2[order]
    return near, dist


def knn_predict(train: DataFrame, test: DataFrame, k: int = 10, id_col: str = "vec_id",
                vec_col: str = "embedding", label_col: str = "label",
                train_blocks: int | None = None, test_blocks: int | None = None,
                train_rows_per_block: int = 50_000, test_rows_per_block: int = 5_000) -> DataFrame:
    """Exact k nearest neighbours (Euclidean, ties by id) and majority vote.

    Block nested loop: train rows go to ``train_blocks`` blocks and test rows
    to ``test_blocks``; each (train block, test block) pair meets in one
    ``cogroup`` task that computes its distance matrix with numpy and emits only
    its k best per test row. No pair is materialised as a row, no side is
    broadcast, and every task holds one block of each side.
    """
    # Block counts follow the data so that one task holds at most about
    # train_rows_per_block x test_rows_per_block distances.
    tb = train_blocks or max(1, -(-train.count() // train_rows_per_block))
    qb = test_blocks or max(1, -(-test.count() // test_rows_per_block))
    par = train.sparkSession.sparkContext.defaultParallelism
    if train_blocks is None and test_blocks is None and tb * qb < par:
        qb = max(qb, -(-par // tb))
    # Block keys are ints on both sides: the cogroup matches groups by key value
    # and type, and a long on one side would never meet an int on the other.
    tr = (train.select(F.col(id_col).alias("t_id"), F.col(vec_col).alias("v"), F.col(label_col).alias("label"),
                       F.pmod(F.xxhash64(id_col), F.lit(tb)).cast("int").alias("tb"),
                       F.explode(F.sequence(F.lit(0), F.lit(qb - 1))).alias("qb"))
          .withColumn("qb", F.col("qb").cast("int")))
    te = (test.select(F.col(id_col).alias("q_id"), F.col(vec_col).alias("v"),
                      F.pmod(F.xxhash64(id_col), F.lit(qb)).cast("int").alias("qb"),
                      F.explode(F.sequence(F.lit(0), F.lit(tb - 1))).alias("tb"))
          .withColumn("tb", F.col("tb").cast("int")))

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"q_id": [], "t_id": [], "dist": [], "label": []})
        a = np.stack([np.asarray(x, dtype=np.float64) for x in left["v"]])
        b = np.stack([np.asarray(x, dtype=np.float64) for x in right["v"]])
        t_ids = left["t_id"].to_numpy()
        labels = left["label"].to_numpy()
        q_ids = right["q_id"].to_numpy()
        kk = min(k, len(left))
        near, dist = _nearest(a, b, t_ids, kk)
        flat = near.ravel()
        return pd.DataFrame({"q_id": np.repeat(q_ids, kk), "t_id": t_ids[flat], "dist": dist.ravel(), "label": labels[flat]})

    # a task for each pair of blocks: with the session's number of partitions a task's pairs would grow with the square of the rows
    pairs = min(tb * qb, KNN_TASKS)
    tr, te = (x.repartition(pairs, "tb", "qb") for x in (tr, te))
    cand = tr.groupBy("tb", "qb").cogroup(te.groupBy("tb", "qb")).applyInPandas(
        block, "q_id long, t_id long, dist double, label int")
    nearest = top_k_per_group(cand, ["q_id"], [F.col("dist"), F.col("t_id")], k)
    votes = nearest.groupBy("q_id", "label").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("q_id").agg(F.max(F.struct(F.col("n"), (-F.col("label")).alias("nl"))).alias("b"))
    return best.select(F.col("q_id").alias(id_col), (-F.col("b.nl")).cast("int").alias("prediction"))
