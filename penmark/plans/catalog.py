"""Registered queries: one Spark plan per operator, each with its DuckDB oracle.

Every query reads the given tables (or data Spark derives from them) in full.
``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is the SQL that
DuckDB runs over the same parquet files. Computed columns carry the same alias
on both sides and doubles are rounded alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.operators import metrics as M
from penmark.plans import sqlfrag as S
from penmark.session import spread, written
from penmark.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# ------------------------------------------------------------------ shared inputs

def documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents"))


def articles(spark: SparkSession, d: str) -> DataFrame:
    return M.articles_from_documents(documents(spark, d))


def metrics(spark: SparkSession, d: str, drop: bool = True) -> DataFrame:
    return M.article_metrics(articles(spark, d), drop_incomplete=drop)


def metric_scalars(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id", "author", "total_number_of_sentences", "total_number_of_words",
        r6("number_of_words_sentence_mean").alias("number_of_words_sentence_mean"),
        r6("number_of_words_sentence_median").alias("number_of_words_sentence_median"),
        F.col("number_of_words_sentence_min").cast("long").alias("number_of_words_sentence_min"),
        F.col("number_of_words_sentence_max").cast("long").alias("number_of_words_sentence_max"))


_M = "WITH " + S.metrics_cte()
_MCOLS = S.metric_columns()
_KEPT = "len(lens) > 0"

# ------------------------------------------------------------------ 2.5 metrics


@query("article_metrics", f"{_M} SELECT doc_id, author, {_MCOLS} FROM m")
def q_article_metrics(spark, d):
    return metric_scalars(metrics(spark, d, drop=False))


@query("drop_incomplete", f"{_M} SELECT doc_id, author, {_MCOLS} FROM m WHERE {_KEPT}")
def q_drop_incomplete(spark, d):
    return metric_scalars(M.drop_incomplete_rows(metrics(spark, d, drop=False)))


@query("feature_projection", f"""{_M} SELECT author, {_MCOLS} FROM m WHERE {_KEPT}""")
def q_feature_projection(spark, d):
    return metric_scalars(metrics(spark, d)).drop("doc_id").select(
        "author", *M.FEATURES)


@query("filter_author", f"{_M} SELECT doc_id, author, {_MCOLS} FROM m WHERE {_KEPT} AND author = 'src3'")
def q_filter_author(spark, d):
    return metric_scalars(M.filter_author(metrics(spark, d), "src3"))


@query("filter_categories", """
SELECT doc_id, lang, n_chars FROM documents WHERE lang IN ('en', 'de')""")
def q_filter_categories(spark, d):
    return M.filter_categories(table(spark, d, "documents"), ["en", "de"]).select("doc_id", "lang", "n_chars")


@query("distinct_authors", f"{_M} SELECT DISTINCT author FROM m WHERE {_KEPT}")
def q_distinct_authors(spark, d):
    return M.distinct_authors(metrics(spark, d).select("author"))


@query("articles_per_author", f"""{_M}
SELECT author, count(*)::BIGINT AS num_of_articles FROM m WHERE {_KEPT} GROUP BY author""")
def q_articles_per_author(spark, d):
    return M.articles_per_author(metrics(spark, d).select("author"))


@query("min_class_size", f"""{_M}
SELECT min(c)::BIGINT AS min_articles FROM (SELECT author, count(*) AS c FROM m WHERE {_KEPT} GROUP BY author)""")
def q_min_class_size(spark, d):
    return M.min_class_size(metrics(spark, d).select("author"))


@query("shuffle_rows", """
SELECT doc_id, md5('7' || CAST(doc_id AS VARCHAR)) AS shuffle_key FROM documents""")
def q_shuffle_rows(spark, d):
    return M.shuffle_rows(table(spark, d, "documents").select("doc_id"), "doc_id", seed="7")


@query("balanced_sample", f"""{_M},
k AS (SELECT author, md5('7' || CAST(doc_id AS VARCHAR)) AS shuffle_key, doc_id FROM m WHERE {_KEPT}),
r AS (SELECT *, row_number() OVER (PARTITION BY author ORDER BY shuffle_key) AS rn FROM k)
SELECT doc_id, author, shuffle_key FROM r
WHERE rn <= (SELECT min(c) FROM (SELECT count(*) AS c FROM k GROUP BY author))""")
def q_balanced_sample(spark, d):
    # read by several branches of the plan: tokenised and written once
    rows = written(metrics(spark, d).select("doc_id", "author"), "kept-rows")
    return M.balanced_sample(rows, "doc_id", seed="7").select(
        "doc_id", "author", "shuffle_key")


@query("longest_articles_topk", f"""{_M}
SELECT doc_id, author, url, list_max(lens)::BIGINT AS number_of_words_sentence_max FROM m WHERE {_KEPT}
ORDER BY list_max(lens) DESC, doc_id LIMIT 25""")
def q_longest_articles_topk(spark, d):
    return M.longest_articles_topk(metrics(spark, d), 25).select(
        "doc_id", "author", "url",
        F.col("number_of_words_sentence_max").cast("long").alias("number_of_words_sentence_max"))


@query("longest_sentence_text", f"""{_M}
SELECT doc_id, list_max(lens)::BIGINT AS number_of_words_sentence_max,
       array_to_string(sw[list_position(lens, list_max(lens))], ' ') AS longest_sentence
FROM m WHERE {_KEPT} ORDER BY list_max(lens) DESC, doc_id LIMIT 25""")
def q_longest_sentence_text(spark, d):
    return M.longest_articles_topk(metrics(spark, d), 25).select(
        "doc_id", F.col("number_of_words_sentence_max").cast("long").alias("number_of_words_sentence_max"),
        "longest_sentence")


@query("flatten_words", f"""{_M}, f AS (SELECT doc_id, flatten(sw) AS w FROM m WHERE {_KEPT})
SELECT doc_id, (generate_subscripts(w, 1) - 1)::BIGINT AS word_pos, unnest(w) AS word FROM f""")
def q_flatten_words(spark, d):
    return M.flatten_words(metrics(spark, d)).select(
        "doc_id", F.col("word_pos").cast("long").alias("word_pos"), "word")


@query("sentence_length_histogram", f"""{_M},
v AS (SELECT author, unnest(lens) AS x FROM m WHERE {_KEPT}),
r AS (SELECT author, min(x) AS lo0, max(x) AS hi0 FROM v GROUP BY author),
g AS (SELECT author, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0::DOUBLE END AS lo,
                     CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0::DOUBLE END AS hi FROM r),
b AS (SELECT v.author, lo, hi, least(49, floor((x - lo) * 50 / (hi - lo)))::INTEGER AS bin FROM v JOIN g USING (author))
SELECT author, bin, round(lo + bin * ((hi - lo) / 50), 6) AS bin_lo,
       round(lo + (bin + 1) * ((hi - lo) / 50), 6) AS bin_hi, count(*)::BIGINT AS n
FROM b GROUP BY author, bin, lo, hi""")
def q_sentence_length_histogram(spark, d):
    h = M.sentence_length_histogram(metrics(spark, d))
    return h.select("author", "bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"), "n")


def _pairs_sql() -> str:
    feats = [
        ("total_number_of_sentences", "len(lens)::DOUBLE"),
        ("total_number_of_words", "list_sum(lens)::DOUBLE"),
        ("number_of_words_sentence_mean", "round(list_sum(lens) / len(lens), 6)"),
        ("number_of_words_sentence_median",
         "round(CASE WHEN len(lens) % 2 = 1 THEN list_sort(lens)[len(lens) // 2 + 1]::DOUBLE "
         "ELSE (list_sort(lens)[len(lens) // 2] + list_sort(lens)[len(lens) // 2 + 1]) / 2.0 END, 6)"),
        ("number_of_words_sentence_min", "list_min(lens)::DOUBLE"),
        ("number_of_words_sentence_max", "list_max(lens)::DOUBLE"),
    ]
    parts = []
    for c in range(6):
        for r in range(6):
            if r < c:
                parts.append(f"SELECT author, doc_id, '{feats[c][0]}' AS x_feature, '{feats[r][0]}' AS y_feature, "
                             f"{feats[c][1]} AS x, {feats[r][1]} AS y FROM m WHERE {_KEPT}")
    return _M + "\n" + "\nUNION ALL\n".join(parts)


@query("feature_pairs", _pairs_sql())
def q_feature_pairs(spark, d):
    m = metric_scalars(metrics(spark, d))
    return M.feature_pairs(m)


@query("grid_pivot", f"""{_M},
l AS (SELECT author, lang, round(avg(list_sum(lens) / len(lens)), 6) AS z FROM m WHERE {_KEPT} GROUP BY author, lang)
SELECT author, max(CASE WHEN lang = 'de' THEN z END) AS de, max(CASE WHEN lang = 'en' THEN z END) AS en,
       max(CASE WHEN lang = 'es' THEN z END) AS es, max(CASE WHEN lang = 'fr' THEN z END) AS fr
FROM l GROUP BY author""")
def q_grid_pivot(spark, d):
    long = (metrics(spark, d).groupBy("author", "lang")
            .agg(r6(F.avg("number_of_words_sentence_mean")).alias("z")))
    # the columns come from the table's own small column, not from tokenising the corpus
    langs = [r.lang for r in table(spark, d, "documents").select("lang").distinct().collect()]
    return M.grid_pivot(long, x="lang", y="author", z="z", x_values=langs)


@query("grid_mesh", """
SELECT lang, source AS author FROM (SELECT DISTINCT lang FROM documents), (SELECT DISTINCT source FROM documents)""")
def q_grid_mesh(spark, d):
    docs = table(spark, d, "documents").select("lang", F.col("source").alias("author"))
    return M.grid_mesh(docs, x="lang", y="author")


# ------------------------------------------------------------------ 2.5 terms

from penmark.functions import text as T  # noqa: E402
from penmark.operators import features as FE  # noqa: E402
from penmark.operators import terms as TM  # noqa: E402
from penmark.operators.blocks import kept  # noqa: E402

_STOP = S.STOP


def _top_sql(words_expr: str) -> str:
    return f"""{_M},
f AS (SELECT doc_id, {words_expr} AS w FROM m WHERE {_KEPT}),
t AS (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM f),
c AS (SELECT doc_id, term, count(*) AS n, min(pos) AS fp FROM t GROUP BY doc_id, term),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, fp) AS rank FROM c)
SELECT doc_id, rank::INTEGER AS rank, term, n::BIGINT AS n FROM r WHERE rank <= 10"""


@query("top_terms", _top_sql("flatten(sw)"))
def q_top_terms(spark, d):
    return TM.top_terms(metrics(spark, d), 10)


@query("top_terms_no_stop", _top_sql(f"list_filter(flatten(sw), lambda x: NOT list_contains({_STOP}, x))"))
def q_top_terms_no_stop(spark, d):
    return TM.top_terms_no_stop(metrics(spark, d), 10)


@query("top_bigrams", f"""{_M},
f AS (SELECT doc_id, list_filter(flatten(sw), lambda x: NOT list_contains({_STOP}, x)) AS w FROM m WHERE {_KEPT}),
p AS (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM f WHERE len(w) > 1),
c AS (SELECT doc_id, w[i] AS w1, w[i + 1] AS w2, count(*) AS n, min(i - 1) AS fp FROM p GROUP BY doc_id, w[i], w[i + 1]),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, fp) AS rank FROM c)
SELECT doc_id, rank::INTEGER AS rank, w1, w2, n::BIGINT AS n FROM r WHERE rank <= 10""")
def q_top_bigrams(spark, d):
    return TM.top_bigrams(metrics(spark, d), 10)


# Unsmoothed path: terms of the cleaned body (equal to the rebuilt token text).
_TF_CLEAN = f"""tf AS (SELECT doc_id, term, count(*) AS tf FROM
  (SELECT doc_id, unnest({S.terms(S.clean('text'))}) AS term FROM documents) GROUP BY doc_id, term)"""


def clean_term_counts(spark, d):
    docs = documents(spark, d).withColumn("text", T.clean_text("text"))
    return FE.term_counts(docs)


@query("count_vectors", f"WITH {_TF_CLEAN} SELECT doc_id, term, tf::BIGINT AS tf FROM tf")
def q_count_vectors(spark, d):
    return clean_term_counts(spark, d)


@query("term_occurrences", f"WITH {_TF_CLEAN} SELECT term, sum(tf)::BIGINT AS occurrences FROM tf GROUP BY term")
def q_term_occurrences(spark, d):
    return TM.term_occurrences(clean_term_counts(spark, d))


@query("matrix_shape", f"""WITH {_TF_CLEAN}
SELECT (SELECT count(*) FROM documents)::BIGINT AS n_samples, count(DISTINCT term)::BIGINT AS n_features FROM tf""")
def q_matrix_shape(spark, d):
    return TM.matrix_shape(table(spark, d, "documents"), clean_term_counts(spark, d))


@query("tfidf_unsmoothed", f"""WITH {_TF_CLEAN},
n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT doc_id, term, tf * (ln(n.n / df.df) + 1) AS w FROM tf JOIN df USING (term), n)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def q_tfidf_unsmoothed(spark, d):
    w, _ = FE.fit_tfidf(documents(spark, d).withColumn("text", T.clean_text("text")), smooth=False)
    return w.select("doc_id", "term", r6("weight").alias("weight"))


# Classifier-sweep path: raw text terms, hash split (seed 42, 25 % test), idf on train.
SWEEP_SEED, SWEEP_TEST = "42", 0.25
_SPLIT = S.split_flag("text", SWEEP_SEED, SWEEP_TEST)
_SWEEP = f"""d AS (SELECT doc_id, lang, text, {_SPLIT} AS is_test FROM documents),
tr AS (SELECT doc_id, lang, text FROM d WHERE NOT is_test),
te AS (SELECT doc_id, lang, text FROM d WHERE is_test),
n AS (SELECT count(*) AS n FROM tr),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({S.terms('text')}) AS term FROM tr) GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
idf AS (SELECT term, ln((1 + n.n) / (1 + df)) + 1 AS idf FROM df, n WHERE df <= 0.5 * n.n),
w0 AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN idf USING (term)),
w AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w0)"""


def sweep_split(spark, d):
    docs = documents(spark, d).select("doc_id", "lang", "text")
    flag = FE.split_flag("text", SWEEP_SEED, SWEEP_TEST)
    return docs.filter(~flag), docs.filter(flag)


def sweep_fit(spark, d):
    """Both sides, and (train weights in blocks, idf) of the sublinear, max_df=0.5 vectoriser as plans, for one reader."""
    train, test = sweep_split(spark, d)
    return train, test, *FE.fit_tfidf(train, smooth=True, sublinear=True, max_df=0.5, with_block=True)


def sweep_tfidf(spark, d):
    """(train, test, train weights, test weights, idf), the fitted tables written once for several readers."""
    train, test, w_train, idf = sweep_fit(spark, d)
    idf = written(idf, "sweep-idf")
    w_train = kept(w_train, "sweep-weights")
    return train, test, w_train, FE.transform_tfidf(test, idf, sublinear=True, with_block=True), idf


@query("tfidf_sublinear", f"WITH {_SWEEP} SELECT doc_id, term, round(weight, 6) AS weight FROM w")
def q_tfidf_sublinear(spark, d):
    _, _, w, _ = sweep_fit(spark, d)
    return w.select("doc_id", "term", r6("weight").alias("weight"))


@query("transform_test", f"""WITH {_SWEEP},
ttf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({S.terms('text')}) AS term FROM te) GROUP BY doc_id, term),
tw0 AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM ttf JOIN idf USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM tw0""")
def q_transform_test(spark, d):
    _, test, _, idf = sweep_fit(spark, d)
    return FE.transform_tfidf(test, idf, sublinear=True).select("doc_id", "term", r6("weight").alias("weight"))


_CHI2 = f"""{_SWEEP},
sh AS (SELECT lang, count(*) / any_value(n.n) AS p FROM tr, n GROUP BY lang),
o AS (SELECT term, lang, sum(weight) AS o FROM w JOIN tr USING (doc_id) GROUP BY term, lang),
t AS (SELECT term, sum(o) AS t FROM o GROUP BY term),
c AS (SELECT term, sum((o - p * t) * (o - p * t) / (p * t)) + any_value(t) * (1 - sum(p)) AS score
      FROM o JOIN sh USING (lang) JOIN t USING (term) GROUP BY term),
top AS (SELECT term, score FROM c ORDER BY score DESC, term LIMIT 50)"""


def sweep_chi2(spark, d, k=50):
    train, _, w, _ = sweep_fit(spark, d)
    return FE.chi2_select(kept(w, "sweep-weights"), train.select("doc_id", "lang"), k)


@query("chi2_select", f"WITH {_CHI2} SELECT term, round(score, 4) AS chi2 FROM top")
def q_chi2_select(spark, d):
    return sweep_chi2(spark, d).select("term", F.round("chi2", 4).alias("chi2"))


@query("selected_names", f"""WITH {_CHI2}
SELECT term, (row_number() OVER (ORDER BY term) - 1)::INTEGER AS position FROM top""")
def q_selected_names(spark, d):
    return FE.selected_names(sweep_chi2(spark, d))


@query("hashed_vectors", f"""WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM
  (SELECT doc_id, unnest({S.terms('text')}) AS term FROM documents) GROUP BY doc_id, term),
b AS (SELECT doc_id, (('0x' || substr(md5(term), 1, 8))::BIGINT % 65536) AS bucket, sum(tf)::DOUBLE AS w
      FROM tf GROUP BY doc_id, bucket)
SELECT doc_id, bucket, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM b""")
def q_hashed_vectors(spark, d):
    h = FE.hashed_vectors(documents(spark, d), 2 ** 16)
    return h.select("doc_id", "bucket", r6("weight").alias("weight"))


_TOK = f"""list_filter(list_transform({S.extract_all('text', T.WORD_OR_PUNCT)},
   lambda t: trim(trim(trim(lower(t)), '_'), '*')),
   lambda t: NOT list_contains({_STOP}, t) AND NOT regexp_matches(t, {S.lit(T.PUNCT_ONLY)}))"""


def pipeline_tokens():
    return T.filter_tokens(T.normalize_tokens(T.wordpunct_tokens("text")))


@query("tfidf_pretokenized", f"""WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM
  (SELECT doc_id, unnest({_TOK}) AS term FROM documents) GROUP BY doc_id, term),
n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT doc_id, term, tf * (ln((1 + n.n) / (1 + df.df)) + 1) AS w FROM tf JOIN df USING (term), n)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def q_tfidf_pretokenized(spark, d):
    w, _ = FE.fit_tfidf(documents(spark, d), smooth=True, tokens=pipeline_tokens())
    return w.select("doc_id", "term", r6("weight").alias("weight"))


@query("label_encode", """
SELECT doc_id, lang, (dense_rank() OVER (ORDER BY lang) - 1)::INTEGER AS label_index FROM documents""")
def q_label_encode(spark, d):
    out, _ = FE.label_encode(table(spark, d, "documents").select("doc_id", "lang"))
    return out


@query("train_test_split", """
SELECT doc_id, CASE WHEN md5('23' || text) < '40000000' THEN 'test' ELSE 'train' END AS split FROM documents""")
def q_train_test_split(spark, d):
    return FE.train_test_split(table(spark, d, "documents").select("doc_id", "text"),
                               "text", "23", 0.25).select("doc_id", "split")


@query("corpus_size", f"""
SELECT CASE WHEN {_SPLIT} THEN 'test' ELSE 'train' END AS split, count(*)::BIGINT AS n_docs,
       round(sum(strlen(text)) / 1e6, 6) AS size_mb, count(DISTINCT lang)::BIGINT AS n_categories
FROM documents GROUP BY 1""")
def q_corpus_size(spark, d):
    docs = FE.train_test_split(table(spark, d, "documents"), "text", SWEEP_SEED, SWEEP_TEST)
    out = TM.corpus_size(docs)
    return out.select("split", "n_docs", r6("size_mb").alias("size_mb"), "n_categories")


# The remaining sections register themselves on import.
from penmark.plans import catalog_io, catalog_ml, catalog_models, catalog_pages, catalog_stream  # noqa: E402,F401
