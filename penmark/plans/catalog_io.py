"""Registered queries: sources and sinks (2.1) as write-then-read round trips.

Each query writes data Spark derives from the input tables with one of the
sinks into a fresh folder under the shared checkpoint location, reads it back
with the matching source, and is compared with SQL over the input tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from penmark.operators import ingest as I
from penmark.plans import sqlfrag as S
from penmark.plans.catalog import _KEPT, _M, _MCOLS, articles, metric_scalars, metrics, query
from penmark.plans.catalog_pages import _PAIRS, all_pairs, pages
from penmark.session import shared_path
from penmark.sources import files as IO
from penmark.tables import table

_ART = f"""SELECT 'doc://' || CAST(doc_id AS VARCHAR) AS url, source AS author, {S.first_line('text')} AS headline,
       text AS body FROM documents"""


def _articles(spark, d):
    return articles(spark, d).select("url", "author", "headline", "body", "lang")


@query("write_url_list", "SELECT url FROM pages")
def q_write_url_list(spark, d):
    path = shared_path(spark, "roundtrip", "url_list")
    IO.write_url_list(table(spark, d, "pages"), path)
    return spark.read.text(path).select(F.col("value").alias("url"))


@query("read_author_list", f"""
SELECT DISTINCT {S.url_root('url')} || '/' || regexp_extract(url, '://[^/]+/([a-z]{{2}})/', 1) AS author_url,
       {S.url_host('url')} AS platform, regexp_extract(url, '://[^/]+/([a-z]{{2}})/', 1) AS handle FROM pages""")
def q_read_author_list(spark, d):
    path = shared_path(spark, "roundtrip", "authors")
    pg = table(spark, d, "pages")
    lines = pg.select(F.concat(F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1), F.lit("/"),
                               F.regexp_extract("url", r"://[^/]+/([a-z]{2})/", 1)).alias("url")).distinct()
    IO.write_url_list(lines, path)
    return IO.read_author_list(spark, path)


@query("write_url_index", f"""WITH {_PAIRS},
b AS (SELECT article_url, author_url, CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS is_new, page_id, link_pos FROM pairs),
r AS (SELECT *, row_number() OVER (PARTITION BY article_url ORDER BY is_new, page_id, link_pos) AS rn FROM b)
SELECT author_url, article_url FROM r WHERE rn = 1""")
def q_write_url_index(spark, d):
    pairs, _ = all_pairs(spark, d)
    cols = ["author_url", "article_url", "page_id", "link_pos"]
    merged = I.upsert_url_index(pairs.filter(F.col("lang") == "en").select(*cols),
                                pairs.filter(F.col("lang") != "en").select(*cols))
    path = shared_path(spark, "roundtrip", "url_index")
    IO.write_url_index(merged, path)
    return IO.read_url_index(spark, path)


@query("read_url_index", f"WITH {_PAIRS} SELECT author_url, article_url FROM pairs")
def q_read_url_index(spark, d):
    pairs, _ = all_pairs(spark, d)
    path = shared_path(spark, "roundtrip", "url_index_pairs")
    IO.write_url_index(pairs, path)
    return IO.read_url_index(spark, path)


@query("append_articles", _ART)
def q_append_articles(spark, d):
    path = shared_path(spark, "roundtrip", "articles_jsonl")
    arts = _articles(spark, d)
    english = F.coalesce(F.col("lang") == "en", F.lit(False))   # an unknown language is on the other side, not on neither
    IO.append_articles(arts.filter(english), path)
    IO.append_articles(arts.filter(~english), path)
    return IO.read_articles_jsonl(spark, path)


@query("read_articles_jsonl", "SELECT 'doc://' || CAST(doc_id AS VARCHAR) AS url FROM documents")
def q_read_articles_jsonl(spark, d):
    path = shared_path(spark, "roundtrip", "articles_urls")
    IO.append_articles(_articles(spark, d), path)
    return IO.read_articles_jsonl(spark, path, columns=["url"])


@query("write_articles_by_author", f"""SELECT url, author, headline, body,
       regexp_replace(regexp_replace(author, '[~#%&*{{}}:<>?/+|"'']', '', 'g'), '\\s', '_', 'g') AS author_key
FROM ({_ART})""")
def q_write_articles_by_author(spark, d):
    path = shared_path(spark, "roundtrip", "article_tree")
    IO.write_articles_by_author(_articles(spark, d), path)
    schema = Ty.StructType(IO.ARTICLE.fields + [Ty.StructField("author_key", Ty.StringType())])
    return spark.read.schema(schema).json(path)


@query("read_article_tree", _ART)
def q_read_article_tree(spark, d):
    path = shared_path(spark, "roundtrip", "article_tree_scan")
    IO.write_articles_by_author(_articles(spark, d), path)
    return IO.read_article_tree(spark, path).select("url", "author", "headline", "body")


@query("append_author_counts", f"WITH {_PAIRS} SELECT author_url, count(*)::BIGINT AS articles FROM pairs GROUP BY 1")
def q_append_author_counts(spark, d):
    pairs, _ = all_pairs(spark, d)
    path = shared_path(spark, "roundtrip", "author_counts")
    IO.append_author_counts(pairs, path)
    return IO.read_author_counts(spark, path)


@query("read_labelled_corpus", """
SELECT doc_id, text, quality AS label FROM documents JOIN labels USING (doc_id)""")
def q_read_labelled_corpus(spark, d):
    return IO.read_labelled_corpus(table(spark, d, "documents"), table(spark, d, "labels"), "quality")


@query("write_metrics_snapshot", f"{_M} SELECT doc_id, author, {_MCOLS} FROM m WHERE {_KEPT}")
def q_write_metrics_snapshot(spark, d):
    path = shared_path(spark, "roundtrip", "metrics_snapshot")
    IO.write_metrics_snapshot(metrics(spark, d), path)
    return metric_scalars(IO.read_metrics_snapshot(spark, path))


@query("read_metrics_snapshot", f"""{_M}
SELECT doc_id, list_max(lens)::BIGINT AS number_of_words_sentence_max FROM m WHERE {_KEPT}""")
def q_read_metrics_snapshot(spark, d):
    path = shared_path(spark, "roundtrip", "metrics_snapshot_scan")
    IO.write_metrics_snapshot(metrics(spark, d), path)
    snap = IO.read_metrics_snapshot(spark, path)
    return snap.select("doc_id", F.col("number_of_words_sentence_max").cast("long").alias("number_of_words_sentence_max"))
