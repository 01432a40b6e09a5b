"""Incremental ingest: set differences, first-claim upserts and crawl logs.

Membership tests are hash anti-joins (AQE broadcasts the small side when its
measured size allows); the first-claim rule is a ``min_by`` aggregate, which
combines map-side, so a URL claimed by millions of rows never forms one group
in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _key(c: str):
    return F.trim(F.regexp_replace(F.col(c), r"[\r\n]+$", ""))


def pending_authors(authors: DataFrame, index: DataFrame) -> DataFrame:
    """Authors with no entry in the URL index (keys trimmed; right side distinct)."""
    covered = index.select(_key("author_url").alias("author_url")).distinct()
    return (authors.withColumn("author_url", _key("author_url"))
            .join(covered, "author_url", "left_anti"))


def pending_articles(index: DataFrame, stored: DataFrame, index_col: str = "article_url",
                     stored_col: str = "url") -> DataFrame:
    """Index entries whose article is not stored yet."""
    done = stored.select(F.col(stored_col).alias(index_col)).distinct()
    return index.join(done, index_col, "left_anti")


def upsert_url_index(old: DataFrame, new: DataFrame, order_cols: tuple[str, ...] = ("page_id", "link_pos")) -> DataFrame:
    """Add only unseen article URLs; the first author to claim a URL keeps it.

    Old entries win over new ones; within a side, arrival order decides.
    """
    both = (old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1))))
    rank = F.struct(F.col("_new"), *[F.col(c) for c in order_cols])
    return both.groupBy("article_url").agg(F.min_by("author_url", rank).alias("author_url"))


def author_article_counts(pairs: DataFrame) -> DataFrame:
    """Articles found per author, counted before de-duplication."""
    return pairs.groupBy("author_url").agg(F.count(F.lit(1)).alias("articles"))


def article_log(articles: DataFrame) -> DataFrame:
    """author, headline, body length (characters) and url per article."""
    return articles.select("author", "headline", F.length("body").cast("long").alias("body_chars"), "url")
