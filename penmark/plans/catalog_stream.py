"""Registered query: streaming ingest (2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.plans.catalog import articles, query
from penmark.session import shared_path
from penmark.sources import files as IO
from penmark.streaming.ingest import stream_ingest, stored_articles

_ART = """SELECT 'doc://' || CAST(doc_id AS VARCHAR) AS url, source AS author, split_part(text, chr(10), 1) AS headline,
       text AS body FROM documents"""


@query("stream_ingest", _ART)
def q_stream_ingest(spark, d):
    """Work files arrive in two drops that overlap; part of the corpus is stored
    before the stream starts. The store must end with every article exactly once."""
    base = shared_path(spark, "stream")
    src, store, ckpt = f"{base}/incoming", f"{base}/store", f"{base}/checkpoint"
    arts = articles(spark, d).select("url", "author", "headline", "body", "lang")
    IO.append_articles(arts.filter(F.col("lang") == "de"), store)
    arts.filter(F.col("lang") != "es").drop("lang").write.mode("append").json(src)
    arts.filter(F.col("lang") != "en").drop("lang").write.mode("append").json(src)
    stream_ingest(spark, src, store, ckpt, ledger_dir=f"{base}/ledger")
    return stored_articles(spark, store)
