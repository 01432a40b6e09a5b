"""Sources, sinks and the streaming ingest."""

import json

from pyspark.sql import functions as F

from penmark.sources import files as IO
from penmark.streaming.ingest import stream_ingest, stored_articles


def test_author_list(spark, tmp_path):
    p = tmp_path / "authors.txt"
    p.write_text("https://blog.example.com/@a\nhttps://blog.example.com/@b\n\nhttps://blog.example.com//@c\nhttps://blog.example.com/@a")
    df = IO.read_author_list(spark, str(p))
    rows = [(r["author_url"], r["handle"]) for r in df.collect()]
    assert ("https://blog.example.com/@b", "@b") in rows and ("https://blog.example.com//@c", "@c") in rows
    assert len(rows) == 4 and all(u for u, _ in rows)


def test_url_index_both_spellings_and_missing(spark, tmp_path):
    p = tmp_path / "index.json"
    p.write_text(json.dumps([{"author_url": "x", "article_url": "u1"}, {"author_URL": "y", "article_URL": "u1"}]))
    rows = sorted((r["author_url"], r["article_url"]) for r in IO.read_url_index(spark, str(p), json_array=True).collect())
    assert rows == [("x", "u1"), ("y", "u1")]
    assert IO.read_url_index(spark, str(tmp_path / "absent.json")).count() == 0


def test_article_tree_roundtrip(spark, tmp_path):
    arts = spark.createDataFrame([("u1", "Jane Doe", "Hé", "b1"), ("u2", "A/B: C", "h", "b2")],
                                 "url string, author string, headline string, body string")
    IO.write_articles_by_author(arts, str(tmp_path / "tree"))
    back = IO.read_article_tree(spark, str(tmp_path / "tree")).collect()
    assert sorted(r["url"] for r in back) == ["u1", "u2"]
    assert any("author_key=Jane_Doe" in r["file_path"] for r in back)


def test_stream_ingest_exactly_once(spark, tmp_path):
    src, store, ckpt = (str(tmp_path / x) for x in ("in", "store", "ckpt"))
    arts = spark.createDataFrame([(f"u{i}", "a", "h", "b") for i in range(10)],
                                 "url string, author string, headline string, body string")
    IO.append_articles(arts.filter(F.col("url").isin("u1", "u2")), store)
    arts.write.mode("append").json(src)
    arts.filter(F.col("url") < "u5").write.mode("append").json(src)
    stream_ingest(spark, src, store, ckpt)
    # a second drop and a restart from the checkpoint add nothing twice
    arts.filter(F.col("url") > "u7").write.mode("append").json(src)
    stream_ingest(spark, src, store, ckpt)
    got = stored_articles(spark, store).groupBy("url").count().collect()
    assert len(got) == 10 and all(r["count"] == 1 for r in got)


def test_stream_ingest_columnar_store(spark, tmp_path):
    src, store, ckpt = (str(tmp_path / x) for x in ("in", "store", "ckpt"))
    arts = spark.createDataFrame([(f"u{i % 6}", "a", "h", "b") for i in range(12)],
                                 "url string, author string, headline string, body string")
    arts.write.mode("append").json(src)
    stream_ingest(spark, src, store, ckpt, store_format="parquet", keyed_state=True)
    got = stored_articles(spark, store, "parquet").groupBy("url").count().collect()
    assert len(got) == 6 and all(r["count"] == 1 for r in got)
