"""Sources and sinks for the corpus formats.

Readers take explicit schemas (no inference). Writers never overwrite a path
that is being read: a rewrite goes to a fresh path that callers then swap in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from penmark.functions import text as T

ARTICLE = Ty.StructType([Ty.StructField(n, Ty.StringType()) for n in ("url", "author", "headline", "body")])
URL_INDEX = Ty.StructType([Ty.StructField("author_url", Ty.StringType()),
                           Ty.StructField("article_url", Ty.StringType())])
AUTHOR_COUNTS = Ty.StructType([Ty.StructField("author_url", Ty.StringType()),
                               Ty.StructField("articles", Ty.LongType())])


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return bool(fs.globStatus(p)) and len(fs.globStatus(p)) > 0


def file_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The files that a pattern names, in order."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that this session wrote and reads no more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# ------------------------------------------------------------------ readers

def read_author_list(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line: trimmed, blank lines dropped, platform and handle derived."""
    lines = spark.read.text(path).select(F.trim(F.regexp_replace("value", r"\s+$", "")).alias("author_url"))
    lines = lines.filter(F.col("author_url") != "")
    return lines.select(
        "author_url",
        T.url_host("author_url").alias("platform"),
        F.regexp_extract("author_url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]+/+([^/?#]+)", 1).alias("handle"))


def read_url_index(spark: SparkSession, path: str, json_array: bool = False) -> DataFrame:
    """(author_url, article_url) pairs; both key spellings are accepted.

    ``json_array`` reads the reference's one-array-per-file layout; otherwise
    JSON lines. A missing path gives an empty table.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], URL_INDEX)
    if json_array:
        raw = spark.read.text(path, wholetext=True).select(
            F.explode(F.from_json("value", "array<map<string,string>>")).alias("m"))
    else:
        raw = spark.read.text(path).filter(F.trim("value") != "").select(
            F.from_json("value", "map<string,string>").alias("m"))
    return raw.select(
        F.coalesce(F.col("m")["author_url"], F.col("m")["author_URL"]).alias("author_url"),
        F.coalesce(F.col("m")["article_url"], F.col("m")["article_URL"]).alias("article_url"))


def read_articles_jsonl(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """JSON-lines articles with the fixed article schema; ``columns`` prunes the rest."""
    if not path_exists(spark, path):
        df = spark.createDataFrame([], ARTICLE)
    else:
        df = spark.read.schema(ARTICLE).json(path)
    return df.select(*columns) if columns else df


def read_article_tree(spark: SparkSession, path: str, one_object_per_file: bool = False) -> DataFrame:
    """Recursive scan of an author-folder tree of JSON articles, with each file's path."""
    reader = spark.read.schema(ARTICLE).option("recursiveFileLookup", "true")
    if one_object_per_file:
        reader = reader.option("multiLine", "true")
    return reader.json(path).withColumn("file_path", F.col("_metadata.file_path"))


def read_labelled_corpus(documents: DataFrame, labels: DataFrame, label_col: str,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, label) for the documents that carry a label."""
    return documents.select(id_col, text_col).join(
        labels.select(id_col, F.col(label_col).alias("label")), id_col)


def read_metrics_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ------------------------------------------------------------------ writers

def write_metrics_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").parquet(path)


def write_url_index(df: DataFrame, path: str) -> None:
    """Rewrite the whole index as JSON lines: written beside ``path``, then swapped in by renames.

    ``df`` may read the old index. A failed write leaves the old index as it was; the old
    files go only when the new ones are in place.
    """
    spark, tag = df.sparkSession, uuid.uuid4().hex
    fresh, old = f"{path.rstrip('/')}.new-{tag}", f"{path.rstrip('/')}.old-{tag}"
    df.select("author_url", "article_url").write.json(fresh)
    jvm = spark.sparkContext._jvm
    p = [jvm.org.apache.hadoop.fs.Path(x) for x in (path, fresh, old)]
    fs = p[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = fs.exists(p[0])
    if had and not fs.rename(p[0], p[2]):
        raise OSError(f"cannot move the old index {path} aside")
    if not fs.rename(p[1], p[0]):
        raise OSError(f"cannot move {fresh} to {path}; the old index is at {old}")
    if had:
        fs.delete(p[2], True)


def append_articles(df: DataFrame, path: str) -> None:
    df.select("url", "author", "headline", "body").write.mode("append").json(path)


def append_author_counts(pairs: DataFrame, path: str) -> None:
    """Append ``author;count`` rows (count before de-duplication)."""
    counts = pairs.groupBy("author_url").agg(F.count(F.lit(1)).alias("articles"))
    counts.write.mode("append").option("sep", ";").csv(path)


def read_author_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUTHOR_COUNTS).option("sep", ";").csv(path)


def write_articles_by_author(df: DataFrame, path: str, files_per_author: int = 8) -> None:
    """Add the articles not stored yet: one folder per author (file-name-safe key), JSON lines inside.

    An author's rows are dealt to ``files_per_author`` tasks by URL, so that a hot author is
    not one task's and a folder doesn't get a file from every task.
    """
    fresh = df.select("url", "author", "headline", "body")
    if path_exists(df.sparkSession, path):
        stored = df.sparkSession.read.schema(ARTICLE).json(path).select("url")
        fresh = fresh.join(stored, fresh["url"].eqNullSafe(stored["url"]), "left_anti")
    keyed = fresh.withColumn("author_key", T.safe_key(T.ascii_fold("author")))
    slot = F.pmod(F.xxhash64("url"), F.lit(files_per_author))
    keyed.repartition(F.col("author_key"), slot).write.mode("append").partitionBy("author_key").json(path)


def write_url_list(df: DataFrame, path: str, col: str = "url") -> None:
    """URLs as text, one per line."""
    df.select(col).write.mode("overwrite").text(path)
