"""Structured Streaming ingest of article files into an append-only store.

Each micro-batch is de-duplicated on ``url`` inside the batch, anti-joined
against the URLs already in the store, and appended. The anti-join makes a
replayed batch (after a failure) idempotent, so the store never holds a URL
twice even under retries; the checkpoint in the shared folder lets the query
resume. ``availableNow`` is "drain what is there, then stop".

Keyed streaming state (``dropDuplicates`` across batches) is optional: without
an event-time watermark it grows with the number of distinct URLs, and the
store anti-join already gives the same result.

With ``ledger_dir`` a batch doesn't read the store. The ledger holds the stored URLs as Parquet files in hash buckets,
and a batch reads those buckets that its own URLs fall into. A batch first leaves a mark, then appends to
the store, then to the ledger. A batch that finds its own mark is a replay after a failure: only then is the store read, once.
The ledger is filled from the store when it is first used; from then on only the stream may write to the store.

A batch adds a file to each bucket it hits. Buckets with more than ``COMPACT_FILES`` files are rewritten after the batch
that makes them so: a file of all their URLs is added first, then the old ones go. As a URL may be in the ledger twice, a
failure between these steps leaves a ledger that is as good as before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from penmark.sources.files import ARTICLE, file_paths, path_exists, read_articles_jsonl, remove_path


def _stored_urls(spark: SparkSession, store_dir: str, store_format: str) -> DataFrame:
    if store_format == "json":
        return read_articles_jsonl(spark, store_dir, ["url"])
    if not path_exists(spark, store_dir):
        return spark.createDataFrame([], "url string")
    return spark.read.format(store_format).load(store_dir).select("url")


COLUMNS = ["url", "author", "headline", "body"]
LEDGER_BUCKETS = 64   # default of a new ledger; more for large stores and small batches
COMPACT_FILES = 16    # files a bucket may have


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(buckets)).cast("int")


def _absent(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """``rows`` whose URL isn't stored; null-safe: an article without a URL is stored once, too, also when a batch is replayed."""
    return rows.join(stored, rows["url"].eqNullSafe(stored["url"]), "left_anti")


def _ledger_append(urls: DataFrame, ledger_dir: str, buckets: int) -> None:
    """One file for each bucket: rows of a bucket are brought together first."""
    rows = urls.select("url", _bucket(buckets).alias("bucket"))
    rows.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{ledger_dir}/urls")


def seed_ledger(spark: SparkSession, store_dir: str, ledger_dir: str, store_format: str = "json",
                buckets: int = LEDGER_BUCKETS) -> int:
    """Fill a new ledger from the store; the ledger's number of buckets, which its mark keeps.

    A fill that died before the mark is done again (URLs may then be in it twice).
    """
    mark = f"{ledger_dir}/marks/seeded"
    if path_exists(spark, f"{mark}/part-*"):
        return spark.read.parquet(mark).first()[0]
    _ledger_append(_stored_urls(spark, store_dir, store_format), ledger_dir, buckets)
    spark.range(buckets, buckets + 1).coalesce(1).write.mode("overwrite").parquet(mark)
    return buckets


def hit_buckets(batch: DataFrame, buckets: int) -> list[int]:
    """The buckets that the batch's URLs fall into."""
    return sorted(r[0] for r in batch.select(_bucket(buckets)).distinct().collect())


def _folders(ledger_dir: str, hit: list[int]) -> str:
    return f"{ledger_dir}/urls/bucket={{{','.join(map(str, hit))}}}"


def ledger_urls(spark: SparkSession, ledger_dir: str, hit: list[int]) -> DataFrame:
    """The stored URLs of the buckets ``hit``; no other bucket is listed or read."""
    if not hit or not path_exists(spark, _folders(ledger_dir, hit)):
        return spark.createDataFrame([], "url string")
    return spark.read.schema("url string").parquet(_folders(ledger_dir, hit))


def compact_ledger(spark: SparkSession, ledger_dir: str, buckets: int, hit: list[int] | None = None,
                   max_files: int | None = None) -> list[int]:
    """Make one file of each bucket (of ``hit``, or of all) that has more than ``max_files``; returns these buckets.

    Only the ledger's one writer may call it, between batches.
    """
    hit = list(range(buckets)) if hit is None else hit
    files: dict[int, list[str]] = {}
    for path in file_paths(spark, f"{_folders(ledger_dir, hit)}/part-*") if hit else []:
        files.setdefault(int(path.rsplit("/bucket=", 1)[1].split("/")[0]), []).append(path)
    full = {b: paths for b, paths in files.items() if len(paths) > (max_files or COMPACT_FILES)}
    old = [path for paths in full.values() for path in paths]
    if old:
        _ledger_append(spark.read.schema("url string").parquet(*old).distinct(), ledger_dir, buckets)
        for path in old:
            remove_path(spark, path)
    return sorted(full)


def ingest_batch(batch: DataFrame, mark: str, store_dir: str, ledger_dir: str, buckets: int, store_format: str = "json") -> None:
    """Append a batch's new articles to the store and their URLs to the ledger; ``mark`` names the batch, also in a replay."""
    spark = batch.sparkSession
    path = f"{ledger_dir}/marks/{mark}"
    replay = path_exists(spark, path)
    if not replay:
        spark.range(1).write.parquet(path)
    once = batch.dropDuplicates(["url"]).select(*COLUMNS).persist()
    hit = hit_buckets(once, buckets)
    new = _absent(once, ledger_urls(spark, ledger_dir, hit))
    fresh = _absent(new, _stored_urls(spark, store_dir, store_format)) if replay else new
    fresh.write.mode("append").format(store_format).save(store_dir)
    _ledger_append(new, ledger_dir, buckets)
    once.unpersist()
    compact_ledger(spark, ledger_dir, buckets, hit)


def stream_ingest(spark: SparkSession, source_dir: str, store_dir: str, checkpoint_dir: str,
                  schema: StructType = ARTICLE, keyed_state: bool = False,
                  available_now: bool = True, max_files_per_trigger: int | None = None,
                  store_format: str = "json", ledger_dir: str | None = None,
                  ledger_buckets: int = LEDGER_BUCKETS):
    """Start (and, with ``available_now``, run to completion) the ingest query.

    ``store_format="json"`` keeps the JSON-lines article store; a columnar format
    such as ``"parquet"`` makes the per-batch URL lookup read one column only,
    which is the better choice once the store is large.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(source_dir)
    if keyed_state:
        stream = stream.dropDuplicates(["url"])

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        if ledger_dir:
            # the id of the query is that of its checkpoint, so batches of another checkpoint have other marks
            own = batch.sparkSession.read.json(f"{checkpoint_dir}/metadata").first()["id"]
            return ingest_batch(batch, f"{own}-{epoch_id}", store_dir, ledger_dir, buckets, store_format)
        fresh = _absent(batch.dropDuplicates(["url"]), _stored_urls(batch.sparkSession, store_dir, store_format))
        fresh.select(*COLUMNS).write.mode("append").format(store_format).save(store_dir)

    if ledger_dir:
        buckets = seed_ledger(spark, store_dir, ledger_dir, store_format, ledger_buckets)

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def stored_articles(spark: SparkSession, store_dir: str, store_format: str = "json") -> DataFrame:
    if store_format == "json":
        return read_articles_jsonl(spark, store_dir)
    return spark.read.format(store_format).load(store_dir)
