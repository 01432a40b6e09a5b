"""Importance resampling towards a target distribution, on hashed n-grams.

Every n-gram of a corpus falls into one of ``buckets`` hash buckets. The counts of a raw and of
a target corpus give each bucket a gain, the logarithm of how much likelier the target is to
draw it. A document's weight is the mean gain of its n-grams, its score that weight plus Gumbel
noise that follows from its id; the documents with the highest scores are a sample without
replacement, drawn in proportion to the exponentiated weights.

Batch concatenation: the texts of a batch are joined with a separator that no word contains, so
that one regular expression pass finds the words of all. A binary search of the words' places
in the documents' offsets tells whose they are; n-grams whose first and last word belong to
different documents are masked, and the rest is counted by bincount. A batch holds about
``BATCH_BYTES`` of text and is read in slices of about ``SLICE`` bytes cut between words (the
last words of a slice go into the next one), so memory is bounded for texts of any length.

Only two tables of one row a bucket come to the driver (``buckets`` rows, whatever the input); the
gains go to the tasks as one array of that size. Ranks come from a range partition of the scores, the sizes
of the partitions and the places within them: nothing is sorted in one task, and rows that
share their score and id are told apart by a row number, so that none of them makes a hot key.

Defined results: a null text has no words; a document without features weighs 0; rows with
repeated ids are rows of their own, and a null id is hashed as the empty text and ranks before
the others at equal scores. An empty raw or target corpus counts as zero everywhere; an empty
table gives an empty table. Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penmark.llm.common import materialise

MAX_N = 1
BUCKETS = 10_000
SEED = 2024
PERCENT = 10
LEAST_WORDS = 20
BATCH_BYTES = 4 << 20
SLICE = 1 << 20

# Of lower-cased UTF-8: digits, letters and every byte of a non-ASCII character.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\x00"


def batches_of_texts(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first, lower-cased texts) of about ``BATCH_BYTES`` each; null is empty."""
    first, held, size = 0, [], 0
    for i, x in enumerate(texts):
        t = x.as_buffer().to_pybytes().lower() if x.is_valid else b""   # bytes: A-Z only
        held.append(t)
        size += len(t)
        if size >= BATCH_BYTES:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def features(texts: list[bytes], max_n: int = MAX_N, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For every slice of the joined texts: the document of each word; the document and the bucket of each n-gram.

    An n-gram's words are joined by one space; its bucket is the crc32 of its bytes modulo ``buckets``.
    """
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    joined = SEPARATOR.join(texts)
    carried, carried_doc = [], np.empty(0, np.int64)
    lo = 0
    while lo < len(joined):
        hi = min(len(joined), lo + SLICE)
        if hi < len(joined) and (m := WORD.match(joined, hi)):   # not within a word
            hi = m.end()
        found = list(WORD.finditer(joined, lo, hi))
        start = np.fromiter((m.start() for m in found), np.int64, len(found))
        own = np.searchsorted(offsets, start, side="right") - 1
        words = carried + [m[0] for m in found]
        doc = np.concatenate((carried_doc, own))
        codes, docs, buks = list(map(crc32, words)), [], []
        spaced = [b" " + w for w in words] if max_n > 1 else []
        for n in range(1, max_n + 1):
            if n > 1:   # a longer n-gram's code goes on from that of its beginning
                codes = list(map(crc32, spaced[n - 1:], codes))
            skip = max(0, len(carried) - n + 1)   # those the slice before has counted
            code = np.array(codes[skip:], np.int64)
            first, last = doc[skip:len(doc) - n + 1], doc[skip + n - 1:]
            one = first == last
            docs.append(first[one])
            buks.append(code[one] % buckets)
        yield own, np.concatenate(docs), np.concatenate(buks)
        keep = max_n - 1
        carried, carried_doc = (words[-keep:], doc[-keep:]) if keep else ([], doc[:0])
        lo = hi


def bucket_counts(docs: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of all ``docs`` (column text) fall into each bucket; one row a task and bucket is exchanged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, texts in batches_of_texts(b.column(0)):
                for _, _, bucket in features(texts, max_n, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) for every bucket."""
    b = float(len(raw))
    all_s, all_t = float(raw.sum()) + b, float(target.sum()) + b
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t)))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, max_n: int = MAX_N, id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_features, weight) for every row; weight is the floored mean gain of its n-grams."""
    buckets = len(gain)
    names = [id_col, "n_words", "n_features", "weight"]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           *[T.StructField(x, T.LongType()) for x in names[1:]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = np.zeros((3, b.num_rows), np.int64)
            for first, texts in batches_of_texts(b.column(1)):
                own = sums[:, first:first + len(texts)]
                for word_doc, doc, bucket in features(texts, max_n, buckets):
                    own[0] += np.bincount(word_doc, minlength=len(texts))
                    own[1] += np.bincount(doc, minlength=len(texts))
                    # sums of a slice are far below 2^53, so doubles hold them exactly
                    own[2] += np.bincount(doc, weights=gain[bucket], minlength=len(texts)).astype(np.int64)
            mean = np.where(sums[1] > 0, sums[2] // np.maximum(sums[1], 1), 0)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, (sums[0], sums[1], mean))], names=names)

    return docs.select(id_col, "text").mapInArrow(run, schema)


def noise(id_col: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)): a thousand times a standard Gumbel draw that follows from the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``place``, 1, 2, 3, ... in ``order`` (which must tell all rows apart).

    Range partitions in that order, each one's size, and the places within: two exchanges of the rows.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = materialise(rows.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "resample-parts")
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("part", before.alias("before"))   # a row for each partition
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return parts.withColumn("within", within).join(sizes, "part").withColumn(
        "place", F.col("before") + F.col("within")).drop("part", "within", "before")


def scores(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, seed: int = SEED,
           id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_features, weight, score) for every row of ``docs``, weighed towards ``target`` (column text)."""
    gain = gains(bucket_counts(docs, max_n, buckets), bucket_counts(target, max_n, buckets))
    return weights(docs, gain, max_n, id_col).withColumn("score", F.col("weight") + noise(F.col(id_col), seed))


def resample(docs: DataFrame, target: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS, seed: int = SEED,
             percent: int = PERCENT, least_words: int = LEAST_WORDS, id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) for every row of ``docs``.

    Of the N rows with ``least_words`` words or more, floor(percent * N / 100) are drawn: those of
    the highest scores, ties to the smaller id. rank is their place in that order, null if undrawn.
    """
    rows = scores(docs, target, max_n, buckets, seed, id_col).withColumn("row", F.monotonically_increasing_id())
    rows = materialise(rows, "resample-scores")
    able = rows.filter(F.col("n_words") >= least_words)
    rest = rows.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    # rows alike in score and id come in the order of what else they return, then of their row numbers
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_first(), F.col("n_features"), F.col("n_words"), F.col("weight"), F.col("row")]
    drawn = able.select(F.floor(F.count(F.lit(1)) * percent / F.lit(100))).scalar()
    placed = ranked(able, order).withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))).drop("place")
    return placed.unionByName(rest).drop("row")


def resampled_documents(docs: DataFrame, target: DataFrame, **params) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns, by id (ids must be unique)."""
    drawn = resample(docs, target, **params).filter("rank IS NOT NULL")
    key = params.get("id_col", "doc_id")
    return docs.join(drawn.select(key), key, "left_semi")
