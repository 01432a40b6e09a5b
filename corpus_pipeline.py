"""A training corpus from the documents table: five stages, each on all that its predecessor kept.

Quality rules drop documents; line dedup drops lines that many documents share; SimHash
near-dedup leaves one document of each group; mixing repeats and cuts documents so that
sources come near their target weights; the last stage encodes the mix and decodes it
again. Every stage's result is written as Parquet and read as the next one's input.

All stages but the last return the columns of documents. The mix has a row for each pass
over a document (two at most), so ids may repeat after it. The last returns doc_id, lang,
source, n_tokens, ids, and the digests of the ids and of the decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.llm.bpe_speculative import decode_documents, encode_documents
from penmark.llm.common import docs_table, materialise
from penmark.llm.line_dedup import drop_frequent_lines
from penmark.llm.quality_cascade import keep_quality
from penmark.llm.simhash_pivots import one_per_group
from penmark.llm.source_mixing import mixed_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_frequent_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs, size=3, max_bits=3)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = encode_documents(docs.select("doc_id", "lang", "source", "text"), path).drop("text")
    return decode_documents(encoded, path).select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("source_mixing", mixing),
    ("bpe_round_trip", tokens),
]

# Fingerprints, pseudorandom draws and tokens have no SQL form; the tests hold the pipeline
# against a single-machine version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of ``sf_dir``."""
    docs = docs_table(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
