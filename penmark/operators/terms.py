"""Term statistics: top terms, bigrams, vocabulary counts, corpus sizes.

Per-document work builds pairs with array expressions inside the row (no
window, no self-join). The word arrays are dealt out by document once; the
counts of (doc, term) and the per-document top-k, a ``row_number() <= k``
window, need no exchange after that, so what is shuffled is the text's size.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.functions import lexicon
from penmark.functions import text as T
from penmark.operators.skew import top_k_per_group


def _words(metrics: DataFrame, id_col: str, stopwords: Iterable[str] | None) -> DataFrame:
    words = F.flatten("sentences_words")
    if stopwords is not None:
        stop = list(stopwords)
        words = F.filter(words, lambda w: ~w.isin(stop))
    return metrics.select(id_col, words.alias("words")).repartition(id_col)


def top_terms(metrics: DataFrame, n: int = 10, id_col: str = "doc_id",
              stopwords: Iterable[str] | None = None) -> DataFrame:
    """n most frequent words per article; ties by first appearance.

    Pass ``stopwords`` (case-sensitive) for the stop-word-free variant.
    """
    tokens = _words(metrics, id_col, stopwords).select(
        id_col, F.posexplode("words").alias("pos", "term"))
    counts = tokens.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("n"),
                                                F.min("pos").alias("first_pos"))
    top = top_k_per_group(counts, [id_col], [F.col("n").desc(), F.col("first_pos")], n)
    return top.select(id_col, "rank", "term", "n")


def top_terms_no_stop(metrics: DataFrame, n: int = 10, id_col: str = "doc_id") -> DataFrame:
    return top_terms(metrics, n, id_col, lexicon.ENGLISH_STOP_WORDS)


def top_bigrams(metrics: DataFrame, n: int = 10, id_col: str = "doc_id",
                stopwords: Iterable[str] | None = lexicon.ENGLISH_STOP_WORDS) -> DataFrame:
    """n most frequent adjacent pairs per article after stop-word removal.

    Pairs cross sentence borders; ties by first appearance. Pairs are formed by
    zipping the word array with itself shifted by one, inside the row.
    """
    w = _words(metrics, id_col, stopwords)
    m = F.size("words") - 1
    pairs = F.arrays_zip(F.slice("words", 1, F.greatest(m, F.lit(0))).alias("w1"),
                         F.slice("words", 2, F.greatest(m, F.lit(0))).alias("w2"))
    exploded = (w.filter(F.size("words") > 1)
                .select(id_col, F.posexplode(pairs).alias("pos", "p"))
                .select(id_col, "pos", F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2")))
    counts = exploded.groupBy(id_col, "w1", "w2").agg(F.count(F.lit(1)).alias("n"),
                                                      F.min("pos").alias("first_pos"))
    top = top_k_per_group(counts, [id_col], [F.col("n").desc(), F.col("first_pos")], n)
    return top.select(id_col, "rank", "w1", "w2", "n")


def term_occurrences(term_counts: DataFrame) -> DataFrame:
    """Corpus-wide occurrences per vocabulary term from a (doc, term, tf) table."""
    return term_counts.groupBy("term").agg(F.sum("tf").alias("occurrences"))


def matrix_shape(documents: DataFrame, term_counts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of samples (all documents) and features (distinct terms)."""
    n_samples = documents.select(F.count(F.lit(1))).scalar()
    return (term_counts.select("term").distinct()
            .agg(F.count(F.lit(1)).alias("n_features"))
            .select(n_samples.alias("n_samples"), "n_features"))


def corpus_size(documents: DataFrame, split_col: str = "split", text_col: str = "text",
                label_col: str = "lang") -> DataFrame:
    """Documents, UTF-8 megabytes and categories per split."""
    return documents.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n_docs"),
        (F.sum(F.octet_length(text_col)) / F.lit(1e6)).alias("size_mb"),
        F.countDistinct(label_col).alias("n_categories"))


def vocabulary_terms(text_col: str = "text", stopwords: Iterable[str] | None = lexicon.ENGLISH_STOP_WORDS):
    """Column: vectoriser terms of a text with stop words removed."""
    t = T.terms(text_col)
    if stopwords is not None:
        t = T.filter_tokens(t, stopwords, drop_punctuation=False)
    return t
