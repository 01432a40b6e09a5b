"""Feature weighting and selection in long form: (doc_id, term, weight).

The document-term matrix is never densified. Term counts shuffle on
(doc, term) with partial aggregation; document frequency shuffles on term; the
row norm is a window over one document's terms (bounded by that document). The
corpus size is a scalar subquery, so no value travels through the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penmark.functions import lexicon
from penmark.operators.blocks import BLOCK, BLOCK_DOCS, blocked, class_sums, coded, in_blocks, marked
from penmark.operators.terms import vocabulary_terms


def split_flag(key: Column | str, seed: str, test_size: float) -> Column:
    """True for the test side of a hash holdout.

    md5(seed || key) compared with a hex threshold: stable under repartitioning,
    reproducible in any engine, and exact copies of a text land on one side
    when the key is the text.
    """
    c = F.col(key) if isinstance(key, str) else key
    threshold = format(int(round(test_size * 16 ** 8)), "08x")
    return F.md5(F.concat(F.lit(seed), c.cast("string"))) < F.lit(threshold)


def train_test_split(df: DataFrame, key: str = "text", seed: str = "23",
                     test_size: float = 0.25, split_col: str = "split") -> DataFrame:
    return df.withColumn(split_col, F.when(split_flag(key, seed, test_size), F.lit("test"))
                         .otherwise(F.lit("train")))


def term_counts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                stopwords: Iterable[str] | None = lexicon.ENGLISH_STOP_WORDS,
                tokens: Column | None = None) -> DataFrame:
    """(doc_id, term, tf): unigram counts; lower-case runs of 2+ word characters.

    ``tokens`` may supply an already tokenised ``array<string>`` column instead.
    """
    toks = tokens if tokens is not None else vocabulary_terms(text_col, stopwords)
    return (documents.select(id_col, F.explode(toks).alias("term"))
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def _idf(df: Column, n_docs: Column, smooth: bool) -> Column:
    return F.log((n_docs + 1) / (df + 1)) + 1 if smooth else F.log(n_docs / df) + 1


def document_frequency(tf: DataFrame, n_docs: Column, smooth: bool = True,
                       max_df: float | None = None) -> DataFrame:
    """(term, df, idf). ``smooth``: ln((1+n)/(1+df))+1, else ln(n/df)+1.

    ``max_df`` drops terms found in more than that share of the documents.
    """
    # Reading ``tf`` here (occurrences) keeps this branch's partial aggregate equal
    # to the term-count branch, so Spark reuses that shuffle instead of tokenising
    # the corpus a second time.
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("occurrences"))
    if max_df is not None:
        df = df.filter(F.col("df") <= F.lit(max_df) * n_docs)
    return df.withColumn("idf", _idf(F.col("df"), n_docs, smooth))


def with_idf(df: DataFrame, n_docs: Column, smooth: bool, max_df: float | None) -> DataFrame:
    """``df`` (df, ...) with idf, without the terms of more than the share ``max_df`` of the documents."""
    df = df if max_df is None else df.filter(F.col("df") <= F.lit(max_df) * n_docs)
    return df.withColumn("idf", _idf(F.col("df"), n_docs, smooth))


# Documents are dealt to blocks, and their cells (id, term, ...) are formed there: a block asks for what it needs of each of its
# distinct terms and gets it back, so the texts and these terms are shuffled, and the cells are not.

def block_tokens(documents: DataFrame, id_col: str, text_col: str, stopwords: Iterable[str] | None, tokens: Column | None,
                 keep: Iterable[str] = ()) -> tuple[DataFrame, int, int]:
    """(BLOCK, id, tokens, ``keep``), the number of blocks and that of documents. The texts are dealt out and tokenised there.

    With ``keep`` a block has a partition of its own.
    """
    toks = tokens if tokens is not None else vocabulary_terms(text_col, stopwords)
    n = documents.select(id_col).count()
    blocks = max(documents.sparkSession.sparkContext.defaultParallelism, -(-n // BLOCK_DOCS))
    keep = list(keep)
    if keep:
        own = documents.select(F.col(id_col).alias("id"), F.col(text_col), *keep)
        own = own.withColumn(BLOCK, F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).repartitionById(blocks, F.col(BLOCK))
        return own.select(BLOCK, "id", toks.alias("tokens"), *keep), blocks, n
    return in_blocks(documents.select(id_col, text_col), id_col, blocks).select(BLOCK, F.col(id_col).alias("id"), toks.alias("tokens")), blocks, n


def _block_cells(t: pa.Table) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The ids and terms of a block, and its cells: places of id and term, count."""
    ids, doc = coded(t["id"])
    lists = t["tokens"].combine_chunks()
    terms, code = coded(pc.list_flatten(lists))
    doc = np.repeat(doc, pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    cell, count = np.unique(doc * max(1, len(terms)) + code, return_counts=True)
    return ids, terms, cell // max(1, len(terms)), cell % max(1, len(terms)), count


def block_terms(tokens: DataFrame) -> DataFrame:
    """(BLOCK, term, n): the distinct terms of every block and how many of its documents hold them."""
    def count(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        _, terms, _, term, _ = _block_cells(t)
        return pa.table({BLOCK: pa.array(np.full(len(terms), key[0].as_py(), np.int32)), "term": terms.cast(pa.string()),
                         "n": pa.array(np.bincount(term, minlength=len(terms)).astype(np.int64))})

    return tokens.groupBy(BLOCK).applyInArrow(count, f"{BLOCK} int, term string, n long")


def block_tfidf(tokens: DataFrame, idf: DataFrame, blocks: int, sublinear: bool, id_col: str, with_block: bool = False) -> DataFrame:
    """``tfidf`` of ``block_tokens`` and the idf (BLOCK, term, idf) that their blocks asked for, rows L2-normalised."""
    def weigh(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({BLOCK: pa.array([], pa.int32()), "id": left["id"].slice(0, 0), "term": pa.array([], pa.string()), "weight": pa.array([], pa.float64())})
        ids, terms, doc, term, count = _block_cells(left)
        at = pc.index_in(terms, value_set=right["term"].combine_chunks().cast(terms.type)).fill_null(-1).to_numpy(zero_copy_only=False)
        known = at[term] >= 0
        doc, term, count = doc[known], term[known], count[known].astype(np.float64)
        w = (np.log(count) + 1 if sublinear else count) * right["idf"].to_numpy()[at[term]]
        norm = np.sqrt(np.bincount(doc, w * w, len(ids)))
        return pa.table({BLOCK: pa.array(np.full(len(doc), key[0].as_py(), np.int32)), "id": ids.take(pa.array(doc)), "term": terms.take(pa.array(term)).cast(pa.string()), "weight": pa.array(w / norm[doc])})

    schema = tokens.select(BLOCK, "id", F.lit("").alias("term"), F.lit(0.0).alias("weight")).schema
    out = tokens.groupBy(BLOCK).cogroup(idf.select(BLOCK, "term", "idf").repartition(blocks, BLOCK).groupBy(BLOCK)).applyInArrow(weigh, schema)
    out = out.withColumnRenamed("id", id_col)
    return marked(out, blocks) if with_block else out.drop(BLOCK)


VECTOR = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"   # as Spark stores a sparse vector


def _vectors(size: int, doc: np.ndarray, idx: np.ndarray, w: np.ndarray, rows: np.ndarray, docs: int) -> pa.Array:
    """``VECTOR`` of every row: the cells of the document at its place in ``rows``, -1 for none."""
    order = np.lexsort((idx, doc))
    offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=docs)))).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in (idx.astype(np.int32), w)]
    if len(rows) != docs or (rows != np.arange(docs)).any():
        none = [pa.array([[]], x.type) for x in lists]
        lists = [pa.concat_arrays([x, n]).take(pa.array(np.where(rows < 0, docs, rows))) for x, n in zip(lists, none)]
    return pa.StructArray.from_arrays([pa.array(np.zeros(len(rows), np.int8)), pa.array(np.full(len(rows), size, np.int32)), *lists],
                                      names=["type", "size", "indices", "values"])


def block_vectors(tokens: DataFrame, index: DataFrame, blocks: int, size: int, sublinear: bool, keep: Iterable[str]) -> DataFrame:
    """``keep`` and ``features`` (``VECTOR``) of every row of ``block_tokens``: its id's tf-idf, L2-normalised, over a numbered vocabulary.

    ``index`` has (BLOCK, term, idf, idx), what the blocks asked for. Formed in the blocks: neither cells nor vectors are shuffled.
    A row without an id has no cell.
    """
    keep = list(keep)

    def form(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, terms, doc, term, count = _block_cells(left)
        at = pc.index_in(terms, value_set=right["term"].combine_chunks().cast(terms.type)).fill_null(-1).to_numpy(zero_copy_only=False)
        known = at[term] >= 0 if len(term) else np.zeros(0, bool)
        doc, term, count = doc[known], term[known], count[known].astype(np.float64)
        w = (np.log(count) + 1 if sublinear else count) * right["idf"].to_numpy()[at[term]]
        norm = np.sqrt(np.bincount(doc, w * w, len(ids)))
        _, rows = coded(left["id"])
        rows = np.where(left["id"].combine_chunks().is_null().to_numpy(zero_copy_only=False), -1, rows)
        vectors = _vectors(size, doc, right["idx"].to_numpy()[at[term]], w / norm[doc], rows, len(ids))
        return pa.table({c: left[c] for c in keep} | {"features": vectors})

    kinds = {f.name: f.dataType.simpleString() for f in tokens.schema.fields}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], f"features {VECTOR}"])
    asked = index.select(BLOCK, "term", "idf", "idx").repartitionById(blocks, F.col(BLOCK))
    return tokens.groupBy(BLOCK).cogroup(asked.groupBy(BLOCK)).applyInArrow(form, schema)


def weight_vectors(weights: DataFrame, index: DataFrame, size: int, id_col: str) -> DataFrame:
    """(id, features) of the ids of (id, term, weight), formed in the weights' blocks over the numbered vocabulary (term, idx)."""
    own, blocks = blocked(weights, id_col)
    own = own.select(BLOCK, F.col(id_col).alias("id"), "term", "weight").filter("id IS NOT NULL")
    asked = own.select(F.col(BLOCK).alias(BLOCK), F.col("term").alias("term")).distinct()

    def form(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, doc = coded(left["id"])
        terms, term = coded(left["term"])
        at = pc.index_in(terms, value_set=right["term"].combine_chunks().cast(terms.type)).fill_null(-1).to_numpy(zero_copy_only=False)
        known = at[term] >= 0 if len(term) else np.zeros(0, bool)
        w = left["weight"].combine_chunks().to_numpy(zero_copy_only=False)[known]
        vectors = _vectors(size, doc[known], right["idx"].to_numpy()[at[term[known]]], w, np.arange(len(ids)), len(ids))
        return pa.table({"id": ids, "features": vectors})

    answers = asked.join(index.select("term", "idx"), "term").repartition(blocks, BLOCK)
    kind = own.schema["id"].dataType.simpleString()
    out = own.groupBy(BLOCK).cogroup(answers.groupBy(BLOCK)).applyInArrow(form, f"id {kind}, features {VECTOR}")
    return out.withColumnRenamed("id", id_col)


def tfidf(tf: DataFrame, idf: DataFrame, sublinear: bool = False, norm: bool = True,
          id_col: str = "doc_id") -> DataFrame:
    """(doc_id, term, weight): tf (or 1+ln tf) times idf, rows L2-normalised.

    Terms missing from ``idf`` are dropped (vocabulary of the fitted side).
    """
    w_tf = (F.log(F.col("tf")) + 1) if sublinear else F.col("tf").cast("double")
    out = tf.join(idf.select("term", "idf"), "term").withColumn("weight", w_tf * F.col("idf"))
    if norm:
        n2 = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(id_col)))
        out = out.withColumn("weight", F.col("weight") / n2)
    return out.select(id_col, "term", "weight")


def fit_tfidf(train_docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              smooth: bool = True, sublinear: bool = False, max_df: float | None = None,
              stopwords: Iterable[str] | None = lexicon.ENGLISH_STOP_WORDS, tokens: Column | None = None,
              with_block: bool = False) -> tuple[DataFrame, DataFrame]:
    """Fit idf on ``train_docs``; returns (train weights, idf table). ``with_block`` leaves the block in the weights, for ``kept``."""
    own, blocks, n = block_tokens(train_docs, id_col, text_col, stopwords, tokens)
    asked = block_terms(own)

    def frequent(df: DataFrame) -> DataFrame:
        return with_idf(df, F.lit(n), smooth, max_df)

    # a row for each block that has the term
    answers = frequent(asked.select(BLOCK, "term", F.sum("n").over(Window.partitionBy("term")).alias("df")))
    return block_tfidf(own, answers, blocks, sublinear, id_col, with_block), frequent(asked.groupBy("term").agg(F.sum("n").alias("df")))


def transform_tfidf(docs: DataFrame, idf: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    sublinear: bool = False, stopwords: Iterable[str] | None = lexicon.ENGLISH_STOP_WORDS,
                    tokens: Column | None = None, with_block: bool = False) -> DataFrame:
    """Apply a fitted idf table to new documents; unseen terms are dropped."""
    own, blocks, _ = block_tokens(docs, id_col, text_col, stopwords, tokens)
    return block_tfidf(own, block_terms(own).select(BLOCK, "term").join(idf.select("term", "idf"), "term"), blocks, sublinear, id_col, with_block)


def hashed_vectors(documents: DataFrame, n_features: int = 2 ** 16, id_col: str = "doc_id",
                   text_col: str = "text",
                   stopwords: Iterable[str] | None = lexicon.ENGLISH_STOP_WORDS) -> DataFrame:
    """(doc_id, bucket, weight): terms hashed into ``n_features`` buckets, L2.

    The bucket is the first 32 bits of the term's md5, so any engine can
    reproduce it; counts are non-negative. No vocabulary pass is needed.
    """
    words = documents.select(id_col, F.explode(vocabulary_terms(text_col, stopwords)).alias("term"))
    bucket = F.pmod(F.conv(F.substring(F.md5("term"), 1, 8), 16, 10).cast("long"), F.lit(n_features))
    out = words.groupBy(id_col, bucket.alias("bucket")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    n2 = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(id_col)))
    return out.withColumn("weight", F.col("weight") / n2)


def chi2_scores(weights: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                label_col: str = "lang") -> DataFrame:
    """(term, chi2): sum over classes of (O-E)^2/E on feature weights.

    O = weight sum of the term in the class, E = class share x term total t. The shares
    add up to 1, so the sum over all classes, absent ones included, is sum(O^2 / share) / t - t:
    one aggregation of the non-zero (class, term) cells.
    """
    n = labels.select(F.count(F.lit(1))).scalar()
    shares = labels.groupBy(F.col(label_col).cast("string").alias("class")).agg((F.count(F.lit(1)) / n).alias("p"))
    obs = class_sums(weights, labels, {"o": 1}, id_col, label_col)
    # One row per class: AQE broadcasts it when its measured size is small.
    return obs.join(shares, "class").groupBy("term").agg(
        (F.sum(F.col("o") * F.col("o") / F.col("p")) / F.sum("o") - F.sum("o")).alias("chi2"))


def chi2_select(weights: DataFrame, labels: DataFrame, k: int, id_col: str = "doc_id",
                label_col: str = "lang") -> DataFrame:
    """The k best terms by chi2 (ties by term)."""
    return (chi2_scores(weights, labels, id_col, label_col)
            .orderBy(F.col("chi2").desc(), F.col("term")).limit(k))


def selected_names(selected: DataFrame) -> DataFrame:
    """Surviving term names in vocabulary (alphabetical) order with their position.

    Runs on the k selected rows only, already reduced by the top-k.
    """
    return selected.select("term").withColumn(
        "position", F.row_number().over(Window.orderBy("term")) - 1)


def label_encode(df: DataFrame, label_col: str = "lang", out_col: str = "label_index"):
    """Label -> index in sorted order (``StringIndexer``, alphabetical)."""
    model = StringIndexer(inputCol=label_col, outputCol=out_col,
                          stringOrderType="alphabetAsc").fit(df)
    return model.transform(df).withColumn(out_col, F.col(out_col).cast("int")), model


def assemble_features(df: DataFrame, cols: Iterable[str], out_col: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out_col).transform(df)
