"""Token tables and lemmatisation by lexicon join.

A trained tagger and WordNet are per-row libraries with external models; here
the lemma comes from a ``lexicon(token, pos, lemma)`` table joined on (token,
word class), and unknown tokens pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penmark.functions import text as T


def token_table(docs: DataFrame, tokens: Column, id_col: str = "doc_id") -> DataFrame:
    """Long form (doc_id, pos, token) of an ``array<string>`` column."""
    return docs.select(id_col, F.posexplode(tokens).alias("pos", "token"))


def derive_lexicon(tokens: DataFrame) -> DataFrame:
    """A lexicon learned from the corpus vocabulary by suffix rules.

    A token maps to its stem when the stem is itself a corpus token:
    ``-s`` nouns (n), ``-ed`` verbs (v), ``-ly`` adverbs (r). The vocabulary
    self-join is an equi-join on the stem, shuffled (or broadcast by AQE).
    """
    vocab = tokens.select("token").distinct()
    rules = [("n", "s", 1), ("v", "ed", 2), ("r", "ly", 2)]
    t = F.col("token")
    cands = F.array(*[
        F.when(t.endswith(suffix) & (F.length(t) > cut + 1),
               F.struct(F.lit(cls).alias("pos"), F.expr(f"substring(token, 1, length(token) - {cut})").alias("lemma")))
        for cls, suffix, cut in rules])
    # All rules in one pass over the vocabulary, then one semi-join on the stem.
    out = (vocab.select("token", F.explode(cands).alias("c")).filter(F.col("c").isNotNull())
           .select("token", "c.pos", "c.lemma")
           .join(vocab.withColumnRenamed("token", "lemma"), "lemma", "left_semi"))
    return out.select("token", "pos", "lemma")


def lemma_join(tokens: DataFrame, lexicon: DataFrame, tag_col: str = "tag") -> DataFrame:
    """(token, tag) -> lemma: the tag's first letter selects the class, default noun."""
    t = tokens.withColumn("_class", T.word_class(tag_col))
    lex = lexicon.select("token", F.col("pos").alias("_class"), "lemma")
    return (t.join(lex, ["token", "_class"], "left")
            .withColumn("lemma", F.coalesce("lemma", "token")).drop("_class"))
