"""Per-article sentence and word statistics, and the relational reports on them.

One article stays one row through the whole metrics stage: sentences, words and
their statistics are array expressions, so the stage is narrow (no shuffle).
Reports that group by author use partial aggregation; nothing collects a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penmark.functions import text as T
from penmark.operators.skew import smallest_k_per_group

FEATURES = (
    "total_number_of_sentences",
    "total_number_of_words",
    "number_of_words_sentence_mean",
    "number_of_words_sentence_median",
    "number_of_words_sentence_min",
    "number_of_words_sentence_max",
)


def articles_from_documents(documents: DataFrame) -> DataFrame:
    """Bind the ``documents`` table to the article model (url, author, headline, body)."""
    return documents.select(
        "doc_id",
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("author"),
        T.first_line("text").alias("headline"),
        F.col("text").alias("body"),
        "lang",
    )


def _median(sorted_lens: Column, n: Column) -> Column:
    half = F.floor(n / 2).cast("int")
    odd = F.get(sorted_lens, half).cast("double")
    even = (F.get(sorted_lens, half - 1) + F.get(sorted_lens, half)) / F.lit(2.0)
    return F.when(n == 0, F.lit(None).cast("double")).when(n % 2 == 1, odd).otherwise(even)


def article_metrics(articles: DataFrame, body_col: str = "body", clean: bool = True,
                    strict: bool = False, drop_incomplete: bool = True) -> DataFrame:
    """Add the metrics columns to every article row.

    Columns: body (cleaned), sentences_words array<array<string>>,
    total_number_of_sentences, total_number_of_words, number_of_words_each_sentence,
    and mean/median/min/max words per sentence. Articles without sentences have
    null statistics and are dropped unless ``drop_incomplete`` is false.
    """
    body = T.clean_text(body_col, strict) if clean else F.col(body_col)
    df = articles.withColumn(body_col, body)
    # The word arrays come out of a one-row ``inline`` (a Generate node): filters
    # and projections above reference the materialised column instead of having
    # the optimizer inline the tokenisation into every predicate that uses it.
    words = T.tokenize_words(T.split_sentences(body_col)).alias("sentences_words")
    df = df.select("*", F.inline(F.array(F.struct(words))))
    lens = T.sentence_lengths("sentences_words")
    df = df.withColumn("number_of_words_each_sentence", lens)
    n = F.size("number_of_words_each_sentence")
    total = F.aggregate("number_of_words_each_sentence", F.lit(0).cast("long"), lambda a, x: a + x)
    srt = F.array_sort("number_of_words_each_sentence")
    df = (df
          .withColumn("total_number_of_sentences", n.cast("long"))
          .withColumn("total_number_of_words", total)
          .withColumn("number_of_words_sentence_mean",
                      F.when(n > 0, total / n).otherwise(F.lit(None).cast("double")))
          .withColumn("number_of_words_sentence_median", _median(srt, n))
          .withColumn("number_of_words_sentence_min", F.array_min("number_of_words_each_sentence"))
          .withColumn("number_of_words_sentence_max", F.array_max("number_of_words_each_sentence")))
    return drop_incomplete_rows(df) if drop_incomplete else df


def drop_incomplete_rows(metrics: DataFrame) -> DataFrame:
    """Drop rows with any null statistic: every statistic is null exactly when
    the article has no sentence, so that one test is the whole null check."""
    return metrics.filter(F.col("total_number_of_sentences") > 0)


def feature_projection(metrics: DataFrame, label_col: str = "author") -> DataFrame:
    return metrics.select(label_col, *FEATURES)


def filter_author(df: DataFrame, author: str, author_col: str = "author") -> DataFrame:
    return df.filter(F.col(author_col) == F.lit(author))


def filter_categories(df: DataFrame, categories: Sequence[str] | None,
                      category_col: str = "lang") -> DataFrame:
    """Rows whose class is in ``categories``; ``None`` keeps all."""
    if categories is None:
        return df
    return df.filter(F.col(category_col).isin(list(categories)))


def distinct_authors(df: DataFrame, author_col: str = "author") -> DataFrame:
    return df.select(author_col).distinct()


def articles_per_author(df: DataFrame, author_col: str = "author") -> DataFrame:
    return df.groupBy(author_col).agg(F.count(F.lit(1)).alias("num_of_articles"))


def min_class_size(df: DataFrame, author_col: str = "author") -> DataFrame:
    return articles_per_author(df, author_col).agg(F.min("num_of_articles").alias("min_articles"))


def shuffle_key(id_col: Column | str, seed: str = "0") -> Column:
    """Reproducible random order: md5 of seed and row key, the same in any engine."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(seed), c.cast("string")))


def shuffle_rows(df: DataFrame, id_col: str, seed: str = "0") -> DataFrame:
    return df.withColumn("shuffle_key", shuffle_key(id_col, seed)).orderBy("shuffle_key")


def balanced_sample(df: DataFrame, id_col: str, author_col: str = "author",
                    seed: str = "0") -> DataFrame:
    """Equal rows per author, as many as the smallest author has, chosen at random.

    The class minimum is a scalar subquery; selection is skew-safe and exact.
    """
    keyed = df.withColumn("shuffle_key", shuffle_key(id_col, seed))
    k = min_class_size(df, author_col).scalar()
    return smallest_k_per_group(keyed, author_col, "shuffle_key", k)


def longest_articles_topk(metrics: DataFrame, n: int, id_col: str = "doc_id") -> DataFrame:
    """Top n articles by longest sentence (ties by id), with that sentence's words."""
    top = metrics.orderBy(F.col("number_of_words_sentence_max").desc(), F.col(id_col)).limit(n)
    return top.withColumn("longest_sentence", longest_sentence_text())


def longest_sentence_text() -> Column:
    """Words of the first longest sentence, space-joined."""
    lens = F.col("number_of_words_each_sentence")
    pos = F.array_position(lens, F.array_max(lens))
    return F.array_join(F.element_at("sentences_words", pos.cast("int")), " ")


def flatten_words(metrics: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return metrics.select(id_col, F.posexplode(F.flatten("sentences_words")).alias("word_pos", "word"))


def sentence_length_histogram(metrics: DataFrame, bins: int = 50,
                              author_col: str = "author") -> DataFrame:
    """Per author, ``bins`` equal-width bins between that author's min and max.

    Bins are half open except the last, which is closed. An author whose values
    are all equal gets the range (v - 0.5, v + 0.5). Only non-empty bins are kept.
    Sentence lengths are first counted per (author, length) with partial
    aggregation; the per-author range is then a window over that small table,
    so the corpus is read once and no window ever sees raw sentences.
    """
    counts = (metrics.select(author_col, F.explode("number_of_words_each_sentence").alias("x"))
              .groupBy(author_col, "x").agg(F.count(F.lit(1)).alias("c")))
    w = Window.partitionBy(author_col)
    lo0, hi0 = F.min("x").over(w), F.max("x").over(w)
    ranged = (counts.withColumn("lo0", lo0).withColumn("hi0", hi0)
              .withColumn("lo", F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0").cast("double")))
              .withColumn("hi", F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0").cast("double"))))
    binned = ranged.withColumn(
        "bin", F.least(F.lit(bins - 1), F.floor((F.col("x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))).cast("int"))
    out = binned.groupBy(author_col, "bin", "lo", "hi").agg(F.sum("c").alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    return out.select(author_col, "bin",
                      (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                      (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"), "n")


def feature_pairs(metrics: DataFrame, authors: Sequence[str] | None = None,
                  author_col: str = "author", id_col: str = "doc_id") -> DataFrame:
    """(author, x, y) points for each of the 15 pairs of the 6 features.

    A row turns into its 15 points by ``explode`` of an array literal built per
    row, so there is no self-join and no shuffle.
    """
    df = metrics if authors is None else metrics.filter(F.col(author_col).isin(list(authors)))
    pairs = [F.struct(F.lit(FEATURES[c]).alias("x_feature"), F.lit(FEATURES[r]).alias("y_feature"),
                      F.col(FEATURES[c]).cast("double").alias("x"), F.col(FEATURES[r]).cast("double").alias("y"))
             for c in range(len(FEATURES)) for r in range(len(FEATURES)) if r < c]
    return df.select(author_col, id_col, F.explode(F.array(*pairs)).alias("p")).select(
        author_col, id_col, "p.x_feature", "p.y_feature", "p.x", "p.y")


def grid_pivot(long: DataFrame, x: str, y: str, z: str, x_values: Sequence | None = None,
               check_unique: bool = True) -> DataFrame:
    """Long (x, y, z) to a wide matrix: one row per y, one column per x, sorted axes.

    With ``check_unique`` a duplicated (x, y) cell raises instead of picking one.
    """
    cells = long.groupBy(y, x).agg(F.count(F.lit(1)).alias("_n"), F.first(z).alias(z))
    if check_unique:
        cells = cells.withColumn(z, F.when(F.col("_n") > 1, F.raise_error(
            F.lit("grid_pivot: duplicate (x, y) cell"))).otherwise(F.col(z)))
    grouped = cells.groupBy(y)
    pv = grouped.pivot(x, sorted(x_values)) if x_values is not None else grouped.pivot(x)
    return pv.agg(F.first(z))


def grid_mesh(long: DataFrame, x: str, y: str, x_block: int = 10_000, y_block: int = 1_000) -> DataFrame:
    """Every (x, y) combination of the distinct axis values, null included.

    Both axes are dealt to blocks by hash, as many as their sizes ask for. The values of an x block are
    one array; an array meets the y values of one block by an equi-join on (x block, y block) and is
    exploded there, so a task holds about ``x_block`` values at a time whatever the size of the axes.
    """
    def blocks(axis, size):
        n = axis.agg(F.floor(F.count(F.lit(1)) / size).cast("int").alias("n")).scalar()
        return n, F.pmod(F.xxhash64(axis.columns[0]), n + 1).cast("int")

    xs, ys = long.select(F.col(x).alias("_x")).distinct(), long.select(F.col(y).alias("_y")).distinct()
    (nx, bx), (ny, by) = blocks(xs, x_block), blocks(ys, y_block)
    arrays = xs.select("_x", bx.alias("_bx")).groupBy("_bx").agg(F.collect_list(F.struct("_x")).alias("_xs"))
    left = arrays.select("_bx", "_xs", F.explode(F.sequence(F.lit(0), ny)).alias("_by"))
    right = ys.select("_y", by.alias("_by")).select("_y", "_by", F.explode(F.sequence(F.lit(0), nx)).alias("_bx"))
    met = right.join(left, ["_bx", "_by"]).select("_y", F.explode("_xs").alias("_c"))
    return met.select(F.col("_c._x").alias(x), F.col("_y").alias(y))
