"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.session import shared_path

# The six ASCII white-space characters that separate words.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def materialise(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` under the cluster's shared folder and read it back.

    Cuts the lineage with a plain written table: every executor can read it, so a
    lost executor costs no recomputation of what lies before it.
    """
    spark = df.sparkSession
    path = shared_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null and blank texts have none."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, GAP, -1))


def n_words(text: Column) -> Column:
    """Number of words of a text (long)."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, GAP, -1))).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, upper, upper.lower())))



def fixed(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns behind a one-row ``inline``, so that each is computed once per row.

    A plain projection may be merged into its consumer; inside a lambda that would
    recompute the expression for every element.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a whole text (null counts as empty)."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("__k1"), F.xxhash64(F.lit(1), t).alias("__k2")]


def docs_table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
