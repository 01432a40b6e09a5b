"""Line dedup over levelled sorted runs of line hashes.

The corpus is taken in batches, each a folder of the hashed lines, read once. A batch's distinct line keys (two 64-bit hashes each)
are counted, merge-anti-joined with the runs of keys that are already settled (seen in
``min_docs`` documents), and added as a new sorted run. Runs are tables bucketed and sorted
by hash, so joins and merges of runs, merge joins in this order, need no exchange of them. When a level holds
``fanout`` runs they are compacted into one run of the next level; keys that reach
``min_docs`` there move to the settled runs, and later batches no longer carry them.
At the end the settled keys are looked up in every text, and their lines go.

DataFrame functions only. What is exchanged is 16 bytes per distinct line and batch,
counted before the exchange, so a line that occurs in a third of all documents is one
row per task. The last join moves the texts once, by a hash of the text.

Defined results: a null or empty text is one empty line; an empty line's key has no
code points and is never dropped while ``min_key`` is 1 or more. Each row is a document:
repeated rows count as often as they occur. A text that loses all lines becomes empty.
Empty tables give empty tables. Other columns, whatever their names, pass unchanged.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penmark.llm.common import BLANKS, ascii_lower, fixed, materialise, text_key
from penmark.session import shared_path
from penmark.sources.files import remove_path

MIN_DOCS = 10
MIN_KEY = 1     # code points
BATCHES = 4
FANOUT = 2      # runs of a level that are merged into one


def line_keys(text: Column) -> Column:
    """The key of every line, in order: stripped at both ends, A-Z lower-cased."""
    return F.transform(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n", -1),
                       lambda x: F.btrim(x, F.lit(BLANKS)))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


class LineRuns:
    """Sorted runs of (h1, h2, n), n the number of documents with that line."""

    def __init__(self, spark, min_docs: int, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.settled: list[str] = []
        self.paths: dict[str, str] = {}   # of the tables' files, in the shared folder

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = shared_path(self.spark, "line-run")
        (df.select("h1", "h2", "n").repartition(self.buckets, "h1", "h2").write.format("parquet").option("path", self.paths[name])
         .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name))
        return name

    def _merge(self, names: list[str]) -> DataFrame:
        """One row per key of the runs, counts added, by merge joins in bucket and sort order."""
        out = self.spark.table(names[0])
        for n in names[1:]:
            right = self.spark.table(n).withColumnRenamed("n", "m").hint("merge")
            out = out.join(right, ["h1", "h2"], "full_outer").select(
                "h1", "h2", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
        return out

    def add(self, batch: DataFrame) -> None:
        """``batch``: one row (h1, h2) per document and distinct line."""
        own = batch.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
        for run in self.settled:
            # an anti-join as left join and test: the optimiser would move a left_anti join below the
            # counts and exchange every single line
            seen = self.spark.table(run).select("h1", "h2", F.lit(True).alias("seen")).hint("merge")
            own = own.join(seen, ["h1", "h2"], "left").filter("seen IS NULL").drop("seen")
        self.levels[0].append(self._write(own))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _compact(self, level: int) -> None:
        names = self.levels[level]
        merged, full = self._merge(names), F.col("n") >= self.min_docs
        self.settled.append(self._write(merged.filter(full)))
        if level + 1 == len(self.levels):
            self.levels.append([])
        self.levels[level + 1].append(self._write(merged.filter(~full)))
        self.levels[level] = []
        self._drop(names)

    def _drop(self, names: list[str]) -> None:
        for n in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {n}")
            remove_path(self.spark, self.paths.pop(n))

    def close(self) -> None:
        """Drops what runs there still are."""
        self._drop(list(self.paths))

    def finish(self) -> DataFrame:
        """(h1, h2) of every key found in ``min_docs`` documents, as a written table.

        A key may come twice: settled, and again among counts from before that.
        """
        names = [n for level in self.levels for n in level]
        out = self._merge(names).filter(F.col("n") >= self.min_docs).select("h1", "h2")
        for run in self.settled:
            out = out.unionByName(self.spark.table(run).select("h1", "h2"))
        return materialise(out, "line-keys")


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_key: int = MIN_KEY,
                   batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(h1, h2) of the keys that at least ``min_docs`` rows of ``docs`` hold."""
    keys = F.array_distinct(F.filter(line_keys(F.col("text")), lambda k: F.length(k) >= min_key))
    rows = docs.select(F.pmod(F.xxhash64("text"), F.lit(batches)).alias("batch"), F.explode(keys).alias("key"))
    spark, path = docs.sparkSession, shared_path(docs.sparkSession, "line-hashes")
    rows.select("batch", *_hashes(F.col("key"))).write.partitionBy("batch").parquet(path)
    rows = spark.read.schema("h1 long, h2 long, batch int").parquet(path)   # a batch's folder is all that its filter reads
    runs = LineRuns(spark, min_docs, fanout)
    try:
        for b in range(batches):
            runs.add(rows.filter(F.col("batch") == b).select("h1", "h2"))
        return runs.finish()
    finally:
        runs.close()


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_key: int = MIN_KEY,
               batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Every row of ``docs`` (columns packed in ``row``) with n_lines, n_dropped and the text that is ``kept``."""
    full = frequent_lines(docs, min_docs, min_key, batches, fanout)
    found = docs.select(*text_key(F.col("text")), F.posexplode(line_keys(F.col("text"))).alias("pos", "key"))
    found = found.filter(F.length("key") >= min_key).select("__k1", "__k2", "pos", *_hashes(F.col("key")))
    drops = materialise(
        found.join(full, ["h1", "h2"], "left_semi").groupBy("__k1", "__k2")
        .agg(F.collect_set("pos").alias("__drop")), "line-drops")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    df = docs.select(row, *text_key(F.col("text"))).join(drops, ["__k1", "__k2"], "left").select("row", "__drop")
    df = fixed(df, __lines=F.split(F.coalesce("row.text", F.lit("")), "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__drop")
    kept = F.when(F.col("__drop").isNull(), F.coalesce("row.text", F.lit(""))).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("__lines", i)), "\n"))
    return df.select("row", F.size("__lines").cast("long").alias("n_lines"),
                     F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))


def drop_frequent_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the same columns, text without the frequent lines, n_chars its length if there is one."""
    out = line_dedup(docs, **options)
    cols = {c: F.col(f"row.`{c}`") for c in docs.columns}
    cols["text"] = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("row.text"))
    if "n_chars" in cols:
        cols["n_chars"] = F.length(cols["text"]).cast("long")
    return out.select(*[c.alias(n) for n, c in cols.items()])
