"""Weights (id, term, weight) in blocks of documents: sums of classes and scores without a shuffle of cells.

Documents are dealt to blocks by a hash of their id (the column ``BLOCK``). What is known of documents, such as their labels, goes
to their block; what is known of terms is asked for by the distinct terms of a block and goes back to it. A block is
one Arrow task. Weights are kept as a table in buckets by block, so that their later readers find them dealt out; weights
without a block are dealt out once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.session import shared_path, written

BLOCK = "_block"
BLOCK_DOCS = 8_192           # documents of a block at most, on average
BLOCK_CELLS = 1_000_000      # the same in cells, for weights that come without a block
FEW_CLASSES = 100            # so many classes of a block's terms meet the block at once
ANSWER_ROWS = 4_000_000      # with more classes, (term, class) rows that meet a block at once, on average


def spark_hash(x: int) -> int:
    """Spark's hash of an int."""
    def mixed(k: int, by: int, left: int) -> int:
        k = k * by & 0xFFFFFFFF
        return (k << left | k >> 32 - left) & 0xFFFFFFFF

    h = 42 ^ mixed(x & 0xFFFFFFFF, 0xCC9E2D51, 15) * 0x1B873593 & 0xFFFFFFFF
    h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= 4
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


@cache
def numbers(parts: int) -> list[int]:
    """A number for each of ``parts``, such that Spark's hash deals them to as many partitions or buckets, one to each."""
    found, x = {}, 0
    while len(found) < parts:
        found.setdefault(spark_hash(x) % parts, x)
        x += 1
    return [found[p] for p in range(parts)]


def in_blocks(df: DataFrame, id_col: str, blocks: int) -> DataFrame:
    """``df`` dealt out by the column ``BLOCK``, by a hash of its id; a block has a partition of its own."""
    number = F.element_at(F.lit(numbers(blocks)), F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int") + 1)
    return df.withColumn(BLOCK, number).repartition(blocks, BLOCK)


def marked(weights: DataFrame, blocks: int) -> DataFrame:
    """``weights`` whose column ``BLOCK`` says how many blocks there are."""
    return weights.withMetadata(BLOCK, {"blocks": blocks})


def blocked(weights: DataFrame, id_col: str) -> tuple[DataFrame, int]:
    """``weights`` with ``BLOCK``, and the number of blocks."""
    if BLOCK in weights.columns:
        return weights, weights.schema[BLOCK].metadata["blocks"]
    blocks = max(weights.sparkSession.sparkContext.defaultParallelism, -(-weights.count() // BLOCK_CELLS))
    return marked(in_blocks(weights, id_col, blocks), blocks), blocks


def kept(weights: DataFrame, kind: str) -> DataFrame:
    """``weights`` written under the shared folder and read back, in a bucket for each block where they have blocks."""
    if BLOCK not in weights.columns:
        return written(weights, kind)
    spark, name = weights.sparkSession, f"{kind}-{uuid.uuid4().hex}".replace("-", "_")
    out = weights.write.bucketBy(weights.schema[BLOCK].metadata["blocks"], BLOCK)
    out.option("path", shared_path(spark, kind)).saveAsTable(name)
    return spark.table(name)


def coded(column: pa.ChunkedArray | pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct values, null included, and every row's place among them."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    encoded = whole.dictionary_encode(null_encoding="encode")
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _places(column: pa.ChunkedArray, values: pa.Array) -> np.ndarray:
    """The place of each row among ``values``, -1 for none."""
    found = pc.index_in(column.combine_chunks().cast(values.type), value_set=values)
    return found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def _doubles(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().fill_null(0.0).to_numpy(zero_copy_only=False)


def _runs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (n[0] of them), then start[1], ..."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


def class_sums(weights: DataFrame, labels: DataFrame, powers: dict[str, int], id_col: str, label_col: str) -> DataFrame:
    """(term, class, ...): for each name in ``powers`` the sum of weight ** power over the labelled documents, a label at a time."""
    own, blocks = blocked(weights, id_col)
    names = list(powers)
    label = labels.select(F.col(id_col).cast(weights.schema[id_col].dataType).alias("id"), F.col(label_col).cast("string").alias("class"))

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, doc = coded(left["id"])
        terms, term = coded(left["term"])
        classes, cls = coded(right["class"])
        place = _places(right["id"], ids)
        order = np.argsort(place, kind="stable")
        place, cls = place[order], cls[order]
        start = np.searchsorted(place, np.arange(len(ids) + 1))   # every document's labels, in a row
        start, n = start[:-1], np.diff(start)
        cell = np.repeat(np.arange(len(doc)), n[doc])
        key, group = np.unique(term[cell] * max(1, len(classes)) + cls[_runs(start[doc], n[doc])], return_inverse=True)
        x = _doubles(left["weight"])[cell]
        out = {"term": terms.take(pa.array(key // max(1, len(classes)))).cast(pa.string()),
               "class": classes.take(pa.array(key % max(1, len(classes)))).cast(pa.string())}
        return pa.table(out | {c: pa.array(np.bincount(group, x ** p, len(key)).astype(float)) for c, p in powers.items()})

    schema = ", ".join(["term string, class string", *[f"`{c}` double" for c in names]])
    given = in_blocks(label.filter("id IS NOT NULL"), "id", blocks).groupBy(BLOCK)
    part = own.select(BLOCK, F.col(id_col).alias("id"), "term", "weight").groupBy(BLOCK).cogroup(given).applyInArrow(sums, schema)
    return part.groupBy("term", "class").agg(*[F.sum(c).alias(c) for c in names])


def class_gains(weights: DataFrame | Sequence[DataFrame], cells: DataFrame, powers: dict[str, int], id_col: str,
                few_classes: int = FEW_CLASSES, answer_rows: int = ANSWER_ROWS) -> DataFrame:
    """(id, class, gain): the sum, over a document's terms in ``cells`` (term, class, ...), of cell[name] * weight ** power for all names.

    A class that a document shares no term with has no row. With many classes they meet a block in parts.
    """
    given = [weights] if isinstance(weights, DataFrame) else list(weights)
    cells = cells.select("term", "class", *powers).filter("term IS NOT NULL")
    many = cells.select("class").distinct().count() > few_classes

    def gains(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, doc = coded(left["id"])
        terms, term = coded(left["term"])
        lists = right["class"].combine_chunks()
        classes, cls = coded(pc.list_flatten(lists))
        by_term = np.argsort(term, kind="stable")
        doc, x = doc[by_term], _doubles(left["weight"])[by_term]
        start = np.searchsorted(term[by_term], np.arange(len(terms) + 1))
        start, n = start[:-1], np.diff(start)
        at = np.repeat(_places(right["term"], terms), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
        value = {c: pc.list_flatten(right[c].combine_chunks()).fill_null(0.0).to_numpy(zero_copy_only=False) for c in powers}
        rows = np.flatnonzero(at >= 0)
        rows = rows[np.argsort(cls[rows], kind="stable")]
        out_doc, out_cls, out_gain = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for own in np.split(rows, np.flatnonzero(np.diff(cls[rows])) + 1) if len(rows) else []:
            cell = _runs(start[at[own]], n[at[own]])
            gain = sum(np.repeat(value[c][own], n[at[own]]) * x[cell] ** p for c, p in powers.items())
            seen = np.flatnonzero(np.bincount(doc[cell], minlength=len(ids)))
            out_doc.append(seen)
            out_cls.append(np.full(len(seen), cls[own[0]]))
            out_gain.append(np.bincount(doc[cell], gain, len(ids))[seen])
        return pa.table({"id": ids.take(pa.array(np.concatenate(out_doc))),
                         "class": classes.take(pa.array(np.concatenate(out_cls))).cast(pa.string()), "gain": pa.array(np.concatenate(out_gain))})

    out = None
    for one in given:
        own, blocks = blocked(one, id_col)
        own = own.select(BLOCK, F.col(id_col).alias("id"), "term", "weight")
        asked, parts = own.select(F.col(BLOCK).alias(BLOCK), F.col("term").alias("term")).distinct(), 1   # other columns than those they meet
        if many:
            per_term = asked.groupBy("term").agg(F.count(F.lit(1)).alias("a")).join(cells.groupBy("term").agg(F.count(F.lit(1)).alias("c")), "term")
            total = per_term.agg(F.sum(F.col("a") * F.col("c"))).first()[0] or 0
            parts = max(1, -(-total // (blocks * answer_rows)))
        keys = [BLOCK, "part"] if parts > 1 else [BLOCK]
        # a row for each term, and part where there are parts
        row = F.struct("class", *[F.col(c).cast("double").alias(c) for c in powers])
        by_term = cells.withColumn("part", F.pmod(F.xxhash64("class"), F.lit(parts)).cast("int")) if parts > 1 else cells
        by_term = by_term.repartition("term").groupBy("term", *keys[1:]).agg(F.collect_list(row).alias("c")).select(
            "term", *keys[1:], *[F.col(f"c.{c}").alias(c) for c in ("class", *powers)])
        answers = asked.join(by_term, "term").repartition(blocks, BLOCK)
        dealt = own.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))) if parts > 1 else own
        schema = own.select("id", F.lit("").alias("class"), F.lit(0.0).alias("gain")).schema
        scored = dealt.groupBy(*keys).cogroup(answers.groupBy(*keys)).applyInArrow(gains, schema)
        out = scored if out is None else out.unionByName(scored)
    if len(given) > 1:
        out = out.groupBy("id", "class").agg(F.sum("gain").alias("gain"))
    return out.withColumnRenamed("id", id_col)


def per_document(weights: DataFrame | Sequence[DataFrame], id_col: str, column, name: str) -> DataFrame:
    """(id, name): the sum of ``column`` over the cells of every document."""
    parts = [weights] if isinstance(weights, DataFrame) else list(weights)
    out = None
    for one in parts:
        own = one.groupBy(id_col).agg(F.sum(column).alias(name))
        out = own if out is None else out.unionByName(own)
    return out if len(parts) == 1 else out.groupBy(id_col).agg(F.sum(name).alias(name))
