"""SimHash near-dedup with pivot distance tables.

A text's fingerprint is the bitwise majority of the 64-bit hashes of its word shingles.
The Hamming distances of every distinct fingerprint to 16 reference fingerprints are
computed once (the pivot table, one byte each). A pair whose coordinates differ by more
than ``max_bits`` at any pivot cannot be within ``max_bits`` (triangle inequality) and is
discarded; the survivors are verified on the fingerprints themselves.

So that not all pairs meet, fingerprints are first dealt by the pigeonhole rule: cut into
``PARTS`` parts, two fingerprints within ``max_bits`` agree on at least PARTS - max_bits
of them, so every choice of that many parts is a bucket key. Copies are one fingerprint,
so a group of copies costs one row. A bucket above ``CHUNK`` fingerprints is compared
chunk against chunk, each pair of chunks where its hash sends it. A task gives back links
that span the components of its pairs, never all pairs.

Defined results: a null or blank text has fingerprint zero, which links like any other;
a text of fewer words than a shingle is one shingle. Rows with null ids get a fingerprint
and a component; the component's id is its smallest non-null id. Repeated rows are rows of
their own. An empty table gives an empty table. Columns besides the id and the text are
not looked at. Shingles of a long text are hashed in slices of ``SLICE``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penmark.llm.common import materialise
from penmark.llm.components import Forest, components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
PARTS = 5
CHUNK = 512
GROUP_ROWS = 1 << 16   # rows of the buckets that are compared in one group
SLICE = 1 << 16
N_PIVOTS = 16


def pivots() -> list[int]:
    """The reference fingerprints: pseudorandom, from the golden-ratio sequence mixed by splitmix64."""
    out, mask = [], (1 << 64) - 1
    for i in range(1, N_PIVOTS + 1):
        z = (i * 0x9E3779B97F4A7C15) & mask
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        out.append(z ^ (z >> 31))
    return out


def simhash(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of a UTF-8 text as a signed 64-bit number."""
    import xxhash

    words = text.lower().split()   # bytes: lowers A-Z, splits at the six ASCII blanks
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    last = ends[min(size, len(words)) - 1:]
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, SLICE):
        hi = min(n, lo + SLICE)
        h = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in
                         zip(starts[lo:hi].tolist(), last[lo:hi].tolist())), np.uint64, hi - lo)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (ones * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """(id, fp) for every row of ``docs``."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            fps = [simhash(x.as_buffer().to_pybytes() if x.is_valid else b"", size) for x in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=[id_col, "fp"])

    return docs.select(id_col, "text").mapInArrow(run, schema)


def pivot_table(fp: Column) -> list[Column]:
    """The distances to all pivots, eight to a long (one byte each)."""
    signed = [p - (1 << 64) if p >> 63 else p for p in pivots()]
    out = []
    for k in range(0, N_PIVOTS, 8):
        packed = F.lit(0).cast("long")
        for j, p in enumerate(signed[k:k + 8]):
            packed = packed.bitwiseOR(F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("long"), 8 * j))
        out.append(packed.alias(f"d{k // 8}"))
    return out


def bucket_keys(fp: Column, max_bits: int = MAX_BITS, parts: int = PARTS) -> Column:
    """Array of (choice, bits): fingerprints within ``max_bits`` share at least one."""
    edges = [64 * i // parts for i in range(parts + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    keys = []
    for i, chosen in enumerate(combinations(range(parts), parts - max_bits)):
        m = sum(masks[c] for c in chosen)
        m = m - (1 << 64) if m >> 63 else m
        keys.append(F.struct(F.lit(i).alias("choice"), fp.bitwiseAND(F.lit(m)).alias("bits")))
    return F.array(*keys)


def spanning_links(bucket: np.ndarray, fp: np.ndarray, table: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (i, j) within buckets that span the same components as all pairs within ``max_bits``.

    Rows are sorted by bucket and first pivot distance; row i meets rows i+1, i+2, ... while
    these are in its bucket and the first coordinates are close enough. Pairs that are
    already connected are passed over, the others go through the pivot table and are verified.
    """
    order = np.lexsort((table[:, 0], bucket))
    bucket, fp, table = bucket[order], fp[order], table[order].astype(np.int16)
    first, n = table[:, 0], len(fp)
    forest = Forest(n)
    i, step = np.arange(n), 0
    while len(i):
        step += 1
        i = i[i + step < n]
        i = i[(bucket[i + step] == bucket[i]) & (first[i + step] - first[i] <= max_bits)]
        a = i[forest.apart(i, i + step)]
        a = a[np.abs(table[a + step] - table[a]).max(axis=1, initial=0) <= max_bits]
        a = a[np.bitwise_count(fp[a + step] ^ fp[a]) <= max_bits]
        forest.add(a, a + step)
    pairs = order[np.concatenate(forest.links)]
    return pairs[:, 0], pairs[:, 1]


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, parts: int = PARTS, chunk: int = CHUNK) -> DataFrame:
    """(u, v) links of distinct fingerprints ``fps`` (column fp) that span all pairs within ``max_bits``."""
    spark = fps.sparkSession
    rows = fps.select("fp", *pivot_table(F.col("fp")), F.explode(bucket_keys(F.col("fp"), max_bits, parts)).alias("k"))
    rows = rows.select("fp", "d0", "d1", "k.choice", "k.bits")
    sizes = (rows.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
             .withColumn("chunks", F.ceil(F.col("n") / chunk)))
    sizes = materialise(sizes, "simhash-sizes")
    total = sizes.agg(F.sum(F.col("n") * F.col("chunks")).alias("n")).first().n or 0
    rows = rows.join(sizes, ["choice", "bits"])
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), "chunks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    rows = rows.withColumn("bucket", F.xxhash64("choice", "bits", F.least("own", "other"), F.greatest("own", "other")))
    # many buckets share a task; the number of groups follows the number of rows
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // GROUP_ROWS))
    rows = rows.select("fp", "d0", "d1", "bucket", F.pmod("bucket", F.lit(groups)).alias("g"))

    def link(g: pd.DataFrame) -> pd.DataFrame:
        fp = g["fp"].to_numpy(np.int64)
        table = np.ascontiguousarray(g[["d0", "d1"]].to_numpy(np.int64)).view(np.uint8)
        i, j = spanning_links(g["bucket"].to_numpy(np.int64), fp.view(np.uint64), table, max_bits)
        return pd.DataFrame({"u": fp[i], "v": fp[j]})

    return rows.groupBy("g").applyInPandas(link, "u long, v long")


def _groups(rows: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """(fp, root, component_id, first_fp) of every fingerprint of ``rows`` (id, fp).

    first_fp is the least fingerprint of the group's rows with the id component_id.
    """
    distinct = materialise(rows.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-distinct")
    roots = components(near_links(distinct, max_bits)).withColumnRenamed("node", "fp")
    member = materialise(distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash-member")
    first = F.min(F.when(F.col("least").isNotNull(), F.struct("least", "fp")))
    ids = member.groupBy("root").agg(first.alias("first"))
    return materialise(member.join(ids, "root").select(
        "fp", "root", F.col("first.least").alias("component_id"), F.col("first.fp").alias("first_fp")), "simhash-ids")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fp, component_id) for every row of ``docs``; component_id is the smallest id reachable."""
    rows = materialise(fingerprints(docs, id_col, size), "simhash-rows")
    return rows.join(_groups(rows, id_col, max_bits), "fp").select(id_col, "fp", "component_id")


def one_per_group(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest doc_id, all columns unchanged.

    Where ids repeat, a row is told by its id and its fingerprint: rows that share both are in one component,
    and one of them stays. A component whose ids are all null keeps one row.
    """
    rows = materialise(fingerprints(docs, "doc_id", size), "simhash-rows")
    groups = _groups(rows, "doc_id", max_bits)
    first = groups.select(F.col("component_id").alias("doc_id"), F.col("first_fp").alias("fp")).distinct()
    first = materialise(first.filter("doc_id IS NOT NULL"), "simhash-first")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    # one id a component, so it grows with the documents: dealt out at every size, not broadcast at small ones
    if rows.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").isEmpty():
        kept = docs.join(first.hint("merge"), "doc_id", "left_semi")
    else:   # fingerprints of the whole rows: needed, and paid for, where ids repeat only
        named = fingerprints(docs.filter("doc_id IS NOT NULL").select(row, "text"), "row", size)
        named = named.withColumn("doc_id", F.col("row.doc_id")).join(first.hint("merge"), ["doc_id", "fp"], "left_semi")
        kept = named.dropDuplicates(["doc_id", "fp"]).select("row.*")
    unnamed = fingerprints(docs.filter("doc_id IS NULL").select(row, "text"), "row", size)
    unnamed = unnamed.join(groups.filter("component_id IS NULL"), "fp").dropDuplicates(["root"])
    return kept.unionByName(unnamed.select("row.*"))
