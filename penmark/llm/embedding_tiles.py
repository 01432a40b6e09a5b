"""Embedding near-dedup by int8 quantised tile products with rigorous error bounds.

A unit vector x is stored as int8 numbers q and a scale s, with the norm of the error
e = x - s q. For two vectors |x.y - (s q).(t r)| <= |f| + |e| |t r|, so a pair whose
quantised product plus this bound is under the threshold cannot reach it. Only the other
pairs are computed again, in double precision from the given numbers.

Equal vectors are one vector with a count. The distinct vectors are dealt at random to
blocks, and every pair of blocks is a task: all pairs are compared once, no pair is
emitted. A tile gives back, for each vector, the number of its links and links that span
the components of the tile. Work grows with the square of the number of distinct vectors,
as the method's does; the blocks keep memory and rows a task fixed.

Integer products run as float32 matrix products: sums of 127 * 127 stay exact below
2**24, that is up to 1,040 dimensions; longer vectors are multiplied in pieces.

Defined results: null and zero vectors and such with null or non-finite components link
with nothing; neither do vectors of different length. Repeated rows are other vectors to
each other, linked if they may link. The component's id is its smallest non-null id; a
row with a null id is not kept. An empty table gives an empty table. Columns besides the
id and the vector are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.llm.common import materialise
from penmark.llm.components import Forest, components

THRESHOLD = 0.9
BLOCK = 8192          # most vectors of a block
LEAST_BLOCKS = 12     # so that there are tasks enough for few vectors, too
STRIP = 256           # rows of a block that are multiplied at a time
PIECE = 1024          # dimensions of an exact float32 product
RECHECK = 1 << 15     # pairs computed again at a time
SLACK = 1e-5          # above what rounding adds to the scaled float32 products

TILE_ROW = "u long, dim int, copies long, x binary, q binary, scale double, error double, norm double"


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 numbers, scale, error norm and quantised norm of unit vectors (rows, double)."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None])
    back = q * scale[:, None]
    # a little above the true norms, so that rounding here cannot break the bound
    error, norm = np.sqrt(((x - back) ** 2).sum(1)) * (1 + 1e-9), np.sqrt((back ** 2).sum(1)) * (1 + 1e-9)
    return q.astype(np.int8), scale, error, norm


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)   # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def tile_links(x: np.ndarray, q: np.ndarray, scale, error, norm, copies, rows: np.ndarray, cols: np.ndarray,
               threshold: float) -> tuple[np.ndarray, Forest]:
    """Links of all pairs (r in rows, c in cols), r < c where both are the same block.

    Returns how many vectors each is linked to (copies counted) and spanning links.
    """
    count, forest, same = np.zeros(len(x), np.int64), Forest(len(x)), rows is cols
    qf = q.astype(np.float32)
    most_error, most_norm = error[cols].max(initial=0), norm[cols].max(initial=0)
    s_cols = scale[cols].astype(np.float32)
    right = np.ascontiguousarray(qf[cols].T)
    for lo in range(0, len(rows), STRIP):
        r = rows[lo:lo + STRIP]
        start = lo if same else 0
        product = np.zeros((len(r), len(cols) - start), np.float32)
        for k in range(0, q.shape[1], PIECE):
            product += qf[r, k:k + PIECE] @ right[k:k + PIECE, start:]
        product *= s_cols[start:]
        least = (threshold - SLACK - most_error - error[r] * most_norm) / scale[r]
        i, j = np.nonzero(product >= least.astype(np.float32)[:, None])
        estimate = product[i, j] * scale[r[i]]
        a, b = r[i], cols[start + j]
        maybe = estimate + error[b] + error[a] * norm[b] >= threshold - SLACK
        if same:
            maybe &= lo + i < start + j
        a, b = a[maybe], b[maybe]
        for k in range(0, len(a), RECHECK):
            u, v = a[k:k + RECHECK], b[k:k + RECHECK]
            linked = (x[u] * x[v]).sum(axis=1) >= threshold
            u, v = u[linked], v[linked]
            np.add.at(count, u, copies[v])
            np.add.at(count, v, copies[u])
            forest.add(u, v)
    return count, forest


def _valid(vector):
    finite = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def embedding_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    key = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2")]
    distinct = materialise(
        rows.filter(_valid(F.col("vector"))).groupBy("vector").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
        .select(F.monotonically_increasing_id().alias("u"), "vector", *key, "copies", "least"), "embedding-distinct")
    kind = np.float64 if distinct.schema["vector"].dataType.elementType.simpleString() == "double" else np.float32

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {k: [] for k in ("x", "q", "scale", "error", "norm")}
            for v in b.column(1):
                x = v.values.to_numpy(zero_copy_only=False).astype(kind)
                q, s, e, n = quantise(unit(x[None]))
                for k, value in zip(out, (x.tobytes(), q.tobytes(), s[0], e[0], n[0])):
                    out[k].append(value)
            dim = pa.array([len(v) for v in b.column(1)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), dim, b.column(2), pa.array(out["x"], pa.binary()), pa.array(out["q"], pa.binary()),
                 *(pa.array(out[k], pa.float64()) for k in ("scale", "error", "norm"))],
                names=["u", "dim", "copies", "x", "q", "scale", "error", "norm"])

    packed = materialise(distinct.select("u", "vector", "copies").mapInArrow(pack, TILE_ROW), "embedding-int8")
    blocks = max(LEAST_BLOCKS, -(-packed.count() // BLOCK))
    tiles = packed.withColumn("own", F.pmod(F.xxhash64("u"), F.lit(blocks)).cast("int"))
    tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    tiles = tiles.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other")

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        dim = int(g["dim"].iloc[0])
        x = unit(np.frombuffer(b"".join(g["x"]), kind).reshape(-1, dim))
        q = np.frombuffer(b"".join(g["q"]), np.int8).reshape(-1, dim)
        own, i, j = g["own"].to_numpy(), g["i"].iloc[0], g["j"].iloc[0]
        first = np.flatnonzero(own == i)
        second = first if i == j else np.flatnonzero(own == j)
        count, forest = tile_links(x, q, g["scale"].to_numpy(), g["error"].to_numpy(), g["norm"].to_numpy(),
                                   g["copies"].to_numpy(), first, second, threshold)
        u, some = g["u"].to_numpy(), np.flatnonzero(count)
        a, b = np.concatenate(forest.links).T
        return pd.DataFrame({"u": np.concatenate([u[some], u[a]]),
                             "v": pd.array([*[None] * len(some), *u[b].tolist()], "Int64"),
                             "n": np.concatenate([count[some], np.zeros(len(a), np.int64)])})

    found = materialise(tiles.groupBy("dim", "i", "j").applyInPandas(compare, "u long, v long, n long"), "embedding-found")
    counts = found.groupBy("u").agg(F.sum("n").alias("n"))
    roots = components(found.select("u", "v").filter("v IS NOT NULL")).withColumnRenamed("node", "u")
    member = materialise(distinct.select("u", "h1", "h2", "copies", "least").join(counts, "u", "left").join(roots, "u", "left")
                         .withColumn("root", F.coalesce("root", "u")), "embedding-member")
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    known = materialise(member.join(ids, "root").select(
        "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "embedding-ids")
    keyed = rows.select("id", F.when(_valid(F.col("vector")), key[0]).alias("h1"),
                        F.when(_valid(F.col("vector")), key[1]).alias("h2"), F.col("vector"))
    out = keyed.drop("vector").join(known, ["h1", "h2"], "left")
    comp = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      comp.alias("component_id"), F.coalesce(F.col("id") == comp, F.lit(False)).alias("kept"))
