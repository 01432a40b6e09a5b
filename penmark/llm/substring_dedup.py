"""Substring dedup: Relative Lempel-Ziv factors against an index of all reference blocks.

Every document is a reference. It is cut into blocks by content: in each window of
``WINDOW`` words the run of ``ANCHOR`` words of least hash is the anchor, and the windows that follow
each other with the same anchor form a block, so equal text has equal anchors and, away
from where it starts to differ, equal blocks. All blocks of all documents are indexed by
(anchor, hash of the block's windows), two 64-bit numbers. A block whose entry has another
occurrence matches whole; greedily joined neighbouring matches are a document's factors.
Where a factor ends, the anchor may still occur elsewhere in other surroundings: there the
windows themselves are compared, one by one. A factor of a window or more is a duplicate
span, and the words it covers are removed. The result is exact up to hash collisions:
a word goes if and only if it is in a window whose words also start anywhere else.

Exchanged are the anchors (about a tenth of the words), then what occurs twice. Texts move
only where a span or an open window was found: the documents' hash buckets (at most
``BUCKETS`` numbers, so broadcast whatever the input) say which these may be. Counts are
combined before each exchange, joins are between written tables and plain scans, so that
adaptive execution can split an anchor, passage or text that a third of all rows share.

Defined results: a null, empty or blank text has no words and the kept text is empty. A
text shorter than a window keeps all words. Repeated rows are occurrences of each other.
An empty table gives an empty table. Other columns pass in ``row``, whatever their names.
Long texts are worked off in pieces of ``PIECE`` window starts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penmark.llm.common import BLANKS, GAP, materialise, n_words

WINDOW = 35
ANCHOR = 8               # words of an anchor
PIECE = 1 << 17          # window starts of a long text that are handled together
BYTES = 1 << 20          # of text that are hashed together
SLICE = 4 << 20          # bytes of text of a part of an Arrow batch
BUCKETS = 1 << 20
SPAN = 32                # a span is packed as first start * SPAN + further starts

BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_BASE = 0x9E3779B97F4A7C15   # odd, so that it has an inverse modulo 2**64


def _mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finish: every bit comes to depend on every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int, known: dict = {}) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(known.get("up", ())) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            known[name] = np.cumprod(p)
    return known["up"], known["down"]


def _run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end] for many runs, from one prefix sum of a polynomial."""
    up, down = _powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return _mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


_BYTE_VALUES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offset and hash of every word of UTF-8 bytes."""
    at, out, lo = [], [], 0
    while lo < len(data):
        hi = min(len(data), lo + BYTES)
        while hi < len(data) and not BLANK[data[hi]]:   # don't cut a word
            stop = np.flatnonzero(BLANK[data[hi:hi + BYTES]])
            hi = hi + int(stop[0]) if len(stop) else min(len(data), hi + BYTES)
        part = data[lo:hi]
        edge = np.diff(np.concatenate(([1], BLANK[part].view(np.int8), [1])))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        at.append(starts + lo)
        out.append(_run_hashes(_BYTE_VALUES[part], starts, ends))
        lo = hi
    return (np.concatenate(at), np.concatenate(out)) if at else (np.empty(0, np.int64), np.empty(0, np.uint64))


def _window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    starts = np.arange(max(0, len(words) - size + 1))
    return _run_hashes(words, starts, starts + size)


def text_words(texts: list[bytes]) -> list[np.ndarray]:
    """The word hashes of each text."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    at, hashes = word_hashes(np.frombuffer(b" ".join(texts), np.uint8))
    return np.split(hashes, np.searchsorted(at, ends[:-1]))


def blocks(words: list[np.ndarray], window: int = WINDOW, anchor: int = ANCHOR):
    """(text, first start, last start, anchor hash, hash of the windows) of every block of the texts."""
    pieces = [(d, lo, w[lo:lo + PIECE + window - 1]) for d, w in enumerate(words)
              for lo in range(0, max(0, len(w) - window + 1), PIECE)]
    out, group, size = [], [], 0
    for k, p in enumerate(pieces):
        group.append(p)
        size += len(p[2])
        if size >= PIECE or k == len(pieces) - 1:
            out.append(_blocks(group, window, anchor))
            group, size = [], 0
    return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)] * 2


def _blocks(group, window: int, anchor: int):
    sizes = np.array([len(p[2]) for p in group])
    words = np.concatenate([p[2] for p in group])
    whole, gram = _window_hashes(words, window), _window_hashes(words, anchor)
    # the least anchor of each window, the leftmost of equals: the low bits hold the position
    bits = np.uint64((len(gram) - 1).bit_length())
    mask = (np.uint64(1) << bits) - np.uint64(1)
    least = (gram & ~mask) | np.arange(len(gram), dtype=np.uint64)
    reach, width = window - anchor + 1, 1
    while width < reach:
        step = min(width, reach - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    at = (least & mask).astype(np.int64)
    piece = np.repeat(np.arange(len(group)), sizes)
    starts = np.flatnonzero(piece[:len(whole)] == piece[window - 1:])   # windows within a piece
    at = at[starts]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.append(first[1:], len(starts)) - 1
    digest = _mix(np.add.reduceat(_mix(whole[starts]), first) + (last - first).astype(np.uint64))
    piece = piece[starts[first]]
    offset = np.array([p[1] for p in group]) - (np.cumsum(sizes) - sizes)
    return (np.array([p[0] for p in group])[piece], starts[first] + offset[piece], starts[last] + offset[piece],
            gram[at[first]], digest)


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """An Arrow batch in parts of about SLICE bytes of text, with the texts (null: empty)."""
    import pyarrow.compute as pc

    col = batch.column(column)
    run = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)) // SLICE
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(run)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            part = batch.slice(a, b - a)
            yield part, [x or b"" for x in part.column(column).cast(pa.binary()).to_pylist()]


def _i64(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64) if h.dtype == np.uint64 else h, pa.int64())


def index_blocks(texts: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(a, c, k1, k2, span) of every block of ``texts`` (k1, k2, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, raw in _parts(b, 2):
                d, lo, hi, a, c = blocks(text_words(raw), window, anchor)
                d = pa.array(d)
                yield pa.RecordBatch.from_arrays(
                    [_i64(a), _i64(c), part.column(0).take(d), part.column(1).take(d), _i64(lo * SPAN + hi - lo)],
                    names=["a", "c", "k1", "k2", "span"])

    return texts.select("k1", "k2", "text").mapInArrow(run, "a long, c long, k1 long, k2 int, span long")


def open_windows(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(k1, k2, span, alone, w) for ``texts`` (k1, k2, text, spans): the window hashes of each span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, raw in _parts(b, 2):
                rows, spans, alone, found = [], [], [], []
                for i, (words, own) in enumerate(zip(text_words(raw), part.column(3).to_pylist())):
                    for s in own:
                        lo, more = divmod(s["span"], SPAN)
                        rows.append(i)
                        spans.append(s["span"])
                        alone.append(s["alone"])
                        found.append(_window_hashes(words[lo:lo + more + window], window))
                flat = np.concatenate(found) if found else np.empty(0, np.uint64)
                offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(spans, pa.int64()),
                     pa.array(alone, pa.bool_()), pa.ListArray.from_arrays(offsets, _i64(flat))],
                    names=["k1", "k2", "span", "alone", "w"])

    return texts.select("k1", "k2", "text", "spans").mapInArrow(
        run, "k1 long, k2 int, span long, alone boolean, w array<long>")


def _maybe(texts: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``texts`` whose key's bucket is (left_semi) or isn't (left_anti) among the keys' buckets."""
    bucket = F.pmod("k1", F.lit(BUCKETS))
    return (texts.withColumn("bucket", bucket)
            .join(F.broadcast(keys.select(bucket.alias("bucket")).distinct()), "bucket", how).drop("bucket"))


def duplicate_spans(texts: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(k1, k2, found, alone, starts) for the texts (k1, k2, text) with blocks that may go.

    ``found`` has the spans whose anchor occurs elsewhere; those also in ``alone`` match no
    other block whole, and of their windows only those at ``starts`` are found elsewhere.
    """
    twice = materialise(index_blocks(texts, window, anchor).groupBy("a").agg(F.count(F.lit(1)).alias("n"))
                        .filter("n > 1").select("a"), "substring-anchors")
    found = materialise(index_blocks(texts, window, anchor).join(twice, "a"), "substring-found")
    entries = materialise(found.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "span")).alias("at")),
                          "substring-entries")
    # anchors in different surroundings: one block for each of these, window by window
    several = materialise(entries.groupBy("a").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("a"),
                          "substring-several")
    asked = materialise(entries.join(several, "a").select("at.*", (F.col("n") == 1).alias("alone")).groupBy("k1", "k2")
                        .agg(F.collect_set(F.struct("span", "alone")).alias("spans")), "substring-asked")
    held = _maybe(texts, asked, "left_semi").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    windows = materialise(open_windows(held.join(asked, ["k1", "k2"]), window), "substring-windows")
    again = materialise(windows.select(F.explode("w").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
                        .filter("n > 1").select("h"), "substring-again")
    starts = (windows.filter("alone").select("k1", "k2", "span", F.posexplode("w").alias("i", "h"))
              .join(again, "h", "left_semi").select("k1", "k2", (F.floor(F.col("span") / SPAN) + F.col("i")).alias("start")))
    none = F.lit(None).cast("long")
    each = (found.select("k1", "k2", F.col("span").alias("found"), none.alias("alone"), none.alias("start"))
            .unionByName(entries.filter("n = 1").select("at.k1", "at.k2", none.alias("found"), F.col("at.span").alias("alone"), none.alias("start")))
            .unionByName(starts.select("k1", "k2", none.alias("found"), none.alias("alone"), "start")))
    spans = each.groupBy("k1", "k2").agg(*[F.collect_set(x).alias(y) for x, y in (
        ("found", "found"), ("alone", "alone"), ("start", "starts"))])
    return materialise(spans.filter((F.size("found") > F.size("alone")) | (F.size("starts") > 0)), "substring-spans")


def factors(found: list[int], alone: list[int], starts: list[int], window: int = WINDOW) -> np.ndarray:
    """Maximal duplicate spans (first word, end) of a text: blocks and windows joined where they touch."""
    whole = np.setdiff1d(np.array(found, np.int64), np.array(alone, np.int64))
    lo = np.concatenate([whole // SPAN, np.array(starts, np.int64)])
    end = np.concatenate([whole // SPAN + whole % SPAN, np.array(starts, np.int64)]) + window
    order = np.argsort(lo)
    lo, end = lo[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate(([True], lo[1:] > end[:-1])))
    return np.stack([lo[first], end[np.append(first[1:], len(lo)) - 1]], axis=1)


def substring_dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Every row of ``docs`` (columns packed in ``row``) with n_words, n_removed, the removed
    ``spans`` (first word, end) and ``kept``, the words that stay joined by one space."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("k1"), F.hash(text).alias("k2"), text.alias("text"))
    marked = duplicate_spans(texts, window, anchor)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.xxhash64(text).alias("k1"), F.hash(text).alias("k2"))
    touched = _maybe(rows, marked, "left_semi").join(marked, ["k1", "k2"], "left").select(
        "row", F.coalesce("row.text", F.lit("")).alias("text"), "found", "alone", "starts")
    schema = T.StructType([touched.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("kept", T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, raw in _parts(b, 1):
                total, removed, spans, kept = [], [], [], []
                for t, *own in zip(raw, *(part.column(i).to_pylist() for i in (2, 3, 4))):
                    words = t.split()
                    gone = factors(*(x or [] for x in own), window) if own[0] else np.empty((0, 2), np.int64)
                    parts, at = [], 0
                    for lo, end in gone.tolist():
                        parts += words[at:lo]
                        at = end
                    parts += words[at:]
                    total.append(len(words))
                    removed.append(len(words) - len(parts))
                    spans.append(gone.tolist())
                    kept.append(b" ".join(parts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["row", "n_words", "n_removed", "spans", "kept"])

    own = F.coalesce("row.text", F.lit(""))
    untouched = _maybe(rows, marked, "left_anti").select(
        "row", n_words(own).alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<array<bigint>>").alias("spans"),
        F.regexp_replace(F.btrim(own, F.lit(BLANKS)), GAP, " ").alias("kept"))
    return touched.mapInArrow(cut, schema).unionByName(untouched)
