"""Mixing sources to target weights by packed blocks.

Each source's documents, in a fixed order, form one stream of words that is packed into
blocks of ``block`` words (the last may be shorter). The mix is a row of slots; a slot
holds one block. Every source has as many slots as meet its target to half a block, and
each slot falls into one of the output shards at random: so the sources' counts of a shard
are multinomial draws, conditioned on the sources' totals. A source's slots are then
numbered through its shards, and its j-th slot takes the block pi(j mod blocks) of the source, pi a
pseudorandom permutation of the source's block numbers for each pass (swap-or-not, Hoang,
Morris and Rogaway 2012: a bijection of any range, computed for each index alone). Slots and
blocks join by (source, block); within a shard, slots come in a pseudorandom order.

DataFrame functions only. No step keeps a source together: offsets come from bucketed
prefix sums (``BUCKETS`` per source, then within a bucket), slots are generated in chunks,
and the join's key has the block number. Only the number of sources is assumed moderate
(one row each is sorted in one task to rank them).

Defined results: a null, empty or blank text has size 0, is never taken and takes no
slot. A null source is a source of its own, ranked last. A source of size 0 has target 0.
Repeated rows are rows of their own. An empty table gives an empty table. Targets never
exceed ``max_passes`` times the source's size, so no block is taken more often.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penmark.llm.common import fixed, materialise, n_words, words

WEIGHTS = (5, 2, 1)   # by code point order of the sources, repeating
SHARE = 1.5           # size of the mix against all sizes
MAX_PASSES = 2
BLOCK = 64            # words
SHARD_SLOTS = 4096    # slots of an output shard
ROUNDS = 16           # of the permutations
BUCKETS = 1024        # of a source's documents, for offsets
CHUNK = 1 << 14       # slots generated from one row


def permute(i: Column, n: Column, *key: Column) -> Column:
    """The image of ``i`` under a keyed pseudorandom permutation of 0 .. n-1 (swap-or-not)."""
    def one_round(x, r):
        y = F.pmod(F.xxhash64(*key, r, F.lit(0)) - x, n)
        return F.when(F.xxhash64(*key, r, F.greatest(x, y)).bitwiseAND(F.lit(1)) == 1, y).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), i.cast("long"), one_round)


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, max_passes: int = MAX_PASSES,
                   block: int = BLOCK) -> DataFrame:
    """One row per source: sid, source, source_size, target, blocks, slots, first_slot.

    Targets are shares of ``share`` x all sizes by weight, held at ``max_passes`` x the
    source's size; what is above goes to the others by weight. With sources in order of
    cap / weight, a source is held if its cap is under its share of what those before it left.
    """
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    src = src.select("source", "source_size", rank.alias("sid"))
    src = src.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), F.pmod("sid", F.lit(len(weights))) + 1))
    src = src.withColumn("cap", F.col("source_size") * float(max_passes))
    whole = Window.partitionBy()
    before = (Window.orderBy(F.col("cap") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1))
    src = src.select("*", (F.sum("source_size").over(whole) * share).alias("total"),
                     F.sum("weight").over(whole).alias("all_weight"),
                     F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cap_before"),
                     F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weight_before"))
    src = src.withColumn("held", F.col("cap") * (F.col("all_weight") - F.col("weight_before"))
                         <= (F.col("total") - F.col("cap_before")) * F.col("weight"))
    free_total = F.col("total") - F.coalesce(F.sum(F.when(F.col("held"), F.col("cap"))).over(whole), F.lit(0.0))
    free_weight = F.sum(F.when(~F.col("held"), F.col("weight"))).over(whole)
    src = src.withColumn("target", F.when(F.col("held"), F.col("cap")).otherwise(
        F.col("weight") * free_total / free_weight))
    src = src.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    src = src.withColumn("slots", F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.least(
        F.round(F.col("target") * F.col("blocks") / F.col("source_size")),
        F.col("blocks") * max_passes)).cast("long"))
    first = F.coalesce(F.sum("slots").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return src.select("sid", "source", "source_size", "target", "blocks", "slots", first.alias("first_slot"),
                      F.sum("slots").over(whole).alias("all_slots"))


def shard_counts(sources: DataFrame, seed: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(sid, blocks, shard, n): how many slots of each shard the draw gives to a source; shards have about ``shard_slots``."""
    chunks = sources.select("sid", "slots", "blocks", "all_slots", F.explode(
        F.when(F.col("slots") > 0, F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(CHUNK).cast("long")))).alias("lo"))
    # a stated number of tasks by key: one source may have most of the chunks
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(tasks, "sid", "lo")
    j = F.explode(F.sequence(F.col("lo"), F.least(F.col("lo") + CHUNK, F.col("slots")) - 1)).alias("j")
    shards = F.greatest(F.lit(1), F.ceil(F.col("all_slots") / shard_slots)).cast("long")
    drawn = chunks.select("sid", "blocks", shards.alias("shards"), j).select(
        "sid", "blocks", F.pmod(F.xxhash64(F.lit(seed), F.lit(-1), "sid", "j"), "shards").alias("shard"))
    return drawn.groupBy("sid", "blocks", "shard").agg(F.count(F.lit(1)).alias("n"))


def mix_slots(sources: DataFrame, seed: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(shard, turn, sid, block): the block that every slot of the mix holds; a shard's slots come in the order of ``turn``."""
    draws = materialise(shard_counts(sources, seed, shard_slots), "mix-draws")
    # a source's slots are numbered through its shards: the sums of groups of shards, then within a group
    draws = draws.withColumn("group", F.floor(F.col("shard") / BUCKETS))
    groups = draws.groupBy("sid", "group").agg(F.sum("n").alias("in_group"))
    groups = groups.select("sid", "group", F.coalesce(F.sum("in_group").over(
        Window.partitionBy("sid").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.coalesce(F.sum("n").over(Window.partitionBy("sid", "group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = draws.withColumn("own", own).join(groups, ["sid", "group"]).withColumn("first", F.col("before") + F.col("own"))
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # few rows that become many: dealt out by source and shard
    numbered = numbered.select("sid", "blocks", "shard", "first", "n").repartition(tasks, "sid", "shard")
    slots = numbered.select("sid", "blocks", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("j"))
    nth = F.floor(F.col("j") / F.col("blocks"))
    block = permute(F.pmod("j", "blocks"), F.col("blocks"), F.lit(seed), F.col("sid"), nth)
    return slots.select("shard", F.xxhash64(F.lit(seed), F.lit(-2), "sid", "j").alias("turn"), "sid", block.alias("block"))


def _picks(sources: DataFrame, seed: int) -> DataFrame:
    """``mix_slots``, made from few rows but as many as the mix has slots, which Spark's estimate doesn't know:
    the hint keeps it from being broadcast."""
    return mix_slots(sources, seed).hint("merge")


def _sid(df: DataFrame, sources: DataFrame) -> DataFrame:
    """Attach the source's row (null is a source, too)."""
    keys = [F.coalesce("source", F.lit("")).alias("__s"), F.col("source").isNull().alias("__null")]
    right = sources.select(*keys, "sid", "source_size", "target")
    return df.select("*", *keys).join(right, ["__s", "__null"]).drop("__s", "__null")


def doc_pieces(sized: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document and block it has words in: what ``sized`` has, sid, block, lo, hi.

    Words lo .. hi-1 of the document are in the block. ``sized`` must have a column
    ``key`` that fixes the documents' order within a source.
    """
    df = _sid(sized, sources).withColumn("bucket", F.pmod(F.col("key"), F.lit(BUCKETS)))
    sums = df.groupBy("sid", "bucket").agg(F.sum("size").alias("in_bucket"))
    sums = sums.select("sid", "bucket", F.coalesce(F.sum("in_bucket").over(
        Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    own = F.coalesce(F.sum("size").over(Window.partitionBy("sid", "bucket").orderBy("key", "doc_id", "size", "row_id")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    df = df.filter(F.col("size") > 0).select("*", own.alias("own")).join(sums, ["sid", "bucket"])
    df = df.withColumn("start", F.col("first") + F.col("own")).drop("first", "own", "bucket", "key")
    df = df.select("*", F.explode(F.sequence(F.floor(F.col("start") / block),
                                             F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    return df.select("*", F.greatest(F.lit(0), F.col("block") * block - F.col("start")).alias("lo"),
                     F.least(F.col("size"), (F.col("block") + 1) * block - F.col("start")).alias("hi"))


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select("row_id", "doc_id", "source", n_words(F.col("text")).alias("size"),
                       F.xxhash64("doc_id", "text").alias("key"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_passes: int = MAX_PASSES,
                block: int = BLOCK, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken (words of the mix that are the document's) and first_shard.

    first_shard is the first output shard with some of the document's words, null if nothing is taken.
    """
    sized = materialise(_sized(docs.withColumn("row_id", F.monotonically_increasing_id())), "mix-sizes")
    sources = materialise(source_targets(sized, weights, share, max_passes, block), "mix-sources")
    picks = _picks(sources, seed)
    pieces = doc_pieces(sized, sources, block)
    taken = (pieces.join(picks, ["sid", "block"], "left")
             .groupBy("row_id", "doc_id", "size", "source_size", "target")
             .agg(F.sum(F.when(F.col("shard").isNotNull(), F.col("hi") - F.col("lo")).otherwise(0)).cast("long").alias("taken"),
                  F.min("shard").alias("first_shard")))
    none = _sid(sized.filter(F.col("size") == 0), sources).withColumn("taken", F.lit(0).cast("long")).withColumn(
        "first_shard", F.lit(None).cast("long"))
    cols = ["doc_id", "size", "source_size", "target", "taken", "first_shard"]
    return taken.select(*cols).unionByName(none.select(*cols))


def mixed_blocks(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_passes: int = MAX_PASSES,
                 block: int = BLOCK, seed: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix itself: (shard, slot, source, text), a row for each slot, its block's words joined by one space.

    Slots of a shard are numbered from 0 in the order of their turns (a shard holds about ``shard_slots`` rows).
    """
    docs = materialise(docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "source", "text"), "mix-texts")
    sized = materialise(_sized(docs), "mix-sizes")
    sources = materialise(source_targets(sized, weights, share, max_passes, block), "mix-sources")
    pieces = doc_pieces(sized, sources, block).select("row_id", "sid", "block", "lo", "hi", "start")
    held = docs.select("row_id", words(F.col("text")).alias("w")).join(pieces, "row_id")
    held = held.select("sid", "block", F.struct(
        "start", F.slice("w", (F.col("lo") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int")).alias("w")).alias("piece"))
    packed = held.groupBy("sid", "block").agg(F.flatten(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p.w)).alias("w"))
    slots = mix_slots(sources, seed, shard_slots).hint("merge").join(packed, ["sid", "block"]).join(sources.select("sid", "source"), "sid")
    place = F.row_number().over(Window.partitionBy("shard").orderBy("turn", "sid", "block")) - 1
    return slots.select("shard", place.alias("slot"), "source", F.array_join("w", " ").alias("text"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_passes: int = MAX_PASSES,
                    block: int = BLOCK, seed: int = 0) -> DataFrame:
    """The mix as rows of ``docs`` (same columns): a row for each pass that takes words of a document.

    The r-th row of a document has the words of its blocks that are taken at least r
    times, in the document's order, with the white space that follows each word; a
    document whose blocks are all taken keeps its text as it is. n_chars follows the text.
    """
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("row_id"), F.struct(
        *[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "mix-documents")
    flat = rows.select("row_id", "row.doc_id", "row.source", "row.text")
    sized = materialise(_sized(flat), "mix-sizes")
    sources = materialise(source_targets(sized, weights, share, max_passes, block), "mix-sources")
    picks = _picks(sources, seed)
    times = doc_pieces(sized, sources, block).join(picks, ["sid", "block"]).groupBy("row_id", "size", "lo", "hi").agg(
        F.count(F.lit(1)).alias("k"))
    spans = times.groupBy("row_id", "size").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "k"))).alias("spans"))
    out = rows.join(spans.hint("merge"), "row_id").withColumn("pass", F.explode(F.sequence(
        F.lit(1).cast("long"), F.array_max(F.transform("spans", lambda s: s.k)))))
    out = out.withColumn("own", F.filter("spans", lambda s: s.k >= F.col("pass")))
    out = fixed(out, words=F.regexp_extract_all("row.text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0)))
    whole = F.aggregate("own", F.lit(0).cast("long"), lambda a, s: a + s.hi - s.lo) == F.col("size")
    part = F.array_join(F.transform("own", lambda s: F.array_join(
        F.slice("words", (s.lo + 1).cast("int"), (s.hi - s.lo).cast("int")), "")), "")
    cols = {c: F.col(f"row.`{c}`") for c in docs.columns}
    cols["text"] = F.when(whole, F.col("row.text")).otherwise(part)
    if "n_chars" in cols:
        cols["n_chars"] = F.length(cols["text"]).cast("long")
    return out.select(*[c.alias(n) for n, c in cols.items()])
