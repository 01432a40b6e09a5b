"""Spelling variants: words one edit apart, grouped by permuterm rotations.

A word is marked with a terminator and rotated in every way. Where the last character of a
rotation is skipped, what is left names the word but for one character; so the words that
differ from it there (a replacement), or lack the character (a deletion, seen from the shorter
word an insertion), share that prefix. The rotations, whole and without their last character,
are dealt out by that prefix and sorted; a scan over runs of equal prefixes emits the neighbours.

A run holds one whole rotation at most and one skipped rotation for each character of the
alphabet, since its prefix fixes all the other characters and their places: its size doesn't
grow with the data. Skipping any character of a run of equal ones gives the same shorter word;
only the first of the run is matched with whole rotations, so each pair of neighbours is found once.

Counts are added up within each task before they are exchanged (``HELD`` words at a time).
Very long texts are read in slices cut between runs of letters. Roots are found by pointer
jumping: as a form is ``ratio`` times as frequent as its word, a chain of forms is as long as
the logarithm of the counts, and the rounds are the logarithm of that.

Defined results: null and empty texts have no words; null ids are hashed as the empty text;
repeated rows count again. An empty table gives an empty table. Columns other than the id and
the text are not looked at. Ties for the form go to the smallest word in code-point order.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.llm.common import materialise

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
THINNED = 199          # of as many (document, run) pairs one loses a character
TERMINATOR = "\x00"    # no word holds it
HELD = 200_000
SLICE = 1 << 20

NOT_LETTER = re.compile("[^A-Za-zÀ-ÿ]")


def letter_runs(text: bytes, least: int) -> Iterator[Counter]:
    """How often the runs of ``least`` letters or more occur in each slice of a UTF-8 text, A-Z lower-cased."""
    text = text.lower().decode()   # bytes: A-Z only
    run = re.compile(f"[a-zÀ-ÿ]{{{least},}}")
    lo = 0
    while lo < len(text):
        m = NOT_LETTER.search(text, lo + SLICE)
        hi = m.start() if m else len(text)
        yield Counter(run.findall(text, lo, hi))
        lo = hi


def word_counts(docs: DataFrame, id_col: str = "doc_id", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                thinned: int = THINNED) -> DataFrame:
    """(word, n) of all texts. A run whose crc32 of "<id>:<run>" ``thinned`` divides loses the code point crc32 % length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for b in batches:
            for key, text in zip(*b.columns):
                if not text.is_valid:
                    continue
                start = crc32(key.as_buffer().to_pybytes() + b":")
                for runs in letter_runs(text.as_buffer().to_pybytes(), least_length):
                    for w, n in runs.items():
                        h = crc32(w.encode(), start)
                        if h % thinned == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1:]
                            if len(w) < least_length:
                                continue
                        held[w] = held.get(w, 0) + n
                    if len(held) > HELD:
                        yield out()
                        held.clear()
        yield out()

    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    found = docs.select(key.alias("key"), F.col("text").cast("string")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, skipped, first, word, n): each rotation of a marked word, whole (skipped is null) and without its last character.

    ``first``: the skipped character is not preceded by an equal one in the word.
    """
    every = F.explode(F.sequence(F.lit(0), F.length("word"))).alias("k")
    rows = words.select("word", "n", every).withColumn(
        "rotation", F.concat(F.expr("substring(word, k + 1)"), F.lit(TERMINATOR), F.expr("substring(word, 1, k)")))
    whole = F.struct(F.col("rotation").alias("prefix"), F.lit(None).cast("string").alias("skipped"), F.lit(True).alias("first"))
    last, before = F.expr("substring(word, k, 1)"), F.expr("substring(word, k - 1, 1)")
    skip = F.struct(F.expr("substring(rotation, 1, length(rotation) - 1)").alias("prefix"), last.alias("skipped"),
                    ((F.col("k") == 1) | (last != before)).alias("first"))
    both = F.when(F.col("k") > 0, F.array(whole, skip)).otherwise(F.array(whole))   # the terminator is never skipped
    return rows.select("word", "n", F.inline(both)).select("prefix", "skipped", "first", "word", "n")


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours (word, n, near, near_n) from rotations sorted by prefix, whole ones first; both directions."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = pa.concat_tables([rest, t]).combine_chunks() if rest is not None else t
        cut = run_starts(t)[-1] if len(t) else 0
        rest = t.slice(cut)   # the last run may go on in the next batch
        yield from pairs(t.slice(0, cut))
    if rest is not None:
        yield from pairs(rest)


def run_starts(t: pa.Table) -> np.ndarray:
    prefix = t["prefix"]
    new = pc.not_equal(prefix.slice(1), prefix.slice(0, len(t) - 1)).to_numpy()
    return np.flatnonzero(np.concatenate(([True], new)))


def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """The pairs within each run of ``t``, row i with row i + 1, then with row i + 2, and so on to the longest run's length."""
    if not len(t):
        return
    sizes = np.diff(np.append(run_starts(t), len(t)))
    ends = np.repeat(np.cumsum(sizes), sizes)
    whole, first = t["skipped"].is_null().to_numpy(), t["first"].to_numpy()
    i, step = np.flatnonzero(ends - np.arange(len(t)) > 1), 1
    while len(i):
        near = i[~whole[i] | first[i + step]]
        if len(near):
            a, b = (t.select(["word", "n"]).take(np.concatenate(x)) for x in ((near, near + step), (near + step, near)))
            yield from pa.table({"word": a["word"], "n": a["n"], "near": b["word"], "near_n": b["n"]}).combine_chunks().to_batches()
        step += 1
        i = i[i + step < ends[i]]


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): each two of ``words`` (word, n; distinct) that differ by one inserted, deleted or replaced code point."""
    rows = rotations(words)
    groups = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(groups, "prefix").sortWithinPartitions("prefix", F.col("skipped").asc_nulls_first())
    return dealt.mapInArrow(scan, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the rows (word, form): forms followed to the last, by pointer jumping."""
    hop = materialise(forms.select("word", F.col("form").alias("root")), "variant-hops")
    while True:
        on = hop.select(F.col("word").alias("root"), F.col("root").alias("next"))
        far = materialise(hop.join(on, "root", "left"), "variant-hops")
        hop = far.select("word", F.coalesce("next", "root").alias("root"))
        if far.filter("next IS NOT NULL").isEmpty():
            return hop


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for ``words`` (word, n; distinct).

    form is the most frequent neighbour if it is ``ratio`` times as frequent as the word, else null.
    """
    words = materialise(words, "variant-words")
    best = neighbours(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("best"))
    rows = words.join(best, "word", "left").withColumn("fits", -F.col("best.m") >= ratio * F.col("n"))
    rows = materialise(rows.select(
        "word", F.when(F.col("fits"), F.col("best.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("fits"), -F.col("best.m")).alias("form_n")), "variant-forms")
    last = roots(rows.filter("form IS NOT NULL"))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                      ratio: int = RATIO, thinned: int = THINNED) -> DataFrame:
    """``group_variants`` of the words of all texts of ``docs``."""
    return group_variants(word_counts(docs, id_col, least_length, least_count, thinned), ratio)
