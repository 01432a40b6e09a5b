"""Quality rules as a short-circuit cascade.

Every rule is a boolean column that is true where a text is to be rejected. The
cost of a rule (seconds) and its selectivity (share of rows it rejects) are measured
on a bounded sample; the rules are then ordered by rejection per cost and evaluated
as one CASE, so that a text rejected by a cheap, selective rule never meets the
dearer ones. The order changes the cost only: the verdict is the same in any order.

Everything is a DataFrame expression on one row per text: no shuffle, no Python.

Defined results: a null, empty or blank text has no words, all its counts are 0 and
it fails the base check (fewer than ``min_words`` words). Repeated rows each get their
own result. An empty table gives an empty table. Input columns besides ``doc_id`` and
``text`` are ignored by :func:`quality_stats`, so clashing names do no harm. A text of
any length is handled whole: the window check sorts the text's own window hashes.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penmark.llm.common import GAP, WORD, fixed, materialise, words

WINDOW = 8            # words in a window of the repetition count
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
SAMPLE_ROWS = 2000    # bound of the sample that costs and selectivities are taken from
RUNS = 2              # jobs that time a rule

# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``reject`` is true for a text to be dropped; it may use text, __w and the count columns."""
    name: str
    reject: Column


def default_rules() -> list[Rule]:
    text, w, n = F.col("text"), F.col("__w"), F.col("n_words")
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    upper = F.length(F.regexp_replace(text, r"\P{Lu}+", ""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return [
        Rule("symbols", F.col("n_symbols") * 10 > n),
        Rule("duplicate_lines", F.col("n_dup_lines") * 2 > F.size(lines)),
        Rule("word_length", (F.col("word_chars") > n * 12) | (F.col("word_chars") * 2 < n * 5)),
        Rule("few_alphabetic_words", F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))) * 10 < n * 6),
        Rule("few_letters", letters * 100 < F.col("word_chars") * 35),
        Rule("shouting", upper * 2 > letters),
        Rule("ellipsis_lines", F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))) * 10 > F.size(lines) * 3),
        Rule("bullet_lines", F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[•‣*\-]\s"))) * 10 > F.size(lines) * 9),
    ]


def quality_stats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text, __w (words) and the base counts of every text.

    ``n_repeat_words`` counts the words covered by ``window``-word windows that occur
    at least twice in the text (the first occurrence included). Windows are compared by a
    64-bit hash within one text; only texts whose hashes are not all distinct are sorted.
    """
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    df = df.select("doc_id", "text", words(F.col("text")).alias("__w"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))
    df = df.select(
        "*", F.size("__w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", GAP, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        # windows' hashes, in order
        F.when(F.size("__w") >= window,
               F.transform(F.sequence(F.lit(1), F.size("__w") - (window - 1)),
                           lambda i: F.xxhash64(F.slice("__w", i, window)))).alias("__h"),
        lines.alias("__lines"))
    df = df.withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
    # hashes with their positions, sorted, where some hash repeats
    df = df.withColumn("__p", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.array_sort(
        F.transform("__h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    df = df.withColumn("__same", F.zip_with(
        "__p", F.slice("__p", F.lit(2), F.size("__p")), lambda a, b: F.coalesce(a.x == b.x, F.lit(False))))
    df = df.withColumn("__hit", F.zip_with(
        "__same", F.concat(F.array(F.lit(False)), F.slice("__same", F.lit(1), F.size("__same") - 1)),
        lambda a, b: a | b))
    df = df.withColumn("__starts", F.sort_array(F.transform(
        F.filter(F.arrays_zip(F.col("__p").alias("p"), F.col("__hit").alias("hit")), lambda z: z.hit),
        lambda z: z.p.i)))
    covered = F.aggregate(
        "__starts", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct((s + window).alias("end"), (a.n + s + window - F.greatest(a.end, s)).alias("n")))
    return df.withColumn("n_repeat_words", F.coalesce(covered.n, F.lit(0)).cast("long")).drop(
        "__h", "__lines", "__p", "__same", "__hit", "__starts")


def base_failed(min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT) -> Column:
    return ((F.col("n_words") < min_words)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_pct))


def order_rules(stats: DataFrame, rules: list[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) by rejection per cost, the best first; ties by cost, then name.

    ``stats`` is the sample (bounded by the caller). A rule's cost is the least time of ``RUNS`` jobs that evaluate it
    for each row, less that of the same job without a rule, which reads the same columns. The share is
    smoothed by half a row, so that rules that reject none of the sample are ordered by their cost.
    """
    n = stats.count()
    reads = F.length("text") + F.size("__w") + F.col("n_words") + F.col("word_chars") + F.col("n_symbols") + F.col("n_dup_lines")

    def run(reject: Column) -> tuple[float, int]:
        t0 = time.perf_counter()
        hit = stats.agg(F.count_if((reads >= 0) & F.coalesce(reject, F.lit(True))).alias("k")).first().k
        return time.perf_counter() - t0, hit

    run(rules[0].reject)   # warm up, so that the first job isn't charged for it
    empty = min(run(F.lit(False))[0] for _ in range(RUNS))
    measured = []
    for r in rules:
        times, hits = zip(*[run(r.reject) for _ in range(RUNS)])
        measured.append((r, max(min(times) - empty, 1e-4), (hits[0] + 0.5) / (n + 1)))
    return sorted(measured, key=lambda m: (-m[2] / m[1], m[1], m[0].name))


def sample_rows(docs: DataFrame, rows: int, seed: int = 8) -> DataFrame:
    """A Bernoulli sample of about ``rows`` rows, at most ``rows``."""
    total = docs.count()
    part = docs.select("doc_id", "text")
    return (part if total <= rows else part.sample(False, min(1.0, rows / total), seed)).limit(rows)


def cascade(rules: list[Rule]) -> Column:
    """False as soon as a rule rejects (or cannot decide), in the order given."""
    out = F.when(F.lit(False), F.lit(False))
    for r in rules:
        out = out.when(F.coalesce(r.reject, F.lit(True)), F.lit(False))
    return out.otherwise(F.lit(True))


def quality_cascade(docs: DataFrame, rules: list[Rule] | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the base counts, base_failed and kept for every row of ``docs``."""
    rules = rules or default_rules()
    sample = materialise(quality_stats(sample_rows(docs, rows)).drop("doc_id"), "quality-sample")
    ordered = [m[0] for m in order_rules(sample.filter(~base_failed()), rules)]
    stats = quality_stats(docs).withColumn("base_failed", base_failed())
    return stats.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(ordered))).drop(
        "text", "__w")


def keep_quality(docs: DataFrame, rules: list[Rule] | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that the base check and every rule let through, all columns unchanged."""
    rules = rules or default_rules()
    sample = materialise(quality_stats(sample_rows(docs, rows)).drop("doc_id"), "quality-sample")
    ordered = [m[0] for m in order_rules(sample.filter(~base_failed()), rules)]
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), "text")
    # the verdict is fixed before the filter: pushed below the counts, it would compute them for each element
    judged = fixed(quality_stats(carried), __ok=F.when(base_failed(), F.lit(False)).otherwise(cascade(ordered)))
    return judged.filter("__ok").select("doc_id.*")
