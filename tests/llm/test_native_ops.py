"""Quality cascade, line dedup and source mixing: rules, edge cases, brute force."""

import brute
import pytest
from pyspark.sql import functions as F

from penmark.llm.line_dedup import drop_frequent_lines, line_dedup
from penmark.llm.quality_cascade import default_rules, keep_quality, order_rules, quality_cascade, quality_stats
from penmark.llm.source_mixing import mix_slots, mix_sources, mixed_blocks, mixed_documents, permute, shard_counts, source_targets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"word{i} stands here" for i in range(20))


def docs(spark, texts, source="a"):
    return spark.createDataFrame([(i, t, "en", source, None if t is None else len(t)) for i, t in enumerate(texts)], DOCS)


def test_quality_edges(spark):
    rep = " ".join(["one two three four five six seven eight"] * 4)
    texts = [None, "", " \n\t", PROSE, PROSE, rep, "x# " * 30 + PROSE, "a\nb\na\na\n\n\n" + PROSE, "É" * 3]
    got = {r.doc_id: r for r in quality_cascade(docs(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i in (0, 1, 2):
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == (0,) * 5
        assert got[i].base_failed and not got[i].kept
    assert got[3].kept and got[4].kept
    assert got[5].n_words == 32 and got[5].n_repeat_words == 32 and got[5].base_failed
    assert got[6].n_symbols == 30 and not got[6].kept and got[6].n_repeat_words > 0
    assert got[7].n_dup_lines == 2
    assert got[8].word_chars == 3


def test_quality_overlapping_windows_count_words_once(spark):
    t = " ".join(["a"] * 12)   # five equal windows that overlap
    assert quality_stats(docs(spark, [t])).first().n_repeat_words == 12


def test_quality_empty_table_and_other_columns(spark):
    empty = docs(spark, []).withColumn("n_words", F.lit(1)).withColumn("__w", F.lit(2))
    assert quality_cascade(empty).count() == 0
    some = docs(spark, [PROSE, "short"]).withColumn("n_words", F.lit("mine")).withColumn("kept", F.lit(7))
    out = keep_quality(some)
    assert out.columns == some.columns
    assert [(r.doc_id, r.n_words, r.kept) for r in out.collect()] == [(0, "mine", 7)]


def test_cascade_orders_by_rejection_per_cost(spark):
    stats = quality_stats(docs(spark, ["# " * 40, "# " * 40, PROSE]))
    ordered = order_rules(stats, default_rules())
    rates = [share / cost for _, cost, share in ordered]
    assert rates == sorted(rates, reverse=True) and len(ordered) == len(default_rules())


LINES = [None, "", "Head\nbody one\n  HEAD\t", "head", "head\n\nhead", "x\n head ", "tail\nÉtoile", "étoile"]


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2), (4, 3)])
def test_line_dedup_matches_brute_force(spark, batches, fanout):
    got = line_dedup(docs(spark, LINES), min_docs=3, batches=batches, fanout=fanout)
    got = sorted((r.row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got.collect())
    assert got == brute.line_dedup(list(enumerate(LINES)), 3)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_line_dedup_edges(spark):
    assert line_dedup(docs(spark, [])).count() == 0
    some = docs(spark, ["same\nown %d" % i for i in range(4)] + ["same\nown 0"]).withColumn("pos", F.lit(5)).withColumn("h1", F.lit("mine"))
    out = drop_frequent_lines(some, min_docs=5)
    assert out.columns == some.columns
    assert sorted(r.text for r in out.collect()) == ["own 0", "own 0", "own 1", "own 2", "own 3"]
    assert {(r.n_chars, r.pos, r.h1) for r in out.collect()} == {(5, 5, "mine")}
    # a row counts once however often it has the line; two equal rows count twice
    assert {r.n_dropped for r in line_dedup(docs(spark, ["x\nx\nx", "x"]), min_docs=3).collect()} == {0}
    assert {r.n_dropped for r in line_dedup(docs(spark, ["x\nx\nx", "x", "x"]), min_docs=3).collect()} == {3, 1}


def test_line_dedup_long_text(spark):
    text = "\n".join(["often"] * 2 + [f"line {i}" for i in range(20_000)])
    rows = line_dedup(docs(spark, [text, "often", "often"]), min_docs=3).collect()
    long = next(r for r in rows if r.row.doc_id == 0)
    assert (long.n_lines, long.n_dropped) == (20_002, 2) and long.kept.startswith("line 0\nline 1\n")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257])
def test_permutation_is_a_bijection(spark, n):
    df = spark.range(n).select("id", permute(F.col("id"), F.lit(n), F.lit(5), F.lit(1)).alias("p"))
    rows = df.collect()
    assert sorted(r.p for r in rows) == list(range(n))
    assert n < 10 or [r.p for r in rows] != list(range(n))


SIZES = {"b": [300, 5, 0, 90], "a": [40, 41], None: [700, 80, 64], "c": [2000], "aa": [0], "d": [1]}


def mix_docs(spark):
    rows = [(10 * i + j, " ".join(f"{s}{k}" for k in range(n)), "en", s, 0) for i, (s, v) in enumerate(SIZES.items()) for j, n in enumerate(v)]
    return spark.createDataFrame(rows, DOCS)


def test_targets_follow_resharing(spark):
    got = {r.source: r.target for r in source_targets(
        mix_docs(spark).select("source", F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", " "))).cast("long").alias("size"))).collect()}
    want = brute.targets({s: sum(v) for s, v in SIZES.items()})
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mixing_meets_targets_and_bounds(spark):
    block = 8
    out = mix_sources(mix_docs(spark), block=block).collect()
    assert len(out) == sum(map(len, SIZES.values()))
    want = brute.targets({s: sum(v) for s, v in SIZES.items()})
    names = list(SIZES)
    taken = dict.fromkeys(names, 0)
    for r in out:
        s = names[r.doc_id // 10]
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size == sum(SIZES[s])
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1.5 * block for s in names)
    again = mix_sources(mix_docs(spark).repartition(3), block=block).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_slots_take_blocks_pass_by_pass(spark):
    sized = spark.createDataFrame([("a", 640), ("b", 64)], "source string, size long")
    sources = source_targets(sized, block=8)
    slots = mix_slots(sources, shard_slots=16).collect()
    draws = {(r.sid, r.shard): r.n for r in shard_counts(sources, shard_slots=16).collect()}
    assert len(slots) == sources.first().all_slots and len({(r.shard, r.turn) for r in slots}) == len(slots)
    assert draws == {k: sum((r.sid, r.shard) == k for r in slots) for k in draws} and sum(draws.values()) == len(slots)
    for r in sources.collect():
        counts = [sum(x.sid == r.sid and x.block == b for x in slots) for b in range(r.blocks)]
        assert sum(counts) == r.slots and max(counts) - min(counts) <= 1


def test_shards_draw_their_sources_at_random(spark):
    sized = spark.createDataFrame([("a", 2_000_000), ("b", 1_000_000), ("c", 3_000_000)], "source string, size long")
    sources = source_targets(sized, block=10)
    shares = {r.sid: r.slots / r.all_slots for r in sources.collect()}
    draws = {}
    for r in shard_counts(sources, shard_slots=4096).collect():
        draws.setdefault(r.shard, {})[r.sid] = r.n
    chi = sum((d.get(s, 0) - sum(d.values()) * p) ** 2 / (sum(d.values()) * p) for d in draws.values() for s, p in shares.items())
    free = (len(draws) - 1) * (len(shares) - 1)   # the totals are given
    assert len(draws) > 100 and abs(chi - free) < 4 * (2 * free) ** 0.5
    sizes = [sum(d.values()) for d in draws.values()]
    assert all(abs(n - sum(sizes) / len(sizes)) < 6 * 4096 ** 0.5 for n in sizes)


def test_taken_against_a_plain_mixer(spark):
    block, docs = 8, mix_docs(spark)
    rows = docs.select("doc_id", "source", "text", F.xxhash64("doc_id", "text").alias("key")).collect()
    rows.sort(key=lambda r: (r.key % 1024, r.key))
    streams, names = {}, sorted({r.source for r in rows}, key=lambda s: (s is None, s or ""))
    for r in rows:
        streams.setdefault(r.source, []).extend((r.doc_id, w) for w in r.text.split())
    sized = docs.select("source", F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", " "))).cast("long").alias("size"))
    slots = mix_slots(source_targets(sized, block=block), shard_slots=16).collect()
    taken, shards = {}, {}
    for s in sorted(slots, key=lambda s: (s.shard, s.turn)):
        held = streams[names[s.sid]][s.block * block:(s.block + 1) * block]
        shards.setdefault(s.shard, []).append(" ".join(w for _, w in held))
        for d, _ in held:
            taken[d] = taken.get(d, 0) + 1
    assert {r.doc_id: r.taken for r in mix_sources(docs, block=block).collect()} == {r.doc_id: taken.get(r.doc_id, 0) for r in rows}
    got = {}
    for r in mixed_blocks(docs, block=block, shard_slots=16).orderBy("shard", "slot").collect():
        assert r.slot == len(got.setdefault(r.shard, []))
        got[r.shard].append(r.text)
    assert got == shards
    assert mixed_blocks(docs.limit(0)).count() == 0


def test_mixed_documents(spark):
    some = mix_docs(spark).withColumn("spans", F.lit("mine"))
    out = mixed_documents(some, block=8)
    assert out.columns == some.columns
    by = {}
    for r in out.collect():
        assert r.n_chars == len(r.text) and r.spans == "mine"
        by[r.doc_id] = by.get(r.doc_id, 0) + len(r.text.split())
    taken = {r.doc_id: r.taken for r in mix_sources(mix_docs(spark), block=8).collect()}
    assert by == {k: v for k, v in taken.items() if v}
    assert mixed_documents(some.limit(0)).count() == 0 and mix_sources(some.limit(0)).count() == 0


def test_mixing_null_and_repeated_rows(spark):
    rows = [(None, None, None, None, None), (1, "a b c", None, "s", 5), (1, "a b c", None, "s", 5), (2, " \t", None, "s", 2)]
    out = mix_sources(spark.createDataFrame(rows, DOCS), block=1).collect()
    assert sorted(r["size"] for r in out) == [0, 0, 3, 3]
    assert sum(r.taken for r in out) == 9 and {r.taken for r in out if r["size"] == 0} == {0}


def test_failed_line_runs_leave_no_tables(spark, monkeypatch):
    from penmark.llm import line_dedup as LD

    def broken(self):
        raise RuntimeError("lost")
    monkeypatch.setattr(LD.LineRuns, "finish", broken)
    docs = spark.createDataFrame([(i, "a\nb", "en", "s", 3) for i in range(12)], DOCS)
    with pytest.raises(RuntimeError):
        LD.frequent_lines(docs)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]
