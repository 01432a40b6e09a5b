"""The corpus pipeline against a single-machine version of its stages, and the registered queries."""

import os

import brute
import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from penmark.llm.common import docs_table, materialise
from penmark.llm.source_mixing import mix_sources
from penmark.tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")
OPS = [n for n in E.queries() if n.startswith("op")]


def test_stages_match_single_machine_versions(spark):
    docs = docs_table(spark, SF)
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    quality = {r.doc_id: r.kept for r in E.queries()["op8_quality_rules"](spark, SF).collect()}

    docs = materialise(corpus_pipeline.quality(spark, docs, SF), "t")
    texts = {k: t for k, t in texts.items() if quality[k]}
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == texts

    docs = materialise(corpus_pipeline.lines(spark, docs, SF), "t")
    texts = {k: t for k, _, _, t in brute.line_dedup(list(texts.items()))}
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == texts

    docs = materialise(corpus_pipeline.near_copies(spark, docs, SF), "t")
    groups = brute.simhash_groups(list(texts.items()))
    texts = {k: t for k, t in texts.items() if groups[k][1] == k}
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == texts

    taken = {r.doc_id: r.taken for r in mix_sources(docs).collect()}
    docs = materialise(corpus_pipeline.mixing(spark, docs, SF), "t")
    rows = docs.collect()
    assert docs.columns == columns
    words = {}
    for r in rows:
        own = brute.words(r.text)
        words[r.doc_id] = words.get(r.doc_id, 0) + len(own)
        assert r.n_chars == len(r.text) and set(own) <= set(brute.words(texts[r.doc_id]))
    assert words == {k: n for k, n in taken.items() if n}

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((r.doc_id, brute.sha(",".join(map(str, library.encode(r.text, add_special_tokens=False).ids))), brute.sha(r.text)) for r in rows)
    got = corpus_pipeline.tokens(spark, docs, SF).collect()
    assert sorted((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "source_mixing", "bpe_round_trip"]
    first = corpus_pipeline.run(spark, SF).select("doc_id", "ids_sha256").collect()
    again = E.queries()["pipeline"](spark, SF).select("doc_id", "ids_sha256").collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again)) and first


@pytest.mark.parametrize("name", [n for n in OPS if n in E.oracle_sql()])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.execute(E.oracle_sql()[name])
    cols = sorted(c[0] for c in rel.description)
    at = [[c[0] for c in rel.description].index(c) for c in cols]
    want = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)
    df = E.queries()[name](spark, SF)
    assert sorted(df.columns) == cols
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == want


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in OPS) == list(range(1, 14)) and "pipeline" in E.queries()
