"""Registered queries against their DuckDB oracles on the smallest data set."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from penmark.tables import TABLES

SF = "/root/testdata/sf0.001"
FAST = ["article_metrics", "longest_sentence_text", "sentence_length_histogram", "balanced_sample", "grid_pivot",
        "top_bigrams", "tfidf_unsmoothed", "tfidf_sublinear", "chi2_select", "hashed_vectors",
        "extract_article_fields", "upsert_url_index", "lemma_join", "strip_message_noise", "ascii_fold",
        "grid_mesh", "assemble_features", "knn_text", "stream_ingest",
        "multinomial_nb", "gaussian_nb", "split_sentences", "append_articles", "knn", "classification_report", "informative_features", "read_url_index"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4) + 0.0
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")
@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")
def test_leaderboard_ends_with_all_fits(spark):
    rows = E.queries()["classifier_leaderboard"](spark, SF).collect()
    assert len(rows) == 14 and all(0 <= r["accuracy"] <= 1 for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")
def test_grid_has_every_setting_and_split(spark):
    rows = E.queries()["grid_search"](spark, SF).collect()
    assert len(rows) == len({(r["max_depth"], r["min_samples_split"], r["split"]) for r in rows}) == 29 * 48 * 10


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "longest_sentence" in df.columns


def test_every_sql_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
