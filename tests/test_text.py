"""Text expressions on the inline fixtures of FIXTURES.md part C."""

import pytest
from pyspark.sql import functions as F

from penmark.functions import text as T
from penmark.operators import metrics as M


def one(spark, col_expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col_expr.alias("o")).first()["o"]


def test_clean_text_quote_fix_and_tails(spark):
    body = "He said “Stop.” Then left.\nABOUT THE AUTHOR\nline one\nline two"
    out = one(spark, T.clean_text("s"), body)
    assert out == "He said “Stop.”. Then left.\n"
    # the strict rule rewrites any character before a closing quote
    assert one(spark, T.clean_text("s", strict=True), "Better Off” x") == "Better Of.”. x"


def test_clean_text_promo_line_and_long_tail(spark):
    body = "Intro.\nFor more, go to Jill on Money\nEnd." + "\nImage by Flickr User " + "x" * 80_000
    assert one(spark, T.clean_text("s"), body) == "Intro.\n\nEnd.\n"


def test_sentence_metrics(spark):
    # lengths 3, 5, 5, 1 in two paragraphs
    body = "One two three. Four five six seven eight!\nA b c d e. Z."
    df = spark.createDataFrame([(1, body, "a")], "doc_id long, body string, author string")
    m = M.article_metrics(df).first()
    assert m["number_of_words_each_sentence"] == [3, 5, 5, 1]
    assert m["total_number_of_sentences"] == 4 and m["total_number_of_words"] == 14
    assert m["number_of_words_sentence_mean"] == 3.5
    assert m["number_of_words_sentence_median"] == 4.0
    assert (m["number_of_words_sentence_min"], m["number_of_words_sentence_max"]) == (1, 5)
    top = M.longest_articles_topk(M.article_metrics(df), 1).first()
    assert top["longest_sentence"] == "Four five six seven eight"


def test_drop_incomplete_removes_empty_and_punctuation_only(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, "...", "a"), (3, "Fine text.", "a")],
                               "doc_id long, body string, author string")
    kept = [r["doc_id"] for r in M.article_metrics(df).collect()]
    assert kept == [3]
    allrows = M.article_metrics(df, drop_incomplete=False).orderBy("doc_id").collect()
    assert allrows[0]["number_of_words_sentence_mean"] is None


def test_normalize_and_filter_tokens(spark):
    toks = ["_x_", "*z*", "***", "", "The", "the", "été", "--", "“"]
    df = spark.createDataFrame([(toks,)], "t array<string>")
    norm = df.select(T.normalize_tokens("t").alias("n")).first()["n"]
    assert norm == ["x", "z", "", "", "the", "the", "été", "--", "“"]
    kept = df.select(T.filter_tokens(T.normalize_tokens("t")).alias("k")).first()["k"]
    # stop words and ASCII-punctuation-only tokens (the empty one too) go
    assert kept == ["x", "z", "été", "“"]
    # stop words are case-sensitive when not lower-cased first
    assert df.select(T.filter_tokens("t").alias("k")).first()["k"] == ["_x_", "*z*", "The", "été", "“"]


def test_wordpunct_and_words(spark):
    assert one(spark, T.wordpunct_tokens("s"), "Hi, there... été!") == ["Hi", ",", "there", "...", "été", "!"]
    assert one(spark, T.split_sentences("s"), "A b. C d?\n\nE") == ["A b.", "C d?", "E"]


def test_headings(spark):
    pages = ["<h2>x</h2><h1>Main <b>title</b></h1>", "<h3>Only three</h3>", "<p>none</p>"]
    got = [one(spark, T.first_heading("s"), p) for p in pages]
    assert got == ["Main title", "Only three", ""]


def test_safe_key_and_fold(spark):
    assert one(spark, T.safe_key("s"), 'a/b\\c: "d"?\tx y') == "ab\\c_d_x_y"
    assert one(spark, T.ascii_fold("s"), "Été à Köln, Straße, Œuvre") == "Ete a Koln, Strasse, OEuvre"
    assert one(spark, T.trim_display("s"), "x" * 81) == "x" * 77 + "..."
    assert one(spark, T.trim_display("s"), "x" * 80) == "x" * 80


def test_declared_count_and_links(spark):
    assert one(spark, T.declared_count("s"), "See all 42 articles") == 42
    assert one(spark, T.declared_count("s"), "none") is None
    html = '<a class="x" href="/a">A</a><A HREF="http://h/b">B</A>'
    assert one(spark, T.links("s"), html) == ["/a", "http://h/b"]


def test_message_noise(spark):
    msg = "From: a\nSubject: b\n\nHello there\n> quoted line\nAll good\n--\nsig"
    assert one(spark, T.strip_message_noise("s"), msg) == "Hello there\nAll good"
    assert one(spark, T.strip_header("s"), "no blank line") == ""


def test_urls_and_author_pairs(spark):
    from penmark.operators import pages as P
    assert one(spark, T.url_host("s"), "https://blog.example.com:8080/en/1?x=2") == "blog.example.com"
    df = spark.createDataFrame([("/a", "http://h.example.org/en/5"), ("https://x.example/b", "http://h.example.org/")],
                               "href string, url string")
    got = [r["u"] for r in df.select(T.absolute_url("href", "url").alias("u")).collect()]
    assert got == ["http://h.example.org/a", "https://x.example/b"]
    pages = spark.createDataFrame([(1, "http://h.example.org/en/5", '<a href="/a">A</a><a href="/b">B</a>')],
                                  "page_id long, url string, html string")
    authors = spark.createDataFrame([("https://h.example.org/",)], "author_url string")
    pairs = [(r["link_pos"], r["article_url"]) for r in P.author_article_pairs(authors, pages).orderBy("link_pos").collect()]
    assert pairs == [(0, "http://h.example.org/a"), (1, "http://h.example.org/b")]
