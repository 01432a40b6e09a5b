"""HTML extraction, WARC revisits and embedding near-dedup: rules, edge cases, brute force."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from penmark.llm.embedding_tiles import embedding_links, quantise, unit
from penmark.llm.html_extract import extract_pages, main_text
from penmark.llm.warc_revisit import canonical_url, header_map, resolve_revisits

P = "<p>" + "The quick brown fox jumps over the lazy dog again and again. " * 5 + "</p>"
T = " ".join(("The quick brown fox jumps over the lazy dog again and again. " * 5).split())


@pytest.mark.parametrize("page,want", [
    ("", ""),
    ("   ", ""),
    ("just  text\n here", "just text here"),
    ("<html><body><header><h1>Site</h1></header><div class='content'><h1>A &amp; B</h1>" + P + "<form><input><button>Go</button></form>"
     + P + "</div><div id=comments><p>nice</p></div><aside>x</aside><footer>&copy;</footer></body></html>", f"A & B\n\n{T}\n\n{T}"),
    ("<body><nav><a href=1>a</a></nav><main><article><header><h1>Head</h1></header>" + P
     + "<blockquote>Q <b>bold</b><br>next</blockquote><ul><li>One<li>Two</ul><section class='comment-list'>no</section></article></main>",
     f"Head\n\n{T}\n\nQ bold next\n\nOne\n\nTwo"),
    ("<body><div class='cookie-notice'>" + "blah " * 200 + "</div><article><h1>T</h1><p>Short.</p></article><div class=ad>Buy</div>", "T\n\nShort."),
    ("<article><p>x<!-- <p>no</p> --> y</p><script>'<p>no</p>'</script><style>p{}</style><noscript>js</noscript></article>", "x y"),
    ("<BODY><NAV><A HREF=x>menu</A></NAV><ARTICLE><H1>Big</H1><P>One<P>Two &lt;b&gt; &#8212; &nbsp;x</BODY>", "Big\n\nOne\n\nTwo <b> — x"),
    ("<article><p>abc</p><p>more <a hre", "abc\n\nmore"),
    ("<article><p>a < b and c > d &am</p></article>", "a < b and c > d &am"),
    ("<body><div><nav><ul><li><a href=x>menu</a></ul></div><article><p>Real text.</p></article>", "Real text."),
    ("<article><p title=\"a>b\">One</p><p class='it's>Two</p></article>", "One\n\nTwo"),
    ("<article><p><b>open<br><p>next</p></article>", "open\n\nnext"),
    ("<div hidden>no</div><div style='display: none'>no</div><p aria-hidden=true>no</p><p>yes</p>", "yes"),
])
def test_main_text(page, want):
    assert main_text(page) == want


AD = "<div class='ad'><p>Buy now.</p></div>"
COMMENTS = "<div id='comments'><ol class='comment-list'>" + "".join(
    f"<li class='comment'><div class='comment-body'><p>{'I like this story. ' * 9}{i}</p></div></li>" for i in range(9)) + "</ol></div>"


@pytest.mark.parametrize("page,want", [
    (f"<body><div class='content has-sidebar'><h1>H</h1>{P}{P}<div class='sidebar'><p>Side</p></div>{AD}</div></body>", f"H\n\n{T}\n\n{T}"),
    (f"<body><div class='post share-enabled'>{P}{P}<div class='share'>Share</div></div>{COMMENTS}</body>", f"{T}\n\n{T}"),
    (f"<body><div class='elementor-widget elementor-widget-text-editor'><div class='elementor-widget-container'>{P}</div></div>{AD}</body>", T),
    ("<body>" + f"<div class='elementor-widget elementor-widget-text-editor'>{P}</div>" * 3 + f"{AD}</body>", "\n\n".join([T] * 3)),
    (f"<body><form id='form1'><nav>menu</nav><div><h1>H</h1>{P}{P}</div><form class='signup'><p>Your mail</p></form></form></body>", f"H\n\n{T}\n\n{T}"),
    (f"<body><article><h1>H</h1><div class='entry no-comments'>{P}{P}</div>{AD}</article></body>", f"H\n\n{T}\n\n{T}"),
    (f"<body><div id='page' class='no-sidebar'><article>{P}{P}</article>{COMMENTS}</div></body>", f"{T}\n\n{T}"),
    (f"<body><div>{P}</div>{COMMENTS}<form><p>Leave your mail.</p></form></body>", T),
    (f"<body><article>{P}</article><div class='related'>" + "<article><p>Teaser of a story.</p></article>" * 20 + "</div></body>", T),
])
def test_suspects_that_hold_the_text_stay(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page,want", [
    ("<article><p class='notice'>Ad<p>Real text</p></article>", "Real text"),
    ("<article><p hidden>Ad<p>Real text</p></article>", "Real text"),
    ("<article><p hidden>Ad<div>Real text</div><p>more</article>", "Real text\n\nmore"),
    ("<article><p>One <span hidden>no<p>Two</article>", "One\n\nTwo"),
    ("<article><ul><li class='ad'>x<li>a<li>b</ul></article>", "a\n\nb"),
    ("<article><ul><li hidden>x<ul><li>y<li>z</ul>x<li>a<li>b</ul></article>", "a\n\nb"),
    ("<article><dl><dt hidden>x<dd>a<dt>b</dl></article>", "a\n\nb"),
    ("<article><table><tr hidden><td>x<td>y<tr><td>a<td hidden>n<td>b</table></article>", "a b"),
    ("<article><ul><li>a<nav><li>menu<li>menu</nav><li>b</ul></article>", "a\n\nb"),
    ("<article><p>a <button><div>no</div></button> b</p></article>", "a b"),
])
def test_left_out_elements_without_end_tags(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("page,want", [
    ("<article><p>a<!-->b</p></article>", "ab"),
    ("<article><p>a<!--->b</p></article>", "ab"),
    ("<article><p>a<!---->b</p></article>", "ab"),
    ("<article><p>a<!-- no --!>b<!-- -- no --></p></article>", "ab"),
    ("<article><p>a<!-- no > no", "a"),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p></article>", "Let x=2 be"),
    ("<article><p>Let <math><semantics><mi>x</mi><annotation encoding='application/x-tex'>\\x</annotation></semantics></math> be</p></article>",
     "Let x be"),
])
def test_comment_ends_and_formulas(page, want):
    assert main_text(page) == want


def test_pages_built_from_known_blocks():
    """Pages put together around known blocks, with and without an article element, give these blocks again."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choices("abcdefghijklmnop", k=rnd.randrange(2, 9)))
    link = lambda: f"<a href='/{word()}'>{word()}</a>"
    prose = lambda: " ".join(word() for _ in range(rnd.randrange(25, 90)))
    junk = [lambda: "<nav><ul>" + "".join(f"<li>{link()}" for _ in range(9)) + "</ul></nav>", lambda: f"<div class='ad'><p>{word()}</p></div>",
            lambda: f"<script>if (a < b) {{ '{word()}</p>' }}</script>", lambda: f"<!-- {word()} -->", lambda: f"<aside><p>{word()}</p></aside>",
            lambda: f"<form><input><button>{word()}</button></form>", lambda: f"<style>p{{}}</style>"]
    for _ in range(200):
        blocks, inner = [word().title()], []
        inner.append(f"<h1>{blocks[0]}</h1>")
        for _ in range(rnd.randrange(3, 12)):
            text = prose()
            kind = rnd.choice(["plain", "open", "bold", "entity", "list"])
            blocks.append(text + " & so" if kind == "entity" else text)
            inner.append({"plain": f"<p>{text}</p>", "open": f"<p>\n{text}\n", "bold": f"<p><b>{text[:9]}</b>{text[9:]}</p>",
                          "entity": f"<p>{text} &amp; so</p>", "list": f"<ul><li>{text}</ul>"}[kind])
            if rnd.random() < 0.3:
                inner.append(rnd.choice(junk[1:])())
        holder = rnd.choice(["article", "main", "div", "div"])
        page = (f"<html><head><title>{word()}</title></head><body>{rnd.choice(junk)()}<header><p>{word()}</p>{link()}</header>{rnd.choice(junk)()}"
                f"<{holder} id='x1'>{''.join(inner)}</{holder}>{rnd.choice(junk)()}<footer><p>{word()} {link()}</p></footer></body></html>")
        assert main_text(page) == "\n\n".join(blocks), page


def test_many_nested_suspects():
    assert main_text("<div class='widget'>" * 5_000 + "deep") == "deep"
    assert main_text("<p>" + "text " * 50 + "</p>" + "<div class='ad'>x</div>" * 5_000) == ("text " * 50).strip()


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    long = "word " * 200_000
    assert main_text(f"<article><p>{long}</p></article>") == long.strip()


def test_extract_pages_edges(spark):
    rows = [(1, "u", None, 7), (None, None, "<p>x</p>", 7), (2, "u", "<p>x</p>", 7), (2, "u", "<p>x</p>", 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = extract_pages(pages)
    assert out.columns == ["page_id", "url", "text"]
    assert sorted(map(str, out.collect())) == sorted(map(str, [
        out.sparkSession.createDataFrame([v], out.schema).first() for v in ((1, "u", ""), (None, None, "x"), (2, "u", "x"), (2, "u", "x"))]))
    assert extract_pages(pages.limit(0)).count() == 0


# ------------------------------------------------------------------ WARC

REC = "record_id long, kind string, url string, ts timestamp, http_status int, headers string, length long, digest string, status string"


def records(spark, rows):
    import datetime
    def at(m):
        return None if m is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m)
    return spark.createDataFrame([(i, k, u, at(m), s, h, 1, f"d{i}", "mine") for i, k, u, m, s, h in rows], REC)


def test_canonical_url(spark):
    same = ["http://www.Example.com/a/", "https://example.com:443/a", "HTTP://example.com/a#x", "https://example.com/a?utm_source=f",
            " http://example.com:80/a?&"]
    other = ["http://example.com/A", "http://example.com/a?b=1&a=2", "http://m.example.com/a", "http://example.com:8080/a"]
    got = [r.u for r in spark.createDataFrame([(x,) for x in same + other + ["http://example.com/a?a=2&b=1", None]], "url string")
           .select(canonical_url(F.col("url")).alias("u")).collect()]
    assert set(got[:5]) == {"example.com/a"} and len(set(got[5:9])) == 4 and got[9] == got[6] and got[10] is None


def test_revisits(spark):
    u = "http://x.org/a"
    rows = [(1, "response", u, 10, 200, 'ETag: "v1"\nLast-Modified: mon\nX: keep\nContent-Length: 5\nbad line\n'),
            (2, "response", u + "/", 20, 200, 'etag: W/"v2"\r\nDate: old'),
            (3, "response", u, 25, 404, 'ETag: "v3"'),
            (4, "revisit", u + "#f", 15, 304, 'ETag: W/"v1"\nContent-Length: 0\nDate: new'),
            (5, "revisit", u, 30, 304, 'ETag: "v2"\nX: drop\nExpires: never'),
            (6, "revisit", u, 31, 304, 'ETag: "v1"'),
            (7, "revisit", u, 32, 304, None),
            (8, "revisit", u, 5, 304, 'ETag: "v1"'),
            (9, "revisit", u, 10, 304, 'ETag: "v1"'),
            (10, "revisit", None, 40, 304, 'ETag: "v1"'),
            (11, "revisit", u, None, 304, 'ETag: "v1"'),
            (12, "revisit", u, 12, 304, "Last-Modified: mon"),
            (13, "revisit", u, 12, 304, "Last-Modified: tue"),
            (14, "revisit", "http://y.org", 50, 304, 'ETag: "v1"'),
            (5, "revisit", u, 30, 304, 'ETag: "v2"\nX: drop\nExpires: never')]
    out = resolve_revisits(records(spark, rows)).collect()
    got = {r.record_id: r for r in out}
    assert len(out) == 12
    assert {k: r.status for k, r in got.items()} == {
        4: "resolved", 5: "resolved", 6: "mismatch", 7: "unverified", 8: "no_response", 9: "no_response", 10: "no_response",
        11: "no_response", 12: "resolved", 13: "mismatch", 14: "no_response"}
    assert got[4].base_id == 1 and got[4].digest == "d1"
    assert got[4].headers == {"etag": 'W/"v1"', "last-modified": "mon", "x": "keep", "content-length": "5", "date": "new"}
    assert got[5].base_id == 2 and got[5].headers == {"etag": '"v2"', "date": "old", "expires": "never"}
    assert all(got[k].base_id is None and got[k].headers is None for k in (6, 7, 8, 10))
    assert resolve_revisits(records(spark, [])).count() == 0


def test_a_hot_url_spans_ranges(spark):
    n = 400
    rows = [(i, "response" if i % 40 == 0 else "revisit", "http://x.org/", i, 200, f'ETag: "{i // 40}"') for i in range(n)]
    got = {r.record_id: r for r in resolve_revisits(records(spark, rows)).collect()}
    assert all(got[i].status == "resolved" and got[i].base_id == i - i % 40 for i in range(n) if i % 40)


def test_header_map(spark):
    got = spark.createDataFrame([("A: 1\nb:2\na: 3\n:x\nno colon",), (None,), ("",)], "h string").select(header_map(F.col("h")).alias("m")).collect()
    assert [r.m for r in got] == [{"a": "3", "b": "2"}, {}, {}]


# ------------------------------------------------------------------ embeddings

def brute_links(rows, threshold=0.9):
    ok = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    n, pairs = [0] * len(rows), []
    for a in ok:
        for b in ok:
            x, y = np.array(rows[a][1], np.float64), np.array(rows[b][1], np.float64)
            if a != b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                n[a] += 1
                pairs.append((a, b))
    comp, least = brute.component_ids(len(rows), pairs), {}
    for (k, _), c in zip(rows, comp):
        if k is not None:
            least[c] = min(k, least.get(c, k))
    return sorted((str(k), n[i], str(least.get(comp[i])), k is not None and k == least.get(comp[i])) for i, (k, _) in enumerate(rows))


def test_embedding_links_match_brute_force(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(12, 16))
    near = np.float32(centre.repeat(9, 0) + 0.3 * rng.normal(size=(108, 16))).tolist()
    rows = [(i, v) for i, v in enumerate(near)] + [(200 + i, near[5]) for i in range(4)] + [
        (300, None), (301, [0.0] * 16), (302, [float("nan")] + [1.0] * 15), (303, [None] + [1.0] * 15), (304, []),
        (305, [float("inf")] + [1.0] * 15), (306, [1.0, 0.0]), (307, [1.0, 0.1]), (308, [1e-30, 1e-31]), (309, [3e38, 3e38]),
        (310, near[7]), (310, near[7]), (None, near[8]), (311, [2.0 * x for x in near[9]])]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<float>, n int")
    got = embedding_links(df).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == brute_links(
        [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for k, v in rows])
    assert embedding_links(df.limit(0)).count() == 0


def test_quantisation_bound_holds():
    rng = np.random.default_rng(1)
    x = unit(rng.normal(size=(300, 64)) * rng.exponential(size=(300, 64)))
    q, scale, error, norm = quantise(x)
    estimate = (q.astype(np.int64) @ q.astype(np.int64).T) * scale[:, None] * scale
    bound = error[None, :] + error[:, None] * norm[None, :]
    assert (np.abs(x @ x.T - estimate) <= bound + 1e-12).all() and bound.max() < 0.2
