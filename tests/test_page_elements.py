"""Balanced elements, marked fields and anchors by class and by the element around them."""

import pytest

from penmark.operators import pages as P


def page(spark, *htmls):
    return spark.createDataFrame([(i, f"https://h{i}.example.com/x", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")


def hrefs(df):
    return [(r["page_id"], r["link_pos"], r["href"]) for r in df.orderBy("page_id", "link_pos").collect()]


def fields(spark, *htmls):
    return {r["page_id"]: (r["author"], r["headline"], r["body"]) for r in P.extract_article_fields(page(spark, *htmls)).collect()}


def test_marked_fields(spark):
    html = """<h1>Site</h1><span class=by itemprop="name">Ann &amp; Bob</span><h2 itemprop='headline big'>The <b>Head</b></h2>
<div itemprop="articleBody"><div>one <div>two</div></div><script>var s = "</div>";</script><!-- </div> -->three</div><div>footer</div>"""
    author, headline, body = fields(spark, html)[0]
    assert (author, headline) == ("Ann & Bob", "The Head")
    assert body.split() == ["one", "two", "three"]


def test_nested_articles_are_one_body(spark):
    got = fields(spark, "<article>a<article>b</article>c</article>d", "<article>open to the end <p>x", "<p>none</p>", None, "",
                 "<ARTICLE>upper</ARTICLE>", "<article data-x='a>b'>in</article>", "</article><article>late</article>out")
    assert [got[i][2] for i in range(8)] == ["abc", "open to the end x", "", "", "", "upper", "in", "late"]
    assert got[2][0] == "h2.example.com" and got[4][1] == ""


def test_void_element_gives_its_content(spark):
    assert fields(spark, "<meta itemprop=headline content='H &lt; I'><h1>other</h1>")[0][1] == "H < I"


def test_anchor_by_class(spark):
    html = "<a class='button big' href=/1>x</a><a class=buttons href=/2>y</a><a href='/3' class=\"small button\">z</a><a class=button>no href</a>"
    assert hrefs(P.select_links(page(spark, html), anchor=("class", "button"))) == [(0, 0, "/1"), (0, 1, "/3")]


def test_anchor_within_balanced_elements(spark):
    html = ("<a href=/0></a><div class=list><div><a href=/1></a></div><a href=/2></a></div><a href=/3></a>"
            "<div><a href=/4></a></div><div class='list x'><a href=/5></a><a href=/6></a>")
    within = ("div", "class", "list")
    assert [h for _, _, h in hrefs(P.select_links(page(spark, html), within=within))] == ["/1", "/2", "/5", "/6"]
    assert [h for _, _, h in hrefs(P.select_links(page(spark, html), within=within, first_only=True))] == ["/1", "/5"]


@pytest.mark.parametrize("html", [None, "", "text < more", "</li></li><a href=/x></a>", "<!-- <li><a href=/x></a></li> -->"])
def test_nothing_to_find(spark, html):
    assert hrefs(P.select_links(page(spark, html), within=("li", None, None))) == []


def test_scan_of_a_long_page(spark):
    html = "<ul>" + "".join(f"<li><b>{i}</b><a href='/{i}?a=1&amp;b=2'>x</a><a href=/no></a></li>" for i in range(20_000)) + "</ul>"
    got = hrefs(P.select_links(page(spark, html), within=("li", None, None), first_only=True))
    assert len(got) == 20_000 and got[-1] == (0, 19_999, "/19999?a=1&b=2")
    body = fields(spark, "<article>" + "<div>w</div> " * 50_000 + "</article>")[0][2]
    assert len(body.split()) == 50_000
