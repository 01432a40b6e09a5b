"""Page extraction: the reference's browser reads re-aimed as jobs over a pages table.

All fields come from regular-expression column functions, one page per row,
so extraction is a narrow map stage; only the per-author rollups shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from penmark.functions import text as T


def author_url(url_col: str = "url"):
    """Author key of a page: the site root of its host."""
    return F.concat(F.lit("https://"), T.url_host(url_col), F.lit("/"))


def extract_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """All anchor hrefs per page, one row per link, with the link's position."""
    return pages.select(id_col, "url", F.posexplode(T.links(html_col)).alias("link_pos", "href"))


def element_html(df: DataFrame, tokens_col: str, out_col: str, tag: str | None = None, attr: str | None = None, word: str | None = None) -> DataFrame:
    """``df`` with the inner HTML of the first element of this tag whose attribute holds this word; null where there is none.

    The element is balanced: it ends where as many tags of its name were closed as opened since, or with the page.
    A void element gives its ``content`` attribute. Narrow, one pass over the page's tokens; comments, scripts and
    styles are left out.
    """
    t = F.col(tokens_col)
    df = df.withColumn("_at", F.array_position(F.transform(t, lambda x: T.opens(x, tag, attr, word)), True).cast("int"))
    df = df.withColumn("_first", F.when(F.col("_at") > 0, F.element_at(t, F.col("_at"))))
    df = df.withColumn("_name", T.tag_name(F.col("_first")))
    df = df.withColumn("_rest", F.slice(t, F.greatest(F.col("_at"), F.lit(0)) + 1, F.size(t)))

    def step(acc, x):
        turn = F.when(T.tag_name(x) != F.col("_name"), 0).when(x.startswith("</"), -1).otherwise(1)
        depth = F.when(acc["depth"] == 0, 0).otherwise(acc["depth"] + turn)
        return F.struct(depth.alias("depth"), (acc["n"] + F.when(depth > 0, 1).otherwise(0)).alias("n"))

    n = F.aggregate("_rest", F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n")), step, lambda acc: acc["n"])
    kept = F.filter(F.slice("_rest", F.lit(1), F.col("_n")), lambda x: ~x.rlike(r"(?i)^<(?:!--|script\b|style\b)"))
    inner = F.when(F.col("_name").rlike(f"^(?:{T.VOID_TAGS})$"), T.attribute(F.col("_first"), "content")).otherwise(F.array_join(kept, ""))
    df = df.withColumn("_n", n).withColumn(out_col, F.when(F.col("_at") > 0, inner))
    return df.drop("_at", "_first", "_name", "_rest", "_n")


def extract_article_fields(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """url, author, headline and body of an article page.

    Elements marked with itemprop (name, headline, articleBody) come first; without them the author is the host, the
    headline the first heading, and the body the first ``article`` element, nested ones included.
    """
    df = pages.select(id_col, "url", html_col, T.html_tokens(html_col).alias("_tokens"))
    for out, find in (("_name_mark", ("span", "itemprop", "name")), ("_head_mark", (None, "itemprop", "headline")),
                      ("_body_mark", (None, "itemprop", "articleBody")), ("_article", ("article", None, None))):
        df = element_html(df, "_tokens", out, *find)
    text = lambda c: F.trim(T.strip_tags(F.col(c)))
    return df.select(
        id_col, "url",
        F.coalesce(text("_name_mark"), T.url_host("url")).alias("author"),
        F.coalesce(text("_head_mark"), T.first_heading(html_col)).alias("headline"),
        F.coalesce(text("_body_mark"), text("_article"), F.lit("")).alias("body"))


def select_links(pages: DataFrame, anchor: tuple | None = None, within: tuple | None = None, first_only: bool = False,
                 id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, url, link_pos, href) of the anchors that match, in page order; link_pos counts a page's matches from 0.

    ``anchor`` is (attribute, word) that the anchor must have; ``within`` is (tag, attribute or None, word or None) of an
    element around it, ``first_only`` keeps the first anchor of each such element (of the outermost, where they nest).
    Elements are balanced by running sums over a page's tags of that name; one that is never closed ends with the page.
    """
    tag = within[0] if within else None
    names = ["a"] + ([tag] if tag else [])
    tags = pages.select(id_col, "url", F.posexplode(F.filter(T.html_tokens(html_col), lambda x: T.tag_name(x).isin(names))).alias("p", "t"))
    t = F.col("t")
    is_link = T.opens(t, "a") & T.attribute(t, "href").rlike("(?s).")
    if anchor:
        is_link = is_link & T.opens(t, "a", *anchor)
    tags = tags.withColumn("is_link", is_link)
    page = Window.partitionBy(id_col, "url")
    if within:
        turn = F.when(T.tag_name(t) != tag, 0).when(t.startswith("</"), -1).otherwise(1)
        tags = tags.withColumn("turn", turn).withColumn("depth", F.sum("turn").over(page.orderBy("p")))
        # an element's two tags are neighbours among the tags of their level
        level = F.col("depth") + F.when(F.col("turn") < 0, 1).otherwise(0)
        peers = Window.partitionBy(id_col, "url", F.col("turn") == 0, level).orderBy("p")
        end = F.coalesce(F.lead("p").over(peers), F.lit(2 ** 31 - 1))
        tags = tags.withColumn("end", F.when(T.opens(t, *within), end))
        around = F.max(F.when(F.col("end").isNotNull(), F.struct("end", F.col("p").alias("start")))).over(
            page.orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
        tags = tags.withColumn("around", around).filter(F.col("around.end") > F.col("p"))
    found = tags.filter("is_link")
    if within and first_only:
        nth = F.row_number().over(Window.partitionBy(id_col, "url", "around.start").orderBy("p"))
        found = found.withColumn("nth", nth).filter("nth = 1")
    return found.select(id_col, "url", (F.row_number().over(page.orderBy("p")) - 1).alias("link_pos"), T.attribute(t, "href").alias("href"))


def crawl_completeness(links: DataFrame, declared: DataFrame, author_col: str = "author_url") -> DataFrame:
    """Per author: collected distinct article links against the declared count."""
    collected = links.groupBy(author_col).agg(F.countDistinct("article_url").alias("collected"))
    return (declared.join(collected, author_col, "left")
            .withColumn("collected", F.coalesce("collected", F.lit(0)).cast("long"))
            .withColumn("complete", F.col("collected") >= F.col("declared")))


def author_article_pairs(authors: DataFrame, pages: DataFrame) -> DataFrame:
    """Fan each author out to (author_url, article_url) rows over its listing pages."""
    listing = pages.select(author_url().alias("author_url"), "page_id", "url", T.links("html").alias("hrefs"))
    joined = authors.select("author_url").join(listing, "author_url")
    return joined.select("author_url", "page_id", "url",
                         F.posexplode("hrefs").alias("link_pos", "href")).select(
        "author_url", "page_id", F.col("url").alias("page_url"), "link_pos",
        T.absolute_url("href", "url").alias("article_url"))
