"""Main text of web pages by composite text density.

The page becomes a tree. Elements that are never part of an article (menus, page headers
and footers, scripts, styles, what is hidden) are taken out by tag or role. Forms and
elements whose class or id has a word for sidebars, notices, adverts or reader comments
are suspects: they are taken out unless they hold the densest subtree or most of the
unlinked text around them (wrappers of the article). For every node that is left the
composite text density is computed from its characters, tags, linked characters and
linked tags (Sun, Song and Liao, 2011): characters per tag, adjusted by the share of
links. The densities of a node's children add up to its density sum; the subtree with the
largest sum is the article, widened to the article or main element around it. The least
density on the path from the body to it is the threshold for the rest of the page: nodes
beside the path that reach it belong to the text, and so do main headlines outside it.

Text is cut into blocks at block elements; white space inside a block, line breaks
included, becomes one space; blocks are joined by two line feeds in page order.

A page is parsed in one pass over the whole html, however broken: unclosed elements,
stray end tags, a cut-off end, tags in upper case, comments and raw text are handled;
nesting is worked off without recursion. Memory is a few times the page's size.

Defined results: null or empty html and pages without text give the empty text. Repeated
rows give equal rows, an empty table gives an empty table, null ids and urls pass, other
columns are not looked at.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Element names of the HTML standard by what they do to the tree and the text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript template svg".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search
section summary table tbody tfoot thead tr ul""".split())
CELL = {"td", "th", "br", "wbr", "img"}            # separate words, not blocks
CLOSES_P = BLOCK - {"body", "caption", "dd", "dt", "html", "legend", "li", "optgroup", "option", "tbody", "tfoot", "thead", "tr"}
# an opening tag ends open elements of the second set, up to one of the third
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
        "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
        "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
        "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"})}

# What is never part of the article (ALWAYS: unless it holds the article).
NOT_TEXT = set("""head nav footer aside button select datalist input textarea script style title xmp iframe noembed
noframes noscript template svg canvas audio video object applet map dialog menu search annotation annotation-xml""".split())
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
ALWAYS = set("""ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion cookie cookies
consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup share sharing social sidebar comment
comments disqus reply replies respond related recommended recommendations breadcrumb breadcrumbs menu nav navbar navigation
footer toolbar pagination pager widget widgets login alert disclaimer skip""".split())
UNLESS_CONTENT = set("header masthead banner meta byline tags author info".split())
CONTENT = set("article post entry content main story body text".split())

COMMENTS = set("comment comments disqus reply replies respond".split())

ROOTS = {"article", "main", "body", "html"}
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
COMMENT_START_END = re.compile(r"-?>")   # a comment that ends where it starts: <!--> or <!--->
COMMENT_END = re.compile(r"--!?>")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)
NOT_NAME = re.compile(r"[^a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parts", "parent", "chars", "tags", "link_chars", "link_tags", "density", "total", "suspect")

    def __init__(self, tag: str, parent: "Node | None", suspect: "tuple[bool, bool] | None" = None):
        self.tag, self.parent, self.parts = tag, parent, []   # parts: text and nodes, in order
        self.suspect = suspect


def unwanted(tag: str, attributes: str, inside_article: bool) -> bool | tuple[bool, bool]:
    """Whether an element is taken out with all it holds.

    A suspect gives two marks instead: whether one of its names is a content name and no more,
    and whether its names have a content word and none for comments.
    """
    if tag in NOT_TEXT or (tag == "header" and not inside_article):
        return True
    if tag in ROOTS or not attributes:
        return (False, False) if tag == "form" else False
    words, content, hit = set(), False, tag == "form"
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id"):
            names = [set(NOT_NAME.split(CAMEL.sub(" ", x).lower())) for x in value.split()]
            own = set().union(*names)
            if not own & ALWAYS and own & UNLESS_CONTENT and not own & CONTENT and not inside_article:
                return True
            hit = hit or bool(own & ALWAYS)
            content = content or any(x & CONTENT and not x & ALWAYS for x in names)
            words |= own
    return (content, bool(words & CONTENT) and not words & COMMENTS) if hit else False


def parse(page: str) -> Node:
    """The tree of a page without unwanted elements."""
    root, suspects = parse_tags(page)
    if suspects:
        settle(root)
    return root


def parse_tags(page: str) -> tuple[Node, bool]:
    """The tree of a page with its suspects, and whether there are any."""
    any_suspect = False
    root = Node("html", None)
    at, n = root, len(page)
    depth_out, out_stack = 0, []      # open elements inside an unwanted one
    articles = 0
    i = 0

    def text(raw: str) -> None:
        if raw and not out_stack:
            at.parts.append(entities.unescape(raw) if "&" in raw else raw)

    def leave(node: Node) -> Node:
        nonlocal articles
        articles -= node.tag in ("article", "main")
        return node.parent

    while i < n:
        j = page.find("<", i)
        if j < 0:
            text(page[i:])
            break
        text(page[i:j])
        nxt = page[j + 1:j + 2]
        if nxt in ("!", "?"):
            if page.startswith("<!--", j):
                end = COMMENT_START_END.match(page, j + 4) or COMMENT_END.search(page, j + 4)
                i = end.end() if end else n
            else:
                end = page.find(">", j)
                i = n if end < 0 else end + 1
            continue
        m = TAG.match(page, j) or LOOSE_TAG.match(page, j)
        if not m:
            if nxt.isalpha() or nxt == "/":
                if nxt == "/" and not page[j + 2:j + 3].isalpha():   # </ and no name: a comment up to >
                    end = page.find(">", j)
                    i = n if end < 0 else end + 1
                    continue
                break   # a tag that the page's end cut off
            text("<")
            i = j + 1
            continue
        i, closing, tag, attributes = m.end(), m[1], m[2].lower(), m[3]
        if out_stack and not closing and tag not in RAW:   # what the tag ends without an end tag
            del out_stack[still_open(tag, out_stack, at):]
        if out_stack:   # only look for the end of what is left out
            if closing:
                if tag in out_stack:
                    while out_stack.pop() != tag:
                        pass
                elif tag in BLOCK and out_owner_closed(at, tag, out_stack[0]):
                    out_stack.clear()
                else:
                    continue
                if out_stack or tag == out_tag:
                    continue
            elif tag in RAW and not attributes.endswith("/"):
                i = raw_end(page, i, tag)
                continue
            else:
                if tag not in VOID and not attributes.endswith("/"):
                    out_stack.append(tag)
                continue
        if closing:
            node = at
            while node is not None and node.tag != tag:
                node = node.parent
            if node is None or node is root:
                if tag == "p":
                    at.parts.append(Node("p", at))
                continue
            while at is not node:
                at = leave(at)
            at = leave(at)
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                i = raw_end(page, i, tag)
            continue
        if tag in CLOSES_P:
            p = at
            while p is not None and p.tag != "p" and p.tag not in BLOCK and p.tag not in ("td", "th"):
                p = p.parent
            if p is not None and p.tag == "p":
                while at is not p:
                    at = leave(at)
                at = leave(at)
        if tag in ENDS:
            ended, scope = ENDS[tag]
            node, found = at, None
            while node is not None and node.tag not in scope:
                if node.tag in ended:
                    found = node
                node = node.parent
            if found is not None:
                while at is not found:
                    at = leave(at)
                at = leave(at)
        if tag == "html":
            continue
        verdict = unwanted(tag, attributes, articles > 0)
        if verdict is True:
            if tag not in VOID and not attributes.endswith("/"):
                out_stack, out_tag = [tag], tag
            at.parts.append(" " if tag not in BLOCK else Node("hr", at))
            continue
        node = Node(tag, at, verdict or None)
        any_suspect = any_suspect or bool(verdict)
        at.parts.append(node)
        if tag not in VOID:
            articles += tag in ("article", "main")
            at = node
    return root, any_suspect


def settle(root: Node) -> None:
    """Take suspects out, inner ones first, but for those that hold the text around them.

    A suspect is held against its surroundings: the article, suspect or page it stands in.
    What counts is unlinked text without that of inner suspects that were taken out.
    """
    order = [root]
    for node in order:
        order.extend(p for p in node.parts if isinstance(p, Node))
    linked = {}
    for node in order:
        linked[id(node)] = node.tag == "a" or (node.parent is not None and linked[id(node.parent)])
    # by node: text, text in articles, the largest article, whether there is an h1, suspects not settled yet
    found = {}
    for node in reversed(order):
        text = 0 if linked[id(node)] else sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        in_articles, largest, headline, inside = 0, 0, node.tag == "h1", []
        for p in node.parts:
            if isinstance(p, Node):
                own = found[id(p)]
                if p.suspect:
                    inside.append((p, own))
                else:
                    text, in_articles, largest = text + own[0], in_articles + own[1], max(largest, own[2])
                    headline = headline or own[3]
                    inside += own[4]
        if inside and (node.suspect or node.tag in ("article", "main") or node is root):
            for _, own in keep_or_drop(node, text, in_articles, inside, node is root):
                text, in_articles, largest = text + own[0], in_articles + own[1], max(largest, own[2])
                headline = headline or own[3]
            inside = []
        if node.tag in ("article", "main"):
            in_articles, largest = text, text
        found[id(node)] = text, in_articles, largest, headline, inside


def keep_or_drop(around: Node, text: int, in_articles: int, inside: list, whole_page: bool) -> list:
    """Settle the suspects ``inside`` one article, suspect or page; returns those that stay."""
    total = text + sum(own[0] for _, own in inside)
    # beside an article, it takes a sign of content, too
    able = [(s, own) for s, own in inside if own[0] and
            (not in_articles or s.suspect[0] or own[3] or own[2] > in_articles)]
    stay = [(s, own) for s, own in able if 2 * own[0] > total]
    if not stay and not in_articles:
        # a page in pieces, such as a page builder's widgets
        pieces = [(s, own) for s, own in able if s.suspect[1]]
        if 2 * sum(own[0] for _, own in pieces) > total:
            stay = pieces
    if not stay and whole_page and able:
        order = measure(around)
        body = next((x for x in order if x.tag == "body"), around)
        best = max(order[order.index(body):], key=lambda x: x.total)
        while best is not None and not best.suspect:
            best = best.parent
        stay = [(s, own) for s, own in able if s is best]
    out = {id(s) for s, _ in inside} - {id(s) for s, _ in stay}
    for parent in {id(s.parent): s.parent for s, _ in inside}.values():
        parent.parts = [p if id(p) not in out else " " if p.tag not in BLOCK else Node("hr", parent) for p in parent.parts]
    return stay


def still_open(tag: str, out_stack: list[str], at: Node) -> int:
    """How many elements of ``out_stack`` an opening tag leaves open; none, if it ends the one that is left out."""
    n = len(out_stack)
    if tag in CLOSES_P:
        k = n - 1
        while k >= 0 and out_stack[k] not in BLOCK and out_stack[k] not in NOT_TEXT and out_stack[k] not in ("td", "th"):
            k -= 1
        if k >= 0:
            n = k if out_stack[k] == "p" else n
        else:   # an inline element: the p around it may end
            while at is not None and at.tag not in BLOCK and at.tag not in ("td", "th"):
                at = at.parent
            if at is not None and at.tag == "p":
                return 0
    if tag in ENDS:
        ended, scope = ENDS[tag]
        walls = scope if tag not in ("li", "dt", "dd") else scope | NOT_TEXT | (BLOCK - {"address", "div", "p", "li", "dt", "dd"})
        for k in range(n - 1, -1, -1):
            if out_stack[k] in ended:
                n = k
            elif out_stack[k] in walls:
                return n
        while at is not None and at.tag not in scope:
            if at.tag in ended:
                return 0
            at = at.parent
    return n


def out_owner_closed(at: Node, tag: str, out_tag: str) -> bool:
    """Whether an end tag ends an element around the one that is left out (which was never closed)."""
    if tag in ("p", "li"):
        return False
    while at is not None:
        if at.tag == tag:
            return at.parent is not None
        at = at.parent
    return False


def raw_end(page: str, i: int, tag: str) -> int:
    """Where a raw-text element that was opened before i ends."""
    m = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, i)
    return m.end() if m else len(page)


def measure(root: Node) -> list[Node]:
    """Counts, densities and density sums of all nodes; returns them, parents before children."""
    order = [root]
    for node in order:
        order.extend(p for p in node.parts if isinstance(p, Node))
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for p in node.parts:
            if isinstance(p, Node):
                node.chars += p.chars
                node.tags += p.tags + 1
                node.link_chars += p.link_chars
                node.link_tags += p.link_tags + (p.tag == "a")
            else:
                node.chars += len("".join(p.split()))
        if node.tag == "a":
            node.link_chars = node.chars
    body = next((x for x in order if x.tag == "body"), root)
    page_share = body.link_chars / max(1, body.chars)
    for node in reversed(order):
        c, t = node.chars, max(1, node.tags)
        lc, lt = max(1, node.link_chars), max(1, node.link_tags)
        # the logarithm's base grows with the share of linked characters; at least e, where there are no links
        base = math.log(c / max(1, c - node.link_chars) * node.link_chars + page_share * c + math.e)
        node.density = c / t * math.log(max(1.0, c / lc * t / lt)) / max(1.0, math.log(base))
        node.total = sum(p.density for p in node.parts if isinstance(p, Node))
        if not node.total:
            node.total = node.density   # a node of text alone stands for itself
    return order


def article_nodes(root: Node) -> set[int]:
    """The nodes (by id) whose whole subtrees are the text."""
    order = measure(root)
    body = next((x for x in order if x.tag == "body"), root)
    best = max(order[order.index(body):], key=lambda x: x.total)
    if best.chars == 0:
        return set()
    wide = best
    while wide is not None and wide.tag not in ("article", "main"):
        wide = wide.parent
    best = wide or best
    path, node = [best], best
    while node.parent is not None and node is not body:
        node = node.parent
        path.append(node)
    threshold = min(x.density for x in path)
    # the article, and main headlines wherever they stand
    chosen = {id(best)} | {id(x) for x in order if x.tag == "h1"}
    on_path = {id(x) for x in path}
    for around in path[1:]:
        chosen.update(id(p) for p in around.parts if isinstance(p, Node) and id(p) not in on_path
                      and p.chars and p.density >= threshold)
    return chosen


def main_text(page: str) -> str:
    """The article's text, blocks joined by two line feeds."""
    root = parse(page)
    chosen = article_nodes(root)
    blocks, line = [], []

    def flush() -> None:
        words = "".join(line).split()
        if words:
            blocks.append(" ".join(words))
        line.clear()

    stack = [(root, False, False)]   # node or text, inside what was chosen, leaving
    while stack:
        x, inside, leaving = stack.pop()
        if isinstance(x, str):
            if inside:
                line.append(x)
            continue
        inside = inside or id(x) in chosen
        if x.tag in BLOCK:
            flush()
        elif x.tag in CELL:
            line.append(" ")
        if not leaving:
            if x.parts:
                stack.append((x, inside, True))
                stack.extend((p, inside, False) for p in reversed(x.parts))
    flush()
    return "\n\n".join(blocks)


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html)."""
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py() or "") for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
