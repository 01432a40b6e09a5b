"""Text cleaning and tokenisation as native column expressions.

Everything here returns a ``Column``; nothing leaves the JVM, so it stays in
whole-stage codegen and needs no Python worker. The patterns are accepted alike
by Java regex (Spark) and RE2 (DuckDB), which makes the SQL oracle exact.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from penmark.functions import lexicon

# Tokenisation recipes. \w is ASCII-only in Java, so Unicode classes are used.
WORD = r"[\p{L}\p{N}_]+"
TERM = r"[\p{L}\p{N}_]{2,}"
SENTENCE = r"[^.!?\n]+[.!?]*"
WORD_OR_PUNCT = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"
PUNCT_ONLY = r"^[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]*$"
LINK = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*')"""
# A comment, a script or style with its content, a tag (a ">" inside quotes doesn't end it), a run of text, or a stray "<".
HTML_TOKEN = (r"""(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>"""
              r"""|</?[a-z][^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>|[^<]+|<""")
VOID_TAGS = "area|base|br|col|embed|hr|img|input|link|meta|source|track|wbr"
_REGEX_SPECIAL = set("\\.^$|?*+()[]{}")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regex_escape(text: str) -> str:
    return "".join("\\" + ch if ch in _REGEX_SPECIAL else ch for ch in text)


def extract_all(c: Column | str, pattern: str) -> Column:
    """All matches of ``pattern`` (no groups needed) as ``array<string>``."""
    return F.regexp_extract_all(_col(c), F.lit(f"({pattern})"), 1)


# ---------------------------------------------------------------- cleaning

def cleaning_rules(strict: bool = False) -> list[tuple[str, str]]:
    """Ordered (pattern, replacement) pairs for ``clean_text``.

    The sentence-end fix inserts a full stop after a closing quote that follows
    one. ``strict`` keeps the original unescaped dot, which rewrites any
    character before a closing quote.
    """
    rules = [(".”" if strict else r"\.”", ".”.")]
    for kind, marker in lexicon.CLEANING_MARKERS:
        pat = regex_escape(marker)
        rules.append(("(?s)" + pat + ".*" if kind == "tail" else pat, ""))
    return rules


def clean_text(c: Column | str, strict: bool = False) -> Column:
    out = _col(c)
    for pattern, replacement in cleaning_rules(strict):
        out = F.regexp_replace(out, F.lit(pattern), F.lit(replacement))
    return out


# ---------------------------------------------------------------- splitting

def split_paragraphs(c: Column | str) -> Column:
    """Split on newline; empty paragraphs are kept."""
    return F.split(_col(c), "\n", -1)


def split_sentences(c: Column | str) -> Column:
    """Sentences in text order: runs up to terminal punctuation, trimmed, non-empty.

    The pattern never crosses a newline, so applying it to the whole body equals
    splitting paragraphs first and concatenating their sentences.
    """
    return F.filter(F.transform(extract_all(c, SENTENCE), lambda s: F.trim(s)),
                    lambda s: s != "")


def tokenize_words(sentences: Column | str) -> Column:
    """``array<array<string>>`` of words per sentence; punctuation is never a word."""
    return F.transform(_col(sentences), lambda s: extract_all(s, WORD))


def sentence_lengths(sentences_words: Column | str) -> Column:
    return F.transform(_col(sentences_words), lambda w: F.size(w))


def wordpunct_tokens(c: Column | str) -> Column:
    """Alternating runs of word characters and of punctuation."""
    return extract_all(c, WORD_OR_PUNCT)


def terms(c: Column | str) -> Column:
    """Vectoriser tokens: lower-case runs of two or more word characters."""
    return extract_all(F.lower(_col(c)), TERM)


def normalize_tokens(tokens: Column | str, lower: bool = True, strip: bool = True) -> Column:
    """lower, then strip spaces, ``_`` and ``*`` in that order (strips share one flag)."""
    def norm(t: Column) -> Column:
        if lower:
            t = F.lower(t)
        if strip:
            t = F.btrim(F.btrim(F.trim(t), F.lit("_")), F.lit("*"))
        return t
    return F.transform(_col(tokens), norm)


def filter_tokens(tokens: Column | str, stopwords: Iterable[str] | None = None,
                  drop_punctuation: bool = True) -> Column:
    """Drop stop words and tokens made only of ASCII punctuation (the empty token too)."""
    stop = list(lexicon.ENGLISH_STOP_WORDS if stopwords is None else stopwords)

    def keep(t: Column) -> Column:
        cond = ~t.isin(stop) if stop else F.lit(True)
        if drop_punctuation:
            cond = cond & ~t.rlike(PUNCT_ONLY)
        return cond
    return F.filter(_col(tokens), keep)


def word_class(tag: Column | str) -> Column:
    """Penn Treebank tag -> lexicon class by its first letter; default noun."""
    first = F.substring(_col(tag), 1, 1)
    out = F.lit(lexicon.DEFAULT_WORD_CLASS)
    for initial, cls in reversed(lexicon.TAG_CLASS):
        out = F.when(first == initial, F.lit(cls)).otherwise(out)
    return out


def suffix_tag(token: Column | str) -> Column:
    """A small suffix tagger standing in for a trained one: CD, VBD, RB or NN."""
    t = _col(token)
    return (F.when(t.rlike(r"^[\p{N}]+$"), F.lit("CD"))
            .when(t.rlike(r"ed$"), F.lit("VBD"))
            .when(t.rlike(r"ly$"), F.lit("RB"))
            .otherwise(F.lit("NN")))


def rebuild_text(sentences_words: Column | str) -> Column:
    return F.array_join(F.flatten(_col(sentences_words)), " ")


# ---------------------------------------------------------------- keys and display

def safe_key(c: Column | str) -> Column:
    """Delete file-name reserved characters, then whitespace -> ``_``."""
    reserved = "[" + "".join("\\" + ch if ch in "\\[]^-" else ch
                             for ch in lexicon.FILE_NAME_RESERVED) + "]"
    return F.regexp_replace(F.regexp_replace(_col(c), reserved, ""), r"\s", "_")


def ascii_fold(c: Column | str) -> Column:
    out = _col(c)
    for ch, rep in lexicon.FOLD_MULTI.items():
        out = F.replace(out, F.lit(ch), F.lit(rep))
    return F.translate(out, lexicon.FOLD_FROM, lexicon.FOLD_TO)


def trim_display(c: Column | str, width: int = 80) -> Column:
    s = _col(c)
    return F.when(F.length(s) > width,
                  F.concat(F.substring(s, 1, width - 3), F.lit("..."))).otherwise(s)


def first_line(c: Column | str) -> Column:
    return F.substring_index(_col(c), "\n", 1)


# ---------------------------------------------------------------- pages

def strip_tags(c: Column | str) -> Column:
    """Markup to text: block ends become newlines, tags go, common entities decode."""
    s = F.regexp_replace(_col(c), r"(?i)<br\s*/?>|</p>|</h[1-6]>|</li>|</div>", "\n")
    return decode_entities(F.regexp_replace(s, r"<[^>]*>", ""))


def decode_entities(s: Column) -> Column:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(ent), F.lit(ch))
    return s


def heading(html: Column | str, level: int) -> Column:
    return F.trim(strip_tags(F.regexp_extract(_col(html), rf"(?is)<h{level}(?:\s[^>]*)?>(.*?)</h{level}>", 1)))


def first_heading(html: Column | str) -> Column:
    """Text of the first heading by level h1..h4; the first level present wins, also with an empty text."""
    out = F.when(F.lit(False), F.lit(""))
    for lv in (1, 2, 3, 4):
        out = out.when(_col(html).rlike(rf"(?is)<h{lv}(?:\s[^>]*)?>.*?</h{lv}>"), heading(html, lv))
    return out.otherwise(F.lit(""))


def article_body(html: Column | str) -> Column:
    inner = F.regexp_extract(_col(html), r"(?is)<article[^>]*>(.*?)</article>", 1)
    return F.trim(strip_tags(inner))


def html_tokens(html: Column | str) -> Column:
    """The page cut into ``HTML_TOKEN``; a null page has none."""
    return F.regexp_extract_all(F.coalesce(_col(html), F.lit("")), F.lit(HTML_TOKEN), F.lit(0))


def tag_name(token: Column) -> Column:
    """Lower-case name of an opening or closing tag; empty for every other token, scripts and styles among them."""
    name = F.lower(F.regexp_extract(token, r"^</?([A-Za-z][A-Za-z0-9-]*)", 1))
    return F.when(name.isin("script", "style"), F.lit("")).otherwise(name)


def attribute(token: Column, name: str) -> Column:
    """Value of a tag's attribute, quotes off and entities decoded; empty where there is none."""
    v = F.regexp_extract(token, rf"""(?i)^<[a-z][^\s>]*(?:\s[^>]*?)?\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return decode_entities(F.regexp_replace(v, "^[\"']|[\"']$", ""))


def opens(token: Column, tag: str | None = None, attr: str | None = None, word: str | None = None) -> Column:
    """Whether a token opens an element of this tag (None: any) whose attribute holds this word."""
    name = tag_name(token)
    out = (name != "") & ~token.startswith("</")
    if tag is not None:
        out = out & (name == tag)
    if attr is not None:
        out = out & F.array_contains(F.split(attribute(token, attr), r"\s+"), word)
    return out


def links(html: Column | str) -> Column:
    """The href of every anchor, in order: either quote style, entities decoded."""
    quoted = F.regexp_extract_all(_col(html), F.lit(LINK), 1)
    return F.transform(quoted, lambda q: decode_entities(F.substring(q, F.lit(2), F.length(q) - 2)))


def url_host(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)


def absolute_url(href: Column | str, page_url: Column | str) -> Column:
    """Resolve a site-relative href against the page's scheme and host."""
    h, u = _col(href), _col(page_url)
    root = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    return F.when(h.startswith("/"), F.concat(root, h)).otherwise(h)


def declared_count(c: Column | str) -> Column:
    """First integer in a label text, as bigint (null when there is none or it is out of range)."""
    return F.nullif(F.regexp_extract(_col(c), r"([0-9]+)", 1), F.lit("")).try_cast("bigint")


# ---------------------------------------------------------------- message noise

def strip_header(c: Column | str) -> Column:
    """Everything after the first blank line; no blank line leaves nothing."""
    s = _col(c)
    pos = F.instr(s, "\n\n")
    return F.when(pos > 0, s.substr(pos + 2, F.length(s) + 2)).otherwise(F.lit(""))


def _strip_ws(s: Column) -> Column:
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def strip_footer(c: Column | str) -> Column:
    """Cut at the last line that is blank or only dashes, unless that is the first line."""
    lines = F.split(_strip_ws(_col(c)), "\n", -1)
    idx = F.sequence(F.lit(0), F.size(lines) - 1)
    cut = F.array_max(F.filter(idx, lambda i: F.btrim(_strip_ws(F.element_at(lines, i + 1)), F.lit("-")) == ""))
    return F.when(cut > 0, F.array_join(F.slice(lines, 1, cut), "\n")).otherwise(_col(c))


def strip_quotes(c: Column | str) -> Column:
    lines = F.split(_col(c), "\n", -1)
    return F.array_join(F.filter(lines, lambda ln: ~ln.rlike(lexicon.QUOTE_LINE)), "\n")


def strip_message_noise(c: Column | str, headers: bool = True, footers: bool = True,
                        quotes: bool = True) -> Column:
    s = _col(c)
    if headers:
        s = strip_header(s)
    if footers:
        s = strip_footer(s)
    if quotes:
        s = strip_quotes(s)
    return s
