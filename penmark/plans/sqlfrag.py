"""DuckDB SQL fragments mirroring the column expressions of ``penmark.functions``.

They are generated from the same constants, so the oracle and the Spark plan
share one definition of every pattern and word list.
"""

from __future__ import annotations

from penmark.functions import lexicon
from penmark.functions import text as T


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def str_list(items) -> str:
    return "[" + ", ".join(lit(x) for x in items) + "]"


STOP = str_list(lexicon.ENGLISH_STOP_WORDS)


def clean(col: str, strict: bool = False) -> str:
    out = col
    for pattern, rep in T.cleaning_rules(strict):
        out = f"regexp_replace({out}, {lit(pattern)}, {lit(rep)}, 'g')"
    return out


def extract_all(col: str, pattern: str) -> str:
    return f"regexp_extract_all({col}, {lit(pattern)})"


def sentences(col: str) -> str:
    return (f"list_filter(list_transform({extract_all(col, T.SENTENCE)}, lambda s: trim(s)), "
            f"lambda s: s <> '')")


def words(sents: str) -> str:
    return f"list_transform({sents}, lambda s: {extract_all('s', T.WORD)})"


def terms(col: str, stop: bool = True) -> str:
    t = extract_all(f"lower({col})", T.TERM)
    return f"list_filter({t}, lambda t: NOT list_contains({STOP}, t))" if stop else t


def first_line(col: str) -> str:
    return f"split_part({col}, chr(10), 1)"


def split_flag(key: str, seed: str, test_size: float) -> str:
    threshold = format(int(round(test_size * 16 ** 8)), "08x")
    return f"(md5({lit(seed)} || CAST({key} AS VARCHAR)) < {lit(threshold)})"


def strip_tags(col: str) -> str:
    s = f"regexp_replace({col}, {lit(r'(?i)<br\s*/?>|</p>|</h[1-6]>|</li>|</div>')}, chr(10), 'g')"
    return decode_entities(f"regexp_replace({s}, '<[^>]*>', '', 'g')")


def decode_entities(s: str) -> str:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = f"replace({s}, {lit(ent)}, {lit(ch)})"
    return s


def heading(html: str, level: int) -> str:
    return f"trim({strip_tags(f'regexp_extract({html}, {lit(f"(?is)<h{level}(?:\\s[^>]*)?>(.*?)</h{level}>")}, 1)')})"


def first_heading(html: str) -> str:
    whens = [f"WHEN regexp_matches({html}, {lit(f'(?is)<h{lv}(?:' + chr(92) + f's[^>]*)?>.*?</h{lv}>')}) THEN {heading(html, lv)}"
             for lv in (1, 2, 3, 4)]
    return "CASE " + " ".join(whens) + " ELSE '' END"


def article_body(html: str) -> str:
    inner = f"regexp_extract({html}, {lit(r'(?is)<article[^>]*>(.*?)</article>')}, 1)"
    return f"trim({strip_tags(inner)})"


def url_host(url: str) -> str:
    return f"regexp_extract({url}, {lit(r'^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)')}, 1)"


def url_root(url: str) -> str:
    return f"regexp_extract({url}, {lit(r'^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)')}, 1)"


def links(html: str) -> str:
    pattern = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*')"""
    return f"list_transform(regexp_extract_all({html}, {lit(pattern)}, 1), lambda q: {decode_entities('q[2:-2]')})"


def metrics_cte(strict: bool = False) -> str:
    """CTE ``m``: doc_id, author, lang, url, headline, body, sw (words per sentence), lens."""
    return f"""
a AS (SELECT doc_id, source AS author, lang, 'doc://' || CAST(doc_id AS VARCHAR) AS url,
             {first_line('text')} AS headline, {clean('text', strict)} AS body FROM documents),
s AS (SELECT *, {words(sentences('body'))} AS sw FROM a),
m AS (SELECT *, list_transform(sw, lambda x: len(x)) AS lens FROM s)"""


def metric_columns(lens: str = "lens") -> str:
    n = f"len({lens})"
    srt = f"list_sort({lens})"
    return f"""{n}::BIGINT AS total_number_of_sentences,
  coalesce(list_sum({lens}), 0)::BIGINT AS total_number_of_words,
  CASE WHEN {n} > 0 THEN round(list_sum({lens}) / {n}, 6) END AS number_of_words_sentence_mean,
  CASE WHEN {n} = 0 THEN NULL WHEN {n} % 2 = 1 THEN round({srt}[{n} // 2 + 1]::DOUBLE, 6)
       ELSE round(({srt}[{n} // 2] + {srt}[{n} // 2 + 1]) / 2.0, 6) END AS number_of_words_sentence_median,
  list_min({lens})::BIGINT AS number_of_words_sentence_min,
  list_max({lens})::BIGINT AS number_of_words_sentence_max"""
