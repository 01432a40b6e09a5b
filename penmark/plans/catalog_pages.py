"""Registered queries: page extraction (2.2), incremental ingest (2.3), text (2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.functions import text as T
from penmark.operators import ingest as I
from penmark.operators import pages as P
from penmark.operators import sentences as SE
from penmark.operators import tokens as TK
from penmark.plans import sqlfrag as S
from penmark.plans.catalog import _KEPT, _M, documents, metrics, pipeline_tokens, query
from penmark.session import spread
from penmark.tables import table


def pages(spark, d):
    return spread(table(spark, d, "pages"))


def page_lang(url="url"):
    return F.regexp_extract(url, r"://[^/]+/([a-z]{2})/", 1)


_HOST = S.url_host("url")
_AUTHOR = f"('https://' || {_HOST} || '/')"
_LANG = "regexp_extract(url, '://[^/]+/([a-z]{2})/', 1)"
_PAIRS = f"""p AS (SELECT {_AUTHOR} AS author_url, page_id, url, {_LANG} AS lang, {S.links('html')} AS h FROM pages),
e AS (SELECT author_url, page_id, url, lang, (generate_subscripts(h, 1) - 1)::INTEGER AS link_pos, unnest(h) AS href FROM p),
pairs AS (SELECT author_url, page_id, lang, link_pos,
                 CASE WHEN starts_with(href, '/') THEN {S.url_root('url')} || href ELSE href END AS article_url FROM e)"""


def all_pairs(spark, d):
    pg = pages(spark, d)
    authors = pg.select(P.author_url().alias("author_url")).distinct()
    pairs = P.author_article_pairs(authors, pg)
    return pairs.withColumn("lang", page_lang("page_url")), pg


# ------------------------------------------------------------------ 2.2 pages

_HREF = r"""(?i)\shref\s*=\s*["']([^"']+)["']"""


@query("extract_links", f"""WITH l AS (SELECT page_id, url, {S.links('html')} AS h FROM pages)
SELECT page_id, url, (generate_subscripts(h, 1) - 1)::INTEGER AS link_pos, unnest(h) AS href FROM l""")
def q_extract_links(spark, d):
    return P.extract_links(pages(spark, d))


# Running sums over the tags of one name, as in the operator, on tokens cut by the same pattern.
_TAGS = f"""tk AS (SELECT page_id, url, generate_subscripts(k, 1) AS p, unnest(k) AS t FROM
  (SELECT page_id, url, {S.extract_all('html', T.HTML_TOKEN)} AS k FROM pages)),
tg AS (SELECT *, lower(regexp_extract(t, '^</?([A-Za-z][A-Za-z0-9-]*)', 1)) AS name, starts_with(t, '</') AS closing FROM tk),
dp AS (SELECT *, sum(CASE WHEN closing THEN -1 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY p) AS depth FROM tg WHERE name = 'li'),
el AS (SELECT page_id, p AS s, closing, coalesce(lead(p) OVER (PARTITION BY page_id, CASE WHEN closing THEN depth + 1 ELSE depth END ORDER BY p), 2147483647) AS e FROM dp),
an AS (SELECT page_id, url, p, {S.decode_entities(f"regexp_extract(t, {S.lit(_HREF)}, 1)")} AS href FROM tg WHERE name = 'a' AND NOT closing AND regexp_matches(t, {S.lit(_HREF)})),
own AS (SELECT an.*, (SELECT max({{'e': e, 's': s}}) FROM el WHERE el.page_id = an.page_id AND NOT closing AND s < an.p AND e > an.p).s AS s FROM an),
fst AS (SELECT page_id, url, s, min(p) AS p, arg_min(href, p) AS href FROM own WHERE s IS NOT NULL GROUP BY ALL)"""


@query("listing_links", f"""WITH {_TAGS}
SELECT page_id, url, (row_number() OVER (PARTITION BY page_id ORDER BY p) - 1)::INTEGER AS link_pos, href FROM fst""")
def q_listing_links(spark, d):
    """The first anchor of every list item: the articles of a listing page."""
    return P.select_links(pages(spark, d), within=("li", None, None), first_only=True)


@query("extract_article_fields", f"""
SELECT page_id, url, {_HOST} AS author, {S.first_heading('html')} AS headline, {S.article_body('html')} AS body FROM pages""")
def q_extract_article_fields(spark, d):
    return P.extract_article_fields(pages(spark, d))


@query("first_heading", f"SELECT page_id, {S.first_heading('html')} AS headline FROM pages")
def q_first_heading(spark, d):
    return pages(spark, d).select("page_id", T.first_heading("html").alias("headline"))


# Binding: a page has no "N articles" label, so the first integer of its URL
# stands in for the declared count; an author's declared count is the largest
# over its pages, and its collected count is the distinct article links found.
_DECL = "TRY_CAST(nullif(regexp_extract(url, '([0-9]+)', 1), '') AS BIGINT)"


@query("declared_count", f"SELECT page_id, {_DECL} AS declared FROM pages")
def q_declared_count(spark, d):
    return table(spark, d, "pages").select("page_id", T.declared_count("url").alias("declared"))


@query("crawl_completeness", f"""WITH {_PAIRS},
decl AS (SELECT {_AUTHOR} AS author_url, max({_DECL}) AS declared FROM pages GROUP BY 1),
col AS (SELECT author_url, count(DISTINCT article_url) AS collected FROM pairs GROUP BY 1)
SELECT author_url, declared, coalesce(collected, 0)::BIGINT AS collected,
       coalesce(collected, 0) >= declared AS complete
FROM decl LEFT JOIN col USING (author_url)""")
def q_crawl_completeness(spark, d):
    pairs, pg = all_pairs(spark, d)
    declared = pg.groupBy(P.author_url().alias("author_url")).agg(
        F.max(T.declared_count("url")).alias("declared"))
    return P.crawl_completeness(pairs, declared)


@query("author_article_pairs", f"WITH {_PAIRS} SELECT author_url, page_id, link_pos, article_url FROM pairs")
def q_author_article_pairs(spark, d):
    pairs, _ = all_pairs(spark, d)
    return pairs.select("author_url", "page_id", "link_pos", "article_url")


# ------------------------------------------------------------------ 2.3 ingest
# Binding: pages whose path language is 'en' are the part already crawled.

@query("pending_authors", f"""WITH {_PAIRS}
SELECT DISTINCT author_url FROM pairs WHERE author_url NOT IN (SELECT author_url FROM pairs WHERE lang = 'en')""")
def q_pending_authors(spark, d):
    pairs, _ = all_pairs(spark, d)
    authors = pairs.select("author_url").distinct()
    return I.pending_authors(authors, pairs.filter(F.col("lang") == "en"))


@query("pending_articles", f"""WITH i AS (SELECT {_AUTHOR} AS author_url, url AS article_url FROM pages),
s AS (SELECT url FROM pages WHERE {_LANG} = 'en')
SELECT author_url, article_url FROM i WHERE article_url NOT IN (SELECT url FROM s)""")
def q_pending_articles(spark, d):
    pg = pages(spark, d)
    index = pg.select(P.author_url().alias("author_url"), F.col("url").alias("article_url"))
    stored = P.extract_article_fields(pg.filter(page_lang() == "en")).select("url")
    return I.pending_articles(index, stored)


@query("upsert_url_index", f"""WITH {_PAIRS},
b AS (SELECT article_url, author_url, CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS is_new, page_id, link_pos FROM pairs),
r AS (SELECT *, row_number() OVER (PARTITION BY article_url ORDER BY is_new, page_id, link_pos) AS rn FROM b)
SELECT article_url, author_url FROM r WHERE rn = 1""")
def q_upsert_url_index(spark, d):
    pairs, _ = all_pairs(spark, d)
    old = pairs.filter(F.col("lang") == "en")
    new = pairs.filter(F.col("lang") != "en")
    return I.upsert_url_index(old.select("author_url", "article_url", "page_id", "link_pos"),
                              new.select("author_url", "article_url", "page_id", "link_pos"))


@query("author_article_counts", f"WITH {_PAIRS} SELECT author_url, count(*)::BIGINT AS articles FROM pairs GROUP BY 1")
def q_author_article_counts(spark, d):
    pairs, _ = all_pairs(spark, d)
    return I.author_article_counts(pairs)


@query("article_log", f"""
SELECT {_HOST} AS author, {S.first_heading('html')} AS headline, length({S.article_body('html')})::BIGINT AS body_chars,
       url FROM pages""")
def q_article_log(spark, d):
    return I.article_log(P.extract_article_fields(pages(spark, d)))


# ------------------------------------------------------------------ 2.4 text

@query("clean_text", f"SELECT doc_id, {S.clean('text')} AS text FROM documents")
def q_clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean_text("text").alias("text"))


@query("split_paragraphs", """WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)
SELECT doc_id, (generate_subscripts(p, 1) - 1)::INTEGER AS para_pos, unnest(p) AS paragraph FROM p""")
def q_split_paragraphs(spark, d):
    return documents(spark, d).select("doc_id", F.posexplode(T.split_paragraphs("text")).alias("para_pos", "paragraph"))


_SENTS = f"SELECT doc_id, {S.sentences('text')} AS s FROM documents"


def _log_sql(x: str) -> str:
    return f"ln(greatest({x}, 1e-12))"


def _fit_sql(k: str, of: str, q: str) -> str:
    return f"({k}) * {_log_sql(q)} + ({of} - ({k})) * {_log_sql(f'1 - {q}')}"


def _association_sql(a: str, b: str, ab: str, n: str) -> str:
    p, p1, p2 = f"({b} / {n})", f"({ab} / {a})", f"(({b} - {ab}) / ({n} - {a}))"
    return (f"-2 * ({_fit_sql(ab, a, p)} + {_fit_sql(f'{b} - {ab}', f'({n} - {a})', p)}"
            f" - ({_fit_sql(ab, a, p1)}) - ({_fit_sql(f'{b} - {ab}', f'({n} - {a})', p2)}))")


def _match(col: str, pattern: str) -> str:
    return f"regexp_matches({col}, {S.lit(pattern)})"


# The trained splitter in SQL: the same counts, ratios and decisions.
_TRAINED = f"""raw AS (SELECT doc_id, x, pos, regexp_replace(regexp_replace(x, {S.lit(SE.OPENING)}, ''), {S.lit(SE.CLOSING)}, '') AS core
        FROM (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS pos FROM (SELECT doc_id, {S.extract_all("coalesce(text, '')", SE.TOKEN)} AS l FROM documents))),
tok AS (SELECT doc_id, pos, x, CASE WHEN {_match('typ', SE.NUMBER)} THEN '{SE.NUMBER_TYPE}' ELSE typ END AS typ,
          suffix(core, '.') AND NOT {_match('core', SE.ELLIPSIS)} AS stop, {_match('core', SE.ELLIPSIS)} AS dots, suffix(core, '!') OR suffix(core, '?') AS strong,
          CASE WHEN {_match('core', SE.UPPER)} THEN 'U' WHEN {_match('core', SE.LOWER)} THEN 'L' ELSE '-' END AS cased
        FROM (SELECT *, lower(regexp_replace(core, {S.lit(SE.TAIL)}, '')) AS typ FROM raw)),
seq AS (SELECT *, lag(x) OVER w AS px, lag(typ) OVER w AS ptyp, lag(stop) OVER w AS pstop, lag(dots) OVER w AS pdots, lag(strong) OVER w AS pstrong
        FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
g AS (SELECT typ, stop, cased, CASE WHEN px IS NULL OR px = chr(10) THEN 's' WHEN pstrong THEN 'x' WHEN pstop THEN 'p' WHEN pdots THEN 'e' ELSE 'o' END AS before,
        CASE WHEN pstop THEN ptyp ELSE '' END AS prev, count(*) AS n FROM seq WHERE x <> chr(10) GROUP BY ALL),
tot AS (SELECT sum(n) AS nn, sum(n) FILTER (WHERE stop) AS bb FROM g),
kind0 AS (SELECT typ, sum(n) AS n, sum(n) FILTER (WHERE stop) AS k, length(replace(typ, '.', '')) AS l FROM g GROUP BY typ HAVING k > 0),
kind AS (SELECT typ AS prev, n AS prev_n, {_match('typ', SE.LETTER)} AND
           -2 * ({_fit_sql('k', 'n', '(bb / nn)')} - k * ln(0.99) - (n - k) * ln(0.01)) * exp(-l) * (length(typ) - l + 1) * pow(l::DOUBLE, -(n - k)::DOUBLE)
             >= {SE.ABBREVIATION} AS abbr, {_match('typ', SE.INITIAL)} AS initial, typ = '{SE.NUMBER_TYPE}' AS number FROM kind0, tot),
aft AS (SELECT g.*, before = 'p' AND NOT coalesce(abbr, false) AS ends, before IN ('s', 'x') OR (before = 'p' AND NOT coalesce(abbr, false)) AS begins
        FROM g LEFT JOIN kind USING (prev)),
word0 AS (SELECT typ, sum(n) AS n, coalesce(sum(n) FILTER (WHERE ends), 0) AS at_end, bool_or(cased = 'L') AS lo, bool_or(cased = 'U') AS up,
            bool_or(cased = 'U' AND before = 'o') AS up_in, bool_or(cased = 'L' AND begins) AS lo_begin FROM aft GROUP BY typ),
allend AS (SELECT sum(at_end) AS e FROM word0),
word AS (SELECT word0.*, coalesce({_match('typ', SE.LETTER)} AND at_end > 0 AND at_end * nn > e * n
           AND CASE WHEN at_end > 0 THEN {_association_sql('e', 'n', 'at_end', 'nn')} END >= {SE.STARTER}, false) AS starter FROM word0, tot, allend),
pair AS (SELECT prev, typ, cased, sum(sum(n)) OVER (PARTITION BY prev, typ) AS ab FROM g WHERE before = 'p' GROUP BY prev, typ, cased),
dec AS (SELECT prev, typ, cased, abbr, initial, (initial OR number) AND NOT starter AND ab > 1 AND ab * nn > prev_n * n AND {_association_sql('prev_n', 'n', 'ab', 'nn')} >= {SE.COLLOCATION} AS bound,
          cased = 'U' AND lo AND NOT up_in AS starts, cased = 'L' AND (up OR NOT lo_begin) AS none, lo, starter
        FROM pair JOIN kind USING (prev) JOIN word USING (typ), tot WHERE abbr OR initial OR number),
hold AS (SELECT prev, typ, cased FROM dec WHERE CASE WHEN bound THEN true WHEN abbr AND NOT initial THEN NOT (starts OR (cased = 'U' AND starter))
           ELSE none OR (initial AND NOT starts AND cased = 'U' AND NOT lo) END),
nxt AS (SELECT *, lead(x) OVER w AS nx, lead(typ) OVER w AS ntyp, lead(cased) OVER w AS ncased FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
brk AS (SELECT nxt.*, CASE WHEN x = chr(10) OR strong OR (stop AND hold.prev IS NULL) OR (dots AND ncased = 'U') THEN 1 ELSE 0 END AS b
        FROM nxt LEFT JOIN hold ON nx <> chr(10) AND hold.prev = nxt.typ AND hold.typ = ntyp AND hold.cased = ncased),
grp AS (SELECT *, coalesce(sum(b) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM brk),
sent AS (SELECT doc_id, s, string_agg(x, ' ' ORDER BY pos) AS sentence FROM grp WHERE x <> chr(10) GROUP BY doc_id, s)"""


@query("split_sentences", f"""WITH {_TRAINED}
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1)::INTEGER AS sent_pos, sentence FROM sent""")
def q_split_sentences(spark, d):
    docs = documents(spark, d).select("doc_id", "text")
    return SE.split(docs, SE.train(docs)).select("doc_id", F.posexplode("sentences").alias("sent_pos", "sentence"))


@query("tokenize_words", f"""WITH x AS ({_SENTS}),
y AS (SELECT doc_id, (generate_subscripts(s, 1) - 1)::INTEGER AS sent_pos, unnest(s) AS sentence FROM x),
z AS (SELECT doc_id, sent_pos, {S.extract_all('sentence', T.WORD)} AS w FROM y)
SELECT doc_id, sent_pos, len(w)::BIGINT AS n_words, array_to_string(w, ' ') AS words FROM z""")
def q_tokenize_words(spark, d):
    s = documents(spark, d).select("doc_id", F.posexplode(T.tokenize_words(T.split_sentences("text"))).alias("sent_pos", "w"))
    return s.select("doc_id", "sent_pos", F.size("w").cast("long").alias("n_words"), F.array_join("w", " ").alias("words"))


_WP = S.extract_all("text", T.WORD_OR_PUNCT)
_NORM = f"list_transform({_WP}, lambda t: trim(trim(trim(lower(t)), '_'), '*'))"


@query("wordpunct_tokens", f"""WITH x AS (SELECT doc_id, {_WP} AS t FROM documents)
SELECT doc_id, len(t)::BIGINT AS n_tokens, array_to_string(t, ' ') AS tokens FROM x""")
def q_wordpunct_tokens(spark, d):
    t = documents(spark, d).select("doc_id", T.wordpunct_tokens("text").alias("t"))
    return t.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query("normalize_tokens", f"SELECT doc_id, array_to_string({_NORM}, ' ') AS tokens FROM documents")
def q_normalize_tokens(spark, d):
    return documents(spark, d).select(
        "doc_id", F.array_join(T.normalize_tokens(T.wordpunct_tokens("text")), " ").alias("tokens"))


_FILT = (f"list_filter({_NORM}, lambda t: NOT list_contains({S.STOP}, t) "
         f"AND NOT regexp_matches(t, {S.lit(T.PUNCT_ONLY)}))")


@query("filter_tokens", f"SELECT doc_id, array_to_string({_FILT}, ' ') AS tokens FROM documents")
def q_filter_tokens(spark, d):
    return documents(spark, d).select("doc_id", F.array_join(pipeline_tokens(), " ").alias("tokens"))


def _lex_sql(cls: str, suffix: str, cut: int) -> str:
    stem = f"substr(token, 1, length(token) - {cut})"
    return (f"SELECT token, '{cls}' AS pos, {stem} AS lemma FROM v WHERE suffix(token, '{suffix}') "
            f"AND length(token) > {cut + 1} AND {stem} IN (SELECT token FROM v)")


@query("lemma_join", f"""WITH k AS (SELECT doc_id, {_FILT} AS k FROM documents),
t AS (SELECT doc_id, (generate_subscripts(k, 1) - 1)::INTEGER AS pos, unnest(k) AS token FROM k),
v AS (SELECT DISTINCT token FROM t),
lex AS ({_lex_sql('n', 's', 1)} UNION ALL {_lex_sql('v', 'ed', 2)} UNION ALL {_lex_sql('r', 'ly', 2)}),
g AS (SELECT *, CASE WHEN regexp_matches(token, '^[\\p{{N}}]+$') THEN 'CD' WHEN regexp_matches(token, 'ed$') THEN 'VBD'
                     WHEN regexp_matches(token, 'ly$') THEN 'RB' ELSE 'NN' END AS tag FROM t),
c AS (SELECT *, CASE substr(tag, 1, 1) WHEN 'N' THEN 'n' WHEN 'V' THEN 'v' WHEN 'R' THEN 'r' WHEN 'J' THEN 'a'
                ELSE 'n' END AS cls FROM g)
SELECT doc_id, c.pos, c.token, tag, coalesce(lex.lemma, c.token) AS lemma
FROM c LEFT JOIN lex ON c.token = lex.token AND c.cls = lex.pos""")
def q_lemma_join(spark, d):
    toks = TK.token_table(documents(spark, d), pipeline_tokens())
    lex = TK.derive_lexicon(toks)
    tagged = toks.withColumn("tag", T.suffix_tag("token"))
    return TK.lemma_join(tagged, lex).select("doc_id", "pos", "token", "tag", "lemma")


_MSG = "('From: ' || role || chr(10) || chr(10) || text)"


def _noise_sql() -> str:
    h = f"CASE WHEN strpos({_MSG}, chr(10) || chr(10)) > 0 THEN substr({_MSG}, strpos({_MSG}, chr(10) || chr(10)) + 2) ELSE '' END"
    ws = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    return f"""WITH a AS (SELECT conv_id, turn, {h} AS h FROM conversations),
b AS (SELECT conv_id, turn, h, string_split({ws.format(x='h')}, chr(10)) AS lines FROM a),
c AS (SELECT conv_id, turn, h, lines,
             list_max(list_filter(range(0, len(lines)), lambda i: trim({ws.format(x='lines[i + 1]')}, '-') = '')) AS cut FROM b),
f AS (SELECT conv_id, turn, CASE WHEN cut > 0 THEN array_to_string(lines[1:cut], chr(10)) ELSE h END AS f FROM c)
SELECT conv_id, turn, array_to_string(list_filter(string_split(f, chr(10)),
       lambda ln: NOT regexp_matches(ln, {S.lit(T.lexicon.QUOTE_LINE)})), chr(10)) AS text FROM f"""


@query("strip_message_noise", _noise_sql())
def q_strip_message_noise(spark, d):
    conv = spread(table(spark, d, "conversations"))
    msg = F.concat(F.lit("From: "), F.col("role"), F.lit("\n\n"), F.col("text"))
    return conv.select("conv_id", "turn", T.strip_message_noise(msg).alias("text"))


@query("rebuild_text", f"{_M} SELECT doc_id, array_to_string(flatten(sw), ' ') AS text FROM m WHERE {_KEPT}")
def q_rebuild_text(spark, d):
    return metrics(spark, d).select("doc_id", T.rebuild_text("sentences_words").alias("text"))


_HEAD = S.first_line("text")


@query("safe_key", f"""SELECT doc_id, regexp_replace(regexp_replace({_HEAD}, '[~#%&*{{}}:<>?/+|"'']', '', 'g'),
       '\\s', '_', 'g') AS key FROM documents""")
def q_safe_key(spark, d):
    return table(spark, d, "documents").select("doc_id", T.safe_key(T.first_line("text")).alias("key"))


def _fold_sql(x: str) -> str:
    from penmark.functions import lexicon as L
    for ch, rep in L.FOLD_MULTI.items():
        x = f"replace({x}, {S.lit(ch)}, {S.lit(rep)})"
    return f"translate({x}, {S.lit(L.FOLD_FROM)}, {S.lit(L.FOLD_TO)})"


@query("ascii_fold", f"SELECT doc_id, {_fold_sql(_HEAD)} AS headline FROM documents")
def q_ascii_fold(spark, d):
    return table(spark, d, "documents").select("doc_id", T.ascii_fold(T.first_line("text")).alias("headline"))


@query("trim_display", f"""SELECT doc_id, CASE WHEN length({_HEAD}) > 80 THEN substr({_HEAD}, 1, 77) || '...'
       ELSE {_HEAD} END AS display FROM documents""")
def q_trim_display(spark, d):
    return table(spark, d, "documents").select("doc_id", T.trim_display(T.first_line("text")).alias("display"))
