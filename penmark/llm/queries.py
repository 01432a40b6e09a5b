"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from penmark.llm.common import docs_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return put


WS = r"[\x20\x09-\x0D]+"
WORDS_SQL = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{WS}'), lambda x: x <> '')"


_OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS_SQL} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
           FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS k
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) >= 8)),
hit AS (SELECT doc_id, i FROM win JOIN (SELECT doc_id, k FROM win GROUP BY ALL HAVING count(*) > 1) USING (doc_id, k)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM hit) GROUP BY doc_id),
s AS (SELECT doc_id, text, w, ls, len(w)::BIGINT AS n_words,
        length(regexp_replace(text, '{WS}', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words,
        length(regexp_replace(text, '\\P{{L}}+', '', 'g')) AS letters,
        length(regexp_replace(text, '\\P{{Lu}}+', '', 'g')) AS upper
      FROM d LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > len(ls)
    OR word_chars > 12 * n_words OR 2 * word_chars < 5 * n_words
    OR 10 * len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) < 6 * n_words
    OR 100 * letters < 35 * word_chars OR 2 * upper > letters
    OR 10 * len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) > 3 * len(ls)
    OR 10 * len(list_filter(ls, lambda x: regexp_matches(x, '^\\s*[•‣*\\-]\\s'))) > 9 * len(ls)) AS kept
FROM b"""


@query("op8_quality_rules", _OP8_SQL)
def op8_quality_rules(spark, d):
    from penmark.llm.quality_cascade import quality_cascade
    return quality_cascade(docs_table(spark, d))


_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_OP3_SQL = f"""
WITH l AS (SELECT doc_id, p, ls[p] AS line, translate(trim(ls[p], {_BL}), '{_UP}', '{_LOW}') AS k
           FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS p
                 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
f AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(f.k)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN f ON l.k = f.k GROUP BY doc_id"""


@query("op3_line_dedup", _OP3_SQL)
def op3_line_dedup(spark, d):
    from pyspark.sql import functions as F

    from penmark.llm.line_dedup import line_dedup
    out = line_dedup(docs_table(spark, d))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_source_mixing")
def op5_source_mixing(spark, d):
    from penmark.llm.source_mixing import mix_sources
    return mix_sources(docs_table(spark, d))


@query("op7_simhash_near_dedup")
def op7_simhash_near_dedup(spark, d):
    from pyspark.sql import functions as F

    from penmark.llm.simhash_pivots import simhash_groups
    out = simhash_groups(docs_table(spark, d))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op9_bpe_round_trip")
def op9_bpe_round_trip(spark, d):
    import public_tokenizers
    from pyspark.sql import functions as F

    from penmark.llm.bpe_speculative import decode_documents, encode_documents
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = decode_documents(encode_documents(docs_table(spark, d).select("doc_id", "text"), path).drop("text"), path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


_OP10_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
n AS (SELECT vec_id, x, sqrt(list_dot_product(x, x)) AS s FROM e),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE CASE WHEN len(a.x) = len(b.x) THEN list_dot_product(a.x, b.x) / (a.s * b.s) END >= 0.9),
r AS (SELECT vec_id AS u, vec_id AS v FROM embeddings UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.u = vec_id)::BIGINT AS n_links, least AS component_id, vec_id = least AS kept
FROM embeddings JOIN (SELECT u, min(v) AS least FROM r GROUP BY u) m ON m.u = vec_id"""


@query("op10_embedding_near_dedup", _OP10_SQL)
def op10_embedding_near_dedup(spark, d):
    from penmark.llm.embedding_tiles import embedding_links
    return embedding_links(docs_table(spark, d, "embeddings"))


_OP1_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS k
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
hit AS (SELECT doc_id, i FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM hit),
word AS (SELECT doc_id, p, w[p] AS x FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM d)),
kept AS (SELECT word.doc_id, count(gone.p) AS n_removed, string_agg(x, ' ' ORDER BY word.p) FILTER (WHERE gone.p IS NULL) AS t
         FROM word LEFT JOIN gone USING (doc_id, p) GROUP BY word.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


@query("op1_substring_dedup", _OP1_SQL)
def op1_substring_dedup(spark, d):
    from pyspark.sql import functions as F

    from penmark.llm.substring_dedup import substring_dedup
    out = substring_dedup(docs_table(spark, d).select("doc_id", "text"))
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_language_id")
def op4_language_id(spark, d):
    from pyspark.sql import functions as F

    from penmark.llm.language_id import held_out, identify, train
    docs = docs_table(spark, d)
    model = train(docs.select("doc_id", "lang", "text").filter(~held_out(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op2_html_extraction")
def op2_html_extraction(spark, d):
    from pyspark.sql import functions as F

    from penmark.llm.html_extract import extract_pages
    return extract_pages(docs_table(spark, d, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def _canon(url: str) -> str:
    """canonical_url in DuckDB's SQL."""
    u = f"regexp_replace(regexp_replace(trim({url}), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
    host = f"regexp_replace(regexp_replace(lower(regexp_extract({u}, '^([^/?]*)', 1)), '^www[.]', ''), ':(80|443)$', '')"
    path = f"regexp_replace(regexp_extract({u}, '^[^/?]*([^?]*)', 1), '/+$', '')"
    params = (f"list_sort(list_filter(string_split(regexp_extract({u}, '[?](.*)$', 1), '&'), lambda p: p <> '' AND NOT "
              "regexp_matches(lower(p), '^(utm_[a-z]+|gclid|fbclid|sessionid|phpsessid)=')))")
    return f"{host} || {path} || CASE WHEN len({params}) > 0 THEN '?' || array_to_string({params}, '&') ELSE '' END"


_OP6_SQL = f"""
WITH p AS (SELECT page_id, {_canon('url')} AS url, '"' || md5(html) || '"' AS tag, 'day ' || (page_id % 28) AS day, strlen(html)::BIGINT AS n, md5(html) AS digest FROM pages),
resp AS (
  SELECT page_id * 10 AS id, url, page_id AS t, CASE WHEN page_id % 5 <> 0 THEN tag END AS etag, CASE WHEN page_id % 3 <> 0 THEN day END AS modified,
    'max-age=60' AS cache, 'text/html' AS kind, 'first' AS stamp, n, digest FROM p
  UNION ALL SELECT page_id * 10 + 4, url, page_id + 1000, '"new"', NULL, NULL, NULL, 'renewed', n, digest FROM p WHERE page_id % 17 = 0),
rev AS (
  SELECT page_id * 10 + 1 AS id, url, page_id + 1440 AS t, CASE WHEN page_id % 7 = 0 THEN '"changed"' ELSE tag END AS etag,
    CASE WHEN page_id % 7 = 0 THEN '"changed"' ELSE 'W/' || tag END AS raw, day AS modified, 'never' AS expires FROM p
  UNION ALL SELECT page_id * 10 + 2, url, page_id - 1, NULL, NULL, NULL, NULL FROM p WHERE page_id % 11 = 0
  UNION ALL SELECT page_id * 10 + 3, url, page_id + 2000, NULL, NULL, NULL, NULL FROM p WHERE page_id % 13 = 0),
j AS (SELECT rev.*, b.id AS bid, b.etag AS betag, b.modified AS bmod, b.cache, b.kind, b.n, b.digest,
        row_number() OVER (PARTITION BY rev.id ORDER BY b.t DESC, b.id DESC) AS k
      FROM rev LEFT JOIN resp b ON b.url = rev.url AND b.t < rev.t),
s AS (SELECT *, CASE WHEN bid IS NULL THEN 'no_response'
        WHEN etag IS NOT NULL AND betag IS NOT NULL THEN CASE WHEN etag = betag THEN 'resolved' ELSE 'mismatch' END
        WHEN modified IS NOT NULL AND bmod IS NOT NULL THEN CASE WHEN modified = bmod THEN 'resolved' ELSE 'mismatch' END
        ELSE 'unverified' END AS status FROM j WHERE k = 1)
SELECT id AS record_id, url, status, CASE WHEN status = 'resolved' THEN bid END AS base_id,
  CASE WHEN status = 'resolved' THEN array_to_string(list_filter([
    'cache-control: ' || cache, 'content-type: ' || kind, 'date: second', 'etag: ' || raw, 'expires: ' || expires, 'last-modified: ' || modified],
    lambda x: x IS NOT NULL), chr(10)) END AS headers,
  CASE WHEN status = 'resolved' THEN n END AS length, CASE WHEN status = 'resolved' THEN digest END AS digest
FROM s"""


@query("op6_warc_revisits", _OP6_SQL)
def op6_warc_revisits(spark, d):
    from penmark.llm.warc_revisit import header_block, records_of_pages, resolve_revisits
    from pyspark.sql import functions as F
    out = resolve_revisits(records_of_pages(docs_table(spark, d, "pages")))
    return out.withColumn("headers", header_block(F.col("headers")))


# CRC-32 (the reflected polynomial 3988292384) of a word's UTF-8 bytes; crct.t is its table of 256 entries.
_CRC_TABLE = """crct AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], list_transform(range(8), lambda z: 0::BIGINT)),
  lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS c FROM (SELECT unnest(range(256)) AS i)))"""


def _crc(x: str) -> str:
    bytes_ = f"list_transform(range(strlen({x})), lambda i: ('0x' || substr(hex(encode({x})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bytes_}), lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295)"


_OP11_SQL = f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
k AS (SELECT w, {_crc('w')} % 10000 AS bucket FROM (SELECT w FROM d UNION SELECT w FROM b), crct),
s AS (SELECT bucket, count(*) AS s FROM d JOIN k USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN k USING (w) GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM d) AS big_s, (SELECT count(*) FROM b) AS big_t),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (big_s + 10000.0::DOUBLE) / ((s + 1.0::DOUBLE) * (big_t + 10000.0::DOUBLE))))::BIGINT AS gain
      FROM s LEFT JOIN t USING (bucket), n),
f AS (SELECT doc_id, count(*)::BIGINT AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight FROM d JOIN k USING (w) JOIN g USING (bucket) GROUP BY doc_id),
r AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
      FROM documents LEFT JOIN f USING (doc_id)),
o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM r WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM o) THEN rank END AS rank FROM r LEFT JOIN o USING (doc_id)"""


@query("op11_importance_resampling", _OP11_SQL)
def op11_importance_resampling(spark, d):
    from penmark.llm.importance_resampling import resample
    return resample(docs_table(spark, d), docs_table(spark, d, "benchmark")).drop("n_words")


_OP12_SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS w
        FROM documents) WHERE length(w) >= 6 GROUP BY doc_id, w),
h AS (SELECT w, n, {_crc("(doc_id || ':' || w)")} AS h FROM d, crct),
v AS (SELECT w, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS w, n FROM h)
      WHERE length(w) >= 6 GROUP BY w HAVING sum(n) >= 5),
c AS (SELECT w, i, substr(w, 1, i - 1) AS p, substr(w, i + 1) AS s FROM (SELECT w, unnest(generate_series(1, length(w))) AS i FROM v)),
e AS (SELECT DISTINCT a.w AS a, b.w AS b FROM c a JOIN c b ON a.p = b.p AND a.s = b.s AND a.w <> b.w
      UNION SELECT c.w, v.w FROM c JOIN v ON v.w = c.p || c.s UNION SELECT v.w, c.w FROM c JOIN v ON v.w = c.p || c.s),
f AS (SELECT a AS word, count(*)::BIGINT AS n_near, min(struct_pack(m := -y.n, w := b)) AS best FROM e JOIN v y ON y.w = b GROUP BY a),
r AS (SELECT v.w AS word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 5 * v.n THEN best.w END AS form,
        CASE WHEN -best.m >= 5 * v.n THEN -best.m END AS form_n FROM v LEFT JOIN f ON f.word = v.w),
z AS (SELECT word, word AS root FROM r WHERE form IS NULL UNION ALL SELECT r.word, z.root FROM z JOIN r ON r.form = z.word)
SELECT r.word, form, root, n, n_near, form_n FROM r JOIN z ON z.word = r.word"""


@query("op12_spelling_variants", _OP12_SQL)
def op12_spelling_variants(spark, d):
    from penmark.llm.spelling_variants import spelling_variants
    return spelling_variants(docs_table(spark, d))


def _op13_sql() -> str:
    from penmark.llm import credential_links as C

    def lit(p):
        return "'" + p.replace("'", "''") + "'"

    def spans(kind, pattern, keep, group=0):
        """The passing matches of a pattern with their places: what stands between the matches gives the starts."""
        gaps = f"string_split_regex(text, {lit(pattern)})"
        return (f"SELECT doc_id, {C.KINDS.index(kind)} AS kind, (list_sum(list_transform(list_slice(g, 1, i), lambda x: length(x)))"
                f" + coalesce(list_sum(list_transform(list_slice(m, 1, i - 1), lambda x: length(x))), 0))::BIGINT AS a, length(m[i]) AS n, v[i] AS v"
                f" FROM (SELECT doc_id, g, m, v, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, {gaps} AS g,"
                f" regexp_extract_all(text, {lit(pattern)}) AS m, regexp_extract_all(text, {lit(pattern)}, {group}) AS v FROM d)) WHERE {keep}")

    def among(col, kinds):
        return f"{col} IN ({', '.join(str(C.KINDS.index(k)) for k in sorted(kinds))})"

    found = [spans("assign", C.ASSIGN, f"length(v[i]) >= {C.LEAST_ASSIGN}", 2), spans("access", C.ACCESS, f"length(v[i]) >= {C.LEAST_ACCESS}"),
             spans("hex", C.HEX, f"length(v[i]) >= {C.LEAST_HEX}"), spans("user", C.USER, "true"),
             spans("short", C.ASSIGN, f"length(v[i]) BETWEEN {C.LEAST_SHORT} AND {C.LEAST_ASSIGN - 1}", 2),
             spans("bare", C.BARE, f"length(v[i]) >= {C.LEAST_BARE}"), spans("url", C.URL, "true"), spans("host", C.HOST, "true")]
    text = f"coalesce(string_agg([{', '.join(lit(k) for k in C.KINDS)}][kind + 1] || ':' || a || ':' || e, ',' ORDER BY a, kind), '')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
p AS (SELECT doc_id, kind, a, a + n AS e, {among('kind', C.STRONG)} AS strong FROM ({' UNION ALL '.join(found)})),
c AS (SELECT p.*, len(regexp_extract_all(substr(text, 1, a::INT), '\\n[ \\t]*\\n')) AS block FROM p JOIN d USING (doc_id)
      WHERE strong OR NOT EXISTS (SELECT 1 FROM p q WHERE q.doc_id = p.doc_id AND q.strong AND q.a < p.e AND q.e > p.a)),
j AS (SELECT s.doc_id, s.a AS sa, s.e AS se, s.kind AS sk, o.a, o.e, o.kind FROM c s JOIN c o ON s.doc_id = o.doc_id AND s.block = o.block
      AND o.a < s.e + {C.REACH} AND o.e > s.a - {C.REACH} WHERE {among('s.kind', C.SECRETS)} AND {among('o.kind', C.IDENTIFIERS | C.ENDPOINTS)}),
f AS (SELECT doc_id, sa, se, sk FROM j GROUP BY ALL HAVING bool_or({among('kind', C.IDENTIFIERS)})
      AND bool_or({among('kind', C.ENDPOINTS)} OR {among('kind', {'access'})} OR {among('sk', {'assign'})})),
w AS (SELECT doc_id, a, e, kind FROM j SEMI JOIN f USING (doc_id, sa, se, sk) UNION SELECT doc_id, sa, se, sk FROM f),
x AS (SELECT doc_id, a, e, kind, strong FROM p WHERE strong UNION ALL SELECT *, false FROM w WHERE NOT {among('kind', C.STRONG)}),
b AS (SELECT doc_id, {text} AS base FROM x WHERE strong GROUP BY doc_id), y AS (SELECT doc_id, {text} AS spans FROM x GROUP BY doc_id),
k AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
        count(*) FILTER (WHERE kind = 2) AS n_hex FROM p GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN k USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN y USING (doc_id)"""


@query("op13_credential_links", _op13_sql())
def op13_credential_links(spark, d):
    from pyspark.sql import functions as F

    from penmark.llm.credential_links import KINDS, secret_spans, spans_text
    out = secret_spans(docs_table(spark, d))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                      spans_text(F.concat("base", "added")).alias("spans"))
