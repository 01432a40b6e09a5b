"""Resolution of WARC revisit records that say "not modified".

A server-not-modified revisit (WARC 1.1, profile ``server-not-modified``) has the headers
of a 304 response and no body. It is resolved by an as-of join: of the full responses
whose canonical URL is the same, the latest that is earlier. The validators must agree
(RFC 9110: entity tags by weak comparison; where one side has none, Last-Modified), and
the stored response's headers are updated with those headers that a 304 may carry.

The join doesn't keep a URL together. Events are dealt by ranges of (URL, time), so that a
URL with a third of all records spans many tasks; a window finds the latest response
within a range, and a second one over one row per URL and range carries it on from the
ranges before. No pair of records is built, and bodies don't move: a response is carried
as its id, headers, length and digest.

Defined results: status is ``resolved``, ``no_response`` (nothing earlier),
``mismatch`` (a validator differs) or ``unverified`` (no validator on both sides); only
resolved records have a base and merged headers. Responses at the same time as the
revisit are not earlier; of responses at the same time the one with the greatest id
counts. Null URLs and null times are never matched (``no_response``). Null or empty headers
are no headers. Other columns are not looked at, repeated revisits are resolved each for
itself, an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penmark.llm.common import fixed, materialise

# Header fields of a 304 response that update the stored ones (RFC 9110, 15.4.5; RFC 9111, 4.3.4).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
# Query parameters that don't change the page.
TRACKING = "^(utm_[a-z]+|gclid|fbclid|sessionid|phpsessid)="


def canonical_url(url: Column) -> Column:
    """One spelling for the URLs of a resource: scheme and www. dropped, host in lower case, no
    default port, fragment, tracking parameter or closing slash, parameters in order."""
    u = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(u, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(u, "^[^/?]*([^?]*)", 1), "/+$", "")
    params = F.array_sort(F.filter(F.split(F.regexp_extract(u, "[?](.*)$", 1), "&"),
                                   lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(F.lit("")))


def header_map(block: Column) -> Column:
    """Header lines ``Name: value`` as a map by lower-case name; the last of equal names counts."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), r"\r?\n"), lambda x: x.rlike("^[^:\\s]+:"))
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.substring_index(x, ":", 1)).alias("k"),
                                                  F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("v")))
    names = F.array_distinct(F.transform(pairs, lambda p: p.k))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(
        n.alias("k"), F.element_at(F.filter(pairs, lambda p: p.k == n), -1).v.alias("v"))))


def merged_headers(stored: Column, update: Column) -> Column:
    """The stored headers with the permitted ones of the 304 in their place, by name."""
    update = F.map_filter(update, lambda k, v: k.isin(PERMITTED))
    return F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(
        F.map_filter(stored, lambda k, v: ~F.map_contains_key(update, k)), update))))


def header_block(headers: Column) -> Column:
    return F.array_join(F.transform(F.map_entries(headers), lambda e: F.concat(e.key, F.lit(": "), e.value)), "\n")


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^[Ww]/", "")


def latest_earlier(events: DataFrame) -> DataFrame:
    """``events`` (url, ts, id, response: a struct for responses, else null) with ``base``: the response
    struct of the latest earlier response of the url, null if there is none."""
    order = [F.col("ts"), F.col("response").isNotNull(), F.col("id")]
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(events.repartitionByRange(tasks, "url", *order).withColumn("part", F.spark_partition_id()), "warc-events")
    before = Window.partitionBy("url", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    near = dealt.withColumn("near", F.last("response", ignorenulls=True).over(before))
    # what a range leaves behind: one row per url and range
    last = dealt.groupBy("url", "part").agg(F.max_by("response", F.when(
        F.col("response").isNotNull(), F.struct("ts", "id"))).alias("last"))
    earlier = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = materialise(last.select("url", "part", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
                          .filter("carried IS NOT NULL"), "warc-carried")
    asked = near.filter("response IS NULL")
    return asked.join(carried, ["url", "part"], "left").select(
        *[c for c in events.columns if c != "response"], F.coalesce("near", "carried").alias("base"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every revisit of ``records``, resolved.

    ``records``: record_id, kind (``response`` or ``revisit``), url, ts, http_status,
    headers (a block of header lines), length and digest of the body. Full responses are
    those of status 200. Returns record_id, url (canonical), status, base_id, headers
    (merged, a map), length and digest (of the base's body).
    """
    response = F.struct(F.col("record_id").alias("id"), "ts", "headers", "length", "digest")
    full = (F.col("kind") == "response") & (F.col("http_status") == 200)
    events = records.filter(full | (F.col("kind") == "revisit")).select(
        canonical_url(F.col("url")).alias("url"), "ts", F.col("record_id").alias("id"),
        F.when(F.col("kind") == "revisit", F.col("headers")).alias("revisit"), F.when(full, response).alias("response"))
    timeless = events.filter("response IS NULL AND (url IS NULL OR ts IS NULL)").drop("response")
    timed = latest_earlier(events.filter("url IS NOT NULL AND ts IS NOT NULL"))
    found = timed.unionByName(timeless, allowMissingColumns=True)
    found = fixed(found, stored=header_map(F.col("base.headers")), update=header_map(F.col("revisit")))
    tags, dates = ([F.element_at(m, n) for m in ("stored", "update")] for n in ("etag", "last-modified"))
    by_tag, by_date = tags[0].isNotNull() & tags[1].isNotNull(), dates[0].isNotNull() & dates[1].isNotNull()
    status = (F.when(F.col("base").isNull(), "no_response")
              .when(by_tag, F.when(_weak(tags[0]) == _weak(tags[1]), "resolved").otherwise("mismatch"))
              .when(by_date, F.when(dates[0] == dates[1], "resolved").otherwise("mismatch")).otherwise("unverified"))
    found = fixed(found, status=status)
    ok = F.col("status") == "resolved"
    return found.select(
        F.col("id").alias("record_id"), "url", "status", F.when(ok, F.col("base.id")).alias("base_id"),
        F.when(ok, merged_headers(F.col("stored"), F.col("update"))).alias("headers"),
        F.when(ok, F.col("base.length")).alias("length"), F.when(ok, F.col("base.digest")).alias("digest"))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """WARC records that a crawl of ``pages`` (page_id, url, html) would hold.

    Each page gives a response at minute page_id and a revisit a day later under another
    spelling of the URL; by remainders of page_id there also are revisits before any
    response, changed entity tags, revisits without validators or with Last-Modified only,
    a second response, and responses that aren't full. Ids: 10 * page_id + a digit.
    """
    p = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    date = F.concat(F.lit("day "), (p % 28).cast("string"))
    pages = fixed(pages.select("page_id", "url", "html"), tag=tag, date=date)

    def record(digit, kind, minute, status, headers, when=None):
        body = F.col("html") if kind == "response" else F.lit("")
        r = F.struct((p * 10 + digit).alias("record_id"), F.lit(kind).alias("kind"),
                     (F.col("url") if kind == "response" else F.regexp_replace("url", "^https?://", "HTTP://")).alias("url"),
                     F.timestamp_seconds(minute * 60).alias("ts"), F.lit(status).alias("http_status"), headers.alias("headers"),
                     F.octet_length(body).cast("long").alias("length"), F.md5(body).alias("digest"))
        return F.when(when, r) if when is not None else r

    def lines(*named):
        return F.concat_ws("\n", *[F.concat(F.lit(n + ": "), v if isinstance(v, Column) else F.lit(v)) for n, v in named])

    stored = lines(("Content-Type", "text/html"), ("ETag", F.when(p % 5 != 0, F.col("tag"))), ("Last-Modified", F.when(p % 3 != 0, F.col("date"))),
                   ("Date", "first"), ("Cache-Control", "max-age=60"))
    again = lines(("etag", F.when(p % 7 == 0, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), F.col("tag")))),
                  ("Last-Modified", F.col("date")), ("Date", "second"), ("Content-Type", "text/plain"), ("Expires", "never"))
    bare = lines(("Date", "early"), ("Server", "x"))
    rows = F.array(record(0, "response", p, 200, stored), record(1, "revisit", p + 1440, 304, again),
                   record(2, "revisit", p - 1, 304, bare, p % 11 == 0), record(3, "revisit", p + 2000, 304, bare, p % 13 == 0),
                   record(4, "response", p + 1000, 200, lines(("ETag", '"new"'), ("Date", "renewed")), p % 17 == 0),
                   record(5, "response", p + 1200, 404, lines(("ETag", '"none"')), p % 19 == 0))
    return pages.select(F.inline(F.filter(rows, lambda r: r.isNotNull())))
