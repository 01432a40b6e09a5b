"""Secret scans with multipart credential linking.

One scan of a text finds its parts: strong ones, which are reported wherever they stand (labelled
values, access identifiers, long hex strings), and weak ones, which alone are mostly harmless:
user names, short or bare values, addresses. Weak parts are candidates only. A credential takes
several parts, so they are linked: around every secret, strong or weak, lies a scope, ``REACH``
code points to either side within its block (lines not parted by a blank line). An interval join
brings identifiers and endpoints to the scopes they overlap. A scope is complete if it holds an
identifier, and the secret is a strong labelled one, or the identifier is strong, or there is an
endpoint as well. The weak parts of complete scopes are reported, all other weak parts are not.

The texts are read once and not exchanged. Parts leave a task only for documents that hold a weak
part, an identifier and a secret. The join runs on (row, bin of ``REACH`` code points), so parts of
one very long document are dealt out, too; a bin holds no more parts than fit into it.

Defined results: a null text counts as empty and has no spans; each row has its own result, also
where ids repeat or are null; an empty table gives an empty table. Columns other than the id and
the text are not looked at. Spans count code points, the end is exclusive. Spans of different kinds
may overlap; a weak part that overlaps a strong one is no candidate.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penmark.llm.common import materialise

REACH = 200
LEAST_ASSIGN, LEAST_SHORT, LEAST_ACCESS, LEAST_HEX, LEAST_BARE = 12, 4, 18, 16, 32


def either_case(words: str) -> str:
    """A pattern's ASCII letters in either case (plain case folding would also match other alphabets' letters)."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


# Fixed values of the base: the labels, and the characters of the values.
_IS = r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN = "(" + either_case("password|passwd|secret|token|api_?key") + ")" + _IS + "([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
# Weak parts.
USER = "(" + either_case("access_?key_?id|client_?id|key_?id|account_?id|user_?name|user|login") + ")" + _IS + "([A-Za-z0-9@._-]+)"
BARE = "[A-Za-z0-9+/]+"
URL = r"""[a-z][a-z0-9+.-]*://[^\x20\x09-\x0D"'<>]+"""
HOST = "(" + either_case("host|hostname|server|endpoint") + ")" + _IS + "([A-Za-z0-9._:/-]+)"

# The kinds in the order they are listed in.
KINDS = ["assign", "access", "hex", "user", "short", "bare", "url", "host"]
STRONG = {"assign", "access", "hex"}
IDENTIFIERS, SECRETS, ENDPOINTS = {"access", "user"}, {"assign", "hex", "short", "bare"}, {"url", "host"}
BLANK_LINE = re.compile(r"\n[ \t]*\n")

# Only lengths that pass are matched where that finds the same spans (maximal runs of a class).
_PATTERNS = {"access": re.compile(f"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4},}}"), "hex": re.compile(f"[0-9a-f]{{{LEAST_HEX},}}"),
             "user": re.compile(USER), "bare": re.compile(f"[A-Za-z0-9+/]{{{LEAST_BARE},}}"), "url": re.compile(URL), "host": re.compile(HOST)}
_ASSIGN = re.compile(ASSIGN)


def find_parts(text: str) -> tuple[list[tuple], list[tuple]]:
    """The strong spans (start, kind, end) and the weak parts of a text, kinds as their places in ``KINDS``."""
    found = {k: [m.span() for m in p.finditer(text)] for k, p in _PATTERNS.items()}
    found["assign"], found["short"] = [], []
    for m in _ASSIGN.finditer(text):
        n = m.end(2) - m.start(2)
        if n >= LEAST_SHORT:
            found["assign" if n >= LEAST_ASSIGN else "short"].append(m.span())
    spans = sorted((a, k, b) for k, kind in enumerate(KINDS) for a, b in found[kind])
    strong = [s for s in spans if KINDS[s[1]] in STRONG]
    starts = [a for a, _, _ in strong]
    ends = np.maximum.accumulate([b for _, _, b in strong]) if strong else []

    def covered(a: int, b: int) -> bool:
        n = np.searchsorted(starts, b)   # strong spans that begin before b
        return n > 0 and ends[n - 1] > a

    return strong, [s for s in spans if KINDS[s[1]] not in STRONG and not covered(s[0], s[2])]


def scan(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(row, id, base, parts) for every row: the strong spans, and all parts with their blocks where links are possible."""
    id_type = docs.schema[id_col].dataType.simpleString()
    kinds = [{KINDS.index(k) for k in x} for x in (IDENTIFIERS, SECRETS)]
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    part = pa.struct([*span, ("block", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, parts = [], []
            for x in b.column(2):
                text = x.as_py() or ""
                strong, weak = find_parts(text)
                base.append([dict(zip(("start", "kind", "end"), s)) for s in strong])
                every = strong + weak if weak and all(any(s[1] in k for s in strong + weak) for k in kinds) else []
                blanks = [m.start() for m in BLANK_LINE.finditer(text)] if every else []
                parts.append([{"start": a, "kind": k, "end": e, "block": int(np.searchsorted(blanks, a))} for a, k, e in every])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(base, pa.list_(span)), pa.array(parts, pa.list_(part))],
                                             names=["row", "id", "base", "parts"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"row long, id {id_type}, base array<struct<start:int,kind:int,end:int>>, "
                                "parts array<struct<start:int,kind:int,end:int,block:int>>")


def _kind(col: str, kinds: set[str]) -> Column:
    return F.col(col).isin([KINDS.index(k) for k in kinds])


def link(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """(row, start, kind, end): the weak ones of ``parts`` (row, start, kind, end, block) that belong to complete scopes."""
    def bins(lo: Column, hi: Column) -> Column:
        return F.explode(F.sequence(F.floor(lo / reach), F.floor((hi - 1) / reach))).alias("bin")

    lo, hi = F.col("start") - reach, F.col("end") + reach
    scopes = parts.filter(_kind("kind", SECRETS)).select(
        "row", "block", F.col("start").alias("s_start"), F.col("kind").alias("s_kind"), F.col("end").alias("s_end"),
        lo.alias("lo"), hi.alias("hi"), bins(lo, hi))
    others = parts.filter(_kind("kind", IDENTIFIERS | ENDPOINTS)).select("row", "block", "start", "kind", "end", bins(F.col("start"), F.col("end")))
    met = scopes.join(others, ["row", "bin", "block"]).filter((F.col("start") < F.col("hi")) & (F.col("end") > F.col("lo")))
    # a pair meets in every bin that both touch; the first of these counts
    met = met.filter(F.col("bin") == F.floor(F.greatest("lo", "start") / reach)).drop("bin")
    met = materialise(met, "credential-pairs")
    scope = ["row", "s_start", "s_kind", "s_end"]
    strong = _kind("s_kind", {"assign"}) | _kind("kind", {"access"})
    has = met.groupBy(*scope).agg(F.max(_kind("kind", IDENTIFIERS)).alias("identifier"),
                                  F.max(_kind("kind", ENDPOINTS) | strong).alias("backed"))
    complete = materialise(has.filter("identifier AND backed").select(*scope), "credential-scopes")
    weak = ~_kind("kind", STRONG)
    secrets = complete.select("row", F.col("s_start").alias("start"), F.col("s_kind").alias("kind"), F.col("s_end").alias("end"))
    return met.join(complete, scope, "left_semi").select("row", "start", "kind", "end").unionByName(secrets).filter(weak).distinct()


def spans_text(spans: Column) -> Column:
    """kind:start:end of spans, by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", reach: int = REACH) -> DataFrame:
    """(id, base, added) for every row of ``docs``: arrays of spans (start, kind, end), kind an index of ``KINDS``."""
    found = materialise(scan(docs, id_col), "credential-parts")
    parts = found.select("row", F.inline("parts"))
    added = link(parts, reach).groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return found.join(added, "row", "left").select(F.col("id").alias(id_col), "base", F.coalesce("added", none).alias("added"))
