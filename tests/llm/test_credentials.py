"""Credential linking against a plain version, and its edge cases."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from penmark.llm import credential_links as C

KEY = "AKIA" + "ABCD1234EFGH5678"
HEX = "0123456789abcdef"
LONG = "abcdefABCDEF123456"


def plain_base(text):
    out = []
    for kind, p, least in (("assign", re.compile(C.ASSIGN), 12), ("access", re.compile(C.ACCESS), 18), ("hex", re.compile(C.HEX), 16)):
        for m in p.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), kind, m.end()))
    return sorted(out, key=lambda s: (s[0], C.KINDS.index(s[1])))


def plain_added(text, reach=C.REACH):
    text = text or ""
    base = plain_base(text)
    weak = [(m.start(), "short", m.end()) for m in re.finditer(C.ASSIGN, text) if 4 <= len(m[2]) < 12]
    for kind, p, least in (("user", C.USER, 0), ("bare", C.BARE, 32), ("url", C.URL, 0), ("host", C.HOST, 0)):
        weak += [(m.start(), kind, m.end()) for m in re.finditer(p, text) if len(m[0]) >= least]
    weak = [w for w in weak if not any(a < w[2] and e > w[0] for a, _, e in base)]
    parts = [(*s, len(re.findall(r"\n[ \t]*\n", text[:s[0]]))) for s in base + weak]
    out = set()
    for s in parts:
        if s[1] not in C.SECRETS:
            continue
        met = [o for o in parts if o[3] == s[3] and o[0] < s[2] + reach and o[2] > s[0] - reach and o[1] in C.IDENTIFIERS | C.ENDPOINTS]
        kinds = {o[1] for o in met}
        if kinds & C.IDENTIFIERS and (kinds & C.ENDPOINTS or "access" in kinds or s[1] == "assign"):
            out |= {o[:3] for o in [*met, s] if o[1] not in C.STRONG}
    return out


def run(spark, texts, reach=C.REACH):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, row string, kind string")
    named = lambda spans: [(s["start"], C.KINDS[s["kind"]], s["end"]) for s in spans]
    return {r["doc_id"]: (named(r["base"]), set(named(r["added"]))) for r in C.secret_spans(docs, reach=reach).collect()}


@pytest.mark.parametrize("text,base,added", [
    (f"token = \"{LONG}\"", ["assign"], []),
    ("password: short1", [], []),                                        # alone: not reported
    (f"{KEY} password: short1", ["access"], ["short"]),
    ("user: bob password: short1", [], []),                              # two weak parts
    ("user: bob password: short1 https://db.example.org/x", [], ["short", "url", "user"]),
    (f"user: bob secret={LONG}", ["assign"], ["user"]),
    (f"user: bob {HEX}", ["hex"], []),
    (f"login=bob {HEX} host: db1", ["hex"], ["host", "user"]),
    (f"see https://db.example.org secret={LONG}", ["assign"], []),       # no identifier
    (f"{KEY}\n \npassword: short1", ["access"], []),                     # another block
    (f"{KEY} {'far ' * 60} password: short1", ["access"], []),           # out of reach
    (f"{KEY}\n{'Z9' * 20}", ["access"], ["bare"]),
    (f"access_key_id = {KEY}", ["access"], []),                          # covered by the strong one
    ("ToKeN='abc.DEF-1234' toKen=abc", ["assign"], []),
    ("to\u212aen=abcdefabcdef123", [], []),                                   # Kelvin sign is no k
    (f"token=secret:{LONG}", [], []),                                    # consumed by the failing match
    ("AKIAABCDEFGHIJKLM AKIA1234567890ABCD", ["access"], []),
])
def test_rules(spark, text, base, added):
    got = run(spark, [text])[0]
    assert [k for _, k, _ in got[0]] == base and sorted(k for _, k, _ in got[1]) == added
    assert got == (plain_base(text), plain_added(text))


def test_against_plain(spark):
    rnd = random.Random(4)
    bits = [KEY, KEY[:12], f"token={LONG}", "passwd : 'abc12'", "secret=abcd", "API_KEY = \"" + LONG + "\"", HEX, HEX * 3, "username=anna", "login: bob@x.org",
            "https://h.example.com:99/p?q", "host = db-1", "Q" * 40, "\n\n", "\n \t\n", "\n", "é…", "plain words here", "x " * 60]
    texts = [" ".join(rnd.choices(bits, k=rnd.choice([1, 3, 6, 12, 40]))) for _ in range(300)]
    texts += [None, "", " ".join(rnd.choices(bits, k=4000)), f"user=a {KEY} secret=abcd " * 2000, "secret=" + "a" * 3000 + f" user=x {KEY}"]
    for reach in (C.REACH, 30):
        got = run(spark, texts, reach)
        assert got == {i: (plain_base(t), plain_added(t, reach)) for i, t in enumerate(texts)}


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = f"{KEY} password: short1"
    rows = spark.createDataFrame([(1, t), (1, t), (1, "user: bob"), (None, t)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, len(r["base"]), len(r["added"])) for r in C.secret_spans(rows).collect())
    assert got == [(0, 1, 1), (1, 0, 0), (1, 1, 1), (1, 1, 1)]
    assert C.secret_spans(rows.limit(0)).collect() == []


def test_query_digest(spark, tmp_path):
    from penmark.llm.queries import QUERIES
    text = f"é {KEY} x {HEX} password: short1"
    spark.createDataFrame([(5, text)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    r = QUERIES["op13_credential_links"](spark, str(tmp_path)).first()
    want = f"access:2:22,hex:{text.index(HEX)}:{text.index(HEX) + 16}"
    assert (r["n_assign"], r["n_access"], r["n_hex"]) == (0, 1, 1)
    assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    assert r["spans"] == f"{want},short:{text.index('password')}:{len(text)}"
    assert spark.range(1).select(C.spans_text(F.array().cast("array<struct<start:int,kind:int,end:int>>")).alias("s")).first().s == ""
