"""Secret scan and PII against plain expressions; URL filter and quality rules against plain rules and SQL."""

import hashlib
import json
import os
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from wirelens.llm import pii, quality, registry, secrets, url_filter

SECRETS = {
    "assign": (re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[1]) >= 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
}


def plain_secrets(text):
    text = text or ""
    return sorted((m.start(), k, m.end()) for k, (p, keep) in enumerate(SECRETS.values()) for m in p.finditer(text) if keep(m))


def crc_token(prefix, body):
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = chr(secrets.BASE62[r]) + out
    return f"{prefix}_{body}{out}"


def wallet(seed):
    raw = bytes.fromhex("0488ade4") + hashlib.sha512(seed).digest() + b"x" * 10
    raw = raw[:78] + hashlib.sha256(hashlib.sha256(raw[:78]).digest()).digest()[:4]
    n, out = int.from_bytes(raw, "big"), ""
    while n:
        n, r = divmod(n, 58)
        out = chr(secrets.BASE58[r]) + out
    return out


def test_secrets_equal_plain_expressions(spark):
    r = random.Random(3)
    bits = ["password", "PassWd", "=", ":", " ", '"', "token", "api_key", "APIKEY", "secret", "AKIA", "A1B2C3D4E5F6", "deadbeef", "0123456789abcdef", "é", "漢", "\n", "x", "ſecret", "toKen", "passwordpassword=abcdefgh"]
    texts = [None, "", "a" * 100_000, "f" * 50_000, *["".join(r.choice(bits) for _ in range(r.randint(1, 40))) for _ in range(400)]]
    rows = spark.createDataFrame([(None if i == 7 else i, t, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, spans string, kind int")
    got = secrets.scan(rows).collect()
    assert len(got) == len(texts)
    names = list(SECRETS)
    for r_, t in zip(sorted(got, key=lambda x: 7 if x["doc_id"] is None else x["doc_id"]), texts, strict=True):
        base = [(s["start"], names.index(s["kind"]), s["end"]) for s in r_["spans"] if s["kind"] in names]
        assert base == plain_secrets(t), t


def test_checksums(spark):
    good, npm, key = crc_token("ghp", "a1B2" * 7 + "zz"), crc_token("npm", "Zz09" * 7 + "aa"), wallet(b"seed")
    assert len(key) == 111
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    text = f"é {good} and {bad} then {npm} or {key} not {key[:-1]}x"
    got = [(s["kind"], text[s["start"] : s["end"]]) for s in secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["spans"]]
    assert got == [("forge", good), ("registry", npm), ("wallet", key)]
    spans = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["spans"]
    assert secrets.redact(text, spans).count("[SECRET]") == 3


def test_recall_of_checksummed_kinds_in_running_text(spark):
    """Tokens of every checksummed kind planted in the tables' texts, each beside a copy with one character changed: all of the first are found, none of the second."""
    r = random.Random(11)
    texts = [x["text"] or "" for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(120).collect()]
    letters = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    made, docs = [], []
    for i, text in enumerate(texts):
        body = "".join(r.choice(letters) for _ in range(30))
        token = crc_token(r.choice(("ghp", "gho", "ghu", "ghs", "ghr", "npm")), body) if i % 3 else wallet(bytes([i]))
        wrong = token[:10] + ("a" if token[10] != "a" else "b") + token[11:]
        at, to = sorted((r.randrange(len(text) + 1), r.randrange(len(text) + 1)))
        made.append(token)
        docs.append((i, f"{text[:at]} {token} {text[at:to]} ({wrong}) {text[to:]}"))
    for x in secrets.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        text = docs[x["doc_id"]][1]
        found = [text[s["start"] : s["end"]] for s in x["spans"] if s["kind"] in ("forge", "registry", "wallet")]
        assert found == [made[x["doc_id"]]]


def test_secret_edges(spark):
    docs = spark.createDataFrame([(None, "token = abcdefgh12", "x"), (1, "token = abcdefgh12", "x"), (1, "token = abcdefgh12", "x"), (2, None, "x"), (3, "", "x")], "doc_id long, text string, spans string")
    assert sorted((r["doc_id"] or 0, len(r["spans"])) for r in secrets.scan(docs).collect()) == [(0, 1), (1, 1), (1, 1), (2, 0), (3, 0)]
    assert secrets.scan(docs.where("false")).count() == 0


PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def holds(kind, value):
    d = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
    return 10 <= len(d) <= 15 if kind == "phone" else True


def test_pii_equals_plain_expressions(spark):
    r = random.Random(5)
    bits = ["a", "b.c", "@", ".", "x-y", "+1", " ", "(", ")", "555", "4111111111111111", "4111 1111 1111 1111", "255", "256.1.1.1", "1.2.3.4", "007", "-", "_", "é", "漢", "+44 20 7946 0958", "x@y.z", "\n", "%"]
    texts = [None, "", "1" * 30_000, "a" * 60_000, "1 " * 5_000, "+1" * 3_000, *["".join(r.choice(bits) for _ in range(r.randint(1, 25))) for _ in range(400)]]
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    for got in pii.find(rows).collect():
        t = texts[got["doc_id"]] or ""
        want = sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(PLAIN.items()) for m in p.finditer(t) if holds(kind, m[0])) if len(t) < 20_000 else None
        base = [(s["start"], s["k"], s["end"]) for s in got["spans"] if s["k"] < 4]
        assert want is None or base == want, t


def test_pii_loose_spans_and_redaction(spark):
    text = "my ssn 123-45-6789, call 212-555-0187 or joe [at] mail [dot] com; order 123-456-7890, version 123 456 789"
    rows = spark.createDataFrame([(1, text, 9, "k"), (2, None, 0, "k"), (3, "clean text", 10, "k")], "doc_id long, text string, n_chars long, row string")
    found = {r["doc_id"]: [pii.KINDS[s["k"]] for s in r["spans"]] for r in pii.find(rows).collect()}
    assert found[1] == ["ssn", "tel", "at"] and found[2] == found[3] == []
    out = {r["doc_id"]: r for r in pii.redact(rows).collect()}
    assert pii.redact(rows).columns == rows.columns
    assert out[1]["text"].startswith("my ssn [SSN], call [TEL] or [AT];") and out[2]["text"] is None and out[3]["text"] == "clean text"
    assert out[1]["n_chars"] == len(out[1]["text"])


def test_pii_plan_is_native(spark):
    plan = pii.find(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_url_filter_rules(spark):
    urls = [None, "", "no scheme", "http://A.Example.COM/en/7x?q", "https://x.net/de/", "https://b.example.net/de/8", "https://q.org/es/1", "https://spam-farm.example.org", "https://m.spam-farm.example.org?x", "https://notspam-farm.example.org/", "a://b://c/d", "https://h/p#f"]
    pages = spark.createDataFrame([(i, u, "k", "w") for i, u in enumerate(urls)], "page_id long, url string, key string, word string")
    got = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
    assert [(got[i]["rule"], got[i]["verdict"]) for i in range(len(urls))] == [
        (None, "allow"), (None, "allow"), (None, "allow"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"),
        ("org/es/", "block"), (None, "block"), (None, "block"), (None, "allow"), (None, "allow"), (None, "allow"),
    ]
    assert (got[3]["host"], got[3]["path"], got[0]["host"], got[11]["path"]) == ("a.example.com", "/en/7x", "", "/p")


def test_cascade_is_exact(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS_A_KEY", 2)  # many false positives, many levels
    r = random.Random(1)
    hosts = [f"h{i}.d{i % 50}.com" for i in range(2000)]
    listed = set(r.sample(hosts, 300)) | {"d7.com"}
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate(hosts)], "page_id long, url string")
    blocked = spark.createDataFrame([(h,) for h in sorted(listed)] + [(None,), ("",), ("d7.com",), ("never.seen",)], "key string")
    want = {i for i, h in enumerate(hosts) if h in listed or h.split(".", 1)[1] in listed}
    got = {x["page_id"] for x in url_filter.judge(pages, (), blocked).where("verdict = 'block'").collect()}
    assert got == want
    monkeypatch.setattr(url_filter, "BITS_A_KEY", 10)
    monkeypatch.setattr(url_filter, "MAX_BITS", 1024)  # several blocks, some of which do not fit at first
    assert {x["page_id"] for x in url_filter.judge(pages, (), blocked).where("verdict = 'block'").collect()} == want
    assert url_filter.judge(pages.where("false"), (), blocked).count() == 0


def test_url_edges_and_plan(spark):
    """Repeated pages and rules of equal length (the later one in order of host wins); the plan runs no Python and has no join."""
    pages = spark.createDataFrame([(None, "http://a.b/x"), (1, "http://a.b/x"), (1, "http://a.b/x"), (2, "http://c.b/x")], "page_id long, url string")
    got = url_filter.judge(pages, (("block", "b", "/xx"), ("allow", "a.b", "/"), ("block", "a.b", "/x"), ("block", "b", "/x")), spark.createDataFrame([], "key string"))
    assert sorted((r["page_id"] or 0, r["rule"], r["verdict"]) for r in got.collect()) == [(0, "a.b/x", "block"), (1, "a.b/x", "block"), (1, "a.b/x", "block"), (2, "b/x", "block")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow|Join", plan)


def test_quality_cases(spark):
    texts = [None, "", "word " * 60, "\n".join(f"line{i} of{i} text{i} with{i} words{i}" for i in range(20)), "A" * 200_000, " ".join(f"w{i}***" for i in range(80)), "\n".join(["the same line again and again"] * 5 + [f"other {i} words here now" for i in range(30)])]
    docs = spark.createDataFrame([(None if i == 3 else i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, kept string")
    got = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert [got[i]["kept"] for i in (0, 1, 2, None, 4, 5)] == [False, False, False, True, False, False]
    assert got[2]["n_repeat_words"] == 60 and got[6]["n_dup_lines"] == 4 and got[5]["n_symbols"] == 240
    assert quality.judge(docs.where("false")).count() == 0


def test_cascade_order_is_by_rejection_per_cost():
    rules = {"slow": lambda d: [sum(range(20_000)), True][1], "never": lambda d: False, "fast": lambda d: True}
    assert quality.cascade_order(quality.measure(["x"] * 50, rules)) == ["fast", "slow", "never"]


def test_listed_counts_cost_a_rule_nothing():
    text = ["a b c " * 20_000] * 5
    free, priced = quality.measure(text)["repeated_windows"][1], quality.measure(text, listed=())["repeated_windows"][1]
    assert free * 10 < priced


def test_quality_filter_equals_verdicts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.unionAll(docs.limit(20)).withColumn("kept", F.lit("clash"))
    want = sorted((r["doc_id"]) for r in quality.judge(docs).where("kept").collect())
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == want
    assert quality.keep_good(docs.where("false")).count() == 0


def test_url_filter_blocks_every_junk_host(spark, sf):
    from wirelens.llm.common import table

    junk = r"(^|\.)(cheap-pills|spam-farm|adult-x|free-bets|casino-win|ads-track)\.example\.(com|net|org)$"
    assert url_filter.blocklist(spark).distinct().count() == url_filter.LISTED_DOMAINS
    for d in (sf, "/root/testdata/sf0.01"):
        host = {r["page_id"]: r["host"] for r in url_filter.op9_url_filters(spark, d).where("rule is null and verdict = 'block'").collect()}
        want = {r["page_id"] for r in url_filter.judge(table(spark, d, "pages")).where("rule is null").collect() if re.search(junk, r["host"])}
        assert want and set(host) == want


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, sf, name):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.sql(f"create view {f[:-8]} as select * from '{sf}/{f}'")
    got, want = registry.queries()[name](spark, sf), c.sql(registry.oracle_sql()[name])
    cols = sorted(got.columns)
    # rows as they come: pandas would make floats of whole numbers where some are null
    plain = lambda names, rows: sorted(json.dumps([None if (v := r[names.index(n)]) is None or v != v else str(v) for n in cols]) for r in rows)
    assert cols == sorted(want.columns) and plain(got.columns, got.collect()) == plain(want.columns, want.fetchall())


def test_spans_columns(spark, sf):
    got = secrets.op1_secret_scans(spark, "/root/testdata/sf0.01").where("n_hex > 0").first()
    assert got["base_sha256"] == hashlib.sha256(",".join(s for s in got["spans"].split(",") if s.split(":")[0] in SECRETS).encode()).hexdigest()
    assert pii.op8_pii(spark, sf).where(F.col("base_sha256") == hashlib.sha256(b"").hexdigest()).where("n_email + n_ip + n_card + n_phone > 0").count() == 0
