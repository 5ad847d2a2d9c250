"""Secret scan: keyword prefilter, anchored expressions, embedded checksums.

1. An Aho-Corasick automaton finds the keywords of all kinds in the text,
   letters A-Z taken as lower case.  Long hexadecimal runs have no keyword;
   for them the text is mapped to character classes, and the keyword is a run
   of 32 class symbols.
2. Each kind's expression is tried only at its keyword hits, anchored there.
   Hits are taken from the left and a hit inside the previous match of its
   kind is passed over, which gives the leftmost non-overlapping matches.
3. Kinds that carry a checksum are kept only where it holds: the last six
   base-62 digits of a token are the CRC-32 of its body, and the last four
   bytes of an extended private key are a double SHA-256 of the rest.

The scan works on UTF-8 bytes and turns the few match positions into code
points.  Defined cases: a null text is empty; a null doc_id is kept; repeated
rows are scanned alike; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import id_and_text, map_rows, spans_sql, table

BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
HEX_RUN = 32


def crc_token_holds(token: bytes) -> bool:
    """prefix, underscore, 30 characters, CRC-32 of those as six base-62 digits."""
    body, check = token[4:34], token[34:]
    got = 0
    for c in check:
        got = got * 62 + BASE62.index(c)
    return got == zlib.crc32(body)


def base58_holds(key: bytes) -> bool:
    """Base58Check: the last four bytes are the double SHA-256 of the others."""
    n = 0
    for c in key:
        n = n * 58 + BASE58.index(c)
    raw = n.to_bytes(82, "big") if n >> 656 == 0 else b""
    return len(raw) == 82 and hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


class Kind:
    def __init__(self, name: str, keywords: tuple[str, ...], pattern: bytes, keep: Callable[[re.Match], bool]):
        self.name, self.keywords, self.pattern, self.keep = name, keywords, re.compile(pattern), keep


_ANY_CASE = rb"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"

#: In the order in which kinds of one start are listed; the first three are the base.
KINDS = (
    Kind("assign", ("password", "passwd", "secret", "token", "api_key", "apikey"), _ANY_CASE + rb"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 8),
    Kind("access", ("akia",), rb"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    Kind("hex", (), rb"[0-9a-f]+", lambda m: len(m[0]) >= HEX_RUN),
    Kind("forge", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])", lambda m: crc_token_holds(m[0])),
    Kind("registry", ("npm_",), rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])", lambda m: crc_token_holds(m[0])),
    Kind("wallet", ("xprv",), rb"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])", lambda m: base58_holds(m[0])),
)
BASE = 3
_HEX_CLASS = bytes(ord("h") if chr(c) in "0123456789abcdef" else 32 for c in range(256))


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for k, kind in enumerate(KINDS):
        for word in kind.keywords:
            found.add_word(word, (k, len(word)))
    found.make_automaton()
    return found


def spans_of(text: str | None, words) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every match, in code points, in order."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    found: list[tuple[int, int, int]] = []
    last = [0] * len(KINDS)
    hits = sorted((end + 1 - size, k) for end, (k, size) in words.iter(raw.lower().decode("latin-1")))
    for start, k in hits:
        if start >= last[k] and (m := KINDS[k].pattern.match(raw, start)):
            last[k] = m.end()
            if KINDS[k].keep(m):
                found.append((start, k, m.end()))
    classes, run, at = raw.translate(_HEX_CLASS), b"h" * HEX_RUN, 0
    while (at := classes.find(run, at)) >= 0:
        m = KINDS[2].pattern.match(raw, at)
        found.append((at, 2, m.end()))
        at = m.end()
    found.sort()
    if len(raw) == len(text):
        return found
    points, seen, count = {}, 0, 0
    for p in sorted({x for s, _, e in found for x in (s, e)}):
        count += len(raw[seen:p].decode("utf-8", "surrogatepass"))
        points[p], seen = count, p
    return [(points[s], k, points[e]) for s, k, e in found]


def join_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k].name}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and spans: array of (kind, start, end) of every secret; narrow, no shuffle."""

    def make():
        words = automaton()
        return lambda rows: {"doc_id": rows["doc_id"], "spans": [[{"kind": KINDS[k].name, "start": s, "end": e} for s, k, e in spans_of(t, words)] for t in rows["text"]]}

    return map_rows(id_and_text(docs), make, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def redact(text: str | None, spans, mark: str = "[SECRET]") -> str | None:
    """The text with every span replaced; overlapping spans share one mark."""
    if not text or not spans:
        return text
    out, at = [], 0
    for s, e in sorted((s["start"], s["end"]) for s in spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    got = scan(table(spark, sf_dir, "documents"))
    names = [k.name for k in KINDS[:BASE]]
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return got.select("doc_id", *[of(n).alias(f"n_{n}") for n in names], F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(*names))), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


_ASSIGN_SQL = _ANY_CASE.decode().replace("(?:", "(", 1) + r"""["\x27]?\x20*[:=]\x20*["\x27]?([A-Za-z0-9+/_.=-]+)"""
#: The base kinds; SQL has no checksums, so this is the whole result where no checksummed kind occurs, as in the test tables.
ORACLE = spans_sql(
    [
        ("assign", _ASSIGN_SQL, f"length(regexp_extract(v, '{_ASSIGN_SQL}', 2)) >= 8", r"""[dDtTnNyY]["\x27]?\x20*[:=]"""),
        ("access", "AKIA[A-Z0-9]+", "length(v) >= 16", "AKIA"),
        ("hex", "[0-9a-f]{32,}", "true", "[0-9a-f]{32}"),
    ]
)
