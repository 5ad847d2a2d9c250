"""Periodic runs of words, by Lyndon arrays.

A run is a stretch of consecutive words with smallest period q, of a least
length and at least ``powers`` times q long, that no neighbouring word extends
with that period.

1. Words are numbered within their document; nothing is compared by
   fingerprint, so equality is exact.
2. Every word of a run occurs ``powers`` times in it and, but for the last two,
   starts three words that occur nearly as often.  Stretches of words for which
   that holds are found for many documents at once; they hold every run with
   its neighbours' verdicts, and only they go on.
3. Each stretch gets its Lyndon array twice, for the order of the numbers and
   for its reverse: from left to right, every word's next smaller suffix is
   found on the chain of smaller ones before it.  How far two suffixes agree is
   taken from comparisons made before: from the two links of the suffix just
   passed where they differ in length, and else from the same comparison in the
   earlier copy of the match that reaches farthest to the right.  Only words
   beyond that match are looked at anew, so each word is matched once an order
   and the time is linear.  There are no suffix arrays or trees and no hashes.
4. By the runs theorem each run starts with less than a period before the
   Lyndon word of one of the two orders that repeats in it; the agreement of the
   two suffixes gives its end.

All of it is narrow: one pass over documents, no exchange.

Defined cases: null and empty texts have no words and no runs; a row without a
doc_id is a row like others (the digest of its id is that of empty text, which
matters to ``repeat_tail`` alone); repeated rows give repeated rows; extra
columns are not read; a text is taken whole, whatever its length.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


class Rule(NamedTuple):
    """Least words of a run, and least length in periods (two or more)."""

    least: int = 6
    powers: int = 4


class Run(NamedTuple):
    start: int
    length: int
    period: int


Change = Callable[[int | None, list[bytes]], list[bytes]]

#: Bytes of text whose words are looked at together; a longer text is alone.
SLICE = 4_000_000


def lyndon(s: list[int]) -> tuple[list[int], list[int]]:
    """For each place the next smaller suffix (the length where there is none), and how many words the two share."""
    n = len(s)
    after, after_lce = [n] * n, [0] * n
    before, before_lce = [-1] * n, [0] * n
    a = b = x = 0  # s[a : a + x - b] equals s[b:x], and x is the farthest that a match has reached
    for i in range(1, n):
        j, e = i - 1, 0
        while True:
            known = False
            if i + e < x:
                earlier, other = i - b + a, j - b + a if j >= b else j
                v = after_lce[other] if after[other] == earlier else before_lce[earlier] if before[earlier] == other else -1
                if v >= 0:
                    known = i + v < x
                    e = v if known else max(e, x - i)
            if not known:
                k, m = j + e, i + e
                while m < n and s[k] == s[m]:
                    k += 1
                    m += 1
                e = m - i
                if m > x:
                    a, b, x = j, i, m
            if i + e < n and s[j + e] < s[i + e]:
                before[i], before_lce[i] = j, e
                break
            # the suffix at i is smaller than the one at j, and with it than all before j that share more with j than e
            shared = e
            while True:
                after[j], after_lce[j] = i, e
                shared, j = before_lce[j], before[j]
                if j < 0 or shared <= e:
                    break
            if j < 0:
                break
            if shared < e:
                before[i], before_lce[i] = j, shared
                break
    return after, after_lce


def runs_of(s: list[int], rule: Rule = Rule()) -> list[Run]:
    """The runs of a sequence of numbers, by start, then period."""
    n, found = len(s), set()
    for order in (s, [-c for c in s]):
        after, lce = lyndon(order)
        for i in range(n):
            p, e = after[i] - i, lce[i]
            if e <= (rule.powers - 2) * p:
                continue
            if i >= p and after[i - p] == i and lce[i - p] >= p:
                continue  # the word stands once more before
            left = 0
            while left < i and s[i - left - 1] == s[i + p - left - 1]:
                left += 1
            run = Run(i - left, left + p + e, p)
            if run.length >= max(rule.least, rule.powers * p):
                found.add(run)
    return sorted(found, key=lambda r: (r.start, r.period))


def _often(keys: np.ndarray, least: int) -> np.ndarray:
    """Whether each key is there so many times."""
    _, back, count = np.unique(keys, return_inverse=True, return_counts=True)
    return count[back] >= least


def stretches(code: np.ndarray, first: np.ndarray, rule: Rule = Rule()) -> Iterator[tuple[int, int]]:
    """(from, to) of stretches that hold all runs of documents.

    ``code`` numbers the words, differently in each document; ``first`` has
    each document's first place and then the number of words.
    """
    if rule.powers < 3:  # such runs may be shorter than three words
        yield from ((a, b) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True) if a < b)
        return
    least = max(rule.least, rule.powers)
    often = np.bincount(code, minlength=1)[code] >= rule.powers
    at = np.flatnonzero(often[:-2] & often[1:-1] & often[2:]) if len(code) > 2 else np.empty(0, np.int64)
    doc = np.searchsorted(first, at, "right")
    same = doc == np.searchsorted(first, at + 2, "right")
    at, doc = at[same], doc[same]
    need = min(rule.powers - 1, least - 2)
    part = doc
    while len(at):
        # places of one stretch follow each other within a document
        part = np.cumsum(np.concatenate(([True], (at[1:] != at[:-1] + 1) | (part[1:] != part[:-1]))))
        long = np.bincount(part)[part] >= least - 2
        at, part = at[long], part[long]
        if not len(at) or need < 2:
            break
        big = len(code) + 1
        pair = np.unique(code[at].astype(np.int64) * big + code[at + 1], return_inverse=True)[1]
        three = np.unique(pair * big + code[at + 2], return_inverse=True)[1]
        keep = _often(three * big + part, need)
        if keep.all():
            break
        at, part = at[keep], part[keep]
    if len(at):
        cut = np.flatnonzero(np.diff(part)) + 1
        for lo, hi in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(at)])), strict=True):
            yield int(at[lo]), int(at[hi - 1]) + 3


def runs_in(texts: list[list[bytes]], rule: Rule = Rule()) -> list[list[Run]]:
    """The runs of each list of words."""
    codes, first = [], [0]
    top = 0
    for words in texts:
        number = dict(zip(dict.fromkeys(words), range(top, top + len(words)), strict=False))
        top += len(number)
        codes += map(number.__getitem__, words)
        first.append(len(codes))
    code, ends = np.array(codes, np.int64), np.array(first)
    found: list[list[Run]] = [[] for _ in texts]
    for lo, hi in stretches(code, ends, rule):
        doc = int(np.searchsorted(ends, lo, "right")) - 1
        found[doc] += [Run(r.start + lo - first[doc], r.length, r.period) for r in runs_of(codes[lo:hi], rule)]
    return [sorted(f, key=lambda r: (r.start, r.period)) for f in found]


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words less those that a run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        drop[r.start + r.period] += 1
        drop[r.start + r.length] -= 1
    return [w for w, d in zip(words, np.cumsum(drop[:-1]).tolist(), strict=True) if not d]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def find_runs(docs: DataFrame, rule: Rule = Rule(), change: Change | None = None) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed (the kept words, joined by a blank) of every document.

    ``change`` may replace a document's words before they are searched.
    """

    def work(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        words = [t.split() for t in texts]  # bytes split at the six ASCII blanks only
        if change:
            words = [change(i, w) for i, w in zip(ids, words, strict=True)]
        found = runs_in(words, rule)
        kept = [b" ".join(collapse(w, r)).decode("utf-8", "surrogatepass") for w, r in zip(words, found, strict=True)]
        runs = [[r._asdict() for r in f] for f in found]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(w) for w in words], pa.int64()), pa.array(runs, _OUT.field("runs").type), pa.array(kept, pa.string())], schema=_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
                raw = t.as_py() or b""
                if texts and size + len(raw) > SLICE:
                    yield work(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(i.as_py())
                texts.append(raw)
                size += len(raw)
            if texts:
                yield work(ids, texts)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """For a tenth of the documents: the words from a place on repeat those behind it with a period, both given by the id."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (1 + (n - a) // p))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(table(spark, sf_dir, "documents"), change=repeat_tail)
    # the greatest exact ratio: cross products decide, and of equal ones the first in order stays
    best = F.aggregate(F.slice("runs", 2, 1 << 30), F.get("runs", F.lit(0)), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    shown = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.expr("b.length * 1000 div b.period")
    return shown.select("doc_id", "n_runs", F.col("b.start").alias("start"), F.col("b.length").alias("length"), F.col("b.period").alias("period"), milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


#: Pairs of equal word triples give the stretches of each period; crc32 is worked out bit by bit.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS o, coalesce(doc_id::VARCHAR, '') AS t FROM documents
), c AS (
  SELECT rid, len(o) AS n, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(list_filter(string_split(t, ''), lambda x: x <> ''), lambda x: ascii(x)::UBIGINT)),
    lambda u, b: list_reduce(list_prepend(xor(u, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END)), 4294967295::UBIGINT)::BIGINT AS h FROM d
), g AS (SELECT *, (h // 10) % n AS a FROM c WHERE n > 0),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM g),
x AS MATERIALIZED (SELECT rid, unnest(range(len(o))) AS i, unnest(o) AS w FROM d),
w AS MATERIALIZED (
  SELECT rid, i, w FROM x JOIN p USING (rid) WHERE h % 10 <> 0
  UNION ALL SELECT x.rid, x.i, y.w FROM x JOIN p USING (rid) JOIN x y ON y.rid = x.rid AND y.i = CASE WHEN x.i < a THEN x.i ELSE a + (x.i - a) % p END WHERE h % 10 = 0
), l AS (SELECT rid, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
m AS MATERIALIZED (SELECT rid, i, dense_rank() OVER (ORDER BY w, w2, w3) AS k FROM l WHERE w3 IS NOT NULL),
e AS (SELECT m.rid, m.i, y.i - m.i AS q FROM m JOIN m y ON y.rid = m.rid AND y.k = m.k AND y.i > m.i JOIN c ON c.rid = m.rid WHERE 4 * (y.i - m.i) <= n),
s AS (SELECT rid, q, min(i) AS start, count(*) + 2 + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM e) GROUP BY rid, q, island),
r AS MATERIALIZED (SELECT rid, start, length, min(q) AS period FROM s WHERE length >= greatest(6, 4 * q) GROUP BY rid, start, length),
b AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
  first({'s': start, 'l': length, 'p': period} ORDER BY length / period DESC, start, period) AS top FROM r GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM r),
kept AS (SELECT rid, string_agg(w, ' ' ORDER BY i) AS kept FROM w ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.s::BIGINT AS start, top.l::BIGINT AS length, top.p::BIGINT AS period, (top.l * 1000 // top.p)::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN b USING (rid) LEFT JOIN kept USING (rid)
"""
