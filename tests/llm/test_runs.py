"""Runs of words: Lyndon arrays against plain loops, and the query against SQL and its contract."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wirelens.llm import runs
from wirelens.llm.runs import Rule, Run


def plain_runs(s, rule=Rule()):
    """Every period, every stretch; of periods with the same stretch the smallest."""
    found = {}
    for q in range(1, len(s) // rule.powers + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j - i + q >= max(rule.least, rule.powers * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((Run(i, n, q) for (i, n), q in found.items()), key=lambda r: (r.start, r.period))


def plain_next_smaller(s):
    n = len(s)
    return [next((j for j in range(i + 1, n) if s[j:] < s[i:]), n) for i in range(n)]


def words(r):
    k, n = r.choice([1, 2, 2, 3, 4]), r.randint(0, 60)
    s = [r.randrange(k) for _ in range(n)]
    if n and r.random() < 0.5:
        a, p = r.randrange(n), r.randint(1, 6)
        for i in range(a, n):
            s[i] = s[a + (i - a) % p] if a + (i - a) % p < n else s[i]
    return s


@pytest.mark.parametrize("rule", [Rule(), Rule(2, 2), Rule(3, 3)])
def test_runs_equal_plain_loops(rule):
    r = random.Random(1)
    for _ in range(1500):
        s = words(r)
        assert runs.runs_of(s, rule) == plain_runs(s, rule), s
        texts = [[b"%d" % c for c in s], [], [b"%d" % c for c in s[::-1]]]
        assert runs.runs_in(texts, rule) == [plain_runs(t, rule) for t in texts], s


def test_lyndon_array_and_agreements():
    r = random.Random(2)
    for _ in range(400):
        s = words(r)
        after, lce = runs.lyndon(s)
        assert after == plain_next_smaller(s)
        for i, (j, e) in enumerate(zip(after, lce, strict=True)):
            assert s[i : i + e] == s[j : j + e] and (j + e >= len(s) or s[i + e] != s[j + e])


class Counted(list):
    """Counts how often places are looked at."""

    looks = 0

    def __getitem__(self, k):
        Counted.looks += 1
        return super().__getitem__(k)


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("make", [lambda n: [0] * n, lambda n: [0, 1] * (n // 2), fibonacci, lambda n: [bin(i).count("1") & 1 for i in range(n)], lambda n: [(i & -i).bit_length() for i in range(1, n + 1)], lambda n: ([0] * 40 + [1]) * (n // 41), lambda n: ([0] * 40 + [1] + [0] * 41 + [1]) * (n // 83)], ids="same two fibonacci thue ruler blocks nested".split())
def test_each_word_is_matched_a_bounded_number_of_times(make):
    looks = []
    for n in (4000, 16000):
        Counted.looks = 0
        runs.lyndon(Counted(make(n)))
        looks.append(Counted.looks / n)
    assert looks[1] < 8 and looks[1] < 1.2 * looks[0]


def test_stretches_leave_plain_text_out():
    text = [b"%d" % (i * i % 997) for i in range(400)] + [b"a", b"b", b"c"] * 5 + [b"%d" % i for i in range(300)]
    number = {w: k for k, w in enumerate(dict.fromkeys(text))}
    import numpy as np

    assert list(runs.stretches(np.array([number[w] for w in text]), np.array([0, len(text)]))) == [(400, 415)]


def test_edges(spark):
    rows = [(None, "a a a a a a a", 1), (1, None, 1), (2, "", 1), (3, " \t\n", 1), (4, "x y x y x y x y z", 1), (4, "x y x y x y x y z", 1), (5, "a a " * 6, 1), (6, "b " * 50_000, 1), (7, "漢 é 漢 é 漢 é 漢 é", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"][:20]) for r in runs.find_runs(docs).collect())
    assert got == [(0, 7, [(0, 7, 1)], "a"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 9, [(0, 8, 2)], "x y z"), (4, 9, [(0, 8, 2)], "x y z"), (5, 6, [(0, 6, 1)], "a a"), (6, 50_000, [(0, 50_000, 1)], "b"), (7, 8, [(0, 8, 2)], "漢 é")]
    assert runs.find_runs(docs.where("false")).count() == 0


def test_query_equals_plain_loops(spark, sf):
    """The whole contract, worked out plainly."""
    got = {r["doc_id"]: r for r in runs.op13_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        w = runs.repeat_tail(d["doc_id"], (d["text"] or "").encode().split())
        found = plain_runs(w)
        best = max(found, key=lambda r: (r.length / r.period, -r.start, -r.period), default=None)
        gone = {i for r in found for i in range(r.start + r.period, r.start + r.length)}
        want = (len(found), *(best or (None,) * 3), best and 1000 * best.length // best.period, hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())
        assert tuple(got[d["doc_id"]][1:]) == want
        planted += bool(found)
    assert planted > 5


def test_repeat_tail_is_an_equation_of_positions():
    for doc_id in range(300):
        w = [b"%d" % i for i in range(97)]
        import zlib

        h = zlib.crc32(str(doc_id).encode())
        a, g = h // 10 % 97, h // 10
        p = 1 + (97 - a) // (3 + g % 8)
        assert runs.repeat_tail(doc_id, w) == [w[i] if h % 10 or i < a else w[a + (i - a) % p] for i in range(97)]


def test_plan_has_no_exchange(spark, sf):
    plan = runs.op13_periodic_runs(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert runs.op13_periodic_runs(spark, sf).where(F.col("n_runs") > 0).count() > 0
