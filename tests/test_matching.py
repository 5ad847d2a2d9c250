"""Joins of matching names against all pairs, and the fold against a plain loop."""

import itertools
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from wirelens.functions import text
from wirelens.operators import dedup, matching
from wirelens.workspace import Workspace

TARGETS = ["Water Pumps", "Acme Tech", "WP", "wpx systems", "ACME", "Industrial Division", "Steel", "steel works", "Contin Unit", "Conti parts", "a", "ab", "", None, "Valve", "Valves & Co", "É du Nord", "Nord Acme Steel", "Acme Water Nord pumps", "Rotor Steel Corp Blades", "Corp Steel", "one two three four five six seven eight nine ten eleven twelve thirteen Water", "thirteen Water parts", "wp one", "Continental Acme"]
SELLERS = ["Acme Holdings", "Acme", "Acme Water", "Continental", "Continental Acme", "Steel Corp", "Nord Steel", "Holdings", "", None, "N/A", "Nord", "Water Nord"]


def deals(rows):
    return rows.select(text.norm(F.col("target")).alias("name"), text.norm(F.col("seller")).alias("seller"), F.lower("stage").alias("st"))


def names(spark, pairs, stages=("signing", "closing")):
    return spark.createDataFrame([(t, s, st) for (t, s), st in itertools.product(pairs, stages)], "target string, seller string, stage string")


def all_pairs(left, right, rule=text.same_deal):
    a = left.select("st", F.col("id").alias("l"), "p")
    b = right.select(F.col("st").alias("st_r"), F.col("id").alias("r"), F.col("p").alias("q"))
    return sorted(map(tuple, a.join(b, F.col("st") == F.col("st_r")).where(rule(F.col("p"), F.col("q"))).select("l", "r").collect()))


def test_matches_equal_all_pairs(spark):
    """Every target with every seller: no rule's pair is lost, whichever names hold other sellers, and none is found twice."""
    known = Workspace.new(spark, "test").keep(matching.profiles(deals(names(spark, itertools.product(TARGETS, SELLERS)))), "known")
    want = [(a, b) for a, b in all_pairs(known, known) if a != b]
    assert sorted(map(tuple, matching.matches(known).collect())) == want and len(want) > 10_000


@pytest.mark.parametrize("named", [False, True])
def test_matches_of_two_sides(spark, named):
    r = random.Random(3)
    pairs = [p for p in itertools.product(TARGETS, SELLERS) if not named or text_has_tokens(p[1])]
    keep = Workspace.new(spark, "test").keep
    one, two = (keep(matching.profiles(deals(names(spark, r.sample(pairs, len(pairs) // 2)))), f"side{k}") for k in range(2))
    assert sorted(map(tuple, matching.matches(one, two).collect())) == all_pairs(one, two)


def text_has_tokens(seller):
    return seller not in (None, "", "Holdings", "N/A")


def test_containing_finds_every_substring(spark):
    r = random.Random(5)
    strings = list({"".join(r.choice("ab c") for _ in range(r.randint(1, 12))) for _ in range(150)})
    rows = spark.createDataFrame([(b, s) for s in strings for b in "xy"[: 1 + len(s) % 2]], "block string, s string")
    got = sorted(map(tuple, matching.containing(rows, rows).collect()))
    held = [tuple(x) for x in rows.collect()]
    assert got == sorted((b, s, t) for b, s in held for c, t in held if b == c and s in t)


def plain_fold(rows, match):
    """Rows (ord, title, target, seller, confidence, reasoning, stage), one after the other."""
    reps = []
    for row in rows:
        for k, rep in enumerate(reps):
            if rep[6] == row[6] and match[rep[2], rep[3], row[2], row[3]]:
                more = row[4] is not None and rep[4] is not None and row[4] > rep[4]
                new, old = (row, rep) if more else (rep, row)
                reps[k] = (*new[:5], (new[5] or "") + f"\n[Also: {old[1] or ''}]", new[6])
                break
        else:
            reps.append(row)
    return reps


SCHEMA = "ord long, title string, target string, seller string, confidence int, reasoning string, stage string"


def rules(spark, pairs):
    """Whether one name of pairs matches another."""
    four = spark.createDataFrame([(*a, *b) for a, b in itertools.product(pairs, pairs)], "a string, s string, b string, t string")
    return {tuple(x)[:4]: x["m"] for x in four.withColumn("m", text.deals_match(F.col("a"), F.col("s"), F.col("b"), F.col("t"))).collect()}


@pytest.mark.parametrize("rounds", [False, True], ids=["tasks", "rounds"])
@pytest.mark.parametrize("seed", [1, 2])
def test_fold_equals_a_plain_loop(spark, monkeypatch, seed, rounds):
    """Groups that change what represents them, names that match several groups, ties, nulls, hot names, stages of null."""
    r = random.Random(seed)
    pairs = r.sample([p for p in itertools.product(TARGETS, SELLERS)], 25)
    match = rules(spark, pairs)
    hot = r.choice(pairs)
    rows = [(i * 3, r.choice([f"t{i}", None]), *(hot if r.random() < 0.3 else r.choice(pairs)), r.choice([None, *range(12)]), r.choice(["why", "", None]), r.choice(["a", "a", "b", None])) for i in range(160)]
    if rounds:
        monkeypatch.setattr(dedup, "FOLD_ROWS", 0)
    got = dedup.fold_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3), ["stage"]).orderBy("place").collect()
    want = plain_fold(rows, match)
    assert sorted(map(repr, (tuple(x[f.split(" ")[0]] for f in SCHEMA.split(", ")) for x in got))) == sorted(map(repr, want))


def test_blocks_keep_apart(spark):
    df = spark.createDataFrame([(i, f"t{i}", "Pumps", "Acme", 1, "", s) for i, s in enumerate(["a", "b", "a", None, "", None])], SCHEMA)
    assert sorted((x["ord"], x["reasoning"]) for x in dedup.fold_repeats(df, ["stage"]).collect()) == [(0, "\n[Also: t2]"), (1, ""), (3, "\n[Also: t5]"), (4, "")]
    assert dedup.fold_repeats(df.where("false"), ["stage"]).count() == 0


def broadcast_tables(plan):
    """Tables that a plan's broadcasts read with no exchange between, whose sizes are guessed from files."""
    inside, found = [], set()  # (column, whether a broadcast) of the exchanges above a line
    for line in plan.splitlines():
        column = len(line) - len(line.lstrip(" :+-*("))
        while inside and inside[-1][0] >= column:
            inside.pop()
        if "BroadcastExchange" in line or " Exchange " in line:
            inside.append((column, "BroadcastExchange" in line))
        elif inside and inside[-1][1]:
            found.update(re.findall(r"/(fold-[a-z0-9]+)\]", line))
    return found


@pytest.mark.parametrize("rounds", [False, True], ids=["tasks", "rounds"])
def test_fold_broadcasts_no_rows(spark, monkeypatch, rounds):
    """Few names in many rows are small files; only tables of names may go through the driver."""
    r = random.Random(4)
    rows = [(i, f"t{i}", f"Target {r.randrange(5)}", f"Seller {r.randrange(3)}", r.randrange(50), "", r.choice("ab")) for i in range(3000)]
    if rounds:
        monkeypatch.setattr(dedup, "FOLD_ROWS", 0)
    kept, plans = Workspace.new(spark, "test").keep, []

    def keep(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        out = dedup.fold_repeats(spark.createDataFrame(rows, SCHEMA), ["stage"], keep=keep)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    found = set().union(*map(broadcast_tables, plans))
    assert "fold-homes" in found and not {t for t in found if t in ("fold-rows", "fold-open", "fold-edges", "fold-groups") or t[5:].isdigit()}, found


def test_many_deals_of_one_seller_that_match_nothing(spark):
    """A hundred thousand names of one seller: work follows what matches, not the square of the block."""
    word = lambda k: F.conv(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1 << 40)).cast("string"), 10, 36)
    rows = spark.range(100_000).select(F.col("id").alias("ord"), F.lit("t").alias("title"), F.concat_ws(" ", *map(word, range(6)), F.lit("plant")).alias("target"), F.lit("Acme Water").alias("seller"), F.lit(5).alias("confidence"), F.lit("").alias("reasoning"), F.lit("signing").alias("stage"))
    began = time.time()
    assert dedup.fold_repeats(rows, ["stage"]).count() >= 99_000
    assert time.time() - began < 400
