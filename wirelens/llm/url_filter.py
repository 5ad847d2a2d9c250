"""URL filters: path rules first, then exact host lists in a Bloom filter cascade.

The cascade's key universe is every host of the corpus with all its parent
domains.  Level 1 encodes the listed keys, level 2 the unlisted keys of the
universe that level 1 takes for listed, level 3 the listed ones that level 2
takes for unlisted, and so on until no key is left.  For every key of the
universe the first level that misses tells its side, so membership is exact
and the pages are judged without a join.

Only DataFrame functions run.  A level is a binary literal of at most MAX_BITS
bits, made in Spark.  Keys that need more are dealt into blocks by hash, each
with a cascade of its own, and the pages are judged once a block; the number of
blocks follows from the sizes of list and universe, and is doubled should a
level still not fit.

Defined cases: a null url, or one without ``://``, has an empty host and path
and is allowed; letters A-Z of hosts are lower-cased, nothing else; repeated
pages are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, lower_ascii, table

#: (verdict, host, path prefix)
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
#: The blocklist of op9: every junk domain under every suffix, filled up with made-up domains to the size of a list in use.
JUNK_NAMES, SUFFIXES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"), ("com", "net", "org")
LISTED_DOMAINS = 1_000_000

BITS_A_KEY, HASHES = 10, 7
#: Bits of one level, at most; a level goes to every task.
MAX_BITS = 1 << 25
#: Share of unlisted keys that one level takes for listed, rounded up; it sizes the blocks.
WRONG_SHARE = 0.02
#: Words of 64 bits that one row brings to the driver.
ROW_WORDS = 1024


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return lower_ascii(host), path


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, on, below in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(below)
        rule, verdict = F.when(fits, on + below).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def host_keys(host: Column) -> Column:
    """The host and its parent domains, longest first; none for an empty host."""
    parts = F.split(host, r"\.")
    keys = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(keys)


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * HASHES + i)), F.lit(bits)) for i in range(HASHES)]


class TooLong(Exception):
    """A level needs more than MAX_BITS."""


class Level:
    """One Bloom filter, kept as a binary literal of 64-bit words."""

    def __init__(self, keys: DataFrame, n: int, level: int):
        n_words = max(1, -(-n * BITS_A_KEY // 64))
        self.level, self.bits = level, 64 * n_words
        if self.bits > MAX_BITS:
            raise TooLong
        p = F.col("p")
        at = keys.select(F.explode(F.array(*_positions(F.col("key"), level, self.bits))).alias("p"))
        ones = at.select(F.floor(p / 64).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int")).alias("b"))
        every = ones.unionAll(keys.sparkSession.range(n_words).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b")))
        words = every.groupBy("w").agg(F.bit_or("b").alias("b"))
        rows = words.groupBy(F.floor(F.col("w") / ROW_WORDS).alias("r")).agg(F.array_sort(F.collect_list(F.struct("w", "b"))).alias("ws"))  # ROW_WORDS of them
        rows = rows.select("r", F.unhex(F.array_join(F.transform("ws", lambda x: F.lpad(F.hex(x["b"]), 16, "0")), "")).alias("data"))
        self.data = b"".join(bytes(x["data"]) for x in sorted(rows.collect()))  # MAX_BITS / 8 bytes at most

    def has(self, key: Column) -> Column:
        def one(p: Column) -> Column:
            place = F.floor(p / 64) * 8 + 8 - F.floor((p % 64) / 8)
            byte = F.conv(F.hex(F.substring(F.lit(self.data), place.cast("int"), F.lit(1))), 16, 10).cast("int")
            return F.call_function("getbit", byte.cast("long"), (p % 8).cast("int")) == 1

        return F.forall(F.array(*_positions(key, self.level, self.bits)), one)  # the literal is in the plan once a level


def cascade(sides: DataFrame, scratch: Scratch, name: str) -> list[Level]:
    """The levels over keys (key, and l: 1 if listed)."""
    levels: list[Level] = []
    encode, other = sides.where("l = 1").select("key"), sides.where("l = 0").select("key")
    while n := encode.count():
        level = Level(encode, n, len(levels) + 1)
        levels.append(level)
        wrong = scratch.table(other.where(level.has(F.col("key"))), f"{name}-{level.level}")
        encode, other = wrong, encode
    return levels


def listed_in(levels: list[Level], key: Column) -> Column:
    """Exact membership of a key of the universe."""
    answer = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        answer = F.when(~level.has(key), F.lit(level.level % 2 == 0)).otherwise(answer)
    return answer


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(blocks))


def cascades(universe: DataFrame, listed: DataFrame, scratch: Scratch) -> list[list[Level]]:
    """A cascade for each block of the distinct keys of both tables (one column, key)."""
    sides = scratch.table(universe.select("key", F.lit(0).alias("l")).union(listed.select("key", F.lit(1).alias("l"))).groupBy("key").agg(F.max("l").alias("l")), "keys")
    n = sides.agg(F.count_if(F.col("l") == 1), F.count_if(F.col("l") == 0)).first()
    blocks = max(1, -(-n[0] * BITS_A_KEY // MAX_BITS), -(-int(n[1] * WRONG_SHARE * BITS_A_KEY) // MAX_BITS))
    while True:
        try:
            return [cascade(sides.where(_block(F.col("key"), blocks) == b), scratch, f"wrong-{blocks}-{b}") for b in range(blocks)]
        except TooLong:
            blocks *= 2


def judge(pages: DataFrame, rules=RULES, blocked: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``blocked`` has one column, key: hosts blocked with their subdomains
    (blocklist() if it is left out).
    """
    spark = pages.sparkSession
    blocked = blocklist(spark) if blocked is None else blocked
    host, path = split_url(pages["url"])
    p = pages.select(pages["page_id"], F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    p = p.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    scratch = Scratch(spark, "urls")
    universe = p.select("host").distinct().select(F.explode(host_keys(F.col("host"))).alias("key")).distinct()
    found = cascades(universe, blocked.where("key is not null and key <> ''").select("key"), scratch)
    many = len(found) > 1
    for b, levels in enumerate(found):
        mine = lambda k, levels_=levels, b_=b: (_block(k, len(found)) == b_) & listed_in(levels_, k) if many else listed_in(levels_, k)
        bad = F.exists(host_keys(F.col("host")), lambda k: mine(k))
        p = p.withColumn("bad", bad if b == 0 else F.col("bad") | bad)
        if many:
            p = scratch.table(p, f"judged-{b}")  # one block's levels in a plan
    return p.select("page_id", "host", "path", "rule", F.coalesce(F.col("by_rule"), F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"))


def blocklist(spark: SparkSession) -> DataFrame:
    """The listed domains, one column, key."""
    junk = [f"{name}.example.{suffix}" for name in JUNK_NAMES for suffix in SUFFIXES]
    made_up = spark.range(LISTED_DOMAINS - len(junk)).select(F.concat(F.lit("site-"), F.col("id").cast("string"), F.lit(".list.example")).alias("key"))
    return spark.createDataFrame([(h,) for h in junk], "key string").unionAll(made_up)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), blocked=blocklist(spark))


def oracle() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    junk = ", ".join(f"('{name}.example.{suffix}')" for name in JUNK_NAMES for suffix in SUFFIXES)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut
), rules(what, on_host, below) AS (VALUES {rules}),
listed(key) AS (
  SELECT 'site-' || i || '.list.example' FROM range({LISTED_DOMAINS - len(JUNK_NAMES) * len(SUFFIXES)}) AS r(i) UNION ALL VALUES {junk}
), keys AS (
  SELECT host, array_to_string(w[i:], '.') AS key FROM (SELECT host, string_split(host, '.') AS w, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM (SELECT DISTINCT host FROM parts))
), bad AS (SELECT DISTINCT host FROM keys SEMI JOIN listed USING (key)),
judged AS (
  SELECT parts.*, (SELECT max_by(on_host || below, length(on_host || below)) FROM rules WHERE (host = on_host OR ends_with(host, '.' || on_host)) AND starts_with(path, below)) AS rule
  FROM parts
)
SELECT page_id, judged.host, path, rule,
       coalesce((SELECT any_value(what) FROM rules WHERE on_host || below = rule), CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN bad ON bad.host = judged.host
"""
