"""Joins of deals whose names match, by keys and by an inverted index for containment.

``text.same_deal`` is a choice of rules.  Each has keys under which two names
that it accepts must meet: whole names, initials, first letters, tokens, pairs
of tokens, and for containment the rarest letters of the contained name, under
which a containing one is listed too.  Keys hold the stage and a token that
both sellers share; only sellers without tokens meet by stage.  Pairs that meet
are made distinct and then put to the rules, so the keys decide about work and
never about the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..workspace import Keep, Workspace

#: Letters of an entry of the containment index.
GRAM = 4
#: Tokens of a name up to which all pairs of them are keys; longer names meet others by single tokens.
LONG = 12
#: Letters of initials that a key holds.
INITIALS = 16


def profile_id(target: Column, seller: Column, stage: Column) -> Column:
    """128 bits of normalized names and stage."""
    return F.md5(F.concat_ws("\x01", target, seller, stage).cast("binary"))


def profiles(deals: DataFrame) -> DataFrame:
    """Distinct names (name, seller and st, normalized and not null) as id, st and p, the profile that the rules read."""
    rows = deals.select("name", "seller", "st").distinct()
    return rows.select(profile_id(F.col("name"), F.col("seller"), F.col("st")).alias("id"), "st", text.profile_of(F.col("name"), F.col("seller")).alias("p"))


def _sub(s: Column, n: int) -> Column:
    """All substrings of n letters, each once."""
    return F.when(F.length(s) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(s) - (n - 1)), lambda i: F.substr(s, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def containing(small: DataFrame, big: DataFrame) -> DataFrame:
    """(block, small, big): strings s of ``small`` within strings s of ``big`` of the same block; both have block and s.

    A string is looked up under the one of its entries that the fewest strings
    of the block have; one with an entry that none has is in none.
    """
    small, big = (d.where("s <> ''").select(F.xxhash64("block", "s").alias("i"), "block", "s").distinct() for d in (small, big))
    # entries and strings go about as hashes; strings come back to the few pairs that are found
    entries = lambda d, *lists: d.select("i", F.explode(F.concat(*lists)).alias("gram"), "block").select("i", F.xxhash64("block", "gram").alias("g"))
    listed = entries(big, _sub(F.col("s"), GRAM)).withColumnRenamed("i", "b")
    own = entries(small.where(F.length("s") >= GRAM), _sub(F.col("s"), GRAM))
    rare = own.join(listed.groupBy("g").agg(F.count("*").alias("n")), "g", "left")
    rare = rare.groupBy("i").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")).alias("r")).where("r.n > 0").select("i", F.col("r.g").alias("g"))
    short = small.where(F.length("s") < GRAM)
    tiny = big.join(short.select("block").distinct(), "block", "left_semi")
    tiny = entries(tiny, *[_sub(F.col("s"), n) for n in range(1, GRAM)]).withColumnRenamed("i", "b").join(short.select("i", F.xxhash64("block", "s").alias("g")), "g")
    met = rare.join(listed, "g").select("i", "b").unionAll(tiny.select("i", "b"))
    named = met.join(small.select("i", "block", F.col("s").alias("small")), "i").join(big.select(F.col("i").alias("b"), F.col("block").alias("there"), F.col("s").alias("big")), "b")
    return named.where((F.col("block") == F.col("there")) & F.contains("big", "small")).select("block", "small", "big")


def _tagged(tag: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.concat(F.lit(tag), v))


def _some(condition: Column, values: Column) -> Column:
    return F.when(condition, values).otherwise(F.array().cast("array<string>"))


def _keyed(side: DataFrame, vocabulary: DataFrame, by_token: bool) -> DataFrame:
    """id, block and three lists of keys: ``both`` meets itself, ``ask`` meets ``list``."""
    soft = side.select("id", "st", F.explode("p.own").alias("tok")).join(vocabulary, ["st", "tok"]).groupBy("id").agg(F.collect_list("tok").alias("soft"))
    d = side.join(soft, "id", "left")
    p = F.col("p")
    name, initials, own = p["name"], p["acronym"], p["own"]
    # what another seller's tokens may leave of a name's own ones, at least
    hard = F.size(F.array_except(own, F.coalesce("soft", F.array().cast("array<string>"))))
    pairs = F.flatten(F.transform(own, lambda a: F.transform(F.filter(own, lambda b: b > a), lambda b: F.concat(a, F.lit(" "), b))))
    both = [_tagged("n", F.array(name)), _some(initials != "", _tagged("a", F.array(initials))), _some(F.size(own) <= LONG, _tagged("2", pairs))]
    ask = [
        _some((F.length(p["seller"]) >= 5) & (F.left(p["seller"], F.lit(4)) == F.left(name, F.lit(4))), _tagged("p", F.array(F.left(name, F.lit(4))))),
        _some(initials != "", F.array(F.concat(F.lit("s"), F.left(initials, F.lit(INITIALS))), F.concat(F.lit("t"), initials))),
        _some(hard <= 1, _tagged("w", own)),
        _some(F.size(own) > LONG, _tagged("l", own)),
    ]
    listed = [
        _some(F.length(name) >= 4, _tagged("p", F.array(F.left(name, F.lit(4))))),
        _tagged("s", F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.least(F.lit(INITIALS), F.length(p["solid"])))), lambda n: F.left(p["solid"], n))),
        _tagged("t", p["tokens"]),
        _some(hard <= 2, _tagged("w", own)),
        _tagged("l", own),
    ]
    if by_token:  # a name of nothing but sellers' words stands for any of its seller's
        ask.append(_some(hard == 0, F.array(F.concat(F.lit("g"), F.coalesce(F.get(own, F.lit(0)), F.lit(""))))))
        listed.append(_tagged("g", F.concat(F.array(F.lit("")), p["seller_tokens"])))
    tok = F.explode(p["seller_tokens"]) if by_token else F.lit("")
    d = d.select("id", "st", "p", tok.alias("tok"), F.concat(*both).alias("both"), F.concat(*ask).alias("ask"), F.concat(*listed).alias("list"))
    return d.withColumn("block", F.concat_ws("|", "st", "tok"))


def _bare(keyed: DataFrame, sellers: DataFrame, by_token: bool) -> DataFrame:
    """(block, id, s): names without sellers, for every seller of the block that may be taken out of them."""
    p = F.col("p")
    base = keyed.select("block", "id", p["bare"].alias("s"))
    names = keyed.select("block", "tok", "id", "p", F.explode(F.array_distinct(F.array(p["name"], p["bare"]))).alias("big"))
    if by_token:  # then the other seller has the block's token too, and so has a name that holds it
        names = names.where(F.contains("big", "tok"))
    sellers = sellers.join(sellers.groupBy("block").agg(F.count("*").alias("n")).where("n > 1"), "block", "left_semi")
    other = containing(sellers, names.select("block", F.col("big").alias("s"))).withColumnRenamed("small", "other")
    met = names.join(other, ["block", "big"]).where(F.col("other") != p["seller"])
    orders = F.array(text.less(text.less(p["name"], p["seller"]), F.col("other")), text.less(text.less(p["name"], F.col("other")), p["seller"]))
    return base.unionAll(met.select("block", "id", F.explode(orders).alias("s"))).where("s <> ''")


def _met(left: DataFrame, right: DataFrame, by_token: bool, same: bool, keep: Keep, name: str) -> DataFrame:
    """(l, r): pairs of ids that meet under some key of a block."""
    vocabulary = left.select("st", F.explode("p.seller_tokens").alias("tok"))
    vocabulary = (vocabulary if same else vocabulary.unionAll(right.select("st", F.explode("p.seller_tokens").alias("tok")))).distinct()
    a = keep(_keyed(left, vocabulary, by_token), f"{name}-keys")
    b = a if same else keep(_keyed(right, vocabulary, by_token), f"{name}-keys-2")
    keys = lambda d, name, *lists: d.select(F.col("id").alias(name), "block", F.explode(F.concat(*lists)).alias("k")).select(name, F.xxhash64("block", "k").alias("k"))
    pairs = keys(a, "l", "both", "ask").join(keys(b, "r", "both", "list"), "k").select("l", "r")
    if not same:
        pairs = pairs.unionAll(keys(a, "l", "list").join(keys(b, "r", "ask"), "k").select("l", "r"))
    sellers = lambda d: d.select("block", F.col("p.seller").alias("s"))
    every = (sellers(a) if same else sellers(a).unionAll(sellers(b))).distinct()
    bare_a = keep(_bare(a, every, by_token), f"{name}-bare")
    bare_b = bare_a if same else keep(_bare(b, every, by_token), f"{name}-bare-2")
    named = lambda d, name, string: d.select("block", F.col("id").alias(name), F.col("s").alias(string))
    pairs = pairs.unionAll(containing(bare_a, bare_b).join(named(bare_a, "l", "small"), ["block", "small"]).join(named(bare_b, "r", "big"), ["block", "big"]).select("l", "r"))
    if not same:
        pairs = pairs.unionAll(containing(bare_b, bare_a).join(named(bare_a, "l", "big"), ["block", "big"]).join(named(bare_b, "r", "small"), ["block", "small"]).select("l", "r"))
    return pairs


def matches(left: DataFrame, right: DataFrame | None = None, rule: Callable[[Column, Column], Column] = text.same_deal, keep: Keep | None = None) -> DataFrame:
    """(l, r): ids of profiles (id, st, p) of one stage that the rule accepts, l given first; with one side, all its pairs in both orders, but for a profile with itself.

    ``keep`` writes a table and reads it back; the sides should be such tables.
    """
    keep = keep or Workspace.new(left.sparkSession, "matches").keep
    same = right is None
    e = left if same else right
    lone, lone_e = (d.where(F.size("p.seller_tokens") == 0) for d in (left, e))
    pairs = _met(left, e, True, same, keep, "token")
    if not lone.isEmpty():  # sellers without tokens may match any
        pairs = pairs.unionAll(_met(lone, e.join(lone.select("st").distinct(), "st", "left_semi"), False, False, keep, "lone"))
    if not same and not lone_e.isEmpty():
        pairs = pairs.unionAll(_met(left.join(lone_e.select("st").distinct(), "st", "left_semi"), lone_e, False, False, keep, "lone-2"))
    one, two = left.select(F.col("id").alias("l"), "st", "p"), e.select(F.col("id").alias("r"), F.col("st").alias("st_r"), F.col("p").alias("q"))
    p, q = F.col("p"), F.col("q")
    if not same:
        return pairs.distinct().join(one, "l").join(two, "r").where(F.col("st") == F.col("st_r")).where(rule(p, q)).select("l", "r")
    pairs = pairs.where("l <> r").select(F.least("l", "r").alias("l"), F.greatest("l", "r").alias("r")).distinct()
    # which side is given first matters only to names that hold the other's seller
    holds = lambda x, y: (y["seller"] != "") & (F.contains(x["name"], y["seller"]) | F.contains(x["bare"], y["seller"]))
    turned = (p["seller"] != q["seller"]) & (holds(p, q) | holds(q, p))
    tried = pairs.join(one, "l").join(two, "r").where(F.col("st") == F.col("st_r")).select("l", "r", rule(p, q).alias("there"), F.when(turned, rule(q, p)).alias("back"))
    both = F.array(F.when(F.col("there"), F.struct("l", "r")), F.when(F.coalesce("back", "there"), F.struct(F.col("r").alias("l"), F.col("l").alias("r"))))
    return tried.select(F.explode(F.filter(both, lambda x: x.isNotNull())).alias("x")).select("x.*")
