"""Removing repeats: by url, by entity within a run, and against earlier runs."""

from __future__ import annotations

import bisect
import itertools

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..workspace import Keep, Workspace
from . import matching

def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order: one aggregation, combined before the exchange."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)]).agg(F.min_by(row, F.struct(*order)).alias("row")).select("row.*")


def unseen(df: DataFrame, seen: DataFrame, on: str = "url") -> DataFrame:
    """Rows whose key no earlier run has."""
    return df.join(seen.select(on), on, "left_anti")


def named(target: Column, seller: Column) -> Column:
    """Whether a deal can match earlier ones: it has a target and a known seller."""
    s = F.upper(text.strip(F.coalesce(seller, F.lit(""))))
    return (text.strip(F.coalesce(target, F.lit(""))) != "") & (s != "") & (s != "N/A") & (s != "UNKNOWN")


def unseen_deals(deals: DataFrame, seen: DataFrame, keep: Keep | None = None) -> DataFrame:
    """Deals that match no earlier deal of their stage; both have target, seller and stage.

    Each distinct name is matched once (matching.matches).  A null stage matches none.
    """
    keep = keep or Workspace.new(deals.sparkSession, "unseen").keep
    target, seller, stage = F.col("target"), F.col("seller"), F.lower("stage")
    new = deals.where(named(target, seller) & stage.isNotNull()).select(text.norm(target).alias("name"), text.norm(seller).alias("seller"), stage.alias("st"))
    # the state's names are normalized when they are stored and once more when they are read
    old = seen.where(stage.isNotNull()).select(text.norm(text.norm(target)).alias("name"), text.norm(text.norm(seller)).alias("seller"), stage.alias("st"))
    one, two = (keep(matching.profiles(d), f"{name}-profiles") for name, d in (("new", new), ("old", old)))
    hit = matching.matches(one, two, keep=keep).select(F.col("l").alias("deal")).distinct()
    own = F.when(named(target, seller), matching.profile_id(text.norm(target), text.norm(seller), stage))
    return deals.withColumn("deal", own).join(hit, "deal", "left_anti").select(*[deals[c] for c in deals.columns])


def _merged(table: DataFrame) -> DataFrame:
    """A table of rows or matches as side of a join that broadcasts neither: its files are small where few names repeat, its rows are not."""
    return table.hint("merge")


#: A block up to so many rows and matches is folded by a task.
FOLD_ROWS, FOLD_MATCHES = 100_000, 3_000_000


def _fold(rows: pa.Table, edges: pa.Table) -> pa.Table:
    """The sequential fold of a block of bounded size: the group, named by its founder, of each row (ord, id, confidence)."""
    rows = rows.sort_by("ord")
    names: dict[str, int] = {}
    into: list[set[int]] = []  # what a name may join
    for name in rows.column("id").to_pylist():
        if names.setdefault(name, len(into)) == len(into):
            into.append({len(into)})
    for a, b in zip(edges.column("l").to_pylist(), edges.column("r").to_pylist(), strict=True):
        into[names[b]].add(names[a])
    led: list[list[int]] = [[] for _ in into]  # groups by the name that represents them
    best: dict[int, tuple[int, int | None]] = {}  # in the order of their beginning
    groups = []
    for at, name, confidence in zip(*(rows.column(c).to_pylist() for c in ("ord", "id", "confidence")), strict=True):
        n = names[name]
        near = into[n]
        if len(best) <= len(near):
            group = next((g for g, (rep, _) in best.items() if rep in near), at)
        else:
            group = min((led[rep][0] for rep in near if led[rep]), default=at)
        groups.append(group)
        old, most = best.setdefault(group, (n, confidence))
        if group == at:
            led[n].append(at)
        elif confidence is not None and most is not None and confidence > most:
            best[group] = (n, confidence)
            led[old].remove(group)
            bisect.insort(led[n], group)
    return pa.table({"ord": rows.column("ord"), "grp": pa.array(groups, pa.int64())})


def _leaders(state: DataFrame) -> DataFrame:
    """(ord, id, grp, until) of the rows that represent their group for a time: until the row ``until`` comes, which replaces them.

    A row with more confidence than all before it replaces them; of equal ones
    the first counts; without confidence none replaces or is replaced.  A group
    has one row for each confidence here, so no window takes all its members.
    """
    first = state.groupBy("grp", "confidence").agg(F.min("ord").alias("ord"), F.min_by("id", "ord").alias("id"))
    stuck = first.where("confidence is null and ord = grp").select("ord", "id", "grp", F.lit(None).cast("long").alias("until"))
    above = Window.partitionBy("grp").orderBy(F.desc("confidence")).rowsBetween(Window.unboundedPreceding, -1)
    rising = first.where("confidence is not null").withColumn("until", F.min("ord").over(above)).where("until is null or ord < until")
    return rising.join(_merged(stuck.select("grp")), "grp", "left_anti").select("ord", "id", "grp", "until").unionAll(stuck)


def _fold_in_rounds(rows: DataFrame, edges: DataFrame, keep: Keep) -> DataFrame:
    """The same fold for rows (ord, id, confidence) of any number: (ord, grp).

    Each round places every row at once, among the representatives that the
    round before left: in the first group whose representative of the row's
    moment it matches, or in one of its own.  A row is right once all that it
    depends on, which is earlier, was right in the round before, so what does
    not change any more is the result of the plain loop.
    """
    own = rows.select(F.col("id").alias("l"), F.col("id").alias("r")).distinct()
    edges = keep(edges.select("l", "r").unionAll(own), "fold-edges")
    leaders = rows.groupBy("id").agg(F.min("ord").alias("ord")).select("ord", "id", F.col("ord").alias("grp"), F.lit(None).cast("long").alias("until"))
    before = None
    for k in itertools.count(1):
        offers = leaders.withColumnRenamed("id", "l").join(_merged(edges), "l").select("r", F.col("ord").alias("since"), "grp", "until")
        # a group that stays open to a name hides all later groups from then on
        lasting = offers.where("until is null").groupBy("r").agg(F.min(F.struct("grp", "since")).alias("m")).select("r", F.col("m.grp").alias("g"), F.col("m.since").alias("s"))
        offers = offers.join(lasting, "r", "left").where("g is null or grp <= g or since < s").select(F.col("r").alias("id"), "since", "grp", "until")
        met = _merged(rows).join(offers, "id").where("since < ord and (until is null or until >= ord)").groupBy("ord").agg(F.min("grp").alias("grp"))
        state = keep(rows.join(met, "ord", "left").select("ord", "id", "confidence", F.coalesce("grp", "ord").alias("grp")), f"fold-{k}")
        now = state.agg(F.sum(F.xxhash64("ord", "grp").cast("decimal(38,0)"))).first()[0]
        if now == before:
            return state.select("ord", "grp")
        before, leaders = now, _leaders(state)


def fold_repeats(alerts: DataFrame, block: list[str], order: str = "ord", keep: Keep | None = None) -> DataFrame:
    """Greedy fold in order: an alert joins the first representative of its block (equal columns) that it matches.

    The more confident one represents (a tie keeps the earlier), with a note
    on the other's title; a replaced one's own notes go with it.  Needs ord
    (unique), title, target, seller, confidence, reasoning and the block's;
    ``place`` orders the results as the groups began.

    Which names match comes from a join of distinct names.  Rows that share
    their block and their seller's most frequent token are folded in a task
    where no match leads out of them and they are few; all others in rounds
    over the whole table.  ``keep`` writes a table and reads it back.
    """
    keep = keep or Workspace.new(alerts.sparkSession, "fold").keep
    st = F.concat_ws("\x01", *[F.coalesce(F.col(b).cast("string"), F.lit("\x02")) for b in block])
    name, seller = text.norm(F.col("target")), text.norm(F.col("seller"))
    held = alerts.select(F.col(order).cast("long").alias("ord"), "title", "target", "seller", F.col("confidence").cast("int").alias("confidence"), "reasoning", *[b for b in block if b not in _OWN], name.alias("fold_name"), seller.alias("fold_seller"), st.alias("fold_st"))
    held = keep(held.withColumn("fold_id", matching.profile_id(F.col("fold_name"), F.col("fold_seller"), F.col("fold_st"))), "fold-rows")
    known = keep(matching.profiles(held.select(F.col("fold_name").alias("name"), F.col("fold_seller").alias("seller"), F.col("fold_st").alias("st"))), "fold-profiles")
    edges = keep(matching.matches(known, keep=keep), "fold-matches")
    rows = held.select("ord", F.col("fold_id").alias("id"), "confidence")
    words = known.select("id", "st", F.explode_outer("p.seller_tokens").alias("tok"))
    often = words.join(words.groupBy("st", "tok").agg(F.count("*").alias("n")), ["st", "tok"])
    home = keep(words.select("id", "st").distinct().join(often.groupBy("id").agg(F.max(F.struct("n", "tok")).alias("m")), "id", "left").select("id", F.concat_ws("\x01", "st", "m.tok").alias("home")), "fold-homes")
    at = lambda end: home.select(F.col("id").alias(end), F.col("home").alias(f"home_{end}"))
    placed = edges.join(at("l"), "l").join(at("r"), "r")
    ends = placed.select(F.explode(F.array("home_l", "home_r")).alias("home"), (F.col("home_l") != F.col("home_r")).alias("out"))
    many = ends.groupBy("home").agg(F.count("*").alias("n"), F.max("out").alias("out")).where(F.col("out") | (F.col("n") > 2 * FOLD_MATCHES)).select("home")
    sizes = rows.groupBy("id").agg(F.count("*").alias("n")).join(home, "id").groupBy("home").agg(F.sum("n").alias("n"))
    closed = keep(sizes.where(F.col("n") <= FOLD_ROWS).join(many, "home", "left_anti").select("home"), "fold-closed")
    mine = rows.join(home.join(closed, "home", "left_semi"), "id")
    theirs = placed.join(closed, placed["home_r"] == closed["home"], "left_semi").select(F.col("home_r").alias("home"), "l", "r")
    small = mine.groupBy("home").cogroup(theirs.groupBy("home")).applyInArrow(_fold, "ord long, grp long")
    open_ids = home.join(closed, "home", "left_anti").select("id")
    large = keep(rows.join(open_ids, "id", "left_semi"), "fold-open")
    groups = small
    if not large.isEmpty():
        groups = small.unionAll(_fold_in_rounds(large, edges.join(open_ids, edges["r"] == open_ids["id"], "left_semi"), keep))
    state = keep(_merged(rows).join(groups, "ord"), "fold-groups")
    leaders = _leaders(state)
    last = leaders.where("until is null").select("grp", F.col("ord").alias("last"))
    before = leaders.where("until is not null").groupBy("grp").agg(F.max("ord").alias("before"))
    ends = keep(last.join(before, "grp", "left"), "fold-ends")
    noted = _merged(state).join(ends, "grp").where("ord > last or ord = before").select("ord", "grp")
    titles = noted.join(_merged(held.select("ord", "title")), "ord").groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("ord", F.coalesce("title", F.lit("")).alias("title")))).alias("t"))
    notes = titles.select("grp", F.array_join(F.transform("t", lambda t: F.concat(F.lit("\n[Also: "), t["title"], F.lit("]"))), "").alias("notes"))
    out = _merged(held).join(ends.select(F.col("last").alias("ord"), "grp"), "ord").join(notes, "grp", "left")
    reasoning = F.when(F.col("notes").isNotNull(), F.concat(F.coalesce("reasoning", F.lit("")), "notes")).otherwise(F.col("reasoning"))
    return out.withColumn("reasoning", reasoning).select(*[b for b in block if b not in _OWN], F.col("grp").alias("place"), *_OWN)


_OWN = ("ord", "title", "target", "seller", "confidence", "reasoning")
