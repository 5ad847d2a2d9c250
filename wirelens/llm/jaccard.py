"""N-gram Jaccard join with token-combination prefixes.

Two documents link when their sets of word shingles have at least a given
Jaccard similarity: by default shingles of five words and 80 percent.

1. Documents with equal sets form one class, found by a 128-bit fingerprint;
   everything later works on classes.
2. First filter: any two linked sets share k or more of the shingles in their
   prefixes extended by k - 1, in hash order; k is a tenth of the smaller set
   (KEEP at least).  Classes with fewer prefix shingles that any other class
   has cannot link and leave.
3. The sets of the classes that stay are ordered by rarity (exact counts among
   them).  A set of n shingles has overlap bound a = ceil(n * percent / 100).
   Extending the prefix to n - a + k shingles makes linked sets share at
   least k of them.  Rare shingles (in at most RARE sets) are indexed singly.
   Frequent ones are dealt into C hash classes, with k = C + 1, so that two
   shared frequent shingles fall in one class: pairs of frequent shingles of
   one class are indexed (2-token combinations).  C grows with n, which keeps
   the number of combinations in proportion to n.
4. An entry tells the largest size that a partner may have there: sets of n
   and m shingles must share ceil(percent * (n + m) / (100 + percent)), which
   leaves the fewer places for a common entry the larger the partner is.
   A bucket of at most RARE sets gives its pairs that are in each other's
   reach; they are made distinct and verified on the full sets.
5. A larger bucket is dealt by pairs of size bands (BAND), each with the sets
   of one band that reach the other; a part without both ends is dropped, a
   small one gives pairs.  So sets that share a long passage but differ by more
   than the similarity allows part here, however many they are.
6. A part that is still large gives only a star.  Stars join into families, cut
   into blocks of bounded size.  Each block is compared with itself and the family's
   first block, by a matrix product that returns a spanning forest, never all
   pairs.  What the largest group so found leaves of a family is then compared
   with the whole family; the group itself is connected and is not.
7. Components of the verified links give every document the smallest doc_id
   that it reaches.

Shingles are 64-bit hashes.  Defined cases: a document without words, or null,
has an empty set and links with nothing; one of fewer words than a shingle has
its whole sequence as its only shingle; null ids are ignored by the minimum (a
component without any id has none); repeated rows are copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, id_and_text, map_arrow, table, tidy_groups
from .components import components
from .wordhash import ODD, WordHasher, mix


class Rule(NamedTuple):
    """Words of a shingle, and the similarity that links, in percent."""

    shingle: int = 5
    percent: int = 80


#: The first filter's extension: a tenth of the set, KEEP at least.
KEEP, KEEP_PART = 8, 10
#: Sets that hold a rare shingle, at most.
RARE = 16
#: Shingles of a set for which one hash class of frequent shingles is used.
CLASS_SPAN = 128
#: Ratio of the sizes that bound a size band.
BAND = 1.05
#: Sets and shingles of one block of a family.
BLOCK_SETS, BLOCK_SHINGLES = 512, 500_000
#: Class representatives whose ids are broadcast to fetch their texts; more are fetched by a shuffled join.
BROADCAST_IDS = 500_000


#: Bytes of text that are hashed at once; a longer text is hashed alone.
_SLICE = 1_000_000


class Hasher(WordHasher):
    """Shingle sets of many texts at once."""

    def __init__(self, shingle: int):
        super().__init__()
        self.shingle = shingle

    def _slice(self, raws: list[bytes]) -> list[np.ndarray]:
        words = self.words(raws)
        w, at, h, size = words.hashes, words.first, words.shingles(self.shingle), self.shingle
        out = []
        for k in range(len(raws)):
            a, b = at[k], at[k + 1]
            if b - a >= size:
                out.append(np.unique(h[a : b - size + 1]))
            elif b > a:  # the whole sequence, told apart by its length
                x = np.full(1, b - a, np.uint64)
                for i in range(a, b):
                    x = mix(x * np.uint64(ODD) + w[i])
                out.append(x)
            else:
                out.append(np.empty(0, np.uint64))
        return out

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """Each text's distinct hashes, ascending."""
        out: list[np.ndarray] = []
        held: list[bytes] = []
        size = 0
        for t in texts:
            raw = t.encode("utf-8", "surrogatepass").lower() if t else b""
            if held and size + len(raw) > _SLICE:
                out += self._slice(held)
                held, size = [], 0
            held.append(raw)
            size += len(raw) + 1
        return out + self._slice(held) if held else out


def least_shared(n: int, percent: int) -> int:
    """Shingles that two linked sets share at least in their extended prefixes, for the smaller set's size n."""
    return min(-(-n * percent // 100), max(KEEP, n // KEEP_PART))


def overlap_bound(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100)


def _print_of(h: np.ndarray) -> bytes | None:
    """The fingerprint of a set; none of an empty one."""
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None


def _sets(rule: Rule, prefix_only: bool):
    def run(batches):
        hasher = Hasher(rule.shingle)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sizes, keys, values, ends = [], [], [], [0]
                for h in hasher.sets(part.column(1).to_pylist()):
                    n = len(h)
                    sizes.append(n)
                    keys.append(_print_of(h))
                    h = h[: n - -(-n * rule.percent // 100) + least_shared(n, rule.percent)] if prefix_only else h
                    values.append(h)
                    ends.append(ends[-1] + len(h))
                flat = np.concatenate(values).view(np.int64) if values else np.empty(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), lists], names=["doc_id", "n", "print", "tokens"])

    return run


_SETS = "doc_id long, n long, print binary, tokens array<long>"


def levels(n: int, percent: int) -> set[int]:
    """Class counts that a set of n shingles is indexed under: those of every size that it can link with."""
    of = lambda m: 1 << max(0, (m // CLASS_SPAN).bit_length() - 1)
    return {of(-(-n * percent // 100)), of(n), of(n * 100 // percent)}


def _index(percent: int):
    """For mapInArrow: (key, n, bucket, far) of every indexed single shingle and combination; tokens are (count, hash), rarest first.

    ``far`` is the largest size of a set that may be met there: one of m
    shingles is met in the first n - ceil(percent * (n + m) / (100 + percent)) + c + 1.
    """

    def run(batches):
        key_of = lambda a, b, c: ((a * np.uint64(0x9E3779B97F4A7C15) ^ b) * np.uint64(0xC2B2AE3D27D4EB4F) ^ (b >> np.uint64(31))) * np.uint64(0x165667B19E3779F9) + np.uint64(c)
        for batch in batches:
            for k in range(batch.num_rows):
                n, tokens = batch.column(1)[k].as_py(), batch.column(2)[k].values
                count = tokens.field(0).to_numpy(zero_copy_only=False)
                h = tokens.field(1).to_numpy(zero_copy_only=False).view(np.uint64)
                spare = n - len(h)  # shingles of no other set: the rarest, first in the prefix
                bound = -(-n * percent // 100)
                buckets, reach = [], []
                for c in levels(n, percent):
                    few = max(0, n - bound + min(c + 1, bound) - spare)
                    place = spare + 1 + np.arange(len(h[:few]))
                    far = np.minimum((100 + percent) * (n + c + 1 - place) // percent - n, n * 100 // percent)
                    rare = count[:few] <= RARE
                    buckets.append(h[:few][rare])
                    reach.append(far[rare])
                    often, often_far = h[:few][~rare], far[~rare]
                    for own in range(c):
                        mine = often % np.uint64(c) == own
                        t, t_far = often[mine], often_far[mine]
                        if len(t) > 1:
                            i, j = np.triu_indices(len(t), 1)
                            buckets.append(key_of(np.minimum(t[i], t[j]), np.maximum(t[i], t[j]), c))
                            reach.append(t_far[j])  # the later place is the nearer bound
                if not buckets:
                    continue
                every, reach = np.concatenate(buckets), np.concatenate(reach)
                order = np.lexsort((-reach, every))
                every, reach = every[order], reach[order]
                first = np.ones(len(every), bool)
                first[1:] = every[1:] != every[:-1]
                every, reach = every[first], reach[first]
                for at in range(0, len(every), 20_000):
                    part = every[at : at + 20_000].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[k].as_py()] * len(part), pa.int64()), pa.array(np.full(len(part), n)), pa.array(part), pa.array(reach[at : at + 20_000], pa.int64())], names=["key", "n", "bucket", "far"])

    return run


def _near_pairs(few: DataFrame, by: list[str], percent: int) -> DataFrame:
    """(a, b): pairs of sets (key, n, far) of a bucket of RARE sets at most that are in each other's reach."""
    held = few.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("key", "n", "far"))).alias("m"))
    near = lambda x, y: (x["far"] >= y["n"]) & (y["far"] >= x["n"]) & (F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent)
    met = F.transform("m", lambda x, i: F.transform(F.filter(F.slice("m", i + 2, F.size("m")), lambda y: near(x, y)), lambda y: F.struct(x["key"].alias("a"), y["key"].alias("b"))))
    return held.select(F.explode(F.flatten(met)).alias("p")).select("p.*")


def _banded(large: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Buckets dealt by pairs of size bands: (key, n, far, bucket, low, high, c, pivot) of parts in which both bands have sets that reach the other."""
    band = lambda size: F.floor(F.log(size.cast("double")) / float(np.log(BAND))).cast("int")
    # no partner is smaller or larger than a set of the bucket
    least, most = F.greatest(overlap_bound(F.col("n"), percent), F.col("lo")), F.least("far", "hi")
    own, other = band(F.col("n")), F.explode(F.sequence(band(least), band(most)))
    parts = large.where(least <= most).select("key", "n", "far", "bucket", own.alias("own"), other.alias("other"))
    parts = parts.select("key", "n", "far", "bucket", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    parts = scratch.table(parts, "bands")
    by = ["bucket", "low", "high"]
    size = parts.groupBy(*by).agg(F.count("*").alias("c"), F.min("key").alias("pivot"), F.min("own").alias("from"), F.max("own").alias("to"))
    size = size.where((F.col("c") > 1) & (F.col("from") == F.col("low")) & (F.col("to") == F.col("high"))).drop("from", "to")
    return parts.drop("own").join(size, by)


def _linked(shared: Column, n: Column, m: Column, percent: int) -> Column:
    return shared * 100 >= (n + m - shared) * percent


def _forest(percent: int):
    """For applyInArrow: a spanning forest of the links within a group of bounded size."""

    def run(group: pa.Table) -> pa.Table:
        keys = group.column("key").to_pylist()
        n = group.column("n").to_numpy()
        sets = [x.values.to_numpy() for x in group.column("tokens")]
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        values, token = np.unique(np.concatenate(sets), return_inverse=True)
        often = np.bincount(token) > 1
        number = np.cumsum(often) - 1
        keep = often[token]
        owner, token = owner[keep], number[token[keep]]
        order = np.argsort(token, kind="stable")
        owner, token = owner[order], token[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        for low in range(0, int(often.sum()), 4096):
            a, b = np.searchsorted(token, (low, low + 4096))
            part = np.zeros((len(sets), 4096), np.float32)
            part[owner[a:b], token[a:b] - low] = 1
            shared += part @ part.T
        link = shared * 100 >= (n[:, None] + n[None, :] - shared) * percent
        left, edges = np.ones(len(keys), bool), []
        for root in range(len(keys)):
            if not left[root]:
                continue
            left[root] = False
            front = [root]
            while front:
                i = front.pop()
                found = np.flatnonzero(link[i] & left)
                left[found] = False
                edges += [(keys[i], keys[j]) for j in found]
                front += found.tolist()
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return run


def _family_links(stars: DataFrame, sets: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Links of families, enough to connect what is linked, without comparing what is connected already.

    First each block of a family is compared with itself and with the family's
    first block, which is linear work.  Of a family of more blocks, the largest
    group that this connects needs no look at itself any more; what is left of
    the family is compared with all of it.
    """
    member = components(stars, scratch, "families").select(F.col("node").alias("key"), F.col("root").alias("family"))
    full = member.join(sets, "key")
    size = full.groupBy("family").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("sets") / BLOCK_SETS, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    full = full.join(size.select("family", blocks.alias("blocks")), "family").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    full = scratch.table(full.select("family", "blocks", "block", "key", "n", "tokens"), "families")
    cells = F.when(F.col("block") > 0, F.array("block")).when(F.col("blocks") > 1, F.sequence(F.lit(1), F.col("blocks") - 1)).otherwise(F.array(F.lit(0)))
    met = full.withColumn("cell", F.explode(cells)).select("family", "cell", "key", "n", "tokens")
    first = scratch.table(met.groupBy("family", "cell").applyInArrow(tidy_groups(_forest(percent)), "a long, b long"), "family-links")
    wide = full.where("blocks > 2").select("family", "blocks", "block", "key", "n")
    if wide.isEmpty():
        return first
    inside = first.join(wide.select(F.col("key").alias("a")), "a", "left_semi")
    group = components(inside, scratch, "family-groups").select(F.col("node").alias("key"), F.col("root").alias("group"))
    held = scratch.table(wide.join(group, "key", "left").withColumn("group", F.coalesce("group", "key")), "grouped")
    main = held.groupBy("family", "group").agg(F.count("*").alias("c")).groupBy("family").agg(F.max(F.struct("c", "group")).alias("m")).select("family", F.col("m.group").alias("main"))
    rest = held.join(main, "family").where("group <> main").select("family", "blocks", "key", "n")
    many = rest.groupBy("family").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    parts = F.ceil(F.greatest(F.col("sets") / BLOCK_SETS, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    rest = rest.join(many.select("family", parts.alias("parts")), "family").withColumn("part", F.pmod(F.xxhash64("key", F.lit(1)), F.col("parts")).cast("int"))
    rest = scratch.table(rest, "family-rest")
    if rest.isEmpty():
        return first
    mine = rest.select("family", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "key")
    theirs = held.select("family", "block", "key").join(rest.select("family", "parts").distinct(), "family").select("family", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block", "key")
    tried = mine.unionByName(theirs).groupBy("family", "part", "block", "key").agg(F.lit(1).alias("x")).drop("x")
    met = tried.join(sets, "key").select("family", "part", "block", "key", "n", "tokens")
    second = met.groupBy("family", "part", "block").applyInArrow(tidy_groups(_forest(percent)), "a long, b long")
    return first.unionAll(scratch.table(second, "family-links-2"))


def classes(docs: DataFrame, scratch: Scratch, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, print) of every document, and (key, print, rep, n) of every class with a set; key is a number given once.

    The table classes-wide, with the prefixes, stays for links(), which drops it.
    """
    wide = scratch.table(map_arrow(id_and_text(docs), _sets(rule, True), _SETS), "documents-wide")
    reps = wide.where("n > 0").groupBy("print").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    reps = scratch.table(reps.select(F.monotonically_increasing_id().alias("key"), "*"), "classes-wide")
    base = scratch.table(wide.select("doc_id", "n", "print"), "documents")
    scratch.drop("documents-wide")
    scratch.release()
    return base, scratch.table(reps.select("key", "print", "rep", "n"), "classes")


def links(docs: DataFrame, reps: DataFrame, scratch: Scratch, rule: Rule) -> DataFrame:
    """(a, b) between classes: a subset of the links that connects every component of linked classes."""
    each = scratch.read("classes-wide", "key long, tokens array<long>").select("key", F.explode("tokens").alias("h"))
    known = each.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    shared = each.join(known, "h").groupBy("key").agg(F.count("*").alias("c"))
    smaller = overlap_bound(F.col("n"), rule.percent)  # no linked set has fewer shingles
    # a set of so few shingles that one more or less is too much links with equal sets only
    need = F.least(overlap_bound(smaller, rule.percent), F.greatest(F.lit(KEEP), F.floor(smaller / KEEP_PART)))
    stay = scratch.table(shared.where(F.col("c") >= -(-rule.percent // max(1, 100 - rule.percent))).join(reps.select("key", "print", "rep", "n"), "key").where(F.col("c") >= need).select("key", "print", "rep"), "stay")
    scratch.drop("classes-wide")
    scratch.release()
    d = id_and_text(docs)
    n_stay = stay.count()
    sent = F.broadcast if n_stay <= BROADCAST_IDS else (lambda df: df)
    wanted = sent(stay.select("rep").distinct())
    texts = d.join(wanted, d["doc_id"].eqNullSafe(wanted["rep"]), "left_semi")
    sets = scratch.table(map_arrow(texts, _sets(rule, False), _SETS).join(sent(stay.select("key", "print")), "print").select("key", "n", "tokens"), "sets")
    if sets.count() > n_stay:  # ids that several rows have brought a set more than once
        sets = scratch.table(sets.groupBy("key").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")), "sets-once")
    each = sets.select("key", F.explode("tokens").alias("h"))
    known = each.groupBy("h").agg(F.count("*").alias("c")).where("c > 1")
    ranked = each.join(known, "h").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("c", "h"))).alias("tokens"))  # a list is one document's set
    ranked = ranked.join(sets.select("key", "n"), "key").where(F.size("tokens") >= overlap_bound(F.col("n"), rule.percent))
    index = scratch.table(map_arrow(ranked.select("key", "n", "tokens"), _index(rule.percent), "key long, n long, bucket long, far long"), "index")
    scratch.release()
    size = index.groupBy("bucket").agg(F.count("*").alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("far").alias("top")).where("c > 1")
    placed = scratch.table(index.join(size, "bucket").where("far >= lo and n <= top").drop("top"), "buckets")
    scratch.release()
    parts = scratch.table(_banded(placed.where(F.col("c") > RARE), scratch, rule.percent), "parts")
    pairs = _near_pairs(placed.where(F.col("c") <= RARE), ["bucket"], rule.percent).unionAll(_near_pairs(parts.where(F.col("c") <= RARE), ["bucket", "low", "high"], rule.percent))
    pairs = pairs.groupBy("a", "b").agg(F.lit(1).alias("x"))
    one, two = (sets.select(F.col("key").alias(k), F.col("n").alias(f"n_{k}"), F.col("tokens").alias(f"t_{k}")) for k in "ab")
    met = pairs.select("a", "b").join(one, "a").join(two, "b")
    checked = met.where(_linked(F.size(F.array_intersect("t_a", "t_b")).cast("long"), F.col("n_a"), F.col("n_b"), rule.percent)).select("a", "b")
    stars = parts.where((F.col("c") > RARE) & (F.col("key") != F.col("pivot"))).groupBy("key", "pivot").agg(F.lit(1).alias("x")).select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    return checked.unionAll(_family_links(stars, sets, scratch, rule.percent))


def _grouped(docs: DataFrame, scratch: Scratch, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, print) of every document, and (print, component, grp) of every class; grp numbers the linked group."""
    base, reps = classes(docs, scratch, rule)
    found = scratch.table(links(docs, reps, scratch, rule), "links")
    scratch.release()
    root = components(found, scratch, "links")
    of = root.join(reps.select(F.col("key").alias("node"), "rep"), "node")
    least = of.groupBy("root").agg(F.min("rep").alias("least"))
    joined = of.join(least, "root").select(F.col("node").alias("key"), "least", "root")
    to = reps.select("key", "print", "rep").join(joined, "key", "left")
    return base, to.select("print", F.coalesce("least", "rep").alias("component"), F.coalesce("root", "key").alias("grp"))


def link_components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    base, to = _grouped(docs, Scratch(docs.sparkSession, "jaccard"), rule)
    return base.join(to, "print", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _print_column(shingle: int):
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = Hasher(shingle)
        for t in texts:
            sets = [h for at in range(0, len(t), 1000) for h in hasher.sets(t.slice(at, 1000).to_pylist())]
            yield pa.array([_print_of(h) for h in sets], pa.binary())

    run.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def keep_one(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The documents, all columns, less all but one row of each linked group: one with the smallest doc_id, a null id last.

    Documents without words are all kept, but a row that has an id and is
    repeated whole is kept once.  Rows that share a doc_id, or have
    none, are told apart by their sets' fingerprints, which only they are
    given here again; the others are found by their ids.
    """
    scratch = Scratch(docs.sparkSession, "keep")
    base, to = _grouped(docs, scratch, rule)
    member = base.where("n > 0").join(to.select("print", "grp"), "print").select("doc_id", "print", "grp")
    first = member.groupBy("grp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")).alias("f")).select("grp", "f.doc_id", "f.print")
    chosen = scratch.table(first, "chosen")
    again = scratch.table(base.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select(F.col("doc_id").alias("id")), "again")
    gone = member.join(chosen.select("doc_id", "print"), ["doc_id", "print"], "left_anti").select(F.col("doc_id").alias("id")).distinct()
    again_sent = F.broadcast(again) if again.count() <= BROADCAST_IDS else again
    columns = docs.columns
    cut = docs.select(F.struct(*[docs[c].alias(c) for c in columns]).alias("row"), docs["doc_id"].cast("long").alias("id"))
    lone = cut.where("id is not null").join(again_sent, "id", "left_anti").join(gone, "id", "left_anti")
    shared = cut.join(again_sent, "id", "left_semi").select("row", "id").unionByName(cut.where("id is null").select("row", "id"))
    marked = shared.withColumn("print", F.arrow_udf(_print_column(rule.shingle), "binary")(F.col("row.text").cast("string")))
    empty = marked.where("print is null")
    wordless = empty.where("id is null").select("row").unionByName(empty.where("id is not null").select("row").distinct())
    c = chosen.select(F.col("doc_id").alias("chosen_id"), F.col("print").alias("chosen_print"))
    best = marked.join(c, (F.col("print") == F.col("chosen_print")) & F.col("id").eqNullSafe(F.col("chosen_id")), "left_semi")
    once = best.groupBy("id", "print").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return lone.select("row").unionByName(wordless).unionByName(once).select("row.*")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents"), Rule(4, 85))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.first, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS first FROM reach GROUP BY a) r USING (doc_id)
"""
