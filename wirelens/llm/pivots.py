"""Near-duplicate vectors by a pivot-permutation index.

1. Rows with equal vectors form one class; everything later works on classes,
   so copies cost nothing and are counted, not paired.
2. Reference points ("pivots") come from a bounded sample of the classes, those
   of the least hashes, of which none is near another taken before; seeded
   random directions fill up what is missing.  There are more of them, and more
   of them must be shared, the more vectors there are (LEVELS).
3. A vector is described by its nearest pivots in their order.  Inverted lists
   hold the vectors of every combination of ``shared`` of those pivots, so two
   vectors with so many in common meet in a list.
4. In a list the pivots that two vectors share are counted, up to the list's
   last pivot: a pair belongs to the list of its lowest shared pivots alone and
   so is looked at once.  Members without a pair of their own leave before any
   vector is fetched.
5. The rest are verified by the cosine in double precision, as a matrix product
   of a list.  A list of more than BLOCK members is dealt into blocks, and every
   two blocks meet in a task of their own: no cap, no pairs as rows.  A task
   returns sums of links and a spanning forest.
6. Components of the forests give each vector the smallest id that it reaches.

Recall is that of step 4, as what is verified is exact: two vectors at a cosine
of 0.95 share the pivots asked for with a chance of 0.95 to 0.99 (64 dimensions),
at 0.98 with 0.999.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
components links with nothing; vectors of different lengths never link; equal
vectors link, whatever their ids; repeated rows are copies; null ids are ignored
by the minimum (a component without any id has none), and a row without an id is
kept if its component has none.  Labels and extra columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .components import components


class Index(NamedTuple):
    """How many pivots there are, how many describe a vector, and how many a pair must share."""

    pivots: int
    near: int
    shared: int


#: The index for up to so many distinct vectors.
LEVELS = ((20_000, Index(512, 8, 3)), (1_000_000, Index(2048, 8, 3)), (30_000_000, Index(4096, 10, 4)), (1 << 62, Index(8192, 11, 4)))
#: Sampled vectors for each pivot, and the cosine from which two are too near to be pivots both.
SAMPLE, APART = 2, 0.8
#: Members of a list, or of a block of it, that are compared in one go.
BLOCK = 512


def index_for(n: int) -> Index:
    return next(index for most, index in LEVELS if n <= most)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision, however large or small they were."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def choose_pivots(sample: np.ndarray, dim: int, many: int) -> np.ndarray:
    """Pivots of vectors of ``dim`` components: rows of the sample that are apart, then seeded directions."""
    taken = np.empty((many, dim), np.float32)
    n = 0
    for v in sample.astype(np.float32):
        if n == many:
            break
        if n == 0 or (taken[:n] @ v).max() < APART:
            taken[n] = v
            n += 1
    if n < many:
        taken[n:] = unit(np.random.default_rng(dim).normal(size=(many - n, dim)))
    return taken


def nearest(vectors: np.ndarray, pivots: np.ndarray, near: int) -> np.ndarray:
    """The numbers of each vector's nearest pivots, nearest first."""
    cosine = vectors.astype(np.float32) @ pivots.T
    found = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
    order = np.argsort(-np.take_along_axis(cosine, found, 1), axis=1, kind="stable")
    return np.take_along_axis(found, order, 1).astype(np.int32)


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _describe(sample: dict[int, np.ndarray], index: Index):
    """For mapInArrow over (key, dim, v): a row for each inverted list of a vector."""
    combos = np.array(list(itertools.combinations(range(index.near), index.shared)))
    weight = index.pivots ** np.arange(index.shared - 1, -1, -1, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in pivots:
                    pivots[dim] = choose_pivots(sample.get(dim, np.empty((0, dim))), dim, index.pivots)
                mine = batch.filter(pa.array(dims == dim))
                for at in range(0, mine.num_rows, 1024):
                    part = mine.slice(at, 1024)
                    near = nearest(unit(_matrix(part.column(2), dim)), pivots[dim], index.near)
                    lists = (np.sort(near, 1).astype(np.int64)[:, combos] * weight).sum(2)
                    many = len(combos)
                    nears = pa.FixedSizeListArray.from_arrays(pa.array(np.repeat(near, many, 0).ravel()), index.near).cast(pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(lists.size, dim, np.int32)), pa.array(lists.ravel()), pa.array(np.repeat(part.column(0).to_numpy(), many)), nears], names=["dim", "list", "key", "near"])

    return run


def own_pairs(near: np.ndarray, block: np.ndarray, last: int, shared: int, across: bool) -> np.ndarray:
    """Which pairs belong to a list: those whose shared pivots up to its last one are the list's own; across blocks only pairs of two blocks."""
    if len(near) <= 16:
        low = np.where(near <= last, near, -1 - np.arange(len(near))[:, None])  # what is above the last is shared with none
        count = (low[:, None, :, None] == low[None, :, None, :]).sum((2, 3))
    else:
        pivots, at = np.unique(near, return_inverse=True)
        has = np.zeros((len(near), len(pivots)), np.float32)
        np.put_along_axis(has, at.reshape(near.shape), 1, 1)
        has = has[:, pivots <= last]
        count = has @ has.T
    own = np.triu(count == shared, 1)
    return own & (block[:, None] != block[None, :]) if across else own


class Cells:
    """The cells of a batch, with their members end to end."""

    def __init__(self, batch: pa.RecordBatch, near: int):
        members = batch.column("members")
        self.ends = np.concatenate(([0], np.cumsum(members.value_lengths().to_numpy())))
        self.members = members.flatten()
        self.near = _matrix(self.members.field("near"), near)
        self.block = self.members.field("block").to_numpy()
        self.columns = {n: batch.column(n).to_numpy() for n in CELL}
        self.cell = np.repeat(np.arange(batch.num_rows), np.diff(self.ends))

    def pairs(self, index: Index) -> Iterator[tuple[int, slice, np.ndarray]]:
        """Each cell's number, members, and which of their pairs are its own."""
        last, across = self.columns["list"] % index.pivots, self.columns["low"] != self.columns["high"]
        for k in range(len(last)):
            at = slice(self.ends[k], self.ends[k + 1])
            yield k, at, own_pairs(self.near[at], self.block[at], last[k], index.shared, across[k])


CELL = ["dim", "list", "low", "high"]


def _shortlist(index: Index):
    """For mapInArrow over cells: the members that have a pair of their own in the list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = Cells(batch, index.near)
            keep = np.zeros(len(cells.cell), bool)
            for _, at, own in cells.pairs(index):
                keep[at] = own.any(0) | own.any(1)
            kept, of = cells.members.filter(pa.array(keep)), cells.cell[keep]
            yield pa.RecordBatch.from_arrays([*(pa.array(cells.columns[n][of]) for n in CELL), *(kept.field(f) for f in ("key", "near", "block"))], names=[*CELL, "key", "near", "block"])

    return run


def forest(link: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what a symmetric matrix links."""
    left, edges = link.any(1), []
    for root in np.flatnonzero(left):
        if not left[root]:
            continue
        left[root] = False
        front = [root]
        while front:
            i = front.pop()
            found = np.flatnonzero(link[i] & left)
            left[found] = False
            edges += [(i, j) for j in found]
            front += found.tolist()
    return edges


def _verify(index: Index, cosine: float):
    """For mapInArrow over cells with vectors: (a, b, n): n rows link with class a, or an edge from a to b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = Cells(batch, index.near)
            key, copies, vectors = (cells.members.field(f) for f in ("key", "copies", "v"))
            key, copies = key.to_numpy(), copies.to_numpy()
            start = np.concatenate(([0], np.cumsum(vectors.value_lengths().to_numpy())))
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            a, b, n = [], [], []
            for k, at, own in cells.pairs(index):
                v = unit(flat[start[at.start] : start[at.stop]].reshape(-1, cells.columns["dim"][k]))
                link = own & (v @ v.T >= cosine)
                link |= link.T
                some = np.flatnonzero(link.any(1))
                if not len(some):
                    continue
                keys, edges = key[at], np.array(forest(link))
                a += [keys[some], keys[edges[:, 0]]]
                b += [np.full(len(some), -1), keys[edges[:, 1]]]
                n += [link[some] @ copies[at], np.zeros(len(edges), np.int64)]
            if a:
                b = np.concatenate(b)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(b, mask=b < 0), pa.array(np.concatenate(n))], names=["a", "b", "n"])

    return run


def usable(v: Column) -> Column:
    """Whether a vector can link: some component is not zero, and all are finite numbers."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _sample(classes: DataFrame, n: int, rows: int) -> dict[int, np.ndarray]:
    """At most n vectors, of the least hashes, by their length; a hash bound keeps the sort small."""
    h = F.xxhash64("v")
    some = classes.where(h < -(1 << 63) + (1 << 64) * 4 * n // rows) if rows > 4 * n else classes
    by: dict[int, list] = {}
    for r in some.orderBy(h, "v").limit(n).select("v").collect():
        by.setdefault(len(r[0]), []).append(r[0])
    return {dim: unit(np.array(vs)) for dim, vs in by.items()}


def link_vectors(vectors: DataFrame, cosine: float = 0.95, index: Index | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors (vec_id, embedding)."""
    scratch = Scratch(vectors.sparkSession, "pivots")
    v = vectors["embedding"].cast("array<double>")
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), F.when(usable(v), v).alias("v"))
    grouped = rows.where("v is not null").groupBy("v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("rep"))
    classes = scratch.table(grouped.select(F.monotonically_increasing_id().alias("key"), F.size("v").alias("dim"), "*"), "classes")
    n = classes.count()
    index = index or index_for(n)
    sample = _sample(classes, SAMPLE * index.pivots, n)
    lists = scratch.table(classes.select("key", "dim", "v").mapInArrow(_describe(sample, index), "dim int, list long, key long, near array<int>"), "lists")
    size = lists.groupBy("dim", "list").agg(F.count("*").alias("c")).where("c > 1")
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    placed = lists.join(size, ["dim", "list"]).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("dim", "list", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "key", "near", "block")
    cells = met.groupBy(*CELL).agg(F.collect_list(F.struct("key", "near", "block")).alias("members"))  # two blocks at most
    own = scratch.table(cells.where(F.size("members") > 1).mapInArrow(_shortlist(index), "dim int, list long, low int, high int, key long, near array<int>, block int"), "own")
    full = own.join(classes.select("key", "copies", "v"), "key").groupBy(*CELL).agg(F.collect_list(F.struct("key", "near", "block", "copies", "v")).alias("members"))
    found = scratch.table(full.mapInArrow(_verify(index, cosine), "a long, b long, n long"), "found")
    root = components(found.where("b is not null").select("a", "b"), scratch, "vectors")
    of = root.join(classes.select(F.col("key").alias("node"), "rep"), "node")
    least = of.groupBy("root").agg(F.min("rep").alias("least"))
    joined = of.join(least, "root").select(F.col("node").alias("key"), "least", F.lit(True).alias("linked"))
    links = found.groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n"))
    to = classes.join(links, "key", "left").join(joined, "key", "left").select("v", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.when(F.col("linked"), F.col("least")).otherwise(F.col("rep")).alias("component"), F.lit(True).alias("usable"))
    out = rows.join(to, "v", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("usable"), F.col("component")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


#: All pairs, for the small tables.
ORACLE = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), u AS MATERIALIZED (
  SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.rid AS a, b.rid AS b FROM u a JOIN u b ON a.rid <> b.rid AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_id AS (SELECT a AS rid, min(vec_id) AS m FROM reach JOIN v ON v.rid = reach.b GROUP BY a),
n AS (SELECT a AS rid, count(*) AS n FROM links GROUP BY a),
o AS (SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, m) AS component_id FROM v LEFT JOIN n USING (rid) LEFT JOIN least_id USING (rid))
SELECT *, vec_id IS NOT DISTINCT FROM component_id AS kept FROM o
"""
