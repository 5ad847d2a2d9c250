"""Connected components of a distributed edge table, by alternating large and small stars.

Every round is two aggregations and two joins over the edges; each table is
written before the next reads it.  The aggregated side of a join gets an
exchange of its own, so that both sides are plain exchanges and a vertex with
very many neighbours can be split at run time.  Neither edges nor components
come to the driver; the rounds end when the edges stay as they
are, which they do after O(log n) rounds or so.

Defined cases: a loop links nothing and gives no row; repeated edges count
once; without edges there are no rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

ROWS_A_FILE = 500_000


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of every vertex of an edge (columns a, b); the root is the component's smallest vertex and is listed too."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = scratch.table(edges.groupBy("u", "v").agg(F.lit(1).alias("x")).select("u", "v"), f"{name}-0")
    files = max(4, edges.count() // ROWS_A_FILE)  # later tables have about as many rows; few rows need few tasks
    state = None
    for k in itertools.count(1):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low.repartition("u"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.table(large.where("u <> v").groupBy("u", "v").agg(F.lit(1).alias("x")).select("u", "v"), f"{name}-{k}a", files)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.repartition("u"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(low.select("u", F.col("m").alias("v")))
        edges = scratch.table(small.groupBy("u", "v").agg(F.lit(1).alias("x")).select("u", "v"), f"{name}-{k}b", files)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == tuple(now):
            break
        state = tuple(now)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
