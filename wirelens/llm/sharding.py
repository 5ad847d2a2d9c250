"""Sharding by histogram sort.

Documents are ordered by a 192-bit key: a hash of the text, a hash of the id
and a hash of the row's number, so equal texts lie side by side and no group
of equal rows is one key.  Each round counts the exact bytes and rows below
candidate key boundaries (probes) across all partitions and refines only the
probe intervals that still hold a splitter further from its target than the
tolerance.  The rows are then exchanged once.

A splitter falls between two texts wherever such an edge lies within the
tolerance; a group of equal texts is split (by id, then by row) only when it is
too large to stay whole.

Defined cases: a null text has no bytes (size 1, checksum 0); a null doc_id is
kept; rows that are equal in every way, any number of them, are dealt in any
order among themselves; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Scratch, id_and_text, table

N_SHARDS = 16
#: Allowed distance of a splitter from its target, as a part of a shard's bytes.
TOLERANCE = 0.01
#: Bits that one round adds to the probes of an unsettled interval.
DIGIT_BITS = 8
HASHES = ("h1", "h2", "h3")
KEY_BITS = 64 * len(HASHES)
DIGITS = KEY_BITS // DIGIT_BITS
#: Rows that one task of the final exchange numbers, about.
ROWS_A_TASK = 100_000

_MASK, _SIGN = (1 << 64) - 1, 1 << 63


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the key hashes of every document; the last one is of a number that only this row has, so the table must be written before it is read twice."""
    d = id_and_text(docs)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(1)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return d.select("doc_id", size.alias("size"), crc.alias("text_crc32"), *_hashes(F.col("text"), F.col("doc_id")))


def _hashes(text: Column, doc_id: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(doc_id, F.lit("row")).alias("h2"), F.xxhash64(F.monotonically_increasing_id()).alias("h3")]


def _parts(point: int) -> list[int]:
    """The 64-bit parts of a point as signed values, whose order follows the unsigned order."""
    return [(point >> 64 * k & _MASK) - _SIGN for k in reversed(range(len(HASHES)))]


def _below(point: int) -> Column:
    """Whether the key lies below the point."""
    out = F.lit(False)
    for name, x in reversed(list(zip(HASHES, _parts(point), strict=True))):
        out = (F.col(name) < F.lit(x)) | ((F.col(name) == F.lit(x)) & out)
    return out


def _digit(depth: int) -> Column:
    a_hash = DIGITS // len(HASHES)
    bits = F.col(HASHES[depth // a_hash]).bitwiseXOR(F.lit(-_SIGN))
    return F.shiftrightunsigned(bits, 64 - DIGIT_BITS * (depth % a_hash + 1)).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))


def splitters(rows: DataFrame, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE) -> list[int]:
    """The n_shards - 1 key boundaries, from exact histograms; each round brings at most (n_shards - 1) * 256 counts to the driver."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    targets = [total * i / n_shards for i in range(1, n_shards)]
    slack = tolerance * total / n_shards
    found: dict[int, int] = {}
    active = {0: (0, list(range(len(targets))))}  # interval start -> bytes below it, targets in it
    for depth in range(DIGITS):
        if not active or not total:
            break
        width = 1 << (KEY_BITS - DIGIT_BITS * depth)
        inside = F.lit(None).cast("int")
        starts = sorted(active)
        for k, s in enumerate(starts):
            within = F.lit(True) if depth == 0 else ~_below(s) & (_below(s + width) if s + width < 1 << KEY_BITS else F.lit(True))
            inside = F.when(within, F.lit(k)).otherwise(inside)
        counts = rows.select(inside.alias("k"), _digit(depth).alias("d"), "size").where("k is not null").groupBy("k", "d").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
        seen: dict[int, dict[int, tuple[int, int]]] = {}
        for r in counts.collect():
            seen.setdefault(r["k"], {})[r["d"]] = (r["b"], r["n"])
        step, after = width >> DIGIT_BITS, {}
        for k, s in enumerate(starts):
            base, wanted = active[s]
            low = base
            for d in range(1 << DIGIT_BITS):
                b, n = seen.get(k, {}).get(d, (0, 0))
                for t in [t for t in wanted if low <= targets[t] < low + b]:
                    left, right = targets[t] - low, low + b - targets[t]
                    if min(left, right) <= slack or n == 1 or depth == DIGITS - 1:
                        found[t] = s + d * step if left <= right else s + (d + 1) * step
                    else:
                        after.setdefault(s + d * step, (low, []))[1].append(t)
                low += b
        active = after
    return [found.get(t, 1 << KEY_BITS) for t in range(len(targets))]


def assign(rows: DataFrame, points: list[int]) -> DataFrame:
    """Adds the shard that the splitters give each key."""
    shard = F.lit(0)
    for p in points:
        shard = shard + F.when(F.lit(p >= 1 << KEY_BITS) | _below(min(p, (1 << KEY_BITS) - 1)), 0).otherwise(1)
    return rows.withColumn("shard", shard.cast("int"))


def shards(docs: DataFrame, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard) of every document.

    Slots are numbered in parallel: each shard is dealt over tasks by the row
    hash, and the tasks' row counts, summed in Spark, give their first slots.
    """
    rows = Scratch(docs.sparkSession, "sharding").table(keyed(docs), "keys")
    placed = assign(rows, splitters(rows, n_shards, tolerance))
    parts = max(4, -(-rows.count() // (n_shards * ROWS_A_TASK)))
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("h3", F.lit(1)), F.lit(parts)).cast("int"))
    counts = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))  # a row for each task
    before = F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    numbered = dealt.withColumn("within", F.row_number().over(W.partitionBy("shard", "part").orderBy(*HASHES, "doc_id")) - 1)
    found = numbered.join(counts.select("shard", "part", before.alias("at")), ["shard", "part"])
    return found.select("doc_id", "size", "text_crc32", "shard", (F.col("at") + F.col("within")).alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE, mode: str = "errorifexists") -> None:
    """Writes the documents, with all their columns, one folder a shard; the texts are not shuffled for it.

    A group of wholly equal rows that is split is dealt by row hash, evenly but for chance.
    """
    rows = Scratch(docs.sparkSession, "sharding").table(keyed(docs), "keys")
    points = splitters(rows, n_shards, tolerance)
    inner = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *_hashes(docs["text"].cast("string"), docs["doc_id"].cast("long")))
    assign(inner, points).select("row.*", F.col("shard").alias("wirelens_shard")).write.mode(mode).partitionBy("wirelens_shard").parquet(path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = shards(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
