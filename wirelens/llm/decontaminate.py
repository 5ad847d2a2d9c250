"""Benchmark decontamination as a prefix-filtered set join.

Items are cut into windows of WINDOW consecutive words (a shorter item is one
window).  A window is contained in a document only if all its shingles of
SHINGLE words are, so by the prefix filter for containment one shingle a
window is a sufficient prefix.

1. The items' windows and shingles become tables; equal windows of several
   items are one.  A Bloom filter of the shingles, of bounded size, goes to
   every task; what it lets through in error only costs time.
2. Documents are read once.  Each gives its word count and, where shingles
   pass the filter, runs: the words around those places, and the shingles.
3. Shingles are ordered by rarity, counted over all documents' runs, and each
   window is indexed under its rarest one.  The runs' shingles are joined with
   that index; a match fixes where the window would have to begin (positional
   bound), which must leave room for all its words (length bound), and only
   then the words of the run are compared with the window's.
4. Hits return to the documents by the text's fingerprint, so copies are
   joined once and neither texts nor the benchmark go to the driver.

Defined cases: null texts have no words; an item without words has no window;
items with one id count once; an item with a null id marks words but is not
listed; a null doc_id is kept; repeated rows are judged alike; without items
nothing is contaminated; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Scratch, id_and_text, map_arrow, table
from .wordhash import ODD, WordHasher, Words

WINDOW, SHINGLE = 10, 5
#: The filter has so many bits for a shingle, and MAX_FILTER_BITS at most (a power of two); a larger benchmark lets more through.
FILTER_BITS, MAX_FILTER_BITS, PROBES = 16, 1 << 27, 4
#: Bytes of text that are hashed at once; a longer text is hashed alone.
SLICE = 1_000_000

_WORD_BYTES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32 for c in range(256))


def plain(text: str | None) -> bytes:
    """The text with a blank for every byte of no word, letters A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_WORD_BYTES) if text else b""


def fingerprint(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def _slices(texts: list[str | None]):
    """(first, raws) of lists of texts of about SLICE bytes."""
    held: list[bytes] = []
    size = at = 0
    for k, t in enumerate(texts):
        raw = plain(t)
        if held and size + len(raw) > SLICE:
            yield at, held
            held, size, at = [], 0, k
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield at, held


def _windows(batches):
    """(item_id, words, size, offs, hs): the windows of every item with their shingles; a window of fewer than SHINGLE words is its own shingle."""
    hasher = WordHasher()
    names = ["item_id", "words", "size", "offs", "hs"]
    for batch in batches:
        for k in range(batch.num_rows):
            raw = plain(batch.column(1)[k].as_py())
            w, own = raw.split(), hasher.words([raw])
            size = min(WINDOW, len(w))
            q = min(SHINGLE, size)
            h = own.shingles(q).view(np.int64) if size else np.empty(0, np.int64)
            many, each = (len(w) - size + 1, size - q + 1) if size else (0, 0)
            for low in range(0, many, 20_000):
                at = range(low, min(many, low + 20_000))
                rows = [[batch.column(0)[k].as_py()] * len(at), [b" ".join(w[i : i + size]).decode("utf-8", "surrogatepass") for i in at], [size] * len(at), [list(range(each))] * len(at), [h[i : i + each] for i in at]]
                types = (pa.string(), pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, types, strict=True)], names=names)


_WINDOWS = "item_id string, words string, size int, offs array<int>, hs array<long>"


class Filter:
    """A Bloom filter over 64-bit hashes."""

    def __init__(self, log_bits: int, data: np.ndarray):
        self.log_bits, self.data = log_bits, data

    @staticmethod
    def probes(h: np.ndarray, log_bits: int):
        for k in range(PROBES):
            yield (h ^ h >> np.uint64(17 + k)) * np.uint64(ODD + 2 * k * 0x632BE59BD9B4E019 & (1 << 64) - 1 | 1) >> np.uint64(64 - log_bits)

    def holds(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that pass."""
        at = np.arange(len(h))
        for p in range(PROBES):
            bit = next(b for k, b in enumerate(self.probes(h[at], self.log_bits)) if k == p)
            at = at[(self.data[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)]
        return at

    @classmethod
    def of(cls, hashes: DataFrame) -> Filter:
        """Over the distinct hashes (one column, h); the bits are set in Spark and at most MAX_FILTER_BITS / 64 rows reach the driver."""
        n = hashes.count()
        log_bits = max(6, min(MAX_FILTER_BITS.bit_length() - 1, (max(1, n) * FILTER_BITS - 1).bit_length()))

        def run(batches):
            for batch in batches:
                bits = np.concatenate(list(cls.probes(batch.column(0).to_numpy().view(np.uint64), log_bits)))
                yield pa.RecordBatch.from_arrays([pa.array((bits >> np.uint64(3)).astype(np.int64)), pa.array((1 << (bits & np.uint64(7)).astype(np.int64)))], names=["at", "b"])

        got = map_arrow(hashes, run, "at long, b long").groupBy(F.floor(F.col("at") / 8).alias("w")).agg(*[F.bit_or(F.when(F.col("at") % 8 == k, F.col("b")).otherwise(0)).cast("int").alias(f"b{k}") for k in range(8)]).toArrow()
        data = np.zeros((1 << log_bits) // 8, np.uint8)
        w = got.column("w").to_numpy()
        for k in range(8):
            data[w * 8 + k] = got.column(f"b{k}").to_numpy()
        return cls(log_bits, data)


_MARKED = "doc_id long, print string, n_words long, runs array<struct<at:int,words:string,pos:array<int>,h:array<long>>>"


def _runs(words: Words, seen: Filter, lengths: list[int], n_docs: int) -> list[list[dict]]:
    """The runs of each text of a slice."""
    places, hashes = [], []
    doc_of = np.repeat(np.arange(n_docs), np.diff(words.first))
    for q in lengths:
        h = words.shingles(q)
        at = seen.holds(h)
        at = at[doc_of[at] == doc_of[at + q - 1]]
        places.append(at)
        hashes.append(h[at])
    out: list[list[dict]] = [[] for _ in range(n_docs)]
    if not places or not sum(map(len, places)):
        return out
    pos, h = np.concatenate(places), np.concatenate(hashes).view(np.int64)
    order = np.argsort(pos, kind="stable")
    pos, h = pos[order], h[order]
    doc = doc_of[pos]
    edge = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (pos[1:] - pos[:-1] >= 2 * WINDOW), [True])))
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        d = int(doc[a])
        first, last = int(words.first[d]), int(words.first[d + 1])
        low, high = max(first, int(pos[a]) - WINDOW + 1), min(last, int(pos[b - 1]) + WINDOW)
        text = b" ".join(words.data[words.start[low] : words.end[high - 1]].tobytes().split()).decode("utf-8", "surrogatepass")
        out[d].append({"at": low - first, "words": text, "pos": (pos[a:b] - first).tolist(), "h": h[a:b].tolist()})
    return out


def _mark(seen: Filter | None, lengths: list[int]):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    runs_type = to_arrow_schema(_parse_datatype_string(_MARKED)).field("runs").type

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                for at, raws in _slices(part.column(2).to_pylist()):
                    words = hasher.words(raws)
                    runs = _runs(words, seen, lengths, len(raws)) if seen else [[] for _ in raws]
                    own = part.slice(at, len(raws))
                    yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(np.diff(words.first), pa.int64()), pa.array(runs, runs_type)], names=["doc_id", "print", "n_words", "runs"])

    return run


def _hits(docs: DataFrame, benchmark: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(doc_id, print, n_words) of every document, and (print, spans, items) of every text with a hit."""
    items = benchmark.select(benchmark["item_id"].cast("string").alias("item_id"), benchmark["text"].cast("string").alias("text")).where("text is not null")
    raw = scratch.table(map_arrow(items, _windows, _WINDOWS), "windows")
    each = raw.groupBy("words").agg(F.first("size").alias("size"), F.first("offs").alias("offs"), F.first("hs").alias("hs"))
    each = scratch.table(each.select("words", "size", F.explode(F.arrays_zip("offs", "hs")).alias("x")).select("words", "size", "x.offs", F.col("x.hs").alias("h")), "shingles")
    lengths = sorted(r[0] for r in each.select(F.least("size", F.lit(SHINGLE))).distinct().collect())  # SHINGLE values at most
    seen = Filter.of(each.select("h").distinct()) if lengths else None
    d = id_and_text(docs).select("doc_id", fingerprint(F.col("text")).alias("print"), "text")
    marked = scratch.table(map_arrow(d, _mark(seen, lengths), _MARKED), "marked")
    some = marked.where(F.size("runs") > 0).groupBy("print").agg(F.first("n_words").alias("n_words"), F.first("runs").alias("runs"))  # copies are joined once
    runs = scratch.table(some.select("print", "n_words", F.posexplode("runs").alias("run", "x")).select("print", "n_words", "run", "x.*"), "runs")
    places = runs.select("print", "run", "n_words", F.explode(F.arrays_zip("pos", "h")).alias("x")).select("print", "run", "n_words", "x.pos", "x.h")
    counts = places.groupBy("h").agg(F.count("*").alias("n"))
    rarest = each.join(counts, "h", "left").groupBy("words", "size").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "offs")).alias("x"))
    prefix = rarest.where("x.n > 0").select("words", "size", "x.h", "x.offs")
    start = F.col("pos") - F.col("offs")
    fits = places.join(prefix, "h").where((start >= 0) & (start + F.col("size") <= F.col("n_words"))).select("print", "run", start.alias("start"), "size", "words")
    tried = fits.groupBy("print", "run").agg(F.collect_list(F.struct("start", "size", "words")).alias("c"))  # of one run
    same = F.expr("element_at(transform(array(split(words, ' ')), w -> filter(c, x -> array_join(slice(w, x.start - at + 1, x.size), ' ') = x.words)), 1)")
    held = tried.join(runs.select("print", "run", "at", "words"), ["print", "run"]).select("print", F.explode(same).alias("x"))
    hits = scratch.table(held.select("print", F.col("x.start").cast("long").alias("start"), (F.col("x.start") + F.col("x.size")).cast("long").alias("end"), "x.words"), "hits")
    by_start = W.partitionBy("print").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    places = hits.select("print", "start", "end").distinct().withColumn("new", F.coalesce(F.col("start") > F.max("end").over(by_start), F.lit(True)).cast("int"))
    turned = places.withColumn("island", F.sum("new").over(W.partitionBy("print").orderBy("start", "end").rowsBetween(W.unboundedPreceding, 0)))
    spans = turned.groupBy("print", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).groupBy("print").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    named = hits.select("print", "words").distinct().join(raw.where("item_id is not null").select("words", "item_id").distinct(), "words").select("print", "item_id").distinct()
    listed = named.groupBy("print").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    return marked.select("doc_id", "print", "n_words"), scratch.table(spans.join(listed, "print", "left"), "found")


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, spans (word places that item windows cover, joined where they touch) and items (ids, as sorted strings) of every document."""
    base, found = _hits(docs, benchmark, Scratch(docs.sparkSession, "decontaminate"))
    got = base.join(found, "print", "left")
    return got.select("doc_id", "n_words", F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def n_hit() -> Column:
    """Words that the spans cover."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that hold no window of any item; null and empty texts stay, copies go or stay together."""
    found = _hits(docs, benchmark, Scratch(docs.sparkSession, "decontaminate"))[1]
    return docs.join(found.select(F.col("print").alias("wirelens_print")), fingerprint(docs["text"]) == F.col("wirelens_print"), "left_anti")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hits = n_hit()
    return got.select("doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hits > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i + 1:i + n], ' ') AS x
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win),
places AS (
  SELECT rid, n, i, array_to_string(w[i + 1:i + n], ' ') AS x
  FROM (SELECT rid, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)
), hit AS (SELECT rid, item_id, places.n, i FROM places JOIN win ON win.n = places.n AND win.x = places.x),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
listed AS (SELECT rid, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM (SELECT DISTINCT rid, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(listed.n, 0)::BIGINT AS n_items,
       sha256(coalesce(listed.s, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN listed USING (rid)
"""
