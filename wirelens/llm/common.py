"""Shared plumbing of the training-data operators.

Every operator reads only the columns it needs, so extra columns of any name
never clash with internal ones.  Intermediate tables are written as Parquet
below the shared folder named by ``spark.checkpoint.dir`` and read back, which
cuts lineage and survives lost executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share, named by ``spark.checkpoint.dir``; set here only where it is unset and all runs in one process (tests)."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "/tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Bytes of tables from which the shuffle files behind them are worth a clean-up.
RELEASE_BYTES = 16_000_000


class Scratch:
    """A folder for the intermediate tables of one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/wirelens/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str, files: int | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        (df.coalesce(files) if files else df).write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def _path(self, name: str = ""):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def release(self) -> None:
        """Lets Spark remove the shuffle files of jobs that are over; it does so, in the background, once their plans are collected.  Where little was written there is little to remove."""
        import gc
        import time

        path, fs = self._path()
        if fs.getContentSummary(path).getLength() < RELEASE_BYTES:
            return
        for _ in range(2):
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(0.3)

    def drop(self, name: str) -> None:
        """Remove a table that no later plan reads."""
        path, fs = self._path(name)
        fs.delete(path, True)


#: Rows of one Arrow batch, where the session has the default: texts may be long.
BATCH_ROWS = 500


def bounded_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def give_back() -> None:
    """Returns a Python worker's freed memory to the system, as the process may stay idle for long."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not the GNU C library
        pass


def tidy(run: Callable) -> Callable:
    """For mapInArrow: a task gives its freed memory back when it ends."""

    def wrapped(batches):
        yield from run(batches)
        give_back()

    return wrapped


def tidy_groups(run: Callable) -> Callable:
    """For applyInArrow over one or two tables: the same after each group."""
    import inspect

    if len(inspect.signature(run).parameters) == 2:

        def two(left: pa.Table, right: pa.Table) -> pa.Table:
            got = run(left, right)
            give_back()
            return got

        return two

    def one(group: pa.Table) -> pa.Table:
        got = run(group)
        give_back()
        return got

    return one


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    return df.mapInArrow(tidy(run), schema)


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id (long) and text, and nothing else."""
    bounded_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def least_hashed(docs: DataFrame, n: int, rows: int) -> DataFrame:
    """text of n documents (doc_id, text), those of the least hashes, whatever the layout; rows that are equal count once.

    ``rows`` is about how many there are: only hashes below a bound that some
    4 n of them fall under are sorted, so no task reads more than that.
    """
    h = F.xxhash64("doc_id", "text")
    if rows > 4 * n:
        docs = docs.where(h < -(1 << 63) + (1 << 64) * 4 * n // rows)
    return docs.select(h.alias("h"), "text").groupBy("h").agg(F.first("text").alias("text")).orderBy("h").limit(n).select("text")


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str, step: int = 2000) -> DataFrame:
    """mapInArrow over slices of at most ``step`` rows.

    ``make`` runs once in each task and returns the function that turns a
    dict of column lists into a dict of output columns.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            work = work or make()
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                got = work({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in out], schema=out)

    return map_arrow(df, run, schema)


def span_sql(kind: str, number: int, pattern: str, keep: str, need: str) -> str:
    """SQL of a kind's leftmost non-overlapping matches in d (rid, text): rid, k, kind, s (code points ahead) and v; keep may use v, need is an expression that a text must hold."""
    return rf"""SELECT rid, {number} AS k, '{kind}' AS kind, v, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s
  FROM (SELECT *, m[i] AS v FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT rid, regexp_extract_all(text, '{pattern}') AS m, regexp_split_to_array(text, '{pattern}') AS g FROM d WHERE regexp_matches(text, '{need}')))) WHERE {keep}"""


def spans_sql(kinds: list[tuple[str, str, str, str]]) -> str:
    """SQL of the base columns of a span query over documents: counts, the digest and the joined spans."""
    found = "\n  UNION ALL BY NAME ".join(span_sql(kind, k, *rest) for k, (kind, *rest) in enumerate(kinds))
    counts = ", ".join(f"count(*) FILTER (k = {k}) AS n_{kind}" for k, (kind, *_) in enumerate(kinds))
    shown = ", ".join(f"coalesce(n_{kind}, 0)::BIGINT AS n_{kind}" for kind, *_ in kinds)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
f AS (
  {found}
), j AS (SELECT rid, {counts}, string_agg(kind || ':' || s::BIGINT || ':' || (s + length(v))::BIGINT, ',' ORDER BY s, k) AS spans FROM f GROUP BY rid)
SELECT doc_id, {shown}, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN j USING (rid)
"""
