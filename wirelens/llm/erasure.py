"""Erasure that follows links from table to table and rewrites only the files that hold victims.

Tables lie as Parquet files of one folder each.  ``lay_out`` makes such a folder
from rows in a given order; ``erase`` removes what a set of keys leads to:

1. Each file gets a Bloom filter on its link key: xxhash64 of the distinct keys,
   taken by Spark, set as bits in blocks of bounded size by key hash.
2. Step by step (``Step``), keys meet the filters block by block in a join, which
   shortlists files: none that holds a victim is missing.
3. Only those files are read; a semi join on the key itself confirms victims,
   and their rows give the keys of the steps that follow.
4. A task streams each confirmed file through a pyarrow filter into a new file,
   whose footer thus counts survivors only.  The new files are written aside and
   listed in a table; once that table is there, each takes the old one's place,
   and files without survivors go.  A task that runs again writes another file
   aside, so lost executors and repeated tasks change nothing.

Keys never come to the driver; what does is one row a file, and the number of
files is a parameter (``lay_out``).  Files are opened by pyarrow under the same
name on driver and executors, so the folder must be shared.

Defined cases: a null key is no victim's; rows that are equal stay or go
together; an empty table has no files; text, numbers and times come back as they
were; no column is special but those that the steps name, so extra columns of
any name stay in place.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, shared_dir, table

#: Rows and bytes of a row group that is written, and rows that are read at once.
GROUP_ROWS, GROUP_BYTES, READ_ROWS = 131_072, 64_000_000, 32_768
#: Bits for a key of a filter, and bits set for it: about one false hit in 100,000.
BITS, PROBES = 24, 16
#: Keys of a filter's block, and keys that are tested against it at once, about.
BLOCK_KEYS, TEST_KEYS = 500_000, 50_000


class Step(NamedTuple):
    """Rows of a table whose ``key`` is among the victims' go; ``after`` names the table whose victims give the keys (none: the seeds), ``gives`` the column that later steps look for."""

    table: str
    key: str
    after: str | None = None
    gives: str | None = None


class Laid(NamedTuple):
    """A table of files: its columns, and (file_no, path, n_rows) of each file."""

    schema: T.StructType
    files: list[tuple[int, str, int]]


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (pafs.LocalFileSystem(), path)


def plain(path: str) -> str:
    """A local path without a scheme; others as they are."""
    return "/" + path.split(":", 1)[1].lstrip("/") if path.startswith("file:") else path


class Writer:
    """Writes batches as row groups of bounded size, in the folder ``aside``; the file appears under its name when it is whole."""

    def __init__(self, path: str, schema: pa.Schema, aside: str):
        self.fs, self.path = _open(path)
        self.aside, self.schema = f"{_open(aside)[1]}/{uuid.uuid4().hex}", schema
        for folder in (self.path, self.aside):
            self.fs.create_dir(folder.rsplit("/", 1)[0], recursive=True)
        self.sink = self.fs.open_output_stream(self.aside)
        self.out = pq.ParquetWriter(self.sink, schema, compression="zstd")
        self.held: list[pa.RecordBatch] = []
        self.rows = self.bytes = 0

    def write(self, batch: pa.RecordBatch) -> None:
        self.held.append(batch)
        self.rows, self.bytes = self.rows + batch.num_rows, self.bytes + batch.nbytes
        if self.rows >= GROUP_ROWS or self.bytes >= GROUP_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            self.out.write_table(pa.Table.from_batches(self.held, self.schema))
        self.held, self.rows, self.bytes = [], 0, 0

    def close(self) -> None:
        self._flush()
        self.out.close()
        self.sink.close()
        self.fs.move(self.aside, self.path)


def _pieces(path: str, low: int, high: int, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows low to high of a file, reading only the row groups that hold them."""
    fs, at = _open(path)
    with fs.open_input_file(at) as source:
        file = pq.ParquetFile(source)
        start, groups, first = 0, [], None
        for g in range(file.num_row_groups):
            n = file.metadata.row_group(g).num_rows
            if start < high and start + n > low:
                groups.append(g)
                first = start if first is None else first
            start += n
        here = first or 0
        for batch in file.iter_batches(READ_ROWS, row_groups=groups, columns=columns) if groups else ():
            a, b = max(low - here, 0), min(high - here, batch.num_rows)
            if a < b:
                yield batch.slice(a, b - a)
            here += batch.num_rows


_PLAN = "file_no long, path string, n_rows long, pieces array<struct<path: string, low: long, high: long>>"


def _write_files(columns: list[str], aside: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                writer = None
                for piece in row["pieces"]:
                    for got in _pieces(piece["path"], piece["low"], piece["high"], columns):
                        got = got.select(columns)
                        writer = writer or Writer(row["path"], got.schema.remove_metadata(), aside)
                        writer.write(got.replace_schema_metadata(None))
                writer.close()
                yield pa.RecordBatch.from_pydict({"file_no": [row["file_no"]], "path": [row["path"]], "n_rows": [row["n_rows"]]})

    return run


def _dealt(rows: DataFrame, many: int) -> DataFrame:
    """Rows that are work for a task each, or some for a task where there are many more than cores."""
    return rows.repartition(max(1, min(many, 3 * rows.sparkSession.sparkContext.defaultParallelism)))


def fresh(columns: list[str], *names: str) -> list[str]:
    """Names for columns of our own, none of which the table has."""
    taken = {c.lower() for c in columns}
    return [next(f"{n}{'_' * k}" for k in range(len(taken) + 1) if f"{n}{'_' * k}" not in taken) for n in names]


def lay_out(rows: DataFrame, columns: list[str], first: Column, folder: str, name: str, scratch: Scratch, parts: int = 150) -> Laid:
    """Writes the columns of the rows, sorted by ``first`` and all of them, as files of 1 + floor(n / parts) rows each.

    One exchange by range sorts them into a table; a task a file then streams
    the file's rows from it.
    """
    lead, place = fresh(columns, "first", "place")
    keyed = rows.select(first.alias(lead), *[rows[c] for c in columns])
    ranged = keyed.repartitionByRange(lead, *columns).sortWithinPartitions(lead, *columns)
    path = f"{scratch.root}/sorted-{name}"
    ranged.withColumn(place, F.monotonically_increasing_id()).drop(lead).write.option("compression", "zstd").option("parquet.block.size", str(8 << 20)).parquet(path)
    held = rows.sparkSession.read.parquet(path)
    found = held.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.min(place).alias("at"), F.count("*").alias("n")).orderBy("at").collect()  # a row for each task that sorted
    size, files, start = 1 + sum(r["n"] for r in found) // parts, [], 0
    for r in found:
        at = 0
        while at < r["n"]:
            no = (start + at) // size
            if no == len(files):
                files.append((no, f"{plain(folder)}/{name}/{no:05d}.parquet", 0, []))
            to = min(r["n"], (no + 1) * size - start)
            files[no] = (*files[no][:2], files[no][2] + to - at, [*files[no][3], (plain(r["path"]), at, to)])
            at = to
        start += r["n"]
    if files:
        done = _dealt(rows.sparkSession.createDataFrame(files, _PLAN), len(files)).mapInArrow(_write_files(columns, f"{plain(scratch.root)}/aside"), "file_no long, path string, n_rows long")
        if scratch.table(done, f"laid-{name}").count() != len(files):
            raise RuntimeError(f"not all files of {name} were written")
    scratch.drop(f"sorted-{name}")
    return Laid(keyed.select(*columns).schema, [f[:3] for f in files])


def _positions(h: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each key hash, by double hashing over its halves."""
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return (low[:, None] + high[:, None] * np.arange(PROBES, dtype=np.uint64)) % np.uint64(bits)


def make_filter(hashes: np.ndarray) -> bytes:
    bits = np.zeros(max(64, len(hashes) * BITS), bool)
    bits[_positions(hashes.view(np.uint64), len(bits)).ravel()] = True
    return np.packbits(bits, bitorder="little").tobytes()


def hits(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which keys a filter may hold."""
    raw = np.frombuffer(bits, np.uint8)
    # as many bits as make_filter set aside: a multiple of eight
    at = _positions(hashes.view(np.uint64), len(raw) * 8)
    return ((raw[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(1)


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            made = make_filter(batch.column("hashes")[k].values.to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch.column(n).slice(k, 1) for n in ("path", "blocks", "block")), pa.array([made], pa.binary())], names=["path", "blocks", "block", "bits"])


def _test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [bool(hits(batch.column("bits")[k].as_py(), batch.column("hashes")[k].values.to_numpy()).any()) for k in range(batch.num_rows)]
        yield batch.select(["path"]).filter(pa.array(keep, pa.bool_()))


def _read(spark: SparkSession, laid: Laid, paths: list[str]) -> DataFrame:
    """(path, row) of files; rows as structs, so that no column's name matters."""
    row = F.struct(*laid.schema.names).alias("row")
    if not paths:
        return spark.createDataFrame([], laid.schema).select(F.lit(None).cast("string").alias("path"), row)
    uri = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/")
    return spark.read.schema(laid.schema).parquet(*paths).select(uri.alias("path"), row)


def file_filters(spark: SparkSession, laid: Laid, key: str, scratch: Scratch, name: str) -> DataFrame:
    """(path, blocks, block, bits): Bloom filters on the distinct keys of each file."""
    rows = _read(spark, laid, [f[1] for f in laid.files])
    sizes = spark.createDataFrame([(f[1], max(1, -(-f[2] // BLOCK_KEYS))) for f in laid.files], "path string, blocks int")
    value = F.col("row")[key]
    keys = rows.where(value.isNotNull()).select("path", F.xxhash64(value.cast("string")).alias("h")).distinct()
    blocked = keys.join(F.broadcast(sizes), "path").withColumn("block", F.pmod(F.shiftright("h", 7), "blocks").cast("int"))  # a row a file is broadcast
    lists = blocked.groupBy("path", "blocks", "block").agg(F.collect_list("h").alias("hashes"))  # a block's keys
    return scratch.table(lists.mapInArrow(_filters, "path string, blocks int, block int, bits binary"), f"filters-{name}")


def shortlist(filters: DataFrame, keys: DataFrame) -> list[str]:
    """Paths of the files that may hold one of the keys (column key)."""
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]  # two numbers at most where all files but the last are alike
    if not sizes:
        return []
    h = keys.select(F.xxhash64(F.col("key").cast("string")).alias("h"))
    groups = max(1, h.count() // TEST_KEYS)
    placed = h.withColumn("blocks", F.explode(F.array(*map(F.lit, sizes)))).withColumns({"block": F.pmod(F.shiftright("h", 7), "blocks").cast("int"), "part": F.pmod("h", F.lit(groups)).cast("int")})
    lists = placed.groupBy("blocks", "block", "part").agg(F.collect_list("h").alias("hashes"))
    met = filters.join(lists, ["blocks", "block"]).select("path", "bits", "hashes")
    return [r[0] for r in met.mapInArrow(_test, "path string").distinct().collect()]  # a row a file


_OUT = "table_name string, file_no long, path string, columns string, n_rows long, n_erased long, cents long, ids_sha256 string, aside string"


def _cents(x: pa.Array) -> int:
    """Sum of an amount in hundredths, rounded half up; null and non-finite ones count as 0."""
    v = np.floor(100 * pc.cast(pc.fill_null(x, 0), pa.float64()).to_numpy(zero_copy_only=False) + 0.5)
    return int(np.where(np.isfinite(v), v, 0).astype(np.int64).sum())


def _rewrite(keys: dict[str, str], money: dict[str, str], aside: str):
    """For mapInArrow over files: streams each one, through a filter into a new file if it has victims, and describes what stays."""

    def one(row: dict) -> dict:
        fs, at = _open(row["path"])
        name, writer, ids, count, cents, erased = row["table_name"], None, hashlib.sha256(), 0, 0, 0
        with fs.open_input_file(at) as source:
            file = pq.ParquetFile(source)
            columns = file.schema_arrow.names
            gone = row["keys"] and pa.array(row["keys"])
            need = columns if gone else list(dict.fromkeys([columns[0], *([money[name]] if name in money else [])]))
            if gone:
                gone = gone.cast(file.schema_arrow.field(keys[name]).type)
                writer = Writer(f"{aside}/{name}-{row['file_no']}-{uuid.uuid4().hex}", file.schema_arrow, aside)
            for batch in file.iter_batches(READ_ROWS, columns=need):
                if gone:
                    stay = pc.invert(pc.is_in(batch.column(keys[name]), value_set=gone, skip_nulls=True))
                    kept = batch.filter(stay)
                    erased += batch.num_rows - kept.num_rows
                    batch = kept
                    if batch.num_rows:
                        writer.write(batch)
                if batch.num_rows:
                    shown = pc.fill_null(pc.cast(batch.column(columns[0]), pa.string()), "").to_pylist()
                    ids.update(("," * (count > 0) + ",".join(shown)).encode())
                    count += batch.num_rows
                    cents += _cents(batch.column(money[name])) if name in money else 0
        if writer:
            writer.close()
        return {"columns": ",".join(columns), "n_rows": count, "n_erased": erased, "cents": cents, "ids_sha256": ids.hexdigest(), "aside": writer and writer.path}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                got = {n: row[n] for n in ("table_name", "file_no", "path")} | one(row)
                yield pa.RecordBatch.from_arrays([pa.array([got[n]], pa.string() if t == "string" else pa.int64()) for n, t in (f.split(" ") for f in _OUT.split(", "))], names=[f.split(" ")[0] for f in _OUT.split(", ")])

    return run


def erase(tables: dict[str, Laid], steps: list[Step], seeds: DataFrame, scratch: Scratch, money: dict[str, str] | None = None, after: Callable[[str], None] | None = None) -> DataFrame:
    """Removes from the tables' files what the seeds (column key) lead to, and describes the files that stay.

    Returns table_name, file_no, path, columns, n_rows, n_erased, cents (sum of
    the column that ``money`` names), ids_sha256 (of the first column) and
    rewritten.  ``steps`` come in the order of their links, one a table.
    ``after`` hears of each finished phase (tests stop there).
    """
    spark = seeds.sparkSession
    seeds = scratch.table(seeds.select("key").where("key is not null").distinct(), "seeds")
    gives: dict[str | None, DataFrame] = {None: seeds}
    gone = []
    for step in steps:
        laid, keys = tables[step.table], gives[step.after]
        paths = shortlist(file_filters(spark, laid, step.key, scratch, step.table), keys) if laid.files else []
        rows = _read(spark, laid, paths)
        held = rows.select("path", F.col("row")[step.key].alias("key"), *([F.col("row")[step.gives].alias("gives")] if step.gives else []))
        hit = scratch.table(held.join(keys, "key", "left_semi").distinct(), f"victims-{step.table}")
        if step.gives:
            gives[step.table] = scratch.table(hit.select(F.col("gives").alias("key")).where("key is not null").distinct(), f"keys-{step.table}")
        gone.append(hit.select("path", F.col("key").cast("string").alias("key")).distinct())
    files = spark.createDataFrame([(name, f[0], f[1]) for name, laid in tables.items() for f in laid.files], "table_name string, file_no long, path string")
    victims = gone[0]
    for g in gone[1:]:
        victims = victims.unionAll(g)
    victims = victims.groupBy("path").agg(F.collect_list("key").alias("keys"))  # a file's victims, each key once
    plan = _dealt(files.join(victims, "path", "left"), sum(len(laid.files) for laid in tables.values()))
    aside = f"{plain(scratch.root)}/aside"
    done = scratch.table(plan.mapInArrow(_rewrite({s.table: s.key for s in steps}, money or {}, aside), _OUT), "files")
    if after:
        after("rewritten")
    for r in done.where("aside is not null").select("path", "aside", "n_rows").collect():  # a row a file
        fs, to = _open(r["path"])
        if r["n_rows"]:
            fs.move(_open(r["aside"])[1], to)
        else:
            fs.delete_file(to)
    for name in [f"{kind}-{s.table}" for s in steps for kind in ("filters", "victims", "keys")] + [f"laid-{n}" for n in tables] + ["seeds", "aside"]:
        scratch.drop(name)
    return done.where("n_rows > 0").select("table_name", "file_no", "path", "columns", "n_rows", "n_erased", "cents", "ids_sha256", F.col("aside").isNotNull().alias("rewritten"))


def _crc(c: Column) -> Column:
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def victim_masters(clients: DataFrame, clicks: DataFrame) -> DataFrame:
    """(key): masters whose crc32 is divisible by 100, and the one whose clients together have most clicks (a tie: the smallest)."""
    of = clients.where("master_id is not null").select("master_id", "client_id").distinct()
    count = clicks.where("client_id is not null").groupBy("client_id").agg(F.count("*").alias("n"))
    top = of.join(count, "client_id", "left").groupBy("master_id").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n")).orderBy(F.desc("n"), "master_id").limit(1).select(F.col("master_id").alias("key"))
    return of.select(F.col("master_id").alias("key")).where(_crc(F.col("key")) % 100 == 0).unionAll(top).distinct()


STEPS = [Step("clients", "master_id", None, "client_id"), Step("clicks", "client_id", "clients"), Step("sales", "client_id", "clients", "sale_id"), Step("sale_lines", "sale_id", "sales")]
MONEY = {"clients": "balance", "clicks": "value", "sales": "total", "sale_lines": "amount"}


def op11_cascading_erasure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lays the shop's tables out by client, erases the victims in place and returns the files that stay."""
    scratch = Scratch(spark, "erasure")
    folder = f"{shared_dir(spark)}/wirelens/erased-{uuid.uuid4().hex}"
    rows = {name: table(spark, sf_dir, name) for name in MONEY}
    owner = rows["sales"].where("sale_id is not null").groupBy("sale_id").agg(F.min("client_id").alias("client_id"))
    owner = scratch.table(owner, "owners")  # both sides of the join then come from files, and Spark can split a sale of very many lines
    lines = rows["sale_lines"]
    (theirs,) = fresh(lines.columns, "client_id")
    owned = rows | {"sale_lines": lines.join(owner.withColumnRenamed("client_id", theirs), "sale_id", "left")}
    laid = {name: lay_out(owned[name], rows[name].columns, _crc(F.col(theirs if name == "sale_lines" else "client_id")), folder, name, scratch) for name in MONEY}
    return erase(laid, STEPS, victim_masters(rows["clients"], rows["clicks"]), scratch, MONEY)
