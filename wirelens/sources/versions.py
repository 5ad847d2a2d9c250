"""State tables as versions: a run rewrites only the parts that it changed.

A table's rows lie in parts, by the day they were first seen or, for sources,
by a hash of the name.  A version is a small JSON file that lists each table's
parts with their folder and fingerprint.  Writing one compares fingerprints
with the version before, writes the parts that differ into a folder of their
own and then puts the version's file in place by one move.  Readers take the
newest version whose file is there, so a crash before the move leaves the old
one, and the parts that it wrote are overwritten or cleared by a later run.
New urls have the day of their run, so they touch that day's part alone;
pruning touches the days that leave.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

TABLES = {"seen": schemas.SEEN, "seen_deals": schemas.SEEN_DEALS, "firm_errors": schemas.FIRM_ERRORS}
#: Parts of the table of sources.
PARTS = 16
#: Versions that stay readable: the last one and its backup.
KEPT = 2


class Versions:
    """Versions of the state below a folder; one run writes at a time, and a second one that does is refused."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.root = spark, folder.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def numbers(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self._names("versions") if n.startswith("v") and n.endswith(".json"))

    def load(self, number: int | None = None) -> dict | None:
        """A version's list of parts, the newest if no number is given; None where there is none."""
        numbers = self.numbers()
        if not numbers:
            return None
        path = self._path(f"versions/v{(numbers[-1] if number is None else number):08d}.json")
        stream = self.fs.open(path)
        try:
            return json.loads(bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def read(self, number: int | None = None) -> dict[str, DataFrame]:
        """The tables of a version; where there is none, or a table is not in it, it is empty."""
        held = (self.load(number) or {"tables": {}})["tables"]
        return {name: self._table(name, held.get(name, {})) for name in TABLES}

    def _table(self, name: str, parts: dict) -> DataFrame:
        paths = [f"{self.root}/{p['path']}" for p in parts.values()]
        return self.spark.read.schema(TABLES[name]).parquet(*paths) if paths else self.spark.createDataFrame([], TABLES[name])

    def write(self, tables: dict[str, DataFrame], now: str | None = None) -> dict:
        """Writes a version with these tables, others as they were; gives its list, with the parts that were rewritten under ``rewritten``."""
        before = self.load() or {"number": 0, "tables": {}}
        number = before["number"] + 1
        listed, rewritten = dict(before["tables"]), {}
        for name, df in tables.items():
            parts, old = self._fingerprints(name, df), before["tables"].get(name, {})
            changed = sorted(p for p, f in parts.items() if old.get(p, {}).get("print") != f)
            folder = f"data/{name}/v{number:08d}"
            if changed:
                rows = df.withColumn("part", part_of(name))
                rows.where(F.col("part").isin(changed)).write.mode("overwrite").partitionBy("part").parquet(f"{self.root}/{folder}")
            listed[name] = {p: {"print": f, "path": f"{folder}/part={p}"} if p in changed else old[p] for p, f in parts.items()}
            rewritten[name] = changed
        made = {"number": number, "last_run": now or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"), "tables": listed, "rewritten": rewritten}
        self._commit(number, made)
        self._clear()
        return made

    def _fingerprints(self, name: str, df: DataFrame) -> dict[str, str]:
        """Count and sum of the rows' hashes for each part: at most the days of the time to live, or PARTS."""
        columns = [F.coalesce(F.col(c.strip().split(" ")[0]).cast("string"), F.lit("\x00")) for c in TABLES[name].split(",")]
        prints = df.groupBy(part_of(name).alias("part")).agg(F.count("*").alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h"))
        return {r["part"]: f"{r['n']}:{r['h']}" for r in prints.collect()}

    def _commit(self, number: int, made: dict) -> None:
        aside, name = self._path(f"versions/.next-{number}"), self._path(f"versions/v{number:08d}.json")
        out = self.fs.create(aside, True)
        out.write(bytearray(json.dumps(made, sort_keys=True).encode()))
        out.close()
        if self.fs.exists(name) or not self.fs.rename(aside, name):
            raise RuntimeError(f"another run has saved version {number} of the state")

    def _clear(self) -> None:
        """Takes away versions before the backup, and folders that neither of the kept ones lists."""
        numbers = self.numbers()
        for n in numbers[:-KEPT]:
            self.fs.delete(self._path(f"versions/v{n:08d}.json"), False)
        used = {p["path"] for n in numbers[-KEPT:] for parts in self.load(n)["tables"].values() for p in parts.values()}
        for table in self._names("data"):
            for version in self._names(f"data/{table}"):
                folder = f"data/{table}/{version}"
                mine = {f"{folder}/{n}" for n in self._names(folder) if n.startswith("part=")}
                if not mine & used:
                    self.fs.delete(self._path(folder), True)
                else:
                    for gone in mine - used:
                        self.fs.delete(self._path(gone), True)

    def size(self) -> int:
        """Bytes of the newest version's parts."""
        held = (self.load() or {"tables": {}})["tables"]
        return sum(self.fs.getContentSummary(self._path(p["path"])).getLength() for parts in held.values() for p in parts.values())


def part_of(name: str) -> Column:
    """The part of a row: its day where the table has one and it is well formed."""
    if "first_seen" in TABLES[name]:
        day = F.left("first_seen", F.lit(10))
        return F.when(F.regexp_like("first_seen", F.lit(r"^\d{4}-\d\d-\d\d")), day).otherwise(F.lit("undated"))
    return F.concat(F.lit("h"), F.pmod(F.xxhash64("firm_name"), F.lit(PARTS)).cast("string"))
