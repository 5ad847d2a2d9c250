"""Saved payloads and cursor services as Spark data sources.

``wirelens_payloads`` reads and writes a folder of payload files (feeds, press
pages), a file a payload, as a table and as a stream:
``spark.read.format("wirelens_payloads").load(folder)``.  ``reviews`` reads the
pages of a cursor service, a partition a page.
"""

from __future__ import annotations

import json
import time
import urllib.parse
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .. import schemas
from .fetch import paged
from .journal import Journal, key_of

#: Bytes of payload files that a partition reads, about; files are never cut.
PARTITION_BYTES = 64 << 20
#: Seconds that a file must be old before a stream takes it, so that it is whole and all files of its time are there.
SETTLE = 10
SUFFIX = ".payload"


def at(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder; one without a scheme is local."""
    return pafs.FileSystem.from_uri(folder) if ":" in folder.split("/", 1)[0] else (pafs.LocalFileSystem(), folder)


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Saved(WriterCommitMessage):
    paths: list[str]


def listed(folder: str) -> list[pafs.FileInfo]:
    """The payload files below a folder, by time and path; a missing folder has none.  Names alone come to the driver, as for any file source."""
    fs, root = at(folder)
    found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=True))
    return sorted((f for f in found if f.type == pafs.FileType.File and f.path.endswith(SUFFIX)), key=lambda f: (f.mtime_ns, f.path))


def packed(files: list[pafs.FileInfo], limit: int) -> list[Files]:
    """Files in groups of about ``limit`` bytes each; a larger file has a group of its own."""
    groups, held = [], 0
    for f in files:
        if not groups or held + f.size > limit:
            groups.append(Files([]))
            held = 0
        groups[-1].paths.append(f.path)
        held += f.size
    return groups


class _Reading:
    def __init__(self, options: dict):
        self.folder, self.limit = options["path"], int(options.get("partitionBytes", PARTITION_BYTES))
        self.settle = float(options.get("settle", SETTLE))

    def read(self, partition: Files) -> Iterator[tuple]:
        """(firm_name, path, body): the firm is the file's name, percent-encoded, up to the last but one dot; bytes that are no UTF-8 are replaced."""
        fs, _ = at(self.folder)
        for path in partition.paths:
            with fs.open_input_stream(path) as f:
                body = f.read().decode("utf-8", "replace")
            name = path.rsplit("/", 1)[-1][: -len(SUFFIX)].rpartition(".")
            yield urllib.parse.unquote(name[0] or name[2]), path, body


class Reader(_Reading, DataSourceReader):
    def partitions(self) -> list[Files]:
        return packed(listed(self.folder), self.limit) or [Files([])]


class StreamReader(_Reading, DataSourceStreamReader):
    """Offsets are the time and path of the last file taken; files are put in place whole and their times do not go back by more than ``settle``."""

    def initialOffset(self) -> dict:
        return {"mtime_ns": 0, "path": ""}

    def latestOffset(self) -> dict:
        until = time.time_ns() - int(self.settle * 1e9)
        old = [f for f in listed(self.folder) if f.mtime_ns <= until]
        return {"mtime_ns": old[-1].mtime_ns, "path": old[-1].path} if old else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Files]:
        low, high = ((o["mtime_ns"], o["path"]) for o in (start, end))
        return packed([f for f in listed(self.folder) if low < (f.mtime_ns, f.path) <= high], self.limit)


class Writer(DataSourceWriter):
    """A file for each row, written aside and moved into place; files of a failed job are taken away again."""

    def __init__(self, folder: str):
        self.folder = folder

    def write(self, rows: Iterator) -> Saved:
        fs, root = at(self.folder)
        fs.create_dir(root, recursive=True)
        paths = []
        for row in rows:
            path = f"{root}/{urllib.parse.quote(row.firm_name or '', safe='')}.{uuid.uuid4().hex}{SUFFIX}"
            with fs.open_output_stream(f"{path}.part") as f:
                f.write((row.body or "").encode("utf-8", "replace"))
            paths.append(path)
        return Saved(paths)

    def commit(self, messages: list) -> None:
        """Files come into sight only now, so a task that ran twice leaves one file a row."""
        fs, _ = at(self.folder)
        for path in (p for m in messages if m for p in m.paths):
            fs.move(f"{path}.part", path)

    def abort(self, messages: list) -> None:
        fs, _ = at(self.folder)
        for path in (p for m in messages if m for p in m.paths):
            fs.delete_file(f"{path}.part")


class Payloads(DataSource):
    """Options: path; partitionBytes; settle (seconds, for streams)."""

    @classmethod
    def name(cls) -> str:
        return "wirelens_payloads"

    def schema(self) -> str:
        return "firm_name string, path string, body string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return Reader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return StreamReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Payloads)


def save(payloads: DataFrame, folder: str) -> None:
    """Writes (firm_name, body) as payload files."""
    register(payloads.sparkSession)
    payloads.selectExpr("firm_name", "'' as path", "body").write.format("wirelens_payloads").mode("append").option("path", folder).save()


def load(spark: SparkSession, folder: str) -> DataFrame:
    register(spark)
    return spark.read.format("wirelens_payloads").load(folder)


def load_stream(spark: SparkSession, folder: str, settle: float = SETTLE) -> DataFrame:
    register(spark)
    return spark.readStream.format("wirelens_payloads").option("settle", settle).load(folder)


@dataclass
class Page(InputPartition):
    key: str


class PageReader(DataSourceReader):
    """A cursor leads from page to page, so planning asks for them one after another and journals each; tasks read the journal."""

    def __init__(self, ask: Callable[[dict], dict], folder: str):
        self.ask, self.folder = ask, folder

    def partitions(self) -> list[Page]:
        journal, keys = Journal(self.folder), []

        def once(body: dict) -> dict:
            keys.append(key_of(json.dumps(body, sort_keys=True)))
            return journal.once(keys[-1], lambda: self.ask(body))

        for _ in paged(once):  # one page at a time is held
            pass
        return [Page(k) for k in keys]

    def read(self, partition: Page) -> Iterator[tuple]:
        from .tables import verdict_row

        for r in (Journal(self.folder).get(partition.key) or {}).get("results", []):
            yield verdict_row(r)


def reviews(spark: SparkSession, ask: Callable[[dict], dict], folder: str) -> DataFrame:
    """Verdict rows of a review service, a partition a page.  ``folder`` is the run's own; the same folder again asks for nothing that it has."""

    class Reviews(DataSource):
        @classmethod
        def name(cls) -> str:
            return "wirelens_reviews"

        def schema(self) -> str:
            return schemas.VERDICT

        def reader(self, schema: StructType) -> DataSourceReader:
            return PageReader(ask, folder)

    spark.dataSource.register(Reviews)
    return spark.read.format("wirelens_reviews").load()
