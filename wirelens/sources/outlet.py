"""The sink as a Spark data source: documents go out row by row, a journal remembers each.

``deliver`` writes (ord, document) through a ``DataSourceWriter``.  Every task
posts its rows at its share of the pace and journals each answer, so a task
that runs again posts only what is not there yet.  Each task reports counts;
commit and abort write them beside the journal.  The outcomes are read back
from the journal, not from the driver.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .journal import Journal, key_of

#: Tasks that share the pace, at most.
TASKS = 4


@dataclass
class Delivered(WriterCommitMessage):
    written: int
    known: int
    refused: int


class Writer(DataSourceWriter):
    def __init__(self, post: Callable[[str], str | None], folder: str, pause: float):
        self.post, self.folder, self.pause = post, folder, pause

    def write(self, rows: Iterator) -> Delivered:
        journal, written, known, refused = Journal(self.folder), 0, 0, 0
        for row in rows:
            key = key_of(row.ord, row.document)
            if journal.get(key) is not None:
                known += 1
                continue
            page = self.post(row.document)
            if page:
                journal.put(key, {"ord": row.ord, "page_id": page})
                written += 1
            else:
                refused += 1
            time.sleep(self.pause)
        return Delivered(written, known, refused)

    def _note(self, end: str, messages: list) -> None:
        done = [m for m in messages if m is not None]
        Journal(f"{self.folder}-runs").put(key_of(end, time.time_ns()), {"end": end, **{n: sum(getattr(m, n) for m in done) for n in ("written", "known", "refused")}})

    def commit(self, messages: list) -> None:
        self._note("committed", messages)

    def abort(self, messages: list) -> None:
        """What was posted stays posted and journaled; a later run goes on from there."""
        self._note("aborted", messages)


def source(post: Callable[[str], str | None], pace: float) -> type[DataSource]:
    """A data source class that posts by a callable, which travels with it."""

    class Outlet(DataSource):
        @classmethod
        def name(cls) -> str:
            return "wirelens_outlet"

        def schema(self) -> str:
            return "ord long, document string"

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            return Writer(post, self.options["path"], pace)

    return Outlet


def deliver(documents: DataFrame, post: Callable[[str], str | None], pause: float, folder: str, tasks: int = TASKS) -> DataFrame:
    """Sends each document (ord, document) once and gives ord, page_id and outcome (written or error).

    ``pause`` is the pace of the sink as a whole: with n tasks each waits n
    times as long.  ``folder`` names the run's journal; the same folder again
    goes on with what is missing.  ``documents`` is a written table.
    """
    spark = documents.sparkSession
    spark.dataSource.register(source(post, pause * tasks))
    rows = documents.select(F.col("ord").cast("long").alias("ord"), "document")
    rows.repartition(tasks, "ord").write.format("wirelens_outlet").mode("append").option("path", folder).save()
    answers = answered(documents, folder)
    return rows.join(answers, "ord", "left").select("ord", "page_id", F.when(F.col("page_id").isNotNull(), "written").otherwise("error").alias("outcome"))


def answered(documents: DataFrame, folder: str) -> DataFrame:
    """(ord, page_id) of what the journal holds for these documents."""
    key = F.sha2(F.concat_ws("\x00", F.col("ord").cast("long").cast("string"), "document"), 256)
    # a journal without answers has no folder yet
    files = documents.sparkSession.read.schema("ord long, page_id string").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
    try:
        held = files.json(folder).select("page_id", F.regexp_extract(F.col("_metadata.file_path"), r"([0-9a-f]{64})\.json$", 1).alias("key"))
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        held = documents.sparkSession.createDataFrame([], "page_id string, key string")
    return documents.select(F.col("ord").cast("long").alias("ord"), key.alias("key")).join(held, "key").select("ord", "page_id")
