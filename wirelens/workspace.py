"""Where tables lie that must not be computed twice."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Writes a table under a name and reads it back.
Keep = Callable[[DataFrame, str], DataFrame]


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``; a default only where all runs in one process."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "/tmp/checkpoints"
    return found.rstrip("/")


class Workspace:
    """A folder of tables, each written once and read back; ``calls`` is where a run's calls of a model are kept, if it has any.

    ``counts`` has each table's rows, under n, and what else was asked for;
    they are observed while it is written.
    """

    def __init__(self, spark: SparkSession, root: str, calls: str | None = None):
        self.spark, self.root, self.calls = spark, root.rstrip("/"), calls
        self.counts: dict[str, dict[str, int]] = {}

    @classmethod
    def new(cls, spark: SparkSession, name: str) -> Workspace:
        return cls(spark, f"{shared_dir(spark)}/wirelens/{name}-{uuid.uuid4().hex}")

    def keep(self, df: DataFrame, name: str, **also: Column) -> DataFrame:
        """Writes a table and reads it back; ``also`` are conditions whose rows are counted on the way."""
        path, seen = f"{self.root}/{name}", Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in also.items()])
        counted.write.mode("overwrite").parquet(path)
        self.counts[name] = seen.get
        return self.spark.read.schema(df.schema).parquet(path)
