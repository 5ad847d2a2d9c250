"""The incremental scan as Structured Streaming: keyed state replaces the state file.

Urls are dropped where they were seen within the time to live, by event time
here or by the clock (``keyed.new_rows``); source errors keep a running streak
and sticky flags (``keyed.error_state``); sinks are idempotent by deal key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.constants import STATE_DAYS
from .keyed import error_state, new_rows  # noqa: F401


def new_articles(articles: DataFrame, event_time: str = "fetched_at", days: int = STATE_DAYS) -> DataFrame:
    """Articles whose url was not seen in the last days of event time; state older than that is dropped."""
    return articles.withWatermark(event_time, f"{days} days").dropDuplicatesWithinWatermark(["url"])


def each_batch(deals_path: str, write: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer that a replayed batch does not repeat: deals already kept under their key are passed over."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        keyed = batch.withColumn("deal_key", text.deal_key(F.col("target_company"), F.col("seller"), F.col("stage")))
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(deals_path)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            keyed = keyed.join(spark.read.parquet(deals_path).where(F.col("batch") != number).select("deal_key"), "deal_key", "left_anti")
        keyed = keyed.groupBy("deal_key").agg(F.max_by(F.struct(*batch.columns), F.struct("confidence", "title")).alias("row")).select("deal_key", "row.*")
        keyed = keyed.persist()
        write(keyed)
        keyed.select("deal_key").write.mode("overwrite").parquet(f"{deals_path}/batch={number}")
        keyed.unpersist()

    return run


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(df: DataFrame, checkpoint: str, writer: Callable[[DataFrame, int], None], mode: str = "append"):
    """Processes all that is available, then stops; state is kept on disk by RocksDB.  The session's own settings stay.

    In update mode no batches without data follow: state that ages by the clock
    would ask for them for ever.  It ages with the next data instead.
    """
    conf, mine = df.sparkSession.conf, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if mode == "update":
        mine["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    before = {k: conf.get(k) for k in mine}
    try:
        for k, v in mine.items():  # a query takes the settings that hold when it starts
            conf.set(k, v)
        return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(writer).start()
    finally:
        for k, v in before.items():
            conf.set(k, v)
