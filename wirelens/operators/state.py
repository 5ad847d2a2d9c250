"""State between runs: seen urls and deals, source errors; kept as tables, replaced as snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text
from ..functions.constants import MISSES_TO_FLAG, STATE_DAYS


def prune(state: DataFrame, now: Column, days: int = STATE_DAYS) -> DataFrame:
    """Rows of the last days; a missing or malformed date is old."""
    first = F.try_to_timestamp(F.col("first_seen").cast("string"))
    return state.where(first.isNotNull() & (first >= now - F.expr(f"INTERVAL {days} DAYS")))


def mark_seen(state: DataFrame, urls: DataFrame, now: Column) -> DataFrame:
    """Adds urls; one that is known keeps its row."""
    new = urls.select("url").distinct().join(state.select("url"), "url", "left_anti")
    return state.unionByName(new.select("url", text.url_hash(F.col("url")).alias("hash"), now.cast("string").alias("first_seen")))


def mark_deals(state: DataFrame, deals: DataFrame, now: Column) -> DataFrame:
    """Adds deals by their normalized key; those without a target are passed over."""
    keyed = deals.where(text.strip(F.coalesce("target", F.lit(""))) != "").select(text.norm(F.col("target")).alias("target"), text.norm(F.col("seller")).alias("seller"), F.lower(F.coalesce("stage", F.lit(""))).alias("stage")).distinct()
    new = keyed.join(state.select("target", "seller", "stage"), ["target", "seller", "stage"], "left_anti")
    return state.unionByName(new.withColumn("first_seen", now.cast("string")))


def miss_streaks(log: DataFrame, source: str, order: list[str]) -> DataFrame:
    """Adds streak: 404s of the source since its last success.  Other errors neither add nor reset.

    ``log`` has outcome: 'ok', '404' or another error.
    """
    w = W.partitionBy(source).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    part = log.withColumn("run", F.sum(F.when(F.col("outcome") == "ok", 1).otherwise(0)).over(w))
    own = W.partitionBy(source, "run").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return part.withColumn("streak", F.sum(F.when(F.col("outcome") == "404", 1).otherwise(0)).over(own)).drop("run")


def firm_errors(log: DataFrame, source: str, order: list[str], limit: int = MISSES_TO_FLAG) -> DataFrame:
    """A row for each source: the current streak, whether it ever reached the limit (sticky), its last error, and whether it wants a rendered fetch (sticky)."""
    s = miss_streaks(log, source, order)
    last = F.struct(*order)
    return s.groupBy(source).agg(
        F.max_by("streak", last).alias("consecutive_404s"),
        (F.max("streak") >= limit).alias("needs_url_update"),
        F.max_by("outcome", last).alias("last_outcome"),
        F.max_by(F.when(F.col("outcome") != "ok", F.col("outcome")), F.when(F.col("outcome") != "ok", last)).alias("last_error"),
        F.max(F.col("outcome") == "403").alias("prefer_render"),
    )


def outcome(error_type: Column) -> Column:
    """What a log row means for its source; null where it means nothing."""
    return F.when(error_type.isNull(), "ok").when(error_type != "unfinished", error_type)


def record(old: DataFrame, log: DataFrame, order: list[str], now: Column, limit: int = MISSES_TO_FLAG) -> DataFrame:
    """The errors table after a run whose fetches are in ``log`` (firm_name, outcome and the order's columns).

    A 404 adds to the streak that the table holds, a success ends it and the
    error; flags stay.  Sources without a fetch keep their row.
    """
    fresh = log.where("outcome is not null")
    s = miss_streaks(fresh, "firm_name", order).join(old.select("firm_name", F.col("consecutive_404s").alias("before")), "firm_name", "left")
    w = W.partitionBy("firm_name").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    s = s.withColumn("won", F.max(F.when(F.col("outcome") == "ok", 1).otherwise(0)).over(w))
    s = s.withColumn("full", F.col("streak") + F.when(F.col("won") == 0, F.coalesce("before", F.lit(0))).otherwise(0))
    last = F.struct(*order)
    mine = s.groupBy("firm_name").agg(
        F.max_by("full", last).cast("int").alias("n"), (F.max("full") >= limit).alias("flag"), F.max(F.col("outcome") == "403").alias("render"), F.max_by("outcome", last).alias("final"),
    )
    both = old.join(mine, "firm_name", "full")
    error = F.when(F.col("final").isNull(), F.col("last_error")).when(F.col("final") != "ok", F.col("final"))
    date = F.when(F.col("final").isNull(), F.col("last_error_date")).when(F.col("final") != "ok", now.cast("string"))
    flag = lambda a, b: F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False))
    return both.select("firm_name", error.alias("last_error"), date.alias("last_error_date"), F.coalesce("n", "consecutive_404s", F.lit(0)).alias("consecutive_404s"), flag(F.col("needs_url_update"), F.col("flag")).alias("needs_url_update"), flag(F.col("prefer_render"), F.col("render")).alias("prefer_render"))


def flagged(errors: DataFrame, source: str) -> DataFrame:
    return errors.where("needs_url_update").select(source)


def clear_flag(errors: DataFrame, source: str, names: list[str]) -> DataFrame:
    """After a new url was found: the flag goes and the streak starts anew."""
    mine = F.col(source).isin(*names)
    return errors.withColumns({"needs_url_update": F.col("needs_url_update") & ~mine, "consecutive_404s": F.when(mine, F.lit(0)).otherwise(F.col("consecutive_404s"))})
