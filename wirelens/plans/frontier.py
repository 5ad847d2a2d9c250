"""Probing in rounds: each firm's next candidate is tried only while none before it was good.

A round fetches one url for each firm that is still open.  A firm is settled by
its first good answer and lost by its first error of the kinds given, so the
requests are those of a loop that stops there, made for all firms at once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..workspace import Keep


def probe(candidates: DataFrame, fetch: Callable[[DataFrame, tuple[str, ...]], DataFrame], good: Column, keep: Keep, name: str, lost: tuple[str, ...] = ()) -> DataFrame:
    """name and url of each firm's first good candidate (name, priority, url); ``good`` reads a row of the fetch log.

    Every round is written under ``name`` before the next one, which leaves out
    the firms that are done; rounds end when no firm has a candidate left.
    """
    turn = F.row_number().over(W.partitionBy("name").orderBy("priority", "url"))
    ranked = keep(candidates.select("name", "url", turn.alias("turn")), f"{name}-candidates")
    logs: list[DataFrame] = []
    for k in range(1, (ranked.agg(F.max("turn")).first()[0] or 0) + 1):
        due = ranked.where(F.col("turn") == k).select("url", F.col("name").alias("firm_name"), "turn")
        if logs:
            ended = F.col("good") | F.coalesce(F.col("error_type").isin(*lost), F.lit(False))
            due = due.join(reduce(DataFrame.unionAll, [log.where(ended).select("firm_name") for log in logs]), "firm_name", "left_anti").select(due.columns)
        log = keep(fetch(due, ("turn",)).withColumn("good", F.col("error_type").isNull() & F.coalesce(good, F.lit(False))), f"{name}-{k}")
        if log.isEmpty():  # no firm is open
            break
        logs.append(log)
    if not logs:
        return ranked.select("name", "url").where("false")
    return reduce(DataFrame.unionByName, logs).where("good").select(F.col("firm_name").alias("name"), "url")
