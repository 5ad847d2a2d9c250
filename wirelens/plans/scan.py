"""Whole plans: scan, look-back, back-test, feedback, reset.

Payload tables go in, so that the same plan runs over saved pages, tests and
live fetches (sources.fetch gives such tables).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

from ..operators import dedup, feedback, filters, model_stage, sink, state
from ..sources import tables
from ..workspace import Workspace


@dataclass
class Inputs:
    """Fetched payloads of one run: firm feeds, core feeds (firm_name, body), press and law pages (firm_name, domain, body), article bodies (url, body), which may be a function that fetches those of given articles."""

    feeds: DataFrame | None = None
    core: DataFrame | None = None
    press: DataFrame | None = None
    law: DataFrame | None = None
    bodies: DataFrame | Callable[[DataFrame], DataFrame] | None = None


@dataclass
class Result:
    alerts: DataFrame
    actionable: DataFrame
    documents: DataFrame
    state: dict[str, DataFrame]
    usage: dict[str, DataFrame] = field(default_factory=dict)
    counts: DataFrame | None = None
    written: DataFrame | None = None


def raw_articles(inputs: Inputs, now: Column, hours: int | None) -> DataFrame:
    """All sources' articles in their order: firm feeds, core feeds, press pages, law firms."""
    parts = [tables.feed_articles(inputs.feeds, now, hours) if inputs.feeds else None, tables.feed_articles(inputs.core, now, hours) if inputs.core else None,
             tables.press_articles(inputs.press, now, hours) if inputs.press else None, tables.press_articles(inputs.law, now, hours) if inputs.law else None]
    found = [p.withColumn("src_rank", F.lit(k)) for k, p in enumerate(parts) if p is not None]
    out = found[0]
    for p in found[1:]:
        out = out.unionByName(p)
    return out


def distinct_articles(raw: DataFrame) -> DataFrame:
    return dedup.keep_first(raw, ["url"], ["src_rank", "firm_name", "ord"])


ORDER = ["src_rank", "firm_name", "ord", "url"]


def _with_bodies(articles: DataFrame, inputs: Inputs) -> DataFrame:
    found = inputs.bodies(articles) if callable(inputs.bodies) else inputs.bodies
    return tables.with_bodies(articles, found) if found is not None else articles


def stage_counts(spark: SparkSession, stages: dict[str, int]) -> DataFrame:
    """stage, place and n: the rows that each stage let through, as they were counted while it was written."""
    return spark.createDataFrame([(name, k, n) for k, (name, n) in enumerate(stages.items())], "stage string, place int, n long")


def scan(
    inputs: Inputs, old: dict[str, DataFrame], now: Column, work: Workspace, classify_with=None, qualify_with=None, hours: int = 24, dry_run: bool = False,
    log: DataFrame | None = None, send: Callable[[DataFrame], DataFrame] | None = None,
) -> Result:
    """One run.  Cheap steps come first: urls are made distinct and compared with the state before bodies and the model.

    ``log`` has the run's fetches (firm_name, outcome, seq, url) and goes into
    the errors table.  ``send`` takes documents (ord, document) to the sink and
    gives ord, page_id and outcome; if all of them fail the run raises, with no
    new state.  Without a dry run the new state marks the urls that the model
    answered for and the deals that the sink took; rows of failed batches or
    writes stay unseen and return in the next run.
    """
    errors = state.record(old["firm_errors"], log, ["seq", "url"], now) if log is not None else old["firm_errors"]
    kept = {"seen": state.prune(old["seen"], now), "seen_deals": state.prune(old["seen_deals"], now), "firm_errors": errors}
    raw = work.keep(raw_articles(inputs, now, hours), "raw")
    distinct = work.keep(distinct_articles(raw), "distinct")
    fresh = work.keep(dedup.unseen(distinct, kept["seen"]), "new")
    fresh = work.keep(_with_bodies(fresh, inputs), "fresh", with_text=F.coalesce("summary", F.lit("")) != "")
    alerts, replies = model_stage.classify(fresh, classify_with, ORDER, work.keep, work.calls)
    alerts = work.keep(alerts, "alerts")
    good = filters.alerts_to_score(alerts)
    numbered = model_stage.batches(good, ORDER, 1).withColumnRenamed("batch", "at").drop("pos")
    numbered = work.keep(numbered, "positives")
    rows = numbered.select(F.col("at").alias("ord"), "title", F.col("target_company").alias("target"), "seller", "confidence", "reasoning", "stage")
    folded = dedup.fold_repeats(rows, ["stage"], keep=work.keep).select(F.col("ord").alias("at"), F.col("reasoning").alias("noted"))
    merged = work.keep(numbered.join(folded, "at").withColumn("reasoning", F.col("noted")).drop("noted"), "merged")
    keyed = merged.select("at", F.col("target_company").alias("target"), "seller", F.coalesce("stage", F.lit("unknown")).alias("stage"))
    new = work.keep(merged.join(dedup.unseen_deals(keyed, kept["seen_deals"], work.keep).select("at"), "at", "left_semi"), "unseen-deals")
    scored, scores = model_stage.qualify(new, qualify_with, ["at"], work.keep, work.calls)
    scored = work.keep(scored, "scored", actionable=filters.to_act_on())
    todo = filters.actionable(scored)
    documents = work.keep(sink.document(sink.project(todo.drop("ord").withColumnRenamed("at", "ord")), "deals"), "documents")
    written, taken = None, todo
    if send and not dry_run:
        sent = work.keep(send(documents), "sent")
        written = sent.unionByName(sink.skipped(scored.drop("ord").withColumnRenamed("at", "ord")))
        sink.check_not_all_failed(written)
        taken = todo.join(sink.pages(sent).select(F.col("ord").alias("at")), "at", "left_semi")
    if not dry_run:
        answered = work.spark.read.parquet(f"{work.root}/classify-in").join(replies.where("reply is not null").select("batch"), "batch", "left_semi")
        kept["seen"] = state.mark_seen(kept["seen"], answered, now)
        kept["seen_deals"] = state.mark_deals(kept["seen_deals"], taken.select(F.col("target_company").alias("target"), "seller", F.coalesce("stage", F.lit("unknown")).alias("stage")), now)
    n = lambda table, what="n": work.counts[table][what]
    counts = stage_counts(work.spark, {"articles": n("raw"), "distinct": n("distinct"), "new": n("new"), "with_text": n("fresh", "with_text"), "with_seller": n("positives"), "merged": n("merged"), "unseen_deals": n("unseen-deals"), "actionable": n("scored", "actionable")})
    return Result(alerts, todo, documents, kept, {"classify": model_stage.usage(replies), "qualify": model_stage.usage(scores)}, counts, written)


def lookback(inputs: Inputs, now: Column, work: Workspace, classify_with=None, days: int = 30) -> DataFrame:
    """CSV rows of all articles of the last days on press pages, and of all in feeds; no state, no filters, no second pass."""
    feeds = Inputs(feeds=inputs.feeds, core=inputs.core)
    pages = Inputs(press=inputs.press, law=inputs.law)
    parts = []
    if feeds.feeds or feeds.core:
        parts.append(raw_articles(feeds, now, None))
    if pages.press or pages.law:
        parts.append(raw_articles(pages, now, days * 24).withColumn("src_rank", F.col("src_rank") + 2))
    raw = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows = distinct_articles(raw)
    rows = work.keep(_with_bodies(work.keep(rows, "new"), inputs), "fresh")
    alerts, _ = model_stage.classify(rows, classify_with, ORDER, work.keep, work.calls)
    return sink.csv_rows(alerts)


def backtest(feeds: DataFrame, now: Column, work: Workspace, classify_with=None) -> DataFrame:
    """Deals found in the feeds as they are, by type: deal_type, n, lines."""
    rows = distinct_articles(raw_articles(Inputs(feeds=feeds), now, None))
    alerts, _ = model_stage.classify(work.keep(rows, "fresh"), classify_with, ORDER, work.keep, work.calls)
    day = F.coalesce(F.date_format("published", "yyyy-MM-dd"), F.lit("no date"))
    line = F.concat(day, F.lit(" "), F.left("title", F.lit(60)), F.lit(" | "), F.col("target_company"), F.lit(" <- "), F.col("seller"), F.lit(" | "), F.coalesce(F.nullif("buyer", F.lit("")), F.lit("?")))
    return alerts.where("deal_type is not null").groupBy("deal_type").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(line)).alias("lines")).orderBy("deal_type")


def accuracy_report(rows: DataFrame) -> str:
    return feedback.report(rows)


def fresh_state(spark: SparkSession) -> dict[str, DataFrame]:
    return {"seen": spark.createDataFrame([], schemas.SEEN), "seen_deals": spark.createDataFrame([], schemas.SEEN_DEALS), "firm_errors": spark.createDataFrame([], schemas.FIRM_ERRORS)}


def reset(spark: SparkSession, path: str) -> None:
    """An empty state; the one before stays as the backup."""
    tables.write_state(fresh_state(spark), path)


