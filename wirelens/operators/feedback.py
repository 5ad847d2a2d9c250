"""Accuracy from reviewers' verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import FALSE_POSITIVE_VERDICTS, PENDING, TRUE_POSITIVE_VERDICTS



def _given():
    return F.coalesce(F.col("verdict"), F.lit("")) != ""


def _reviewed():
    return _given() & (F.col("verdict") != PENDING)


def false_positives(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("verdict").isin(*FALSE_POSITIVE_VERDICTS))


def summary(rows: DataFrame) -> DataFrame:
    """total, reviewed, pending, confirmed, false_positives and precision (0 where none is decided)."""
    tp, fp = F.count_if(F.col("verdict").isin(*TRUE_POSITIVE_VERDICTS)), F.count_if(F.col("verdict").isin(*FALSE_POSITIVE_VERDICTS))
    return rows.agg(F.count("*").alias("total"), F.count_if(_reviewed()).alias("reviewed"), F.count_if(~_reviewed()).alias("pending"), tp.alias("confirmed"), fp.alias("false_positives")).withColumn(
        "precision", F.coalesce(F.try_divide(F.col("confirmed"), F.col("confirmed") + F.col("false_positives")), F.lit(0.0))
    )


def breakdown(rows: DataFrame) -> DataFrame:
    return rows.where(_given()).groupBy("verdict").agg(F.count("*").alias("n"))


def fp_by(rows: DataFrame, column: str) -> DataFrame:
    """False positives by a column, without its empty values."""
    return false_positives(rows).where(F.coalesce(F.col(column), F.lit("")) != "").groupBy(column).agg(F.count("*").alias("n"))


def fp_by_reason(rows: DataFrame) -> DataFrame:
    counts = false_positives(rows).groupBy("verdict").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("verdict", "n", F.round(F.col("n") * 100 / F.col("total"), 4).alias("percent"))  # the total is one row


def fp_grouping_sets(rows: DataFrame) -> DataFrame:
    """By deal type, reason and action in one pass."""
    fp = false_positives(rows).select(F.explode(F.array(*[F.struct(F.lit(n).alias("dimension"), F.col(c).alias("value")) for n, c in (("deal_type", "deal_type"), ("reason", "verdict"), ("action", "action"))])).alias("x")).select("x.*")
    return fp.where(F.coalesce("value", F.lit("")) != "").groupBy("dimension", "value").agg(F.count("*").alias("n"))


def examples(rows: DataFrame, order: str, limit: int = 10) -> DataFrame:
    """The first false positives, as the report lists them."""
    return false_positives(rows).orderBy(order).limit(limit).withColumn("title", F.left("title", F.lit(80)))


def report(rows: DataFrame, order: str = "page_id") -> str:
    """The text report; only small aggregates come to the driver."""
    s = summary(rows).first()
    out = ["Accuracy report", "", f"Total alerts: {s['total']}", f"Reviewed: {s['reviewed']}", f"Pending: {s['pending']}", f"Confirmed: {s['confirmed']}", f"False positives: {s['false_positives']}", f"Precision: {s['precision']:.0%}"]
    for name, df, column in (("Verdicts", breakdown(rows), "verdict"), ("False positives by reason", fp_by_reason(rows), "verdict"), ("False positives by deal type", fp_by(rows, "deal_type"), "deal_type"), ("False positives by action", fp_by(rows, "action"), "action")):
        got = df.orderBy(F.desc("n"), column).collect()
        if got:
            out += ["", f"{name}:"] + [f"  {r[column]}: {r['n']}" + (f" ({r['percent']:.0f}%)" if "percent" in r else "") for r in got]
    some = examples(rows, order).collect()
    if some:
        out += ["", "Examples:"]
        for r in some:
            out += [f"  [{r['verdict']}] {r['title']}", f"    deal_type={r['deal_type']}, score={r['score']}, action={r['action']}", f"    target={r['target']}, seller={r['seller']}"]
    return "\n".join(out)
