"""Rows for the sinks: properties document, CSV, outcome counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.constants import PENDING, SINK_TEXT


def consistent_type(qualified: bool = True) -> Column:
    """The deal type, unless it contradicts is_carveout or a discard."""
    kept = F.when(F.col("is_carveout"), F.col("deal_type"))
    return F.when(F.col("recommended_action") == "discard", None).otherwise(kept) if qualified else kept


def writable() -> Column:
    return F.length(text.strip(F.coalesce("title", F.lit("")))) > 2


def project(alerts: DataFrame) -> DataFrame:
    """Flat sink columns of qualified alerts; a null column is left out of the document."""
    cut = lambda c: F.left(c, F.lit(SINK_TEXT))
    default = lambda c: cut(F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("N/A")))
    some = lambda c: F.nullif(cut(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    stage = F.when(F.col("stage").isNotNull(), text.capitalize(F.col("stage")))
    action = F.col("recommended_action")
    return alerts.where(writable()).select(
        "ord", cut(text.strip(F.col("title"))).alias("alert"), cut(F.coalesce("pe_firm", F.lit(""))).alias("pe_firm"), default("target_company").alias("target"), default("seller").alias("seller"),
        F.col("fit").alias("score"), F.nullif("url", F.lit("")).alias("url"), cut(F.coalesce("reasoning", F.lit(""))).alias("reasoning"), F.lit(PENDING).alias("verdict"),
        consistent_type().alias("deal_type"), some("buyer").alias("buyer"), stage.alias("stage"), F.date_format("published", "yyyy-MM-dd").alias("date"),
        F.when(action.isin("pursue", "monitor"), action).alias("action"), F.when((action == "pursue") & stage.isin("Signing", "Closing"), "Queued").alias("brief_status"),
    )


def document(flat: DataFrame, database: str) -> DataFrame:
    """ord and the JSON document of each row."""
    rich = lambda c: F.struct(F.array(F.struct(F.struct(F.col(c).alias("content")).alias("text"))).alias("rich_text"))
    pick = lambda c: F.struct(F.struct(F.col(c).alias("name")).alias("select"))
    opt = lambda c, made: F.when(F.col(c).isNotNull(), made(c))
    props = F.struct(
        F.struct(F.array(F.struct(F.struct(F.col("alert").alias("content")).alias("text"))).alias("title")).alias("Alert"), rich("pe_firm").alias("PE Firm"), rich("target").alias("Target"), rich("seller").alias("Seller"),
        F.struct(F.col("score").alias("number")).alias("%"), F.struct(F.col("url")).alias("URL"), rich("reasoning").alias("Reasoning"), pick("verdict").alias("Verdict"), opt("deal_type", pick).alias("Deal Type"),
        opt("buyer", rich).alias("Buyer"), opt("stage", pick).alias("Stage"), F.when(F.col("date").isNotNull(), F.struct(F.struct(F.col("date").alias("start")).alias("date"))).alias("Date"),
        opt("action", pick).alias("Action"), opt("brief_status", pick).alias("Brief Status"),
    )
    body = F.struct(F.struct(F.lit(database).alias("database_id")).alias("parent"), props.alias("properties"))
    return flat.select("ord", F.to_json(body, {"ignoreNullFields": "true"}).alias("document"))


def property_text(kind: Column, content: Column, name: Column, number: Column) -> Column:
    """A typed property as text: joined content, a selected name, a number, else empty."""
    return F.when(kind.isin("title", "rich_text"), F.array_join(content, "")).when(kind == "select", F.coalesce(name, F.lit(""))).when(kind == "number", F.coalesce(number.cast("string"), F.lit(""))).otherwise("")


def csv_rows(alerts: DataFrame) -> DataFrame:
    """All alerts, positive or not, as the look-back file lists them."""
    return alerts.select(
        F.coalesce(F.date_format("published", "yyyy-MM-dd HH:mm"), F.lit("")).alias("date"), F.col("firm_name").alias("firm"), "title", "url", F.coalesce("deal_type", F.lit("none")).alias("deal_type"),
        F.coalesce("stage", F.lit("")).alias("stage"), "target_company", "seller", "buyer", "confidence", "reasoning",
    )


def skipped(scored: DataFrame) -> DataFrame:
    """Outcome rows of what is never sent: discards, and rows without a usable title."""
    return scored.where(~F.coalesce(F.col("recommended_action").isin("pursue", "monitor"), F.lit(False)) | ~writable()).select(F.col("ord").cast("long").alias("ord"), F.lit(None).cast("string").alias("page_id"), F.lit("skipped").alias("outcome"))


def pages(written: DataFrame) -> DataFrame:
    """ord and page_id of the rows that the sink took."""
    return written.where("outcome = 'written'").select("ord", "page_id")


def outcomes(written: DataFrame) -> DataFrame:
    """written, skipped and errors of a sink run (outcome: written, skipped or error)."""
    return written.agg(*[F.count_if(F.col("outcome") == o).alias(n) for o, n in (("written", "written"), ("skipped", "skipped"), ("error", "errors"))])


def check_not_all_failed(written: DataFrame) -> None:
    r = outcomes(written).first()
    if r["errors"] > 0 and r["written"] == 0:
        raise RuntimeError("every row failed at the sink; the state is not saved")
