"""Row rules of the scan: windows, required fields, alerts, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..functions.constants import MIN_CONFIDENCE, PRESS_LINK_WORDS


def in_window(df: DataFrame, now: Column, hours: int | None, column: str = "published") -> DataFrame:
    return df.where(dates.within(F.col(column), now, hours))


def window_counts(df: DataFrame, now: Column, hours: int, column: str = "published") -> DataFrame:
    c = F.col(column)
    kept = dates.within(c, now, hours)
    return df.agg(F.count_if(c.isNotNull() & kept).alias("kept_dated"), F.count_if(c.isNull()).alias("kept_undated"), F.count_if(~kept).alias("dropped"))


def required(df: DataFrame) -> DataFrame:
    """Entries with a title and a link."""
    return df.where((text.strip(F.coalesce("title", F.lit(""))) != "") & (text.strip(F.coalesce("url", F.lit(""))) != ""))


def is_positive() -> Column:
    return F.col("deal_type").isNotNull() & (F.col("confidence") >= MIN_CONFIDENCE)


def has_seller(seller: Column | None = None) -> Column:
    s = F.lower(text.strip(F.coalesce(F.col("seller") if seller is None else seller, F.lit(""))))
    return (s != "") & ~s.startswith("unknown") & (s != "n/a")


def alerts_to_score(df: DataFrame) -> DataFrame:
    return df.where(is_positive() & has_seller())


def action_counts(df: DataFrame) -> DataFrame:
    a = F.coalesce("recommended_action", F.lit("discard"))
    return df.agg(F.count_if(a == "pursue").alias("pursue"), F.count_if(a == "monitor").alias("monitor"), F.count_if(~a.isin("pursue", "monitor")).alias("discard"))


def to_act_on() -> Column:
    return F.col("recommended_action").isin("pursue", "monitor")


def actionable(df: DataFrame) -> DataFrame:
    """Pursue, then monitor; rank keeps that order."""
    return df.where(to_act_on()).withColumn("rank", F.when(F.col("recommended_action") == "pursue", 0).otherwise(1))


def route(firms: DataFrame, errors: DataFrame) -> DataFrame:
    """Adds route: how a firm's press page is read (skip, discover, render or plain)."""
    e = errors.select(F.col("firm_name").alias("name"), "needs_url_update", "prefer_render")
    return firms.join(e, "name", "left").withColumn(
        "route",
        F.when(F.coalesce("needs_url_update", F.lit(False)), "skip").when(F.coalesce("press_url", F.lit("")) == "", "discover").when(F.coalesce("prefer_render", F.lit(False)), "render").otherwise("plain"),
    )


def escalate(route: Column, error_type: Column, rows: Column) -> Column:
    """After a plain fetch: 403 renders (and is remembered), other errors stop, no rows render."""
    return F.when(route != "plain", route).when(error_type == "403", "render").when(error_type.isin("dns", "404", "timeout"), "stop").when(rows == 0, "render").otherwise("done")


def on_own_host(url: Column, domain: Column) -> Column:
    host = F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit(""))
    return (host == "") | host.contains(domain)


def press_links(hrefs: Column) -> Column:
    """Links that look like articles."""
    low = F.transform(hrefs, lambda h: F.lower(h))
    return F.size(F.filter(low, lambda h: F.exists(F.array(*map(F.lit, PRESS_LINK_WORDS)), lambda w: h.contains(w))))
