"""Landing payloads as rows: dimension file, feeds, press pages, verdict pages, state."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import dates, html, text
from ..functions.constants import CORE_FEEDS, LAW_FIRMS, STATE_BYTES_TO_WARN
from .versions import Versions

RSS = "channel struct<item: array<struct<title: string, link: string, description: string, pubDate: string, updated: string>>>"
ATOM = "entry array<struct<title: string, link: array<struct<_href: string, _rel: string>>, summary: string, content: string, published: string, updated: string>>"


def firms(spark: SparkSession, path: str) -> DataFrame:
    """The firm dimension from its YAML file; a missing list is empty, unknown keys are ignored."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return firms_from(spark, (yaml.safe_load(f) or {}).get("firms") or [])


def firms_from(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([(r["name"], r.get("domain") or "", r.get("feed_url"), r.get("press_url"), r.get("hq") or "", r.get("sectors") or [], r.get("source_category") or "pe_firm") for r in rows], schemas.FIRM)


def write_firms(df: DataFrame, path: str) -> None:
    """The dimension back to YAML: one driver file, of a size that people edit."""
    import yaml

    rows = [{k: v for k, v in r.asDict().items() if v not in (None, "", [])} for r in df.orderBy("name").collect()]
    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump({"firms": rows}, f, sort_keys=False, allow_unicode=True)


def core_feeds(spark: SparkSession) -> DataFrame:
    """Feeds that belong to no firm; the source stands for the firm's name."""
    return spark.createDataFrame(list(CORE_FEEDS), "firm_name string, url string")


def law_firms(spark: SparkSession) -> DataFrame:
    return firms_from(spark, [{"name": n, "domain": d, "press_url": u, "source_category": "law_firm"} for n, d, u in LAW_FIRMS])


def feed_entries(body: Column) -> Column:
    """Entries of an RSS or Atom document, in order: array of title, url, summary, date; empty for anything else."""
    rss, atom = F.from_xml(body, RSS), F.from_xml(body, ATOM)
    entry = lambda t, u, s, d: F.struct(text.strip(F.coalesce(t, F.lit(""))).alias("title"), text.strip(F.coalesce(u, F.lit(""))).alias("url"), F.left(text.strip(F.coalesce(s, F.lit(""))), F.lit(500)).alias("summary"), d.alias("date"))
    items = F.transform(rss["channel"]["item"], lambda i: entry(i["title"], i["link"], i["description"], F.coalesce(i["pubDate"], i["updated"])))
    entries = F.transform(atom["entry"], lambda e: entry(e["title"], F.get(e["link"], F.lit(0))["_href"], F.coalesce(e["summary"], e["content"]), F.coalesce(e["published"], e["updated"])))
    return F.coalesce(items, entries, F.array().cast("array<struct<title:string,url:string,summary:string,date:string>>"))


def feed_articles(fetched: DataFrame, now: Column, hours: int | None) -> DataFrame:
    """Articles of fetched feeds (firm_name, body), with their order; undated entries stay."""
    rows = fetched.select("firm_name", F.posexplode(feed_entries(F.col("body"))).alias("ord", "e"))
    rows = rows.select(F.col("e.title").alias("title"), F.col("e.url").alias("url"), F.col("e.summary").alias("summary"), dates.feed_date(F.col("e.date")).alias("published"), "firm_name", "ord")
    return rows.where((F.col("title") != "") & (F.col("url") != "") & dates.within(F.col("published"), now, hours))


def press_articles(fetched: DataFrame, now: Column, hours: int | None) -> DataFrame:
    """Articles of fetched press pages (firm_name, domain, body)."""
    rows = fetched.select("firm_name", F.explode(html.cards_udf("body", "domain")).alias("c"))
    published = dates.date_cascade(F.col("c.time_attr"), F.col("c.text"), F.col("c.href"))
    rows = rows.select(F.col("c.title").alias("title"), F.col("c.url").alias("url"), F.col("c.summary").alias("summary"), published.alias("published"), "firm_name", F.col("c.ord").alias("ord"))
    return rows.where(dates.within(F.col("published"), now, hours))


def with_bodies(articles: DataFrame, bodies: DataFrame) -> DataFrame:
    """Replaces summaries by body texts where one was fetched (url, body); no article is lost."""
    b = bodies.select("url", html.body_text_udf("body").alias("found")).dropDuplicates(["url"])
    return articles.join(b, "url", "left").withColumn("summary", F.coalesce(F.nullif("found", F.lit("")), "summary")).drop("found")


def verdicts(spark: SparkSession, pages: list[str]) -> DataFrame:
    """Verdict rows from saved answer pages of the review database (JSON texts)."""
    return spark.createDataFrame([verdict_row(r) for page in pages for r in json.loads(page).get("results", [])], schemas.VERDICT)


def verdict_row(r: dict) -> tuple:
    """A result of an answer page as a row of schemas.VERDICT."""
    p = r.get("properties", {})
    return (r.get("id", ""), *[property_value(p.get(n, {})) for n in ("Alert", "Verdict", "Action", "Deal Type", "Target", "Seller", "Buyer", "PE Firm", "%")], (p.get("URL") or {}).get("url") or "")


def property_value(p: dict) -> str:
    kind = p.get("type")
    if kind in ("title", "rich_text"):
        return "".join(t.get("plain_text", "") for t in p.get(kind) or [])
    if kind == "select":
        return (p.get("select") or {}).get("name", "")
    if kind == "number":
        return "" if p.get("number") is None else str(p["number"])
    return ""


def read_state(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The state tables of a folder's newest version; where there is none they are empty."""
    return Versions(spark, path).read()


def state_from_json(spark: SparkSession, doc: str) -> dict[str, DataFrame]:
    """State from the JSON form, tolerant: anything but an object with seen is a fresh state; missing parts are empty."""
    try:
        d = json.loads(doc)
    except ValueError:
        d = {}
    if not isinstance(d, dict) or not isinstance(d.get("seen"), dict):
        d = {"seen": {}}
    seen = [(u, v.get("hash"), v.get("first_seen")) for u, v in d["seen"].items()]
    deals = [(*([*k.split("|"), "", ""][:3]), v.get("first_seen")) for k, v in (d.get("seen_deals") or {}).items()]
    errors = [(n, e.get("last_error"), e.get("last_error_date"), e.get("consecutive_404s", 0), e.get("needs_url_update", False), e.get("prefer_render", False)) for n, e in (d.get("firm_errors") or {}).items()]
    return {"seen": spark.createDataFrame(seen, schemas.SEEN), "seen_deals": spark.createDataFrame(deals, schemas.SEEN_DEALS), "firm_errors": spark.createDataFrame(errors, schemas.FIRM_ERRORS)}


def write_state(tables: dict[str, DataFrame], path: str, now: str | None = None) -> int:
    """Writes a version of the state, of which only changed parts are new (versions.Versions); the one before stays as the backup.

    Gives the bytes of its parts and warns where they are many.
    """
    import warnings

    versions = Versions(next(iter(tables.values())).sparkSession, path)
    versions.write(tables, now)
    size = versions.size()
    if size > STATE_BYTES_TO_WARN:
        warnings.warn(f"the state has grown to {size} bytes", stacklevel=2)
    return size


def last_run(spark: SparkSession, path: str) -> str | None:
    """When the last run saved its state; None before the first."""
    return (Versions(spark, path).load() or {}).get("last_run")
