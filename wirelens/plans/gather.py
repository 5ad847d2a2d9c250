"""Fetching what a run reads: firm feeds, core feeds, press pages, law firms' pages, article bodies.

Every stage is a table of urls that is fetched once and kept as a log; the
plans read payloads from it and the state takes its outcomes.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html
from ..functions.constants import FETCH_BUDGET
from ..operators import discovery, filters, state
from ..sources import fetch, tables
from . import frontier
from .scan import Inputs, Workspace

_PAGE = ("kind", "domain", "route", "seq")


@dataclass
class Web:
    """How pages are got: ``get`` and, where there is one, ``render``."""

    get: fetch.Get = fetch.http_get
    render: Callable[[str], str | None] | None = None
    unverified: bool = False
    until: float | None = None

    def fetch(self, urls: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
        return fetch.fetch(urls, self.get, self.render, carry, unverified=self.unverified, until=self.until)

    def within(self, seconds: float) -> Web:
        """The same, with one deadline for all fetches from now on."""
        return replace(self, until=time.time() + seconds)


@dataclass
class Gathered:
    inputs: Inputs
    log: DataFrame
    found: DataFrame
    unfinished: DataFrame


def find_press_pages(firms: DataFrame, work: Workspace, web: Web) -> DataFrame:
    """name and url of firms without a press page: the first path that reads like one; a firm whose host cannot be reached is not tried further."""
    plain = replace(web, render=None)
    return frontier.probe(discovery.press_candidates(firms), plain.fetch, discovery.is_press_page(F.col("body")), work.keep, "press", ("dns", "timeout"))


def find_feeds(firms: DataFrame, work: Workspace, web: Web) -> DataFrame:
    """name and url of each firm's feed: links of the home page, then of the press page, its own feed, the usual paths; a later page or path is asked for only while no feed is found."""
    good = F.size(tables.feed_entries(F.col("body"))) > 0
    left, found = firms, None
    for k, (page, bounds) in enumerate(((F.concat(F.lit("https://"), F.col("domain")), (0, 100_000)), (F.col("press_url"), (100_000, 200_000)), (None, (200_000, 1 << 31)))):
        pages = feed_pages(left, page, work, web, f"feed-pages-{k}") if page is not None else firms.sparkSession.createDataFrame([], "url string, body string")
        candidates = discovery.feed_candidates(left, pages).where((F.col("priority") >= bounds[0]) & (F.col("priority") < bounds[1]))
        got = work.keep(frontier.probe(candidates, web.fetch, good, work.keep, f"feeds-{k}"), f"feeds-found-{k}")
        found = got if found is None else found.unionByName(got)
        left = left.join(got.select("name"), "name", "left_anti")
    return found


def gather(spark: SparkSession, firms: DataFrame, errors: DataFrame, work: Workspace, web: Web, scrape: bool = True, flags: bool = True) -> Gathered:
    """Payloads of one run, with the fetch log, new press pages and the sources that time left out.

    Flagged firms are passed over, unless ``flags`` is off (a back-test reads
    all feeds).  A press page that is refused or has no cards is rendered where
    there is a renderer.
    """
    web = web.within(FETCH_BUDGET) if web.until is None else web
    routed = filters.route(firms, errors)
    routed = routed if flags else routed.withColumn("route", F.when(F.col("route") == "skip", "plain").otherwise(F.col("route")))
    routed = work.keep(routed.where("route <> 'skip'"), "routed")
    none = spark.createDataFrame([], "name string, url string")
    found = work.keep(find_press_pages(routed.where("route = 'discover'"), work, web), "press-found") if scrape else none
    part = lambda df, kind, column, seq: df.where(F.coalesce(F.col(column), F.lit("")) != "").select(F.col("name").alias("firm_name"), F.col(column).alias("url"), F.lit(kind).alias("kind"), F.coalesce("domain", F.lit("")).alias("domain"), "route", F.lit(seq).alias("seq"))
    urls = part(routed, "feed", "feed_url", 0)
    core = tables.core_feeds(spark)
    urls = urls.unionByName(core.select("firm_name", "url", F.lit("core").alias("kind"), F.lit("").alias("domain"), F.lit("plain").alias("route"), F.lit(1).alias("seq")))
    if scrape:
        new = routed.join(found.select("name", F.col("url").alias("new_url")), "name").withColumn("route", F.lit("plain"))
        law = filters.route(tables.law_firms(spark), errors).where("route <> 'skip'")
        urls = urls.unionByName(part(routed.where("route <> 'discover'"), "press", "press_url", 2)).unionByName(part(new, "press", "new_url", 2)).unionByName(part(law, "law", "press_url", 2))
    urls = work.keep(urls, "urls")
    direct = F.lit(web.render is not None) & (F.col("route") == "render") & F.col("kind").isin("press", "law")
    log = web.fetch(urls.where(~direct), _PAGE)
    if web.render:
        log = log.unionByName(fetch.rendered(urls.where(direct), web.render, _PAGE))
    log = work.keep(log, "fetch-log")
    pages = log.where("kind in ('press', 'law')")
    if web.render:
        cards = F.size(html.cards_udf("body", "domain"))
        again = pages.where(~F.col("used_render")).where(filters.escalate(F.lit("plain"), F.col("error_type"), F.when(F.col("error_type").isNull(), cards).otherwise(0)) == "render")
        second = work.keep(fetch.rendered(again, web.render, _PAGE).where("error_type is null"), "rendered")
        pages = pages.join(second.select("firm_name", "url"), ["firm_name", "url"], "left_anti").unionByName(second)
    good = log.where("error_type is null")
    pages = pages.where("error_type is null")
    got = Inputs(
        feeds=good.where("kind = 'feed'").select("firm_name", "body"), core=good.where("kind = 'core'").select("firm_name", "body"),
        press=pages.where("kind = 'press'").select("firm_name", "domain", "body") if scrape else None, law=pages.where("kind = 'law'").select("firm_name", "domain", "body") if scrape else None,
    )
    outcomes = log.where("kind <> 'core'").select("firm_name", "seq", "url", state.outcome(F.col("error_type")).alias("outcome"))
    return Gathered(got, outcomes, found, fetch.unfinished(log))


def bodies(work: Workspace, web: Web) -> Callable[[DataFrame], DataFrame]:
    """For scan(): fetches the pages of articles (url, firm_name); gives url and body of those that came."""

    def run(articles: DataFrame) -> DataFrame:
        log = work.keep(web.fetch(articles.select("url", "firm_name").dropDuplicates(["url"])), "bodies")
        return log.where("error_type is null").select("url", "body")

    return run


def feed_pages(firms: DataFrame, page: Column, work: Workspace, web: Web, name: str) -> DataFrame:
    """url and body of firms' pages that may link to feeds."""
    urls = firms.where((F.coalesce("domain", F.lit("")) != "") & page.isNotNull()).select(F.col("name").alias("firm_name"), page.alias("url"))
    log = work.keep(web.fetch(urls.dropDuplicates(["url"])), name)
    return log.where("error_type is null").select("url", "body")
