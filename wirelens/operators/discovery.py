"""Finding a firm's feed or press page: candidates in order, the first valid one wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html
from ..functions.constants import FEED_PATHS, PRESS_LINKS_NEEDED, PRESS_PATHS
from .filters import press_links


def press_candidates(firms: DataFrame) -> DataFrame:
    """name, priority and url of the paths to try."""
    return firms.where(F.coalesce("domain", F.lit("")) != "").select("name", F.posexplode(F.array(*[F.concat(F.lit("https://"), F.col("domain"), F.lit(p)) for p in PRESS_PATHS])).alias("priority", "url"))


def feed_candidates(firms: DataFrame, pages: DataFrame) -> DataFrame:
    """name, priority and url: feed links of the home page, then of the press page, then the press page's own feed, then the usual paths.

    ``pages`` has url and body of pages that were fetched.
    """
    f = firms.where((F.coalesce("domain", F.lit("")) != "") & (F.coalesce("feed_url", F.lit("")) == ""))
    of = lambda page, rank: f.select("name", page.alias("page")).where("page is not null").join(pages.select(F.col("url").alias("page"), "body"), "page").select("name", "page", F.posexplode(html.feed_links(F.col("body"))).alias("at", "href")).select("name", (F.lit(rank) + F.col("at")).alias("priority"), html.join_url_udf("page", "href").alias("url"))
    home, press = of(F.concat(F.lit("https://"), F.col("domain")), 0), of(F.col("press_url"), 100_000)
    own = f.where("press_url is not null").select("name", F.lit(200_000).alias("priority"), F.concat(F.regexp_replace("press_url", "/+$", ""), F.lit("/feed")).alias("url"))
    paths = f.select("name", F.posexplode(F.array(*[F.concat(F.lit("https://"), F.col("domain"), F.lit(p)) for p in FEED_PATHS])).alias("at", "url")).select("name", (F.lit(300_000) + F.col("at")).alias("priority"), "url")
    return home.unionByName(press).unionByName(own).unionByName(paths)


def first_valid(candidates: DataFrame, valid: DataFrame) -> DataFrame:
    """name and url of each firm's first candidate among the valid urls (one column, url)."""
    return candidates.join(valid.select("url").distinct(), "url", "left_semi").groupBy("name").agg(F.min_by("url", "priority").alias("url"))


def is_press_page(body: Column) -> Column:
    return press_links(html.hrefs(body)) >= PRESS_LINKS_NEEDED


def select_firm(firms: DataFrame, wanted: str) -> DataFrame:
    """The one firm of a name: exact but for case, else the only one that contains it."""
    low = F.lower("name")
    for rule in (low == wanted.lower(), low.contains(wanted.lower())):
        got = firms.where(rule)
        n = got.limit(2).count()
        if n == 1:
            return got
        if n > 1:
            raise ValueError(f"{wanted!r} fits more than one firm")
    raise ValueError(f"no firm fits {wanted!r}")


def counts(firms: DataFrame, found: DataFrame) -> DataFrame:
    """with_feed, found, press_only and none."""
    f = firms.join(found.select("name", F.col("url").alias("new_url")), "name", "left")
    feed, new, press = F.col("feed_url").isNotNull(), F.col("new_url").isNotNull(), F.col("press_url").isNotNull()
    return f.agg(F.count_if(feed).alias("with_feed"), F.count_if(~feed & new).alias("found"), F.count_if(~feed & ~new & press).alias("press_only"), F.count_if(~feed & ~new & ~press).alias("none"))


def fill_urls(firms: DataFrame, found: DataFrame, column: str, overwrite: bool = False) -> DataFrame:
    """Fills a null url column from name, url; overwrite also replaces (for one firm's repair)."""
    f = firms.join(found.select("name", F.col("url").alias("new_url")), "name", "left")
    value = F.coalesce("new_url", column) if overwrite else F.coalesce(column, "new_url")
    return f.withColumn(column, value).drop("new_url")
