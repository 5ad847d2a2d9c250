"""Queries of the news operators over the driver's tables; oracles.py has the SQL of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, html, model_json, scoring, text
from ..functions.constants import CLASSIFY_BATCH
from ..operators import dedup, discovery, feedback, filters, matching, model_stage, sink, state
from ..sources import readers, tables
from ..workspace import Workspace

AS_OF = "2024-01-31 00:00:00"
Read = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[Read], DataFrame]] = {}
#: Queries that write files; tests hold them against others.
WRITING = {"feed_files"}


def query(f):
    QUERIES[f.__name__] = f
    return f


def now() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def verdict_rows(t: Read) -> DataFrame:
    """Documents as review rows: the label gives the verdict."""
    verdict = F.when(F.col("quality").isNull(), "Pending").when(F.col("quality") == 1, "Confirmed").when(F.col("toxic") == 1, "Not Relevant").otherwise("Low EV")
    number = F.regexp_extract("source", "([0-9]+)", 1).cast("int")
    d = t("documents").join(t("labels"), "doc_id", "left")
    return d.select("doc_id", F.col("text").alias("title"), verdict.alias("verdict"), F.when(number % 3 == 0, "").when(number % 2 == 0, "corporate_carveout").otherwise("portco_carveout").alias("deal_type"),
                    F.when(F.col("lang") == "en", "pursue").when(F.col("lang") == "de", "monitor").otherwise("").alias("action"), F.col("n_chars").cast("string").alias("score"), F.col("lang").alias("target"), F.col("source").alias("seller"))


@query
def accuracy_summary(t):
    return feedback.summary(verdict_rows(t)).withColumn("precision", F.round("precision", 6))


@query
def verdict_breakdown(t):
    return feedback.breakdown(verdict_rows(t))


@query
def fp_by_reason(t):
    return feedback.fp_by_reason(verdict_rows(t))


@query
def fp_by_deal_type(t):
    return feedback.fp_by(verdict_rows(t), "deal_type")


@query
def fp_by_action(t):
    return feedback.fp_by(verdict_rows(t), "action")


@query
def fp_grouping_sets(t):
    return feedback.fp_grouping_sets(verdict_rows(t))


@query
def fp_examples_top10(t):
    return feedback.examples(verdict_rows(t), "doc_id").select("doc_id", "title", "verdict", "deal_type", "action", "score")


def dated_events(t: Read) -> DataFrame:
    return t("events").withColumn("published", F.when(F.col("event_id") % 10 != 0, F.col("ts").cast("timestamp_ntz")))


@query
def lookback_window(t):
    return filters.in_window(dated_events(t), now(), 48).select("event_id", stamp(F.col("published")).alias("published"))


@query
def window_counters(t):
    return filters.window_counts(dated_events(t), now(), 336)


def event_urls(t: Read) -> DataFrame:
    return t("events").select("event_id", F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("url"), "ts", "event_type", "value")


@query
def url_distinct_keep_first(t):
    return dedup.keep_first(event_urls(t), ["url"], ["ts", "event_id"]).select("url", "event_id", "value")


@query
def seen_anti_join(t):
    e = event_urls(t)
    seen = e.where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    return dedup.unseen(e, seen).select("event_id", "url")


@query
def source_union_rank(t):
    branches = [event_urls(t).where(F.col("event_type") == kind).withColumn("src_rank", F.lit(k)) for k, kind in enumerate(("signup", "view", "click", "purchase"))]
    union = branches[0]
    for b in branches[1:]:
        union = union.unionByName(b)
    return union.groupBy("src_rank").agg(F.count("*").alias("n"), F.countDistinct("url").alias("urls"))


@query
def state_ttl_prune(t):
    first = F.when(F.col("event_id") % 97 == 0, "not a date").when(F.col("event_id") % 89 != 0, stamp(F.col("ts")))
    s = t("events").select("event_id", first.alias("first_seen"))
    return state.prune(s, F.lit(AS_OF).cast("timestamp")).select("event_id", "first_seen")


@query
def seen_hash(t):
    return t("pages").select("page_id", text.url_hash(F.col("url")).alias("hash"))


def fetch_outcomes(t: Read) -> DataFrame:
    kind = F.col("event_type")
    return t("events").select("event_id", "ts", F.col("user_id").alias("firm"), F.when(kind == "error", "404").when(kind.isin("purchase", "signup"), "ok").when(kind == "view", "timeout").otherwise("403").alias("outcome"))


@query
def not_found_streak(t):
    return state.miss_streaks(fetch_outcomes(t), "firm", ["ts", "event_id"]).select("event_id", "firm", "streak")


@query
def flagged_firms(t):
    return state.flagged(state.firm_errors(fetch_outcomes(t), "firm", ["ts", "event_id"]), "firm")


@query
def firm_error_state(t):
    return state.firm_errors(fetch_outcomes(t), "firm", ["ts", "event_id"])


def firm_rows(t: Read) -> DataFrame:
    k = F.col("s_suppkey")
    return t("supplier").select(F.col("s_name").alias("name"), F.concat(F.lit("www."), F.lower(F.regexp_replace("s_name", "#", "")), F.lit(".example.com")).alias("domain"), F.when(k % 3 == 0, F.concat(F.lit("https://feed/"), k.cast("string"))).alias("feed_url"), F.when(k % 4 != 0, F.concat(F.lit("https://press/"), k.cast("string"))).alias("press_url"))


@query
def prefer_render_route(t):
    e = state.firm_errors(fetch_outcomes(t), "firm", ["ts", "event_id"])
    e = e.select(F.concat(F.lit("Supplier#"), F.lpad(F.col("firm").cast("string"), 9, "0")).alias("firm_name"), "needs_url_update", "prefer_render")
    return filters.route(firm_rows(t), e).select("name", "route")


@query
def norm_text(t):
    return t("documents").select("doc_id", F.sha2(text.norm(F.col("text")), 256).alias("norm_sha"))


@query
def deal_key(t):
    return t("part").select("p_partkey", text.deal_key(F.concat(F.lit(" The "), F.col("p_name"), F.lit(" (Division)!")), F.col("p_brand"), F.col("p_type")).alias("key"))


@query
def deal_tokens(t):
    return t("documents").select("doc_id", F.size(text.tokens(F.col("text"))).cast("long").alias("n"), F.sha2(F.array_join(F.array_sort(text.tokens(F.col("text"))), " "), 256).alias("sha"))


@query
def acronym(t):
    return t("part").select("p_partkey", text.acronym(F.concat_ws(" ", "p_type", "p_name", F.lit("of a Unit"))).alias("acronym"))


def deals(t: Read) -> DataFrame:
    """Parts as deals: the target varies in form with the key, the brand sells."""
    k = F.col("p_partkey")
    bare = F.regexp_replace("p_brand", "#", "")
    target = F.when(k % 7 == 0, F.concat(bare, F.lit(" Tech"))).when(k % 7 == 1, F.lit("Industrial Division")).when(k % 7 == 2, F.upper("p_name")).when(k % 7 == 3, F.concat("p_name", F.lit(" products unit"))).otherwise(F.concat_ws(" ", "p_type", "p_name"))
    return t("part").select(F.col("p_partkey").alias("ord"), target.alias("target"), F.concat(bare, F.lit(" Holdings")).alias("seller"), F.when(F.col("p_size") % 2 == 0, "signing").otherwise("closing").alias("stage"), F.col("p_size").alias("confidence"), F.col("p_name").alias("title"), F.lit("").alias("reasoning"))


@query
def token_jaccard_pairs(t):
    """For each distinct target of a seller: its other targets with Jaccard of 0.5 or more; they share a token, so they meet by it."""
    d = deals(t).select("seller", "target").distinct().select("*", text.tokens(F.col("target")).alias("toks"))
    side = lambda n: d.select("seller", F.col("target").alias(f"t{n}"), F.col("toks").alias(f"k{n}"), F.explode("toks").alias("tok"))
    pairs = side(1).join(side(2), ["seller", "tok"]).where("t1 < t2").select("seller", "t1", "t2", text.jaccard(F.col("k1"), F.col("k2")).alias("j")).where("j >= 0.5").distinct()
    return pairs.select("seller", "t1", "t2", F.round("j", 6).alias("j"))


@query
def targets_match_pairs(t):
    """Distinct targets of a seller and stage that match: a count for each, over the pairs of the containment join."""
    d = deals(t).select("seller", "stage", "target").distinct()
    name, seller, st = text.norm(F.col("target")), text.norm(F.col("seller")), F.lower("stage")
    d = d.withColumn("id", matching.profile_id(name, seller, st))
    keep = Workspace.new(d.sparkSession, "targets").keep
    known = keep(matching.profiles(d.select(name.alias("name"), seller.alias("seller"), st.alias("st"))), "profiles")
    pairs = matching.matches(known, rule=lambda p, q: (p["seller"] == q["seller"]) & text.same_target(p, q), keep=keep)
    forms = d.groupBy("id").agg(F.count("*").alias("forms"))
    others = pairs.join(forms.withColumnRenamed("id", "r"), "r").groupBy(F.col("l").alias("id")).agg(F.sum("forms").alias("others"))
    n = (F.coalesce("others", F.lit(0)) + F.col("forms") - 1).alias("n")  # forms of one name match each other too
    return d.join(forms, "id").join(others, "id", "left").select("seller", "stage", "target", n).where("n > 0")


@query
def fuzzy_deal_anti_join(t):
    d = deals(t)
    seen = d.where(F.col("ord") % 5 == 0)
    return dedup.unseen_deals(d.where(F.col("ord") % 5 != 0), seen).select("ord", "target", "stage")


@query
def greedy_deal_dedup(t):
    """All deals, folded within their stage."""
    return dedup.fold_repeats(deals(t), ["stage"]).select("ord", "stage", "seller", "target", "confidence", "reasoning")


@query
def cap_text(t):
    c = text.cap_text(F.col("text"))
    return t("documents").select("doc_id", F.length(c).cast("long").alias("n"), F.sha2(c, 256).alias("sha"))


@query
def word_gate(t):
    return t("documents").select("doc_id", text.word_gate(F.col("text")).alias("passes"))


def _order_day() -> Column:
    return F.col("o_orderdate")


@query
def date_cascade(t):
    k, day = F.col("o_orderkey"), _order_day()
    body = (F.when(k % 6 == 0, F.date_format(day, "d MMMM yyyy")).when(k % 6 == 1, F.date_format(day, "MMMM d, yyyy")).when(k % 6 == 2, F.date_format(day, "yyyy-MM-dd"))
            .when(k % 6 == 3, F.date_format(day, "MM.dd.yy")).when(k % 6 == 4, F.concat(F.lit("31 February 2024 then "), F.date_format(day, "yyyy-MM-dd"))).otherwise("no date here"))
    got = dates.date_cascade(F.lit(None).cast("string"), F.concat(F.lit("Posted "), body, F.lit(" by staff")), F.lit("/news/x"))
    return t("orders").select("o_orderkey", F.date_format(got, "yyyy-MM-dd").alias("day"))


@query
def url_date(t):
    k, day = F.col("o_orderkey"), _order_day()
    href = F.concat(F.lit("https://x.example.com/news/"), F.when(k % 3 == 0, F.date_format(day, "yyyy/MM/dd/")).when(k % 3 == 1, F.date_format(day, "yyyy/MM/")).otherwise("item/"), F.lit("n"), k.cast("string"))
    return t("orders").select("o_orderkey", F.date_format(dates.url_date(href), "yyyy-MM-dd").alias("day"))


@query
def host_filter(t):
    return t("pages").where(filters.on_own_host(F.col("url"), F.lit("example.com"))).select("page_id", "url")


def saved_feeds_of(t: Read) -> DataFrame:
    """A feed for each user, with an item for each event."""
    e = t("events")
    item = F.concat(F.lit("<item><title> Event "), F.col("event_id").cast("string"), F.lit(" &amp; more </title><link>https://x.example.com/"), F.col("event_id").cast("string"), F.lit("</link><description>"), F.col("event_type"), F.lit("</description><pubDate>"), F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000</pubDate></item>"))
    return e.groupBy(F.col("user_id").cast("string").alias("firm_name")).agg(F.concat(F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>f</title>'), F.array_join(F.array_sort(F.collect_list(item)), ""), F.lit("</channel></rss>")).alias("body"))


def feed_items(feeds: DataFrame) -> DataFrame:
    got = tables.feed_articles(feeds, F.lit(AS_OF).cast("timestamp"), None)
    return got.select("firm_name", "title", "url", "summary", F.date_format("published", "yyyy-MM-dd HH:mm:ss").alias("published"))


@query
def rss_parse(t):
    return feed_items(saved_feeds_of(t))


@query
def feed_files(t):
    """The same feeds saved as payload files and read back through the data source; writes files, so it has no SQL."""
    feeds = saved_feeds_of(t)
    folder = Workspace.new(feeds.sparkSession, "feeds").root
    readers.save(feeds, folder)
    return feed_items(readers.load(feeds.sparkSession, folder))


def linked_pages(t: Read) -> DataFrame:
    """Pages with a feed link or article links added, by page_id."""
    k = F.col("page_id")
    link = F.concat(F.lit("<link rel='alternate' type='application/rss+xml' href='/feed/"), k.cast("string"), F.lit(".xml'>"))
    news = F.concat(*[F.concat(F.lit(f'<a href="/news/{i}/'), k.cast("string"), F.lit('">n</a>')) for i in range(3)])
    return t("pages").select("page_id", F.concat(F.when(k % 2 == 0, link).otherwise(""), F.when(k % 3 == 0, news).otherwise(""), "html").alias("body"))


@query
def feed_link_discovery(t):
    links = html.feed_links(F.col("body"))
    return linked_pages(t).where(F.size(links) > 0).select("page_id", F.element_at(links, 1).alias("feed"))


@query
def press_candidate(t):
    return linked_pages(t).where(discovery.is_press_page(F.col("body"))).select("page_id")


@query
def body_extract(t):
    return t("pages").select("page_id", html.body_text_udf("html").alias("body"))


@query
def card_extract(t):
    c = t("pages").select("page_id", F.explode(html.cards_udf("html", F.lit("example.com"))).alias("c"))
    return c.select("page_id", "c.ord", "c.title", "c.url", F.date_format(dates.date_cascade(F.col("c.time_attr"), F.col("c.text"), F.col("c.href")), "yyyy-MM-dd").alias("day"))


@query
def llm_batches(t):
    b = model_stage.batches(t("documents").select("doc_id"), ["doc_id"], CLASSIFY_BATCH)
    return b.groupBy("batch").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.max("pos").alias("last_pos"))


@query
def prompt_render(t):
    b = model_stage.batches(t("documents").select("doc_id", "source", "text"), ["doc_id"], CLASSIFY_BATCH)
    p = model_stage.prompts(b, model_stage.article_line(F.col("pos"), F.col("source"), F.col("text")), "Classify these items:\n")
    return p.select("batch", "n", F.sha2("prompt", 256).alias("sha"))


def replies(t: Read) -> DataFrame:
    """A reply for each order, in the forms that models give."""
    k = F.col("o_orderkey")
    kind = F.when(k % 4 == 0, "none").when(k % 4 == 1, "corporate_carveout").when(k % 4 == 2, "portco_carveout").otherwise("merger")
    obj = F.concat(F.lit('{"deal_type": "'), kind, F.lit('", "stage": "'), F.when(k % 3 == 0, "signing").otherwise("rumour"), F.lit('", "confidence": '), (k % 101).cast("string"), F.lit(', "tags": [1, [2]], "seller": "S'), F.col("o_custkey").cast("string"), F.lit('"}'))
    reply = F.when(k % 5 == 0, F.concat(F.lit("```json\n["), obj, F.lit("]\n```"))).when(k % 5 == 1, F.concat(F.lit("Here: ["), obj, F.lit("] done [x]"))).when(k % 5 == 2, F.lit("nothing")).when(k % 5 == 3, F.concat(F.lit("["), obj)).otherwise(F.concat(F.lit("["), obj, F.lit("]")))
    return t("orders").select("o_orderkey", reply.alias("reply"))


@query
def llm_result_parse(t):
    parsed = replies(t).select("o_orderkey", F.get(F.from_json(model_json.json_array(F.col("reply")), model_json.ANSWER), F.lit(0)).alias("a"))
    return parsed.select("o_orderkey", model_json.deal_type(F.col("a.deal_type")).alias("deal_type"), model_json.stage(F.col("a.stage")).alias("stage"), F.coalesce(model_json.whole(F.col("a.confidence")), F.lit(0)).alias("confidence"), F.coalesce("a.seller", F.lit("")).alias("seller"))


def alerts(t: Read) -> DataFrame:
    """Orders as alerts, with sub-scores."""
    k = F.col("o_orderkey")
    seller = F.when(k % 11 == 0, "  ").when(k % 11 == 1, "Unknown parent").when(k % 11 == 2, "n/a").otherwise(F.concat(F.lit("Seller "), (k % 40).cast("string")))
    return t("orders").select(
        k.alias("ord"), F.concat(F.lit(" Deal "), k.cast("string"), F.lit(" ")).alias("title"), F.concat(F.lit("https://x.example.com/"), k.cast("string")).alias("url"), F.col("o_orderdate").alias("published"),
        F.when(k % 3 == 0, "corporate_carveout").when(k % 3 == 1, "portco_carveout").alias("deal_type"), (k % 3 != 2).alias("is_carveout"), F.when(F.col("o_orderstatus") == "O", "signing").when(F.col("o_orderstatus") == "F", "closing").alias("stage"),
        F.concat(F.lit("Target "), (k % 17).cast("string")).alias("target_company"), seller.alias("seller"), F.when(k % 2 == 0, "").otherwise("Buyer").alias("buyer"), F.lit("because").alias("reasoning"), (k % 101).cast("int").alias("confidence"),
        (k % 97).cast("int").alias("raw_fit"), F.when(k % 13 != 0, (k % 10).cast("int")).alias("pe_buyer"), (k % 7).cast("int").alias("separation_complexity"), F.col("o_orderpriority").alias("firm_name"), F.lit("").alias("pe_firm"),
    )


@query
def alert_filter(t):
    return filters.alerts_to_score(alerts(t)).select("ord", "deal_type", "seller", "confidence")


def scored(t: Read) -> DataFrame:
    fit, action = scoring.capped(F.col("raw_fit"), scoring.action_from_fit(F.col("raw_fit")), F.col("pe_buyer"), F.col("separation_complexity"))
    return alerts(t).withColumns({"fit": fit, "recommended_action": action})


@query
def fit_score_caps(t):
    return scored(t).select("ord", "fit", F.col("recommended_action").alias("action"))


@query
def action_counts(t):
    return filters.action_counts(scored(t))


@query
def sink_projection(t):
    return sink.project(filters.actionable(scored(t)))


@query
def csv_export(t):
    return sink.csv_rows(alerts(t))


@query
def cost_report(t):
    d = t("documents").select(F.floor(F.col("n_chars") / 4).alias("tokens_in"), F.floor(F.col("n_chars") / 40).alias("tokens_out"))
    return model_stage.usage(d).withColumn("cost", F.round("cost", 6))


@query
def backtest_by_type(t):
    p = alerts(t).where("deal_type is not null")
    return p.groupBy("deal_type").agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


@query
def targets_fill_nulls(t):
    found = t("supplier").where("s_suppkey % 2 = 0").select(F.col("s_name").alias("name"), F.concat(F.lit("https://found/"), F.col("s_suppkey").cast("string")).alias("url"))
    return discovery.fill_urls(firm_rows(t), found, "press_url").select("name", "press_url")


@query
def discovery_counts(t):
    found = t("supplier").where("s_suppkey % 5 = 0").select(F.col("s_name").alias("name"), F.lit("https://found").alias("url"))
    return discovery.counts(firm_rows(t), found)


@query
def first_valid_candidate(t):
    c = discovery.press_candidates(firm_rows(t))
    return discovery.first_valid(c, c.where((F.length("name") + F.col("priority") * 7 + F.length("url")) % 5 == 0).select("url"))


@query
def scale_workers(t):
    return t("nation").groupBy("n_regionkey").agg(F.count("*").alias("n")).select("n_regionkey", scoring.scale_workers(F.col("n") * (F.col("n_regionkey") * 20)).alias("workers"))


@query
def mini_scan(t):
    """The scan's relational core: union, distinct, unseen, filters, fold, caps, actions."""
    a = scored(t)
    first = dedup.keep_first(a, ["url"], ["published", "ord"])
    new = dedup.unseen(first, first.where("ord % 9 = 0").select("url"))
    good = filters.alerts_to_score(new).withColumns({"target": F.col("target_company")})
    folded = dedup.fold_repeats(good, ["stage"]).select("ord")
    kept = good.join(folded, "ord", "left_semi")
    return kept.groupBy("stage", "recommended_action").agg(F.count("*").alias("n"), F.max("fit").alias("best"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(f):
        return lambda spark, sf_dir: f(lambda name: _ntz(spark.read.parquet(f"{sf_dir}/{name}.parquet")))

    return {name: bind(f) for name, f in QUERIES.items()}


def _ntz(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, whichever way the file holds them."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}) if any(isinstance(f.dataType, T.TimestampType) for f in df.schema.fields) else df
